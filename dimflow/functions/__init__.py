"""Column helpers. Each takes and returns Columns; none is a Python UDF."""

from dimflow.functions.convert import (
    canonical_code,
    flag,
    int_to_date_or_default,
    mask_when,
    parse_ts14,
    parse_yyyymmdd,
    prefer,
    stringify,
    to_bool_or_false,
    to_decimal,
    to_int_or_null,
)
from dimflow.functions.dates import (
    OPEN_END,
    add_date_parts,
    batch_id,
    date_key,
    day_after,
    day_before,
    greatest_strict,
    least_strict,
    open_end,
)
from dimflow.functions.keys import row_hash, surrogate_key
from dimflow.functions.text import (
    after_colon,
    all_ids,
    any_of,
    correct_cost_center,
    cost_center_code,
    distinct_ids,
    first_id,
    first_token,
    single_or_null,
    split_part_safe,
    strip_code_prefix,
    strtok,
    tagged_value,
)
from dimflow.functions.udfs import register_functions

__all__ = [name for name in dir() if not name.startswith("_")]
