"""Text helpers: tokens, code fields and ids mined from free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimflow.functions.keys import Col, _c

# Id forms looked for in free text. Where one form begins
# another, the longer one comes first, since the first alternative that fits wins.
REQUISITION_IDS = (
    "R-[0-9]{7}",
    "R-[0-9]{6}",
    "R_[0-9]{5}BR_[0-9]{2}",
    "R_[0-9]{5}BR_EVRGRN",
    "R_[0-9]{7}",
    "R_[0-9]{6}",
)
POSITION_IDS = (
    "P_[0-9]{10}",
    "P_[0-9]{9}",
    "P_[0-9]{8}",
    "P-[0-9]{10}",
    "P-[0-9]{9}",
    "P-[0-9]{8}",
)


def any_of(patterns: tuple[str, ...]) -> str:
    return "|".join(patterns)


def first_token(col: Col) -> Column:
    """Text up to the first blank of the trimmed value; '' when there is none."""
    c = _c(col)
    return F.trim(F.substring(c, F.lit(1), F.locate(" ", F.trim(c))))


def after_colon(col: Col, n: int = 10) -> Column:
    """Up to ``n`` characters that follow the first ':', trimmed."""
    c = _c(col)
    return F.trim(F.substring(c, F.locate(":", F.trim(c)) + 1, F.lit(n)))


def split_part_safe(col: Col, delim: str, n: int) -> Column:
    """``split_part`` where part 0 means part 1."""
    return F.split_part(_c(col), F.lit(delim), F.lit(n or 1))


def strtok(col: Col, delim: str, n: int) -> Column:
    """The n-th non-empty token; each character of ``delim`` separates; null when short."""
    cls = "[" + "".join("\\" + ch if not ch.isalnum() else ch for ch in delim) + "]"
    tokens = F.filter(F.split(_c(col), cls), lambda t: t != "")
    return F.try_element_at(tokens, F.lit(n))


def cost_center_code(col: Col) -> Column:
    """'CC_' and the three trimmed parts of 'a-b-c'."""
    c = _c(col)
    return F.concat(F.lit("CC_"), *[F.trim(F.split_part(c, F.lit("-"), F.lit(i))) for i in (1, 2, 3)])


def correct_cost_center(col: Col, default: str | None = None) -> Column:
    """Zero the middle block (characters 8-11) of a code when it sorts below '1000' or is 'ARCH'.

    The comparison is on text. A null code becomes ``default``.
    """
    c = _c(col)
    block = F.trim(F.substring(c, 8, 4))
    zeroed = F.concat(F.substring(c, 1, 7), F.lit("0000"), F.substr(c, F.lit(12)))
    return F.when(c.isNull(), F.lit(default)).when((block < "1000") | (block == "ARCH"), zeroed).otherwise(c)


def strip_code_prefix(col: Col) -> Column:
    """Drop a leading four-character code from a value that starts with a digit."""
    c = _c(col)
    return F.when(c.rlike("^[0-9]"), F.trim(F.substr(c, F.lit(5)))).otherwise(c)


def tagged_value(col: Col, tag: str, end: str = ";") -> Column:
    """The value after ``tag`` up to ``end`` in a tagged list; null when the tag is absent."""
    c = _c(col)
    found = F.split_part(F.split_part(c, F.lit(tag), F.lit(2)), F.lit(end), F.lit(1))
    return F.when(F.instr(F.upper(c), tag.rstrip("/").upper()) > 0, found)


def first_id(col: Col, pattern: str) -> Column:
    return F.regexp_substr(_c(col), F.lit(pattern))


def all_ids(col: Col, patterns: tuple[str, ...]) -> Column:
    return F.regexp_extract_all(F.upper(_c(col)), F.lit(any_of(patterns)), F.lit(0))


def distinct_ids(cols: list[Col], patterns: tuple[str, ...]) -> Column:
    """Sorted distinct ids found in any of the text columns of a row.

    Row-local: the matches never leave their row, so nothing is shuffled.
    """
    text = F.concat_ws(" ", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])
    return F.array_sort(F.array_distinct(all_ids(text, patterns)))


def single_or_null(arr: Col) -> Column:
    """The only element of an array, or null when it has none or several."""
    arr = _c(arr)
    return F.when(F.coalesce(F.size(arr), F.lit(0)) == 1, F.array_join(arr, ""))
