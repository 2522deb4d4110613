"""Defaulting conversions between text, numbers, dates and flags."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.dates import UNDATED
from dimflow.functions.keys import Col, _c

# Limits and sentinels of the yyyymmdd conversion.
NO_DATE_TEXT = "99999999"
FIRST_DATE = dt.date(1700, 1, 1)
LAST_DATE = dt.date(4000, 12, 30)
PLACEHOLDER_DATE = dt.date(1940, 1, 1)

# Text forms of a missing value.
NULL_TOKENS = ("nan", "<NA>", "null", "None", "NaT")


def parse_yyyymmdd(col: Col) -> Column:
    """yyyymmdd text or number to a date.

    '99999999' is the lower limit; missing, ill-formed and placeholder values
    are 1900-01-01; the rest is clamped to the two limits.
    """
    text = _c(col).cast("string")
    parsed = F.try_to_date(text, "yyyyMMdd")
    undated = F.lit(UNDATED)
    return (
        F.when(text == NO_DATE_TEXT, F.lit(FIRST_DATE))
        .when(text.isNull() | (F.length(text) != 8) | parsed.isNull(), undated)
        .when(parsed == F.lit(PLACEHOLDER_DATE), undated)
        .otherwise(F.least(F.greatest(parsed, F.lit(FIRST_DATE)), F.lit(LAST_DATE)))
    )


def int_to_date_or_default(col: Col) -> Column:
    """yyyymmdd number to a date, 1900-01-01 when it is none."""
    text = F.substring(_c(col).cast("string"), 1, 8)
    return F.coalesce(F.try_to_date(text, "yyyyMMdd"), F.lit(UNDATED))


def parse_ts14(col: Col) -> Column:
    """yyyymmddhhmmss text to a timestamp."""
    return F.try_to_timestamp(F.substring(_c(col), 1, 14), F.lit("yyyyMMddHHmmss"))


def to_bool_or_false(col: Col) -> Column:
    return F.coalesce(_c(col).cast("string").try_cast("boolean"), F.lit(False))


def to_int_or_null(col: Col) -> Column:
    return _c(col).cast("string").try_cast("decimal(38,0)")


def to_decimal(col: Col, precision: int, scale: int) -> Column:
    """Strict cast: a value out of range is an error, not a null."""
    return _c(col).cast(f"decimal({precision},{scale})")


def canonical_code(col: Col) -> Column:
    """Numeric code without leading zeros, as text."""
    return _c(col).cast("int").cast("string")


def flag(cond: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is unknown)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def prefer(first: Col, *others: Col) -> Column:
    """First source's trimmed non-empty text, else the next source's value."""
    return F.coalesce(F.nullif(F.trim(_c(first)), F.lit("")), *[_c(o) for o in others])


def mask_when(value: Col, by: Col, sensitive: list[str], masked: Column | None = None) -> Column:
    """Mask a value when its sibling column names a sensitive attribute."""
    hidden = F.lit("*****") if masked is None else masked
    return F.when(_c(by).isin(sensitive) & _c(value).isNotNull(), hidden).otherwise(_c(value))


def stringify(df: DataFrame, null_tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """All columns as text, with the text forms of a missing value made null."""
    text = {c: F.col(f"`{c}`").cast("string") for c in df.columns}
    return df.select([F.when(~t.isin(*null_tokens), t).alias(c) for c, t in text.items()])
