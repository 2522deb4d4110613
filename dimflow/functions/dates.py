"""Date arithmetic, sentinels and date parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.keys import Col, _c

# End date of an open version, first date of an undated one.
OPEN_END = dt.date(9999, 12, 31)
UNDATED = dt.date(1900, 1, 1)

LEVELS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
}


def open_end() -> Column:
    return F.lit(OPEN_END)


def day_before(col: Col) -> Column:
    return F.date_sub(_c(col), 1)


def day_after(col: Col) -> Column:
    return F.date_add(_c(col), 1)


def date_key(col: Col) -> Column:
    """Date as a yyyyMMdd number."""
    return F.date_format(_c(col), "yyyyMMdd").cast("int")


def batch_id(now: dt.datetime | None = None) -> Column:
    """Run stamp as a yyyyMMddHHmmss number; pass ``now`` to make a run repeatable."""
    if now is not None:
        return F.lit(int(now.strftime("%Y%m%d%H%M%S")))
    return F.date_format(F.current_timestamp(), "yyyyMMddHHmmss").cast("long")


def _strict(fn, cols: tuple[Col, ...]) -> Column:
    cols = [_c(c) for c in cols]
    known = cols[0].isNotNull()
    for c in cols[1:]:
        known = known & c.isNotNull()
    return F.when(known, fn(*cols))


def greatest_strict(*cols: Col) -> Column:
    """``greatest`` that is null when any input is."""
    return _strict(F.greatest, cols)


def least_strict(*cols: Col) -> Column:
    return _strict(F.least, cols)


def add_date_parts(
    df: DataFrame, col: str, fmt: str | None = None, levels: tuple[str, ...] = ("year", "month", "day")
) -> DataFrame:
    """Add one integer column per level, parsed from a text or date column."""
    if col not in df.columns:
        raise ValueError(f"no column {col!r} to take date parts from")
    unknown = [lv for lv in levels if lv not in LEVELS]
    if unknown:
        raise ValueError(f"unknown date levels {unknown}")
    ts = F.to_timestamp(F.col(col)) if fmt is None else F.to_timestamp(F.col(col), fmt)
    return df.withColumns({lv: LEVELS[lv](ts) for lv in levels})
