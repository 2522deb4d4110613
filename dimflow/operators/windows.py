"""Ordered-by-key operators: latest row, changes, validity intervals, fills.

``keyed_window`` is the one primitive that needs a whole key in order. Where a
key is bounded it is a Spark window. Where it isn't, the caller names slices of
the order, such as months: a task holds one slice of a key, and each slice
carries over what it needs from the slices before or after it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.functions.dates import day_before, open_end

Order = str | Column


@dataclass(frozen=True)
class Number:
    """1, 2, 3 … within the key."""


@dataclass(frozen=True)
class Lag:
    col: str


@dataclass(frozen=True)
class Lead:
    col: str


@dataclass(frozen=True)
class RunMax:
    """Largest value so far."""

    col: str


@dataclass(frozen=True)
class Carry:
    """Latest non-null value so far."""

    col: str


Spec = Number | Lag | Lead | RunMax | Carry


def _local(spec: Spec, w, running) -> Column:
    match spec:
        case Number():
            return F.row_number().over(w).cast("long")
        case Lag(c):
            return F.lag(c).over(w)
        case Lead(c):
            return F.lead(c).over(w)
        case RunMax(c):
            return F.max(c).over(running)
        case Carry(c):
            return F.last(c, ignorenulls=True).over(running)
    raise TypeError(spec)


def _plain(df: DataFrame, keys: list[str], order: list[Order], specs: dict[str, Spec]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({name: _local(spec, w, running) for name, spec in specs.items()})


def _sliced(df: DataFrame, keys: list[str], order: list[Order], specs: dict[str, Spec], slice_by: Column) -> DataFrame:
    stored = df.withColumn("__slice", slice_by)
    w = Window.partitionBy(*keys, "__slice").orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {f"__l_{n}": _local(s, w, running) for n, s in specs.items()}
    local["__first"] = F.row_number().over(w) == 1
    local["__last"] = F.lead(F.lit(1)).over(w).isNull()
    rows = stored.withColumns(local)

    # One row per key and slice, from which each slice's carry-in is derived.
    def at(mark: str, col: str) -> Column:
        return F.first(F.when(F.col(mark), F.struct(F.col(col).alias("v"))), ignorenulls=True)

    summary_cols = {}
    for name, spec in specs.items():
        match spec:
            case Number():
                summary_cols[name] = F.count(F.lit(1))
            case Lag(c):
                summary_cols[name] = at("__last", c)
            case Lead(c):
                summary_cols[name] = at("__first", c)
            case RunMax(c):
                summary_cols[name] = F.max(c)
            case Carry(_):
                summary_cols[name] = at("__last", f"__l_{name}")
    summary = rows.groupBy(*keys, "__slice").agg(*[c.alias(f"__s_{n}") for n, c in summary_cols.items()])
    by_slice = Window.partitionBy(*keys).orderBy("__slice")
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    carry = {}
    for name, spec in specs.items():
        s = F.col(f"__s_{name}")
        match spec:
            case Number():
                carry[f"__c_{name}"] = F.coalesce(F.sum(s).over(before), F.lit(0))
            case Lag(_):
                carry[f"__c_{name}"] = F.lag(s).over(by_slice)["v"]
            case Lead(_):
                carry[f"__c_{name}"] = F.lead(s).over(by_slice)["v"]
            case RunMax(_):
                carry[f"__c_{name}"] = F.max(s).over(before)
            case Carry(_):
                carry[f"__c_{name}"] = F.last(s["v"], ignorenulls=True).over(before)
    carried = summary.withColumns(carry).select(*keys, "__slice", *carry)

    on = F.col("l.__slice") == F.col("s.__slice")
    for k in keys:
        on = on & F.col(f"l.`{k}`").eqNullSafe(F.col(f"s.`{k}`"))
    joined = rows.alias("l").join(carried.alias("s"), on, "left")
    out = []
    for name, spec in specs.items():
        loc, car = F.col(f"l.__l_{name}"), F.col(f"s.__c_{name}")
        match spec:
            case Number():
                value = loc + car
            case Lag(_):
                value = F.when(F.col("l.__first"), car).otherwise(loc)
            case Lead(_):
                value = F.when(F.col("l.__last"), car).otherwise(loc)
            case RunMax(_):
                value = F.greatest(loc, car)
            case Carry(_):
                value = F.coalesce(loc, car)
        out.append(value.alias(name))
    return joined.select(*[F.col(f"l.`{c}`") for c in df.columns], *out)


def keyed_window(
    df: DataFrame,
    keys: list[str],
    order: list[Order],
    specs: dict[str, Spec],
    *,
    bounded: bool = False,
    slice_by: Column | None = None,
) -> DataFrame:
    """Add one column per spec, computed over each key in the given order.

    ``bounded=True`` states that a key cannot grow with the table, for instance
    because there is one row per key and day. Any other call names ``slice_by``,
    a value that never falls along ``order`` (the year of an ascending date, its
    negative for a descending one); a slice of a key is what one task holds.
    ``order`` must rank the rows of a key without ties for the result to be
    repeatable.
    """
    if bounded:
        return _plain(df, keys, order, specs)
    if slice_by is None:
        raise ValueError("an unbounded key needs slice_by")
    return _sliced(df, keys, order, specs, slice_by)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Order]) -> DataFrame:
    """First row of each key in the given order.

    Spark keeps one row per key and map task before the shuffle
    (WindowGroupLimit), so a key's size does not matter.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def version_number(df: DataFrame, keys: list[str], order: list[Order], name: str = "version", **kw) -> DataFrame:
    return keyed_window(df, keys, order, {name: Number()}, **kw)


def prior_value(df: DataFrame, keys: list[str], order: list[Order], col: str, name: str, **kw) -> DataFrame:
    return keyed_window(df, keys, order, {name: Lag(col)}, **kw)


def next_value(df: DataFrame, keys: list[str], order: list[Order], col: str, name: str, **kw) -> DataFrame:
    return keyed_window(df, keys, order, {name: Lead(col)}, **kw)


def running_max(df: DataFrame, keys: list[str], order: list[Order], cols: dict[str, str], **kw) -> DataFrame:
    """Running maxima, ``{new column: source column}``."""
    return keyed_window(df, keys, order, {n: RunMax(c) for n, c in cols.items()}, **kw)


def ffill_group(df: DataFrame, keys: list[str], order: list[Order], col: str, name: str, **kw) -> DataFrame:
    """Carry the latest non-null value forward.

    Same as numbering the non-null values and taking the one value of each
    number, in one pass instead of two.
    """
    return keyed_window(df, keys, order, {name: Carry(col)}, **kw)


def first_seen(df: DataFrame, attrs: list[str], date_col: str) -> DataFrame:
    """Earliest date of each distinct attribute tuple; a return to an old state is not seen."""
    return df.groupBy(*attrs).agg(F.min(date_col).alias(date_col))


def islands(
    df: DataFrame,
    keys: list[str],
    attrs: list[str],
    date_col: str,
    *,
    gap_days: int | None = None,
    bounded: bool = True,
) -> DataFrame:
    """First row of each run of equal attributes, so A, B, A gives three rows.

    Expects one row per key and date (see ``daily``). With ``gap_days`` a run
    also ends where the key is missing for more than that many days.
    """
    # The attributes are compared as a struct, which tells null from ''.
    hashed = df.withColumn("__h", F.struct(*attrs))
    specs = {"__prior": Lag("__h"), "__prior_dt": Lag(date_col)}
    marked = keyed_window(hashed, keys, [date_col], specs, bounded=bounded)
    starts = ~F.col("__prior").eqNullSafe(F.col("__h"))
    if gap_days is not None:
        starts = starts | (F.datediff(F.col(date_col), F.col("__prior_dt")) > gap_days)
    return marked.filter(starts).drop("__h", "__prior", "__prior_dt")


def daily(df: DataFrame, keys: list[str], date_col: str, order: list[Order] | None = None) -> DataFrame:
    """One row per key and date; bounds a key to the number of report dates."""
    tie = order or [F.xxhash64(*[c for c in df.columns if c not in keys + [date_col]])]
    return latest_per_key(df, [*keys, date_col], tie)


def close_intervals(
    df: DataFrame,
    keys: list[str],
    eff: str = "eff_dt",
    *,
    disc: str = "disc_dt",
    order: list[Order] | None = None,
    same_day: bool = True,
    current: str | None = "is_current",
    bounded: bool = True,
    slice_by: Column | None = None,
) -> DataFrame:
    """End date from the next start: the day before it, open when there is none.

    A successor on the same day leaves the version its start date as end
    (``same_day``); without that rule its end falls before its start.
    """
    nxt = keyed_window(df, keys, order or [eff], {"__next": Lead(eff)}, bounded=bounded, slice_by=slice_by)
    end = day_before("__next")
    if same_day:
        end = F.when(F.col("__next") == F.col(eff), F.col(eff)).otherwise(end)
    out = nxt.withColumn(disc, F.coalesce(end, open_end())).drop("__next")
    return out.withColumn(current, F.col(disc) == open_end()) if current else out


def disappeared(df: DataFrame, keys: list[str], date_col: str, name: str = "last_seen_dt") -> DataFrame:
    """Keys whose last date is before the feed's last date, with that last date."""
    last = df.groupBy(*keys).agg(F.max(date_col).alias(name))
    return last.filter(F.col(name) != last.agg(F.max(name)).scalar())
