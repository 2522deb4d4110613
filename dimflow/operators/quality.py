"""Checks, de-duplication, key sequences, reconciliation and masking."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.operators.windows import latest_per_key
from dimflow.session import stage_table


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns with nulls, and how many, from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "n_nulls").filter(F.col("n_nulls") > 0)


def require_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Same rows; the job fails on the first null in a listed column.

    The check rides on the columns themselves, so it costs no extra scan.
    """
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"null in {c}")).cast(df.schema[c].dataType)) for c in cols}
    )


def dedupe_intervals(df: DataFrame, sk: str, eff: str = "eff_dt", disc: str = "disc_dt") -> DataFrame:
    """Of the rows of one key and start date, the one that ends last; ties by row content."""
    others = [c for c in df.columns if c not in (sk, eff, disc)]
    return latest_per_key(df, [sk, eff], [F.col(disc).desc(), *others])


def append_sequence(new: DataFrame, target: DataFrame | None, key: str, by: list[str]) -> DataFrame:
    """Number new rows densely in the order of ``by``, continuing after the target's largest key.

    Rows are sorted over range partitions and stored; a row's number is its place in its
    partition and the sizes of the partitions before it, one row each. ``by`` must
    identify a row, which also makes the numbers repeatable.
    """
    start = target.agg(F.max(key)).first()[0] if target is not None else None
    rows = new.select([c for c in new.columns if c != key or c in by])
    ranked = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    ranked = stage_table(ranked.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part, row = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = ranked.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    numbered = ranked.withColumn("__part", part).join(offsets, "__part")
    number = F.lit(int(start or 0)) + F.col("__off") + row + 1
    return numbered.select(number.alias(key), *[c for c in new.columns if c != key])


def reconcile(source_rows: int, written: int, rejected: int = 0) -> None:
    if source_rows != written + rejected:
        raise ValueError(f"{source_rows} rows read, but {written} written and {rejected} rejected")


def reconcile_tables(source: DataFrame, out: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row with the three counts and whether they add up."""
    counts = source.agg(F.count(F.lit(1)).alias("n_source"))
    for name, df in (("n_out", out), ("n_rejected", rejected)):
        counts = counts.withColumn(name, df.agg(F.count(F.lit(1))).scalar())
    return counts.withColumn("balanced", F.col("n_source") == F.col("n_out") + F.col("n_rejected"))


# -- masking -----------------------------------------------------------------

# What a fully masked text and a fully masked date become.
MASKED_TEXT = "*****"
MASKED_DATE = dt.date(1900, 1, 1)


def mask_string_full(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(MASKED_TEXT))


def mask_string_partial(c: Column, keep: int = 4) -> Column:
    """Stars for all but the last characters; values no longer than those are all stars."""
    hidden = F.greatest(F.length(c) - keep, F.lit(0))
    tail = F.when(F.length(c) > keep, F.right(c, F.lit(keep))).otherwise(F.repeat(F.lit("*"), F.length(c)))
    return F.concat(F.repeat(F.lit("*"), hidden), tail)


def mask_date_full(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(MASKED_DATE))


def mask_date_partial(c: Column) -> Column:
    """Keep the year."""
    return F.trunc(c, "YEAR")


POLICIES = {
    "string_full": mask_string_full,
    "string_partial": mask_string_partial,
    "date_full": mask_date_full,
    "date_partial": mask_date_partial,
}


def apply_masks(df: DataFrame, policies: dict[str, str]) -> DataFrame:
    """Mask columns, ``{column: policy name}``."""
    return df.withColumns({c: POLICIES[p](F.col(c)) for c, p in policies.items()})


def masks_by_suffix(columns: list[str], suffixes: dict[str, str]) -> dict[str, str]:
    """Policies for columns chosen by name ending, e.g. ``{"_pii": "string_full"}``."""
    return {c: p for c in columns for end, p in suffixes.items() if c.lower().endswith(end)}


