"""Projections, filters, set operations, aggregates and reshaping."""

from __future__ import annotations

import re
import datetime as dt

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimflow.functions.dates import batch_id

# -- projections -------------------------------------------------------------


def rename_map(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keep the mapped columns only, under their new names."""
    return df.select([F.col(src).alias(dst) for src, dst in names.items()])


def star_except(df: DataFrame, *dropped: str) -> DataFrame:
    return df.drop(*dropped)


def columns_except(df: DataFrame, *dropped: str) -> list[str]:
    """Column list for a row hash: everything but keys and bookkeeping."""
    skip = {c.lower() for c in dropped}
    return [c for c in df.columns if c.lower() not in skip]


def stamp(df: DataFrame, rec_src: str, now: dt.datetime | None = None) -> DataFrame:
    """Record source and the batch numbers of insert and last update."""
    return df.withColumns(
        {"rec_src": F.lit(rec_src), "ins_batch_id": batch_id(now), "upd_batch_id": batch_id(now)}
    )


def stamp_file(df: DataFrame, load_date: dt.date | str) -> DataFrame:
    """Source file and load date; ``df`` must come straight from a file source."""
    return df.select(
        "*", F.col("_metadata.file_path").alias("raw_filename"), F.lit(load_date).cast("date").alias("load_date")
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Common shape: listed columns in order, cast, null where absent."""
    have = {c.lower() for c in df.columns}
    return df.select(
        [
            (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def null_out(df: DataFrame, when: Column, cols: list[str]) -> DataFrame:
    """Make columns null on the rows where a condition holds."""
    return df.withColumns({c: F.when(when, None).otherwise(F.col(c)) for c in cols})


def apply_corrections(df: DataFrame, rules: list[tuple[str, Column, object]]) -> DataFrame:
    """Replace single values: (column, predicate, new value), in order."""
    for col, predicate, value in rules:
        new = value if isinstance(value, Column) else F.lit(value)
        df = df.withColumn(col, F.when(predicate, new.cast(df.schema[col].dataType)).otherwise(F.col(col)))
    return df


# -- filters -----------------------------------------------------------------


def live_rows(df: DataFrame, flag: str = "expirationdate", live: object = 0, drop: tuple[str, ...] = ()) -> DataFrame:
    """Rows not soft-deleted, without the source's bookkeeping columns."""
    return df.filter(F.col(flag) == live).drop(flag, *drop)


def is_recent(stamp: Column, days: int, today: dt.date) -> Column:
    """Whether a text stamp (yyyymmdd…) lies within the last ``days`` days; null where it is no date."""
    stamped = F.try_to_date(F.substring(stamp.cast("string"), 1, 8), "yyyyMMdd")
    return stamped >= F.lit(today - dt.timedelta(days=days))


def keep_recent(df: DataFrame, col: str, days: int, today: dt.date) -> DataFrame:
    """Rows whose text stamp (yyyymmdd…) lies within the last ``days`` days."""
    return df.filter(is_recent(F.col(col), days, today))


def not_at_maximum(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value differs from the table's maximum."""
    return df.filter(F.col(col) != df.agg(F.max(col)).scalar())


def changes_only(df: DataFrame, value: str = "current_value", prior: str = "prior_value") -> DataFrame:
    return df.filter(F.col(prior).isNull() | (F.col(value) != F.col(prior)))


# -- set operations ----------------------------------------------------------


def union_extracts(*dfs: DataFrame) -> DataFrame:
    """Distinct union by column name."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df)
    return out.distinct()


def append_rows(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """Add literal rows (unknown member, manual corrections) in the table's schema."""
    return df.unionByName(df.sparkSession.createDataFrame([Row(*r) for r in rows], df.schema))


# -- aggregates --------------------------------------------------------------


def min_max_dates(df: DataFrame, keys: list[str], eff: str, disc: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(eff).alias(eff), F.max(disc).alias(disc))


def sum_as_text(df: DataFrame, keys: list[str], col: str, name: str, scale: int = 2) -> DataFrame:
    """Exact decimal sum, delivered as text."""
    total = F.sum(F.col(col).cast(f"decimal(18,{scale})"))
    return df.groupBy(*keys).agg(total.cast("string").alias(name))


def having_count(df: DataFrame, keys: list[str], *, more_than: int | None = None, equal: int | None = None):
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > more_than if equal is None else F.col("n") == equal)


def having_distinct(df: DataFrame, keys: list[str], col: str, more_than: int, name: str = "n_distinct"):
    """Keys with more than so many distinct values; exact."""
    pairs = df.select(*keys, col).distinct()
    return pairs.groupBy(*keys).agg(F.count(col).alias(name)).filter(F.col(name) > more_than)


def distinct_values(df: DataFrame, keys: list[str], col: str, name: str) -> DataFrame:
    """Sorted array of the distinct values of a key.

    Meant for columns of few distinct values: duplicates are removed before the
    shuffle, so a key's array is bounded by the column's domain, not its rows.
    """
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(col)).alias(name))


def profile_types(df: DataFrame, json_col: str) -> DataFrame:
    """For each key of a JSON object column, the value types seen."""
    seen = df.select(json_col).lateralJoin(
        df.sparkSession.tvf.variant_explode(F.parse_json(F.col(json_col).outer()))
    )
    pairs = seen.select(F.col("key").alias("field"), F.schema_of_variant("value").alias("type")).distinct()
    return pairs.groupBy("field").agg(F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"))


def size_report(df: DataFrame) -> DataFrame:
    """Row count and total serialized size in bytes."""
    text = F.to_json(F.struct(*df.columns))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n_bytes")
    )


# -- reshaping ---------------------------------------------------------------


def unpivot_attrs(
    df: DataFrame, ids: list[str], attrs: list[str], name: str = "change_column", value: str = "current_value"
) -> DataFrame:
    """Wide to tall, values as text; a null attribute gives no row.

    Written as an exploded array of pairs rather than as an unpivot: the rows
    stay in the partition they are in, so a table that is partitioned by its
    ids needs no second shuffle for the windows that follow.
    """
    pairs = F.array(*[F.struct(F.lit(a).alias(name), F.col(a).cast("string").alias(value)) for a in attrs])
    known = F.filter(pairs, lambda p: p[value].isNotNull())
    return df.select(*ids, F.inline(known))


def explode_list(df: DataFrame, col: str, sep: str = ";", out: str | None = None) -> DataFrame:
    """One row per trimmed piece of a list delimited by the whole of ``sep``; a null list gives none."""
    pieces = F.split(F.col(col), re.escape(sep))
    return df.withColumn(out or col, F.explode(pieces)).withColumn(out or col, F.trim(F.col(out or col)))


def explode_path(df: DataFrame, path: str, member: str, level: str = "level") -> DataFrame:
    """One row per member of a path array, levels counted from 1."""
    others = [c for c in df.columns if c != path]
    out = df.select(*others, F.posexplode(path).alias("__pos", member))
    return out.withColumn(level, F.col("__pos") + 1).drop("__pos")
