"""Incremental runs: what to read again, and when a run is a first one."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.functions.keys import surrogate_key
from dimflow.operators.joins import UNKNOWN
from dimflow.sources.sinks import path_exists, write_full


def run_mode(spark: SparkSession, path: str, full_refresh: bool = False, *, protect: bool = False) -> str:
    """'first', 'full' or 'incremental'; a protected table is never rebuilt."""
    if not path_exists(spark, path):
        return "first"
    return "full" if full_refresh and not protect else "incremental"


def backfill_once(spark: SparkSession, path: str, history: Callable[[], DataFrame]) -> bool:
    """Write a one-off history load, but only where the target does not exist yet."""
    if run_mode(spark, path) != "first":
        return False
    write_full(history(), path)
    return True


def unresolved(target: DataFrame, sk_cols: list[str]):
    return reduce(lambda a, b: a | b, [F.col(c) == UNKNOWN for c in sk_cols])


def incremental_facts(
    stage: DataFrame,
    target: DataFrame | None,
    pk: str,
    event_col: str,
    sk_cols: list[str],
    *,
    target_event_col: str | None = None,
    pk_cols: list[str] | None = None,
) -> DataFrame:
    """Stage rows to load: new events, and every row whose fact still lacks a key.

    ``stage`` must carry the fact's primary key under the name ``pk``, or else have the
    columns ``pk_cols`` that it is the surrogate key of: then it isn't shuffled, and rows
    have it only if they met the unresolved keys, by which they lie. One small
    job reads the mark and the oldest unresolved date; the older of the two is
    pushed to the scan, which is read once. The list of unresolved keys joins
    as a flag, so no union and no distinct is needed.
    """
    if target is None:
        return stage
    at = target_event_col or event_col
    open_keys = unresolved(target, sk_cols)
    mark, oldest, undated = target.agg(
        F.max(at), F.min(F.when(open_keys, F.col(at))), F.count_if(open_keys & F.col(at).isNull())
    ).first()
    if mark is None:
        return stage
    kind = stage.schema[event_col].dataType
    new = F.col(event_col) >= F.lit(mark).cast(kind)
    if oldest is None and not undated:
        return stage.filter(new)
    retry = target.filter(open_keys).select(pk).distinct().withColumn("__retry", F.lit(True))
    rows = stage
    if not undated:
        rows = rows.filter(F.col(event_col) >= F.lit(min(mark, oldest)).cast(kind))
    if pk in stage.columns or not pk_cols:
        return rows.join(retry, pk, "left").filter(new | F.col("__retry")).drop("__retry")
    own = surrogate_key(*pk_cols)
    retry = retry.withColumnRenamed(pk, "__open")
    met = rows.join(retry, own == F.col("__open"), "left")
    return met.filter(new | F.col("__retry")).drop("__open", "__retry").withColumn(pk, own)


def new_entities(stage: DataFrame, target: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Stage rows whose key tuple is absent from the target, whatever their date."""
    known = target.select([F.col(t).alias(s) for s, t in keys.items()]).distinct()
    return stage.join(known, list(keys), "left_anti")
