"""Landing jobs: time-clock CSV, JSON reports, relational extracts."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimflow.functions.convert import stringify
from dimflow.functions.dates import add_date_parts
from dimflow.operators.quality import reconcile
from dimflow.operators.reshape import is_recent, keep_recent, size_report, stamp_file
from dimflow.sources.readers import read_jdbc, read_landing_csv, read_report_json
from dimflow.sources.sinks import (
    MEGABYTE,
    append_audit,
    export_parquet,
    path_exists,
    set_run_status,
    write_json_chunks,
    write_partitioned,
)

RETENTION_DAYS = 30


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def timeclock_rows(
    df: DataFrame,
    *,
    time_col: str,
    partition_col: str,
    fmt: str | None,
    levels: tuple[str, ...],
    today: dt.date,
    days: int = RETENTION_DAYS,
) -> DataFrame:
    """Recent rows, with date parts, every column as text."""
    dated = add_date_parts(df, partition_col, fmt, levels)
    return stringify(keep_recent(dated, time_col, days, today))


def ingest_timeclock(
    spark: SparkSession,
    path: str | list[str],
    out: str,
    audit: str,
    *,
    time_col: str,
    partition_col: str | None = None,
    fmt: str | None = None,
    levels: tuple[str, ...] = ("year", "month", "day"),
    today: dt.date,
    days: int = RETENTION_DAYS,
    schema: StructType | None = None,
) -> dict:
    """CSV landing to partitioned parquet, with an audit row.

    Rows older than the retention are dropped. Read and rejected rows, the latter by
    their own predicate, are observed while the one job writes; written rows are
    counted in the files. The three must add up.
    """
    start = utc_now()
    load_date = today
    raw = stamp_file(read_landing_csv(spark, path, schema=schema), load_date)
    seen = Observation("read")
    recent = is_recent(F.col(time_col), days, today)
    rows = timeclock_rows(
        raw.observe(
            seen,
            F.count(F.lit(1)).alias("n"),
            F.count_if(~F.coalesce(recent, F.lit(False))).alias("old"),
        ),
        time_col=time_col,
        partition_col=partition_col or time_col,
        fmt=fmt,
        levels=levels,
        today=today,
        days=days,
    )
    n_before = spark.read.parquet(out).count() if path_exists(spark, out) else 0
    write_partitioned(rows, out, list(levels))
    n_read, n_old = seen.get["n"], seen.get["old"]
    n_kept = spark.read.parquet(out).count() - n_before
    report = {
        "run_key": uuid.uuid4().hex,
        "job": "timeclock",
        "source_name": path if isinstance(path, str) else ",".join(path),
        "target_name": out,
        "source_rows": n_read,
        "insert_rows": n_kept,
        "rejected_rows": n_old,
        "start_tmsp": start,
        "end_tmsp": utc_now(),
        "status": "SUCCESS",
    }
    reconcile(n_read, n_kept, report["rejected_rows"])
    append_audit(spark, audit, report)
    return report


def land_report(
    spark: SparkSession,
    path: str,
    out: str,
    audit: str,
    *,
    run_key: str,
    root: str = "Report_Entry",
    schema: StructType | None = None,
    max_mb: float = 10,
) -> dict:
    """JSON report to bounded chunk files, with audit row and run status.

    An empty report writes no file and is a success.
    """
    start = utc_now()
    report = {"run_key": run_key, "job": "report", "source_name": path, "target_name": out, "start_tmsp": start}
    try:
        rows = read_report_json(spark, path, root, schema)
        sized = size_report(rows).first() if rows.columns else {"n_rows": 0, "n_bytes": 0}
        n, mb = sized["n_rows"], round(sized["n_bytes"] / MEGABYTE, 2)
        written = 0
        if n:
            chunks = write_json_chunks(rows, out, max_mb, root=root)
            written = chunks.agg(F.sum("n_records")).first()[0]
        reconcile(n, written)
        report |= {"source_rows": n, "insert_rows": written, "rejected_rows": 0, "size_mb": mb, "end_tmsp": utc_now()}
        append_audit(spark, audit, {**report, "status": "RUNNING"})
        set_run_status(spark, audit, run_key, "SUCCESS")
        return {**report, "status": "SUCCESS"}
    except Exception:
        append_audit(spark, audit, {**report, "end_tmsp": utc_now(), "status": "FAILED"})
        raise


def export_table(spark: SparkSession, url: str, table: str, path: str, *, codec: str = "gzip", **reader) -> dict:
    """Relational table to compressed parquet; returns row count and schema of the copy."""
    return export_parquet(read_jdbc(spark, url, table, **reader), path, codec)
