"""Landing files as a stream: each new file is taken exactly once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dimflow.plans.landing import RETENTION_DAYS, timeclock_rows, utc_now
from dimflow.operators.quality import reconcile
from dimflow.operators.reshape import is_recent
from dimflow.sources.readers import ANY_CSV, refuse_other_files
from dimflow.sources.sinks import append_audit, by_partition, count_rows, has_audit


def ingest_landing_stream(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    *,
    schema: StructType,
    time_col: str,
    partition_col: str | None = None,
    fmt: str | None = None,
    levels: tuple[str, ...] = ("year", "month", "day"),
    today: dt.date,
    days: int = RETENTION_DAYS,
    audit: str | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Process all CSV files not seen before, in batches of ``max_files``, and stop.

    A batch is written under its own ``batch_id`` folder with overwrite, so a
    batch repeated after a failure replaces what it had written: every row is
    in the output once, and every batch has one audit row. Rejected rows are counted by
    their own predicate, written ones in the files; a batch that doesn't add up fails.
    A folder that holds a file of another format is refused before the start.
    """
    refuse_other_files(spark, source)
    recent = is_recent(F.col(time_col), days, today)
    stream = (
        spark.readStream.option("header", True)
        .option("pathGlobFilter", ANY_CSV)
        .option("maxFilesPerTrigger", max_files)
        .schema(schema)
        .csv(source)
        .select("*", F.col("_metadata.file_path").alias("raw_filename"))
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        start = utc_now()
        read = Observation()
        old = F.count_if(~F.coalesce(recent, F.lit(False))).alias("old")
        rows = timeclock_rows(
            batch.withColumn("load_date", F.lit(today)).observe(read, F.count(F.lit(1)).alias("n"), old),
            time_col=time_col,
            partition_col=partition_col or time_col,
            fmt=fmt,
            levels=levels,
            today=today,
            days=days,
        )
        target = f"{out.rstrip('/')}/batch_id={batch_id}"
        by_partition(rows, list(levels)).write.mode("overwrite").partitionBy(*levels).parquet(target)
        n_read, n_old = read.get["n"], read.get["old"]
        n_kept = count_rows(spark, target)
        reconcile(n_read, n_kept, n_old)
        run_key = f"{checkpoint}#{batch_id}"
        if audit is not None and not has_audit(spark, audit, run_key):
            append_audit(
                spark,
                audit,
                {
                    "run_key": run_key,
                    "job": "timeclock-stream",
                    "source_name": source,
                    "target_name": target,
                    "source_rows": n_read,
                    "insert_rows": n_kept,
                    "rejected_rows": n_old,
                    "start_tmsp": start,
                    "end_tmsp": utc_now(),
                    "status": "SUCCESS",
                },
            )

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
