"""Sinks: tables, partitioned and exported files, JSON chunks, swaps and audit rows."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from dimflow.operators.quality import dedupe_intervals
from dimflow.session import stage_table


def write_full(df: DataFrame, path: str) -> None:
    """Full rebuild. ``df`` must not read the path it replaces (see ``publish_swap``)."""
    df.write.mode("overwrite").parquet(path)


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def by_partition(df: DataFrame, parts: list[str]) -> DataFrame:
    """Rows of one partition value brought together, without overfilling a task.

    Else every task would write a small file into every folder. The rebalance
    hint lets adaptive execution split a value that holds much of the table
    over several tasks, and merge small ones, by measured size.
    """
    return df.hint("rebalance", *[F.col(p) for p in parts])


def write_partitioned(df: DataFrame, path: str, parts: list[str]) -> None:
    """Append parquet under one folder per value of the partition columns."""
    by_partition(df, parts).write.mode("append").partitionBy(*parts).parquet(path)


def export_parquet(df: DataFrame, path: str, codec: str = "gzip") -> dict:
    """Write compressed parquet and report what a reader of it finds."""
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    back = df.sparkSession.read.parquet(path)
    return {"path": path, "num_rows": back.count(), "schema": back.schema.simpleString()}


def export_csv(df: DataFrame, path: str, sort_cols: list[str]) -> None:
    """Sorted CSV; part files follow the sort order."""
    df.orderBy(*sort_cols).write.mode("overwrite").option("header", True).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, *, properties: dict[str, str] | None = None) -> None:
    df.write.mode("overwrite").jdbc(url, table, properties=properties)


# -- JSON chunks -------------------------------------------------------------

MEGABYTE = 1024 * 1024


def json_chunks(df: DataFrame, *, max_bytes: int = 10 * MEGABYTE, root: str = "Report_Entry") -> DataFrame:
    """Rows wrapped into ``{root: [...]}`` documents of at most ``max_bytes``.

    Returns (chunk_id, n_records, document), every input row in exactly one document.
    Rows are serialised once and stored; a row's offset is the sum of the bytes before
    it, in its partition and in those before, one row each. Equal steps of offsets are
    the documents, a step being the room less the longest row, so no document overflows.
    A row of more than half the room gets a document of its own, whatever its size.
    """
    frame = len(f'{{"{root}":[]}}')
    room = max(1, max_bytes - frame)
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"))
    lines = lines.withColumn("size", (F.octet_length("line") + 1).cast("bigint")).withColumn("at", F.monotonically_increasing_id())
    lines = stage_table(lines, "lines").withColumns({"part": F.shiftright("at", 33), "small": 2 * F.col("size") <= room})
    sizes = lines.groupBy("part").agg(
        F.coalesce(F.sum(F.when(F.col("small"), F.col("size"))), F.lit(0)).alias("bytes"),
        F.max(F.when(F.col("small"), F.col("size"))).alias("longest"),
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("before"))
    step = F.lit(room) - F.coalesce(sizes.agg(F.max("longest")).scalar(), F.lit(0))
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.when(F.col("small"), F.col("size"))).over(within), F.lit(0))
    placed = lines.withColumn("inside", inside).join(starts, "part")
    chunk = F.floor((F.col("before") + F.col("inside")) / step)
    # A document's rows are bounded by its bytes, so one task can hold them.
    kept = placed.withColumn("chunk", F.when(F.col("small"), chunk).otherwise(-1 - F.col("at")))
    docs = kept.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n_records"), F.sort_array(F.collect_list(F.struct("at", "line"))).alias("rows")
    )
    number = F.abs("chunk").cast("string")
    name = F.concat(F.when(F.col("chunk") < 0, "single-").otherwise("chunk-"), F.lpad(number, F.greatest(F.length(number), F.lit(9)), F.lit("0")))
    body = F.concat(F.lit(f'{{"{root}":['), F.array_join("rows.line", ","), F.lit("]}"))
    return docs.select(name.alias("chunk_id"), "n_records", body.alias("document"))


def write_json_chunks(df: DataFrame, path: str, max_mb: float = 10, *, root: str = "Report_Entry") -> DataFrame:
    """Write one text file per chunk and return (chunk_id, n_records, n_bytes)."""
    # The documents are staged once: the listing below describes the written files.
    docs = stage_table(json_chunks(df, max_bytes=int(max_mb * MEGABYTE), root=root), "chunks")
    docs.select("document").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return docs.select("chunk_id", "n_records", F.octet_length("document").cast("long").alias("n_bytes"))


# -- swap, purge, status -----------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders of the table at ``path``, from the outermost; empty where it has none."""
    fs, at = _fs(spark, path)
    names: list[str] = []
    while fs.exists(at):
        inner = [f.getPath() for f in fs.listStatus(at) if f.isDirectory() and "=" in f.getPath().getName()]
        if not inner:
            break
        at = inner[0]
        names.append(at.getName().split("=", 1)[0])
    return names


def publish_swap(df: DataFrame, path: str, *, backup: str | None = None) -> str:
    """Replace the table at ``path``, also when ``df`` reads it; its partition folders stay.

    The new table is written beside the old one; only then is the old one set
    aside as ``<path>_BKP`` and the new one renamed. Until that moment the old
    table is intact; ``recover`` finishes a swap that was cut between renames.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    backup = backup or f"{path}_BKP"
    fresh = f"{path}_NEW_{uuid.uuid4().hex[:8]}"
    parts = [c for c in partition_columns(spark, path) if c in df.columns]
    if parts:
        by_partition(df, parts).write.partitionBy(*parts).parquet(fresh)
    else:
        df.write.parquet(fresh)
    fs, target = _fs(spark, path)
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    if fs.exists(target):
        if fs.exists(hpath(backup)):
            fs.delete(hpath(backup), True)
        if not fs.rename(target, hpath(backup)):
            raise OSError(f"cannot set {path} aside")
    if not fs.rename(hpath(fresh), target):
        raise OSError(f"cannot publish {fresh}; the old table is at {backup}")
    return backup


def recover(spark: SparkSession, path: str) -> bool:
    """Put the backup back when a swap was cut after setting the old table aside."""
    path = path.rstrip("/")
    fs, target = _fs(spark, path)
    saved = spark._jvm.org.apache.hadoop.fs.Path(f"{path}_BKP")
    if fs.exists(target) or not fs.exists(saved):
        return False
    return bool(fs.rename(saved, target))


def purge_where(spark: SparkSession, path: str, predicate: Column) -> None:
    """Delete the rows a predicate holds for; rows where it is unknown stay.

    Of a partitioned table only partitions that hold such a row are written again;
    the files of the others are not touched.
    """
    df = spark.read.parquet(path)
    gone = F.coalesce(predicate, F.lit(False))
    parts = partition_columns(spark, path)
    if not parts:
        publish_swap(df.filter(~gone), path)
        return
    per = df.groupBy(*parts).agg(F.count_if(gone).alias("__gone"), F.count_if(~gone).alias("__kept"))
    hit = stage_table(per.filter("__gone > 0"), "partitions")
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(hit[c]) for c in parts])
    kept = stage_table(df.filter(~gone).join(hit, same, "left_semi"), "kept")
    # A partition without rows left has nothing to overwrite it with.
    empty = reduce(lambda a, b: a & b, [df[c].eqNullSafe(hit[c]) for c in parts])
    files = df.join(hit.filter("__kept = 0"), empty, "left_semi").select("_metadata.file_path").distinct()
    folders = {r[0].rsplit("/", 1)[0] for r in files.collect()}
    by_partition(kept, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *parts
    ).parquet(path)
    fs, _ = _fs(spark, path)
    for folder in sorted(folders):
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder)), True)


def dedupe_table(spark: SparkSession, path: str, sk: str, *, eff: str = "eff_dt", disc: str = "disc_dt") -> None:
    """Keep the row that ends last per key and start date, and swap the table in."""
    publish_swap(dedupe_intervals(spark.read.parquet(path), sk, eff, disc), path)


AUDIT_SCHEMA = StructType(
    [
        StructField("run_key", StringType()),
        StructField("job", StringType()),
        StructField("source_name", StringType()),
        StructField("target_name", StringType()),
        StructField("source_rows", LongType()),
        StructField("insert_rows", LongType()),
        StructField("rejected_rows", LongType()),
        StructField("start_tmsp", TimestampType()),
        StructField("end_tmsp", TimestampType()),
        StructField("size_mb", DoubleType()),
        StructField("status", StringType()),
        StructField("updt_tmsp", TimestampType()),
    ]
)


def append_audit(spark: SparkSession, path: str, row: dict) -> None:
    """Append one audit row; fields left out are null."""
    unknown = set(row) - set(AUDIT_SCHEMA.names)
    if unknown:
        raise ValueError(f"unknown audit fields {sorted(unknown)}")
    values = tuple(row.get(n) for n in AUDIT_SCHEMA.names)
    spark.createDataFrame([values], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def has_audit(spark: SparkSession, path: str, run_key: str) -> bool:
    if not path_exists(spark, path):
        return False
    return not spark.read.schema(AUDIT_SCHEMA).parquet(path).filter(F.col("run_key") == run_key).isEmpty()


def count_rows(spark: SparkSession, path: str) -> int:
    """Rows in the parquet files under a path; 0 where no file was written."""
    fs, at = _fs(spark, path)
    found = fs.exists(at) and fs.listFiles(at, True)
    while found and found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return spark.read.parquet(path).count()
    return 0


STATUS_SCHEMA = StructType(
    [StructField("run_key", StringType()), StructField("status", StringType()), StructField("updt_tmsp", TimestampType())]
)


def _status_log(path: str) -> str:
    return f"{path.rstrip('/')}_status"


def set_run_status(spark: SparkSession, path: str, key: str, status: str, now: dt.datetime | None = None) -> None:
    """Set status and update time of one run, other fields untouched.

    One row is appended to a log beside the audit rows; ``read_audit`` takes the newest of
    a run. No row is ever written again, so other writers lose nothing.
    """
    at = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(key, status, at)], STATUS_SCHEMA).coalesce(1).write.mode("append").parquet(_status_log(path))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit rows, each with the newest status of its run; of changes at one time the largest text."""
    audit = spark.read.schema(AUDIT_SCHEMA).parquet(path)
    if not path_exists(spark, _status_log(path)):
        return audit
    log = spark.read.schema(STATUS_SCHEMA).parquet(_status_log(path))
    newest = log.groupBy("run_key").agg(F.max(F.struct("updt_tmsp", "status")).alias("__s"))
    joined = audit.join(newest.withColumnRenamed("run_key", "__run"), F.col("run_key") == F.col("__run"), "left")
    set_ = F.col("__s").isNotNull()
    return joined.withColumns(
        {c: F.when(set_, F.col(f"__s.{c}")).otherwise(F.col(c)) for c in ("status", "updt_tmsp")}
    ).select(*AUDIT_SCHEMA.names)
