"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. All are runtime SQL settings, so they can also
# be applied to a session somebody else has built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A lookup is often followed by a window or an aggregate; without this the
    # skew split is given up whenever it would cost that later step a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def get_session(app: str = "dimflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def reliable_dir(spark: SparkSession) -> str:
    """Folder shared by all executors: the one named in spark.checkpoint.dir.

    A machine-local folder is used only where driver and executors are one process
    (local[...]); anywhere else the setting is required.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    named = named or sc.getCheckpointDir()
    if named is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="dimflow-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for tables staged by a job."""
    return os.path.join(reliable_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def stage_table(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Compute once, store in the shared folder, go on from the stored table.

    For a result that is used several times, like a merge source: without it
    every use would compute it again. It also ends the lineage, so a lost
    executor costs a reread only. ``options`` are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
