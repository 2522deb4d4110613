"""Incremental runs and file-arrival ingestion."""

import datetime as dt

from pyspark.sql import functions as F

from dimflow.operators.joins import lookup_sk
from dimflow.functions.keys import surrogate_key
from dimflow.plans.incremental import incremental_facts, new_entities, run_mode
from dimflow.queries.registry import query
from dimflow.sources.readers import since_watermark
from dimflow.sources.sinks import write_full
from dimflow.streaming.landing import ingest_landing_stream

SPLIT = "1998-01-01"


def first_run(t):
    """Facts of an earlier run, when the customers of one segment were not yet known."""
    dim = t.customer.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", surrogate_key("c_custkey").alias("cust_sk"))
    old = t.orders.filter(F.col("o_orderdate") < F.lit(SPLIT).cast("date"))
    return lookup_sk(old.select("o_orderkey", "o_custkey", "o_orderdate"), dim, {"o_custkey": "c_custkey"}, "cust_sk")


@query(
    "inc_unresolved_retry",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < DATE '1998-01-01')
      OR (o_orderdate < DATE '1998-01-01' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'))""",
)
def _(t):
    stage = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return incremental_facts(stage, first_run(t), "o_orderkey", "o_orderdate", ["cust_sk"])


@query(
    "inc_new_entities",
    """SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders f WHERE f.o_orderstatus = 'F'
      AND f.o_custkey = o.o_custkey AND f.o_orderdate = o.o_orderdate)""",
)
def _(t):
    target = t.orders.filter("o_orderstatus = 'F'")
    out = new_entities(t.orders, target, {"o_custkey": "o_custkey", "o_orderdate": "o_orderdate"})
    return out.select("o_orderkey", "o_custkey")


@query(
    "inc_run_mode",
    """SELECT 'first' AS run_1, 'incremental' AS run_2, 'full' AS run_3, 'incremental' AS protected, count(*) AS n_new FROM orders
    WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < DATE '1998-01-01')""",
)
def _(t):
    path = t.scratch("mode")
    modes = [run_mode(t.spark, path)]
    rows = t.orders.select("o_orderkey", "o_orderdate")
    write_full(rows.filter(F.col("o_orderdate") < F.lit(SPLIT).cast("date")), path)
    modes += [run_mode(t.spark, path), run_mode(t.spark, path, True), run_mode(t.spark, path, True, protect=True)]
    new = since_watermark(rows, t.spark.read.parquet(path), "o_orderdate", "o_orderdate")
    names = ("run_1", "run_2", "run_3", "protected")
    return new.agg(F.count(F.lit(1)).alias("n_new")).select(*[F.lit(m).alias(n) for m, n in zip(modes, names)], "n_new")


@query(
    "inc_landing_stream",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type <> 'view' THEN event_type END AS event_type,
      strftime(ts, '%Y%m%d%H%M') AS "TIATIM", CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
    FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-11'""",
)
def _(t):
    source = t.scratch("landing")
    kind = F.when(F.col("event_type") == "view", "nan").otherwise(F.col("event_type"))
    rows = t.events.select("event_id", kind.alias("event_type"), F.date_format("ts", "yyyyMMddHHmm").alias("TIATIM"), "user_id")
    rows.repartition(4, "user_id").drop("user_id").write.option("header", True).csv(source)
    out = t.scratch("formatted")
    query_ = ingest_landing_stream(
        t.spark,
        source,
        out,
        t.scratch("stream-state"),
        schema="event_id string, event_type string, TIATIM string",
        time_col="TIATIM",
        fmt="yyyyMMddHHmm",
        levels=("month", "day"),
        today=dt.date(2024, 1, 31),
        days=20,
        audit=t.scratch("stream-audit"),
        max_files=3,
    )
    query_.awaitTermination()
    back = t.spark.read.parquet(out)
    return back.select("event_id", "event_type", "TIATIM", F.col("month").cast("int"), F.col("day").cast("int"))
