"""Sources: tables, landing files, reports, watermarks."""

import datetime as dt

from pyspark.sql import functions as F

from dimflow.queries.registry import query
from dimflow.sources import readers as R
from dimflow.sources.sinks import write_json_chunks


@query("src_scan_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def _(t):
    return R.read_table(t.spark, t.folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


@query(
    "src_report_json",
    "SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value FROM events",
)
def _(t):
    rows = t.events.select("event_id", "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))
    path = t.scratch("report")
    write_json_chunks(rows, path, max_mb=0.1)
    return R.read_report_json(t.spark, path, schema=rows.schema)


@query(
    "src_landing_csv",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
      CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events""",
)
def _(t):
    path = t.scratch("csv")
    rows = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    rows.write.option("header", True).csv(path)
    return R.read_landing_csv(t.spark, [path, path + "/x_$folder$"])


@query(
    "src_union_extracts",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F','O') UNION SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O','P')",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return R.union_extracts(rows.filter("o_orderstatus in ('F','O')"), rows.filter("o_orderstatus in ('O','P')"))


@query("src_live_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def _(t):
    flagged = t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "P", 20240101).otherwise(0).alias("expirationdate"),
        F.lit("x").alias("effectivedate"),
    )
    return R.live_rows(flagged, drop=("effectivedate",))


MARK = dt.date(1997, 12, 31)


def loaded(t):
    """What an earlier run has loaded: orders up to the mark."""
    return t.orders.filter(F.col("o_orderdate") <= F.lit(MARK))


LOADED = "(SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= DATE '1997-12-31')"


@query("src_since_watermark", f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > {LOADED}")
def _(t):
    rows = R.since_watermark(t.orders, loaded(t), "o_orderdate", "o_orderdate")
    return rows.select("o_orderkey", "o_orderdate")


@query("src_since_watermark_inclusive", f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= {LOADED}")
def _(t):
    rows = R.since_watermark(t.orders, loaded(t), "o_orderdate", "o_orderdate", inclusive=True)
    return rows.select("o_orderkey", "o_orderdate")


@query(
    "src_changed_key_history",
    f"""SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_custkey IN
      (SELECT o_custkey FROM orders WHERE o_orderdate > {LOADED} AND o_orderstatus = 'P')""",
)
def _(t):
    changed = R.since_watermark(t.orders, loaded(t), "o_orderdate", "o_orderdate").filter("o_orderstatus = 'P'")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return R.history_of_changed_keys(rows, changed, ["o_custkey"])


@query(
    "inc_watermark_by_key",
    """WITH m AS (SELECT o_custkey, max(o_orderdate) AS mark FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT o.o_orderkey, o.o_custkey FROM orders o LEFT JOIN m ON m.o_custkey = o.o_custkey
    WHERE mark IS NULL OR o.o_orderdate > mark""",
)
def _(t):
    rows = R.since_watermark_by_key(
        t.orders, t.orders.filter("o_orderstatus = 'F'"), ["o_custkey"], "o_orderdate", "o_orderdate"
    )
    return rows.select("o_orderkey", "o_custkey")
