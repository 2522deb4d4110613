"""Sinks and merges; each writes to the shared folder and reads back."""

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from dimflow.functions.keys import row_hash
from dimflow.operators import merge as M
from dimflow.queries.registry import DAYS, latest_orders_sql, query, sql_of
from dimflow.sources import sinks as S
from dimflow.sources.readers import read_report_json
from dimflow.sources.tables import VersionedTable

OLD = latest_orders_sql("o_orderdate < DATE '1998-01-01'")
NEW = latest_orders_sql("o_orderdate >= DATE '1998-01-01'")
SPLIT = "1998-01-01"


def stored(t, df, name, **options):
    """A merge target is a stored table; store it as an earlier run would have."""
    path = t.scratch(name)
    df.write.options(**options).parquet(path)
    return t.spark.read.parquet(path)


def old_new(t):
    return stored(t, t.latest_orders(before=SPLIT), "target"), t.latest_orders(since=SPLIT)


@query("snk_full_rebuild", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _(t):
    path = t.scratch("full")
    rows = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    S.write_full(rows, path)
    S.write_full(rows, path)
    return t.spark.read.parquet(path)


@query("snk_view", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def _(t):
    name = S.register_view(t.customer.filter("c_acctbal > 0"), "dimflow_paying_customers")
    return t.spark.sql(f"SELECT c_custkey, c_name FROM {name}")


@query(
    "snk_upsert",
    f"""WITH old AS ({OLD}), new AS ({NEW})
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM new)""",
)
def _(t):
    old, new = old_new(t)
    return M.merge_upsert(old, new, ["o_custkey"])


@query(
    "snk_upsert_listed_columns",
    f"""WITH old AS ({OLD}), new AS ({NEW})
    SELECT o.o_custkey, coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, o.o_orderstatus,
      o.o_totalprice, coalesce(n.o_orderdate, o.o_orderdate) AS o_orderdate, o.o_orderpriority
    FROM old o LEFT JOIN new n ON n.o_custkey = o.o_custkey
    UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM new
    WHERE o_custkey NOT IN (SELECT o_custkey FROM old)""",
)
def _(t):
    old, new = old_new(t)
    return M.merge_upsert(old, new, ["o_custkey"], update_cols=["o_orderkey", "o_orderdate"])


@query(
    "snk_upsert_kept_columns",
    f"""WITH old AS ({OLD}), new AS ({NEW})
    SELECT o.o_custkey, coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
      coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice, o.o_orderdate, coalesce(n.o_orderpriority, o.o_orderpriority) AS o_orderpriority
    FROM old o LEFT JOIN new n ON n.o_custkey = o.o_custkey
    UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM new
    WHERE o_custkey NOT IN (SELECT o_custkey FROM old)""",
)
def _(t):
    old, new = old_new(t)
    return M.merge_upsert(old, new, ["o_custkey"], no_update_cols=("o_orderdate",))


SCD_PARTS = f"""{DAYS},
tgt_days AS (SELECT * FROM prio_days WHERE rpt_dt < DATE '1998-01-01'),
tgt_runs AS (
  SELECT o_custkey, rpt_dt, o_orderpriority FROM tgt_days
  QUALIFY lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY rpt_dt) IS DISTINCT FROM o_orderpriority
       OR row_number() OVER (PARTITION BY o_custkey ORDER BY rpt_dt) = 1),
tgt AS (
  SELECT o_custkey, o_orderpriority, rpt_dt AS rpt_eff_dt,
    coalesce(CAST(lead(rpt_dt) OVER (PARTITION BY o_custkey ORDER BY rpt_dt) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS disc_dt
  FROM tgt_runs),
src AS (
  SELECT o_custkey, o_orderpriority, rpt_dt AS rpt_eff_dt FROM prio_days WHERE rpt_dt >= DATE '1998-01-01'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY rpt_dt) = 1)"""


def scd_sides(t):
    """Versions up to a day, and each key's first state after it."""
    from dimflow.operators.windows import close_intervals, islands, latest_per_key

    days = t.priority_days()
    runs = islands(days.filter(F.col("rpt_dt") < F.lit(SPLIT).cast("date")), ["o_custkey"], ["o_orderpriority"], "rpt_dt")
    hashed = row_hash("o_orderpriority").alias("dbt_hash")
    tgt = close_intervals(runs.withColumnRenamed("rpt_dt", "rpt_eff_dt"), ["o_custkey"], "rpt_eff_dt").select("*", hashed)
    src = latest_per_key(days.filter(F.col("rpt_dt") >= F.lit(SPLIT).cast("date")), ["o_custkey"], ["rpt_dt"])
    src = src.select(
        "o_custkey",
        "o_orderpriority",
        F.col("rpt_dt").alias("rpt_eff_dt"),
        F.lit("9999-12-31").cast("date").alias("disc_dt"),
        F.lit(True).alias("is_current"),
        hashed,
    )
    return tgt, src


@query(
    "snk_scd2_merge",
    f"""WITH {SCD_PARTS}, closed AS (
      SELECT t.o_custkey, t.o_orderpriority, t.rpt_eff_dt,
        CASE WHEN t.disc_dt = DATE '9999-12-31' AND s.o_orderpriority <> t.o_orderpriority
          THEN CAST(s.rpt_eff_dt - INTERVAL 1 DAY AS DATE) ELSE t.disc_dt END AS disc_dt
      FROM tgt t LEFT JOIN src s ON s.o_custkey = t.o_custkey),
    added AS (SELECT s.o_custkey, s.o_orderpriority, s.rpt_eff_dt, DATE '9999-12-31' AS disc_dt FROM src s
      WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.o_custkey = s.o_custkey AND t.o_orderpriority = s.o_orderpriority
        AND t.disc_dt = DATE '9999-12-31')),
    merged AS (SELECT * FROM closed UNION ALL SELECT * FROM added)
    SELECT *, disc_dt = DATE '9999-12-31' AS is_current FROM merged""",
)
def _(t):
    tgt, src = scd_sides(t)
    return M.scd2_merge(stored(t, tgt, "versions"), src, ["o_custkey"]).drop("dbt_hash")


@query(
    "snk_delete_insert",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey NOT IN
      (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    UNION ALL SELECT o_orderkey, o_custkey, 'X' FROM orders WHERE o_orderstatus = 'P'""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    source = rows.filter("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("X"))
    return M.delete_insert(rows, source, ["o_custkey"])


def table_of(t, rows, key):
    """A versioned table whose files each hold a range of keys, as an earlier run would have left it."""
    table = VersionedTable(t.spark, t.scratch("table"))
    table.overwrite(rows.repartitionByRange(8, key))
    return table


@query("snk_upsert_files", sql_of("snk_upsert"))
def _(t):
    table = table_of(t, t.latest_orders(before=SPLIT), "o_custkey")
    table.upsert(t.latest_orders(since=SPLIT), ["o_custkey"])
    return table.read()


@query("snk_scd2_files", sql_of("snk_scd2_merge"))
def _(t):
    tgt, src = scd_sides(t)
    table = table_of(t, tgt, "o_custkey")
    table.scd2(src, ["o_custkey"])
    return table.read().drop("dbt_hash")


@query("snk_delete_insert_files", sql_of("snk_delete_insert"))
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    table = table_of(t, rows, "o_custkey")
    table.delete_insert(rows.filter("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("X")), ["o_custkey"])
    return table.read()


@query(
    "snk_partitioned",
    """SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day FROM events""",
)
def _(t):
    path = t.scratch("parts")
    rows = t.events.select("event_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"))
    S.write_partitioned(rows, path, ["year", "month", "day"])
    back = t.spark.read.parquet(path)
    return back.select("event_id", *[F.col(c).cast("long").alias(c) for c in ("year", "month", "day")])


@query(
    "snk_export_parquet",
    "SELECT count(*) AS num_rows, 'struct<o_orderkey:bigint,o_orderstatus:string>' AS schema_text FROM orders",
)
def _(t):
    meta = S.export_parquet(t.orders.select("o_orderkey", "o_orderstatus"), t.scratch("export"))
    # The reported metadata, beside a count of the source.
    return t.orders.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(meta["num_rows"]).cast("long").alias("num_rows"), F.lit(meta["schema"]).alias("schema_text")
    )


@query("snk_export_csv", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def _(t):
    path = t.scratch("export-csv")
    S.export_csv(t.orders.select("o_orderkey", "o_orderpriority"), path, ["o_orderpriority", "o_orderkey"])
    return t.spark.read.option("header", True).csv(path)


@query(
    "snk_json_chunks",
    """SELECT doc_id, text, lang, source, n_chars, CAST(0 AS BIGINT) AS n_over_limit,
      (SELECT count(*) FROM documents) AS n_listed FROM documents""",
)
def _(t):
    limit = 2 * S.MEGABYTE
    path = t.scratch("chunks")
    chunks = S.write_json_chunks(t.documents, path, max_mb=2)
    back = read_report_json(t.spark, path, schema=t.documents.schema)
    listed = chunks.agg(
        F.struct(
            F.sum("n_records").alias("n"),
            F.count_if((F.col("n_bytes") > limit) & (F.col("n_records") > 1)).alias("over"),
        ).alias("x")
    ).scalar()
    return back.withColumns({"n_over_limit": listed["over"], "n_listed": listed["n"]})


@query(
    "snk_publish_swap",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus FROM orders",
)
def _(t):
    path = t.scratch("swap")
    S.publish_swap(t.orders.select("o_orderkey", "o_orderstatus"), path)
    old = t.spark.read.parquet(path)
    status = F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus"))
    S.publish_swap(old.withColumn("o_orderstatus", status), path)
    return t.spark.read.parquet(path)


@query("snk_purge", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def _(t):
    path = t.scratch("purge")
    S.write_full(t.orders.select("o_orderkey", "o_orderstatus"), path)
    S.purge_where(t.spark, path, F.col("o_orderstatus") == "F")
    return t.spark.read.parquet(path)


@query(
    "snk_audit_rows",
    """SELECT 'copy' AS job, count(*) AS source_rows, count(*) AS insert_rows, CAST(0 AS BIGINT) AS rejected_rows,
      'SUCCESS' AS status FROM events""",
)
def _(t):
    audit, seen = t.scratch("audit"), Observation("copied")
    S.write_full(t.events.observe(seen, F.count(F.lit(1)).alias("n")), t.scratch("copy"))
    n = seen.get["n"]
    row = {"job": "copy", "source_rows": n, "insert_rows": n, "rejected_rows": 0, "status": "SUCCESS"}
    S.append_audit(t.spark, audit, row)
    return t.spark.read.parquet(audit).select(*row)


@query(
    "snk_run_status",
    """SELECT event_type AS run_key, count(*) AS source_rows,
      CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'RUNNING' END AS status FROM events GROUP BY event_type""",
)
def _(t):
    path = t.scratch("status")
    runs = t.events.groupBy(F.col("event_type").alias("run_key")).agg(F.count(F.lit(1)).alias("source_rows"))
    shaped = runs.select(
        [F.col(f.name) if f.name in runs.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.AUDIT_SCHEMA]
    ).withColumn("status", F.lit("RUNNING"))
    shaped.write.parquet(path)
    S.set_run_status(t.spark, path, "error", "FAILED", dt.datetime(2024, 2, 1))
    return S.read_audit(t.spark, path).select("run_key", "source_rows", "status")


@query(
    "snk_align_schema",
    """SELECT CAST(n_nationkey AS BIGINT) AS k, n_name AS name, CAST(NULL AS DOUBLE) AS balance FROM nation
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
)
def _(t):
    a, b = M.align_schema(
        t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")),
        t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
    )
    return a.unionByName(b)


@query(
    "snk_update_from",
    """WITH last AS (SELECT o_custkey, max(o_orderdate) AS dt FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus,
      CASE WHEN o.o_orderstatus = 'O' AND last.dt IS NOT NULL THEN last.dt ELSE o.o_orderdate END AS o_orderdate
    FROM orders o LEFT JOIN last ON last.o_custkey = o.o_custkey""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    last = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.max("o_orderdate").alias("dt"))
    return M.update_from(rows, last, ["o_custkey"], {"o_orderdate": "dt"}, F.col("o_orderstatus") == "O", check=False)
