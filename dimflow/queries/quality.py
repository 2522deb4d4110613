"""Checks, de-duplication, sequences and masking."""

from pyspark.sql import functions as F

from dimflow.functions.convert import mask_when
from dimflow.operators import quality as Q
from dimflow.queries.registry import query


@query("dq_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return Q.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


HOLES = """SELECT o_orderkey, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus FROM orders"""


@query(
    "dq_not_null",
    f"""WITH h AS ({HOLES}) SELECT * FROM (
      SELECT 'o_custkey' AS column_name, count(*) FILTER (WHERE o_custkey IS NULL) AS n_nulls FROM h
      UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM h) WHERE n_nulls > 0""",
)
def _(t):
    holed = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    return Q.check_not_null(holed, ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("dq_require_not_null", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(t):
    return Q.require_not_null(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey", "o_custkey"])


@query(
    "dq_masks",
    """SELECT '*****' AS name_pii, repeat('*', length(c_mktsegment) - 4) || right(c_mktsegment, 4) AS segment_sens,
      DATE '1900-01-01' AS birth_pii, CAST(date_trunc('year', DATE '1970-01-01' + CAST(c_custkey AS INTEGER)) AS DATE) AS start_sens, c_custkey FROM customer""",
)
def _(t):
    born = F.date_add(F.lit("1970-01-01").cast("date"), F.col("c_custkey").cast("int"))
    rows = t.customer.select(
        "c_custkey", F.col("c_name").alias("name_pii"), F.col("c_mktsegment").alias("segment_sens"), born.alias("birth_pii"), born.alias("start_sens")
    )
    texts = Q.masks_by_suffix(["name_pii", "segment_sens"], {"_pii": "string_full", "_sens": "string_partial"})
    dates = Q.masks_by_suffix(["birth_pii", "start_sens"], {"_pii": "date_full", "_sens": "date_partial"})
    return Q.apply_masks(rows, texts | dates)


@query(
    "dq_mask_by_sibling",
    """SELECT event_id, event_type, CASE WHEN event_type IN ('purchase', 'error') THEN '*****' ELSE props END AS props FROM events""",
)
def _(t):
    masked = mask_when("props", "event_type", ["purchase", "error"])
    return t.events.select("event_id", "event_type", masked.alias("props"))


@query(
    "dq_dedupe_intervals",
    """SELECT o_custkey, eff_dt, disc_dt, o_orderkey FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS eff_dt,
        CAST(o_orderdate + INTERVAL (CAST(o_orderkey % 40 AS INTEGER)) DAY AS DATE) AS disc_dt, o_orderkey FROM orders)
    QUALIFY row_number() OVER (PARTITION BY o_custkey, eff_dt ORDER BY disc_dt DESC, o_orderkey) = 1""",
)
def _(t):
    d = F.to_date("o_orderdate")
    rows = t.orders.select(
        "o_custkey", d.alias("eff_dt"), F.date_add(d, (F.col("o_orderkey") % 40).cast("int")).alias("disc_dt"), "o_orderkey"
    )
    return Q.dedupe_intervals(rows, "o_custkey")


@query(
    "dq_sequence",
    """SELECT o_orderkey, o_custkey, (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY o_orderkey) AS p_partkey
    FROM orders""",
)
def _(t):
    return Q.append_sequence(t.orders.select("o_orderkey", "o_custkey"), t.part, "p_partkey", ["o_orderkey"])


@query(
    "dq_reconcile",
    """SELECT count(*) AS n_source, count(*) FILTER (WHERE o_orderstatus <> 'P') AS n_out,
      count(*) FILTER (WHERE o_orderstatus = 'P') AS n_rejected, true AS balanced FROM orders""",
)
def _(t):
    return Q.reconcile_tables(t.orders, t.orders.filter("o_orderstatus <> 'P'"), t.orders.filter("o_orderstatus = 'P'"))
