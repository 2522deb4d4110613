"""Projections, filters, aggregates, set operations and reshaping."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from dimflow.functions.keys import row_hash
from dimflow.operators import reshape as P
from dimflow.operators.joins import intersect_intervals
from dimflow.plans.scd import build_attribute_log
from dimflow.queries.joins import TREE, customer_tree, order_texts
from dimflow.queries.registry import SNAP, VERSIONS, padded_sql, query
from dimflow.operators.hierarchy import hierarchy_paths

NOW = dt.datetime(2024, 2, 1, 3, 4, 5)


@query("prj_rename_map", "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment FROM customer")
def _(t):
    return P.rename_map(
        t.customer, {"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "segment"}
    )


@query("prj_star_except", "SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")
def _(t):
    return P.star_except(t.customer, "c_acctbal", "c_name")


@query(
    "prj_column_list_hash",
    "SELECT c_custkey, md5(c_name || '-' || CAST(c_nationkey AS VARCHAR) || '-' || c_mktsegment) AS row_hash FROM customer",
)
def _(t):
    tracked = P.columns_except(t.customer, "c_custkey", "c_acctbal")
    return t.customer.select("c_custkey", row_hash(*tracked).alias("row_hash"))


@query(
    "prj_stamp",
    """SELECT c_custkey, 'CRM' AS rec_src, CAST(20240201030405 AS BIGINT) AS ins_batch_id,
      CAST(20240201030405 AS BIGINT) AS upd_batch_id FROM customer""",
)
def _(t):
    return P.stamp(t.customer.select("c_custkey"), "CRM", NOW)


@query(
    "prj_conform",
    """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""",
)
def _(t):
    shape = StructType(
        [
            StructField("id", LongType()),
            StructField("name", StringType()),
            StructField("balance", DoubleType()),
            StructField("segment", StringType()),
        ]
    )
    sup = P.rename_map(t.supplier, {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"})
    cus = P.rename_map(
        t.customer, {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"}
    )
    return P.conform(sup, shape).unionByName(P.conform(cus, shape))


@query(
    "prj_null_out",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS o_totalprice,
      CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return P.null_out(rows, F.col("o_orderstatus") == "O", ["o_totalprice", "o_orderpriority"])


@query(
    "prj_stamp_file",
    "SELECT r_regionkey, 'region.parquet' AS raw_filename, DATE '2024-02-01' AS load_date FROM region",
)
def _(t):
    stamped = P.stamp_file(t.region, dt.date(2024, 2, 1))
    return stamped.select("r_regionkey", F.element_at(F.split("raw_filename", "/"), -1).alias("raw_filename"), "load_date")


@query(
    "prj_corrections",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_custkey % 2 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
      CASE WHEN o_orderdate < DATE '1993-01-01' THEN CAST('1993-01-01' AS TIMESTAMP) ELSE o_orderdate END AS o_orderdate FROM orders""",
)
def _(t):
    rules = [
        ("o_orderstatus", (F.col("o_orderstatus") == "P") & (F.col("o_custkey") % 2 == 0), "F"),
        ("o_orderdate", F.col("o_orderdate") < F.lit("1993-01-01").cast("date"), "1993-01-01"),
    ]
    return P.apply_corrections(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), rules).drop("o_custkey")


@query(
    "flt_and_or_null",
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND (o_custkey <> 7 OR o_orderpriority IS NULL) AND o_totalprice IS NOT NULL",
)
def _(t):
    c = F.col
    keep = (c("o_orderstatus") == "F") & ((c("o_custkey") != 7) | c("o_orderpriority").isNull()) & c("o_totalprice").isNotNull()
    return t.orders.filter(keep).select("o_orderkey")


@query("flt_in_list", "SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#2', 'Brand#17', 'Brand#5')")
def _(t):
    return t.part.filter(F.col("p_brand").isin("Brand#2", "Brand#17", "Brand#5")).select("p_partkey", "p_brand")


@query("flt_like_upper", "SELECT p_partkey, p_name FROM part WHERE upper(p_name) LIKE '%RING%' AND upper(p_type) NOT LIKE 'ECO%'")
def _(t):
    keep = F.upper("p_name").like("%RING%") & ~F.upper("p_type").like("ECO%")
    return t.part.filter(keep).select("p_partkey", "p_name")


@query("flt_between_dates", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def _(t):
    low, high = F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date")
    # On the stored column, so the range reaches the scan; dates are midnights.
    return t.orders.filter(F.col("o_orderdate").between(low, high)).select("o_orderkey")


@query(
    "flt_not_at_maximum",
    f"WITH {SNAP} SELECT user_id, rpt_dt, event_type FROM snap WHERE rpt_dt <> (SELECT max(rpt_dt) FROM snap)",
)
def _(t):
    return P.not_at_maximum(t.snapshot().select("user_id", "rpt_dt", "event_type"), "rpt_dt")


@query(
    "flt_recent_days",
    "SELECT event_id, strftime(ts, '%Y%m%d%H%M') AS stamp FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - INTERVAL 10 DAY",
)
def _(t):
    rows = t.events.select("event_id", F.date_format("ts", "yyyyMMddHHmm").alias("stamp"))
    return P.keep_recent(rows, "stamp", 10, dt.date(2024, 1, 31))


@query(
    "flt_exclude_hash",
    "SELECT c_custkey, md5(c_name) AS h FROM customer WHERE md5(c_name) <> (SELECT md5(c_name) FROM customer WHERE c_custkey = 5)",
)
def _(t):
    hashed = t.customer.select("c_custkey", row_hash("c_name").alias("h"))
    bad = hashed.filter("c_custkey = 5").select("h").scalar()
    return hashed.filter(F.col("h") != bad)


@query("agg_min_max_dates", """SELECT o_custkey, o_orderstatus, min(o_orderdate) AS eff, max(until) AS disc
    FROM (SELECT *, o_orderdate + INTERVAL 7 DAY AS until FROM orders) GROUP BY 1, 2""")
def _(t):
    rows = t.orders.select(
        "o_custkey", "o_orderstatus", F.col("o_orderdate").alias("eff"), (F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")).alias("disc")
    )
    return P.min_max_dates(rows, ["o_custkey", "o_orderstatus"], "eff", "disc")


@query(
    "agg_sum_as_text",
    "SELECT l_partkey, l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS VARCHAR) AS total FROM lineitem GROUP BY 1, 2",
)
def _(t):
    return P.sum_as_text(t.lineitem, ["l_partkey", "l_returnflag"], "l_extendedprice", "total")


@query("agg_global_max", "SELECT max(l_shipdate) AS mark, max(l_orderkey) AS top_key FROM lineitem")
def _(t):
    return t.lineitem.agg(F.max("l_shipdate").alias("mark"), F.max("l_orderkey").alias("top_key"))


@query("agg_having_count", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return P.having_count(t.lineitem, ["l_orderkey", "l_linenumber"], more_than=1)


@query("agg_having_single", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) = 1")
def _(t):
    return P.having_count(t.lineitem, ["l_orderkey"], equal=1)


@query(
    "agg_having_distinct",
    "SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_distinct FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 3",
)
def _(t):
    return P.having_distinct(t.orders, ["o_custkey"], "o_orderpriority", 3)


@query("agg_distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(t):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query(
    "agg_distinct_values",
    "SELECT user_id, list_sort(list(DISTINCT event_type)) AS states FROM events GROUP BY user_id",
)
def _(t):
    return P.distinct_values(t.events, ["user_id"], "event_type", "states")


@query(
    "agg_two_level_max",
    """WITH k AS (SELECT user_id, max(CAST(ts AS DATE)) AS by_key FROM events GROUP BY 1)
    SELECT user_id, by_key, (SELECT max(by_key) FROM k) AS by_file FROM k""",
)
def _(t):
    from dimflow.operators.joins import join_one_row

    by_key = t.events.groupBy("user_id").agg(F.max(F.to_date("ts")).alias("by_key"))
    return join_one_row(by_key, by_key.agg(F.max("by_key").alias("by_file")))


@query("agg_json_types", "SELECT DISTINCT k AS field, 'BIGINT' AS types FROM (SELECT unnest(json_keys(props)) AS k FROM events)")
def _(t):
    return P.profile_types(t.events, "props")


@query(
    "agg_size_report",
    """SELECT count(*) AS n_rows, CAST(sum(strlen('{"r":' || o_orderkey || ',"s":"' || o_orderstatus || '"}')) AS BIGINT) AS n_bytes FROM orders""",
)
def _(t):
    return P.size_report(t.orders.select(F.col("o_orderkey").alias("r"), F.col("o_orderstatus").alias("s")))


@query("set_union_all", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def _(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.col("s_nationkey").alias("k")))


@query("set_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t):
    return P.union_extracts(t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k")))


@query(
    "set_append_rows",
    "SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT -1, 'UNKNOWN', -1 UNION ALL SELECT -2, 'SEVERAL', -1",
)
def _(t):
    return P.append_rows(t.nation, [(-1, "UNKNOWN", -1), (-2, "SEVERAL", -1)])


@query(
    "sem_unpivot",
    f"""WITH {SNAP}, wide AS (SELECT user_id, rpt_dt, event_type AS state,
      CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 10 AS VARCHAR) END AS grade FROM snap)
    SELECT user_id, rpt_dt, 'state' AS change_column, state AS current_value FROM wide WHERE state IS NOT NULL
    UNION ALL SELECT user_id, rpt_dt, 'grade', grade FROM wide WHERE grade IS NOT NULL""",
)
def _(t):
    wide = t.snapshot().select(
        "user_id",
        "rpt_dt",
        F.col("event_type").alias("state"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 10).alias("grade"),
    )
    return P.unpivot_attrs(wide, ["user_id", "rpt_dt"], ["state", "grade"])


@query(
    "sem_explode_list",
    """SELECT p_partkey, trim(piece) AS piece FROM (
      SELECT p_partkey, unnest(string_split(replace(p_name, ' ', ' ; ') || ';' || p_type, ';')) AS piece FROM part)""",
)
def _(t):
    rows = t.part.select("p_partkey", F.concat(F.replace("p_name", F.lit(" "), F.lit(" ; ")), F.lit(";"), "p_type").alias("piece"))
    return P.explode_list(rows, "piece")


@query(
    "sem_document_lines",
    "SELECT doc_id, trim(piece) AS piece FROM (SELECT doc_id, unnest(string_split(text, '.')) AS piece FROM documents)",
)
def _(t):
    return P.explode_list(t.documents.select("doc_id", F.col("text").alias("piece")), "piece", sep=".")


@query(
    "sem_extract_ids",
    f"""SELECT o_orderkey, list_sort(list_distinct(regexp_extract_all(upper(concat_ws(' ', coalesce(subject, ''), note)),
      'R-[0-9]{{7}}|R-[0-9]{{6}}|R_[0-9]{{7}}|R_[0-9]{{6}}'))) AS ids FROM (
      SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'for r-' || {padded_sql('o_orderkey', 6)} || ' approved' END AS subject,
        CASE WHEN o_orderpriority LIKE '1%' THEN 'see R_' || {padded_sql('o_orderkey', 7)} ELSE 'none' END AS note FROM orders)""",
)
def _(t):
    from dimflow.functions.text import distinct_ids

    forms = ("R-[0-9]{7}", "R-[0-9]{6}", "R_[0-9]{7}", "R_[0-9]{6}")
    return order_texts(t).select("o_orderkey", distinct_ids(["subject", "note"], forms).alias("ids"))


@query(
    "sem_explode_path",
    f"""WITH RECURSIVE {TREE} SELECT c_custkey, string_split(path, ',')[i] AS member, CAST(i AS BIGINT) AS level
    FROM paths, range(1, depth + 1) AS r(i)""",
)
def _(t):
    paths = hierarchy_paths(customer_tree(t), "c_custkey", "boss", list(range(1, 10)))
    out = P.explode_path(paths.select("c_custkey", "path"), "path", "member")
    return out.select("c_custkey", F.col("member").cast("string").alias("member"), F.col("level").cast("long").alias("level"))


LOG = f"""{SNAP}, wide AS (SELECT user_id, rpt_dt, event_type AS state, CAST(event_id % 4 AS VARCHAR) AS grade FROM snap),
tall AS (SELECT user_id, rpt_dt, 'state' AS change_column, state AS current_value FROM wide
  UNION ALL SELECT user_id, rpt_dt, 'grade', grade FROM wide),
chg AS (SELECT *, lag(current_value) OVER (PARTITION BY user_id, change_column ORDER BY rpt_dt) AS prior_value FROM tall
  QUALIFY prior_value IS NULL OR prior_value <> current_value),
log AS (SELECT user_id, change_column, current_value, rpt_dt AS eff_dt,
  coalesce(CAST(lead(rpt_dt) OVER (PARTITION BY user_id, change_column ORDER BY rpt_dt) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS disc_dt
  FROM chg)"""


def graded_snapshot(t):
    return t.snapshot().select(
        "user_id", "rpt_dt", F.col("event_type").alias("state"), (F.col("event_id") % 4).cast("string").alias("grade")
    )


INTERSECT = f"""WITH {LOG}
    SELECT a.user_id, a.current_value AS state, b.current_value AS grade,
      greatest(a.eff_dt, b.eff_dt) AS eff_dt, least(a.disc_dt, b.disc_dt) AS disc_dt
    FROM log a JOIN log b ON b.user_id = a.user_id AND a.change_column = 'state' AND b.change_column = 'grade'
    WHERE greatest(a.eff_dt, b.eff_dt) <= least(a.disc_dt, b.disc_dt)"""


@query("sem_pivot_asof", INTERSECT)
def _(t):
    log = build_attribute_log(graded_snapshot(t), ["user_id"], ["state", "grade"], "rpt_dt", one_row_a_day=True)
    return intersect_intervals(log, ["user_id"], ["state", "grade"])


@query(
    "jn_intersect_intervals",
    f"""WITH {VERSIONS}, status_days AS (
      SELECT o_custkey, CAST(o_orderdate AS DATE) AS rpt_dt, o_orderstatus FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1),
    status_runs AS (SELECT * FROM status_days
      QUALIFY lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY rpt_dt) IS DISTINCT FROM o_orderstatus
        OR row_number() OVER (PARTITION BY o_custkey ORDER BY rpt_dt) = 1),
    s AS (SELECT o_custkey, o_orderstatus, rpt_dt AS eff_dt,
      coalesce(CAST(lead(rpt_dt) OVER (PARTITION BY o_custkey ORDER BY rpt_dt) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS disc_dt FROM status_runs)
    SELECT p.o_custkey, p.o_orderpriority AS priority, s.o_orderstatus AS status,
      greatest(p.eff_dt, s.eff_dt) AS eff_dt, least(p.disc_dt, s.disc_dt) AS disc_dt
    FROM prio_versions p JOIN s ON s.o_custkey = p.o_custkey
    WHERE greatest(p.eff_dt, s.eff_dt) <= least(p.disc_dt, s.disc_dt)""",
)
def _(t):
    rows = t.orders.select(
        "o_custkey",
        F.to_date("o_orderdate").alias("rpt_dt"),
        "o_orderkey",
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )
    from dimflow.operators.windows import latest_per_key

    days = latest_per_key(rows, ["o_custkey", "rpt_dt"], [F.desc("o_orderkey")]).drop("o_orderkey")
    log = build_attribute_log(days, ["o_custkey"], ["priority", "status"], "rpt_dt", one_row_a_day=True)
    return intersect_intervals(log, ["o_custkey"], ["priority", "status"])
