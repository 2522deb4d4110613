"""Window, change-detection and sorting operators."""

from pyspark.sql import functions as F

from dimflow.operators.reshape import changes_only
from dimflow.operators.windows import (
    close_intervals,
    disappeared,
    ffill_group,
    first_seen,
    islands,
    latest_per_key,
    next_value,
    prior_value,
    running_max,
    version_number,
)
from dimflow.queries.registry import DAYS, SNAP, SNAP_VERSIONS, latest_orders_sql, query


@query("win_latest_per_key", latest_orders_sql("true"))
def _(t):
    return t.latest_orders()


@query(
    "win_first_seen",
    f"WITH {SNAP} SELECT user_id, event_type, min(rpt_dt) AS rpt_dt FROM snap GROUP BY user_id, event_type",
)
def _(t):
    return first_seen(t.snapshot(), ["user_id", "event_type"], "rpt_dt")


@query(
    "win_islands",
    f"""WITH {SNAP}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rpt_dt)
              - row_number() OVER (PARTITION BY user_id, event_type ORDER BY rpt_dt) AS run FROM snap)
    SELECT user_id, event_type, min(rpt_dt) AS rpt_dt FROM numbered GROUP BY user_id, event_type, run""",
)
def _(t):
    return islands(t.snapshot(), ["user_id"], ["event_type"], "rpt_dt").select("user_id", "event_type", "rpt_dt")


@query(
    "win_islands_with_gaps",
    f"""WITH {SNAP} SELECT user_id, event_type, rpt_dt FROM snap
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rpt_dt) = 1
         OR lag(event_type) OVER (PARTITION BY user_id ORDER BY rpt_dt) <> event_type
         OR date_diff('day', lag(rpt_dt) OVER (PARTITION BY user_id ORDER BY rpt_dt), rpt_dt) > 1""",
)
def _(t):
    runs = islands(t.snapshot(), ["user_id"], ["event_type"], "rpt_dt", gap_days=1)
    return runs.select("user_id", "event_type", "rpt_dt")


@query(
    "win_version_number",
    """SELECT o_custkey, o_orderkey,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS version FROM orders""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return version_number(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], slice_by=-F.year("o_orderdate")).drop("o_orderdate")


@query(
    "win_prior_value",
    """SELECT event_id, user_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prior_value
    FROM events""",
)
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    out = prior_value(rows, ["user_id"], ["ts", "event_id"], "event_type", "prior_value", slice_by=F.trunc("ts", "month"))
    return out.select("event_id", "user_id", "prior_value")


@query(
    "win_next_value",
    """SELECT event_id, user_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_value
    FROM events""",
)
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    out = next_value(rows, ["user_id"], ["ts", "event_id"], "event_type", "next_value", slice_by=F.trunc("ts", "month"))
    return out.select("event_id", "user_id", "next_value")


@query(
    "win_close_intervals",
    f"""WITH {SNAP}, {SNAP_VERSIONS}
    SELECT user_id, event_type, eff_dt, disc_dt, disc_dt = DATE '9999-12-31' AS is_current FROM snap_versions""",
)
def _(t):
    runs = islands(t.snapshot(), ["user_id"], ["event_type"], "rpt_dt")
    runs = runs.select("user_id", "event_type", F.col("rpt_dt").alias("eff_dt"))
    return close_intervals(runs, ["user_id"], "eff_dt")


@query(
    "win_close_intervals_same_day",
    """WITH d AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS eff_dt FROM orders),
    n AS (SELECT *, lead(eff_dt) OVER (PARTITION BY o_custkey ORDER BY eff_dt, o_orderkey) AS nxt FROM d)
    SELECT o_custkey, o_orderkey, eff_dt,
      CASE WHEN nxt IS NULL THEN DATE '9999-12-31' WHEN nxt = eff_dt THEN eff_dt
           ELSE CAST(nxt - INTERVAL 1 DAY AS DATE) END AS disc_dt FROM n""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("eff_dt"))
    # Orders of a customer are not one a day, so the key is not bounded here.
    return close_intervals(
        rows, ["o_custkey"], "eff_dt", order=["eff_dt", "o_orderkey"], current=None, bounded=False, slice_by=F.year("eff_dt")
    )


@query(
    "win_forward_fill",
    """WITH g AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS v FROM events),
    n AS (SELECT *, count(v) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp FROM g)
    SELECT event_id, user_id, max(v) OVER (PARTITION BY user_id, grp) AS last_purchase FROM n""",
)
def _(t):
    rows = t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("v")
    )
    out = ffill_group(rows, ["user_id"], ["ts", "event_id"], "v", "last_purchase", slice_by=F.trunc("ts", "month"))
    return out.select("event_id", "user_id", "last_purchase")


@query(
    "win_running_max",
    """SELECT event_id, user_id, max(CASE WHEN event_type = 'error' THEN value END)
      OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS worst FROM events""",
)
def _(t):
    rows = t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "error", F.col("value")).alias("v")
    )
    out = running_max(rows, ["user_id"], ["ts", "event_id"], {"worst": "v"}, slice_by=F.trunc("ts", "month"))
    return out.select("event_id", "user_id", "worst")


@query(
    "win_over_aggregate",
    """WITH g AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)
    SELECT c_nationkey, c_mktsegment, n FROM g
    QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) = 1""",
)
def _(t):
    grouped = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return latest_per_key(grouped, ["c_nationkey"], [F.desc("n"), "c_mktsegment"])


@query(
    "win_element_ordinal",
    """SELECT p_partkey, i - 1 AS pos, string_split(p_name, ' ')[i] AS piece
    FROM part, range(1, len(string_split(p_name, ' ')) + 1) AS r(i)""",
)
def _(t):
    out = t.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "piece"))
    return out.withColumn("pos", F.col("pos").cast("long"))


@query(
    "win_last_row_flag",
    f"""WITH {SNAP} SELECT user_id, rpt_dt AS last_dt, CAST(event_type = 'error' AS INTEGER) AS last_is_error FROM snap
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rpt_dt DESC) = 1""",
)
def _(t):
    last = latest_per_key(t.snapshot(), ["user_id"], [F.desc("rpt_dt")])
    flag = (F.col("event_type") == "error").cast("int")
    return last.select("user_id", F.col("rpt_dt").alias("last_dt"), flag.alias("last_is_error"))


@query(
    "win_disappeared",
    f"""WITH {SNAP} SELECT user_id, max(rpt_dt) AS last_seen_dt FROM snap GROUP BY user_id
    HAVING max(rpt_dt) <> (SELECT max(rpt_dt) FROM snap)""",
)
def _(t):
    return disappeared(t.snapshot(), ["user_id"], "rpt_dt")


@query(
    "flt_changes_only",
    f"""WITH {DAYS} SELECT o_custkey, rpt_dt, o_orderpriority AS current_value,
      lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY rpt_dt) AS prior_value FROM prio_days
    QUALIFY prior_value IS NULL OR prior_value <> current_value""",
)
def _(t):
    rows = t.priority_days().withColumnRenamed("o_orderpriority", "current_value")
    return changes_only(prior_value(rows, ["o_custkey"], ["rpt_dt"], "current_value", "prior_value", bounded=True))


@query("srt_global", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey")
def _(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate").orderBy("o_custkey", "o_orderdate", "o_orderkey")


@query(
    "srt_top_one_per_group",
    """SELECT p_brand, p_partkey, p_retailprice FROM part
    QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) = 1""",
)
def _(t):
    best = latest_per_key(t.part, ["p_brand"], [F.desc("p_retailprice"), "p_partkey"])
    return best.select("p_brand", "p_partkey", "p_retailprice")


@query(
    "srt_mixed_directions",
    "SELECT p_partkey, p_brand, p_size FROM part ORDER BY p_size DESC, p_brand DESC, p_partkey ASC",
)
def _(t):
    return t.part.select("p_partkey", "p_brand", "p_size").orderBy(F.desc("p_size"), F.desc("p_brand"), "p_partkey")
