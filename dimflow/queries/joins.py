"""Lookups and joins."""

from pyspark.sql import functions as F

from dimflow.functions.keys import surrogate_key
from dimflow.functions.convert import prefer
from dimflow.functions.text import REQUISITION_IDS, any_of
from dimflow.operators import joins as J
from dimflow.operators.hierarchy import hierarchy_paths
from dimflow.plans.facts import requisition_ids
from dimflow.queries.registry import DAYS, SHIPMENTS, SNAP, VERSIONS, latest_orders_sql, padded, padded_sql, query, sql_of

PART_DIM = "md5(CAST(p_partkey AS VARCHAR))"


def part_dim(t, keep):
    return t.part.filter(keep).select(
        F.col("p_partkey").alias("part_id"), "p_brand", surrogate_key("p_partkey").alias("part_sk")
    )


@query(
    "jn_lookup_sk",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, coalesce(part_sk, '-1') AS part_sk FROM lineitem
    LEFT JOIN (SELECT p_partkey, {PART_DIM} AS part_sk FROM part WHERE p_size > 10) ON l_partkey = p_partkey""",
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return J.lookup_sk(lines, part_dim(t, F.col("p_size") > 10), {"l_partkey": "part_id"}, "part_sk")


@query(
    "jn_lookup_asof",
    f"""WITH {VERSIONS}, {SHIPMENTS}
    SELECT s.l_orderkey, s.l_linenumber, s.l_partkey, s.ship_dt, coalesce(v.cust_sk, '-1') AS cust_sk
    FROM shipments s LEFT JOIN prio_versions v
      ON v.o_custkey = s.o_custkey AND s.ship_dt BETWEEN v.eff_dt AND v.disc_dt""",
)
def _(t):
    out = J.lookup_asof(t.shipments(), t.priority_versions(), {"o_custkey": "o_custkey"}, "ship_dt", "cust_sk")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "ship_dt", "cust_sk")


@query(
    "jn_lookup_asof_bucketed",
    f"""WITH {VERSIONS}, {SHIPMENTS}
    SELECT s.l_orderkey, s.l_linenumber, s.l_partkey, s.ship_dt, coalesce(v.cust_sk, '-1') AS cust_sk
    FROM shipments s LEFT JOIN prio_versions v
      ON v.o_custkey = s.o_custkey AND s.ship_dt BETWEEN v.eff_dt AND v.disc_dt""",
)
def _(t):
    out = J.lookup_asof(
        t.shipments(), t.priority_versions(), {"o_custkey": "o_custkey"}, "ship_dt", "cust_sk", bucket_days=365
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "ship_dt", "cust_sk")


@query("jn_lookup_indexed", sql_of("jn_lookup_asof"))
def _(t):
    out = J.lookup_indexed(t.shipments(), t.priority_versions(), {"o_custkey": "o_custkey"}, "ship_dt", "cust_sk")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "ship_dt", "cust_sk")


@query(
    "jn_lookup_many",
    f"""WITH {VERSIONS}, {SHIPMENTS}
    SELECT s.l_orderkey, s.l_linenumber, s.ship_dt, coalesce(v.cust_sk, '-1') AS cust_sk, w.cust_sk AS part_as_cust_sk
    FROM shipments s LEFT JOIN prio_versions v ON v.o_custkey = s.o_custkey AND s.ship_dt BETWEEN v.eff_dt AND v.disc_dt
    LEFT JOIN prio_versions w ON w.o_custkey = s.l_partkey AND s.ship_dt BETWEEN w.eff_dt AND w.disc_dt""",
)
def _(t):
    versions = t.priority_versions()
    looks = [
        J.AsOf(versions, {"o_custkey": "o_custkey"}, "ship_dt", "cust_sk"),
        J.AsOf(versions, {"l_partkey": "o_custkey"}, "ship_dt", "cust_sk", out="part_as_cust_sk", default=None),
    ]
    # Line numbers repeat, so rows are told apart by what is looked up.
    out = J.lookup_many(t.shipments(), ["o_custkey", "l_partkey", "ship_dt"], looks)
    return out.select("l_orderkey", "l_linenumber", "ship_dt", "cust_sk", "part_as_cust_sk")


@query(
    "jn_lookup_roles",
    f"""WITH {SNAP}, moves AS (
      SELECT user_id, rpt_dt, event_type AS new_state,
        lag(event_type) OVER (PARTITION BY user_id ORDER BY rpt_dt) AS prev_state FROM snap),
    states AS (SELECT DISTINCT event_type, md5(event_type) AS state_sk FROM events WHERE event_type <> 'error')
    SELECT user_id, rpt_dt, coalesce(p.state_sk, '-1') AS prev_sk, coalesce(n.state_sk, '-1') AS new_sk
    FROM moves LEFT JOIN states p ON p.event_type = prev_state LEFT JOIN states n ON n.event_type = new_state""",
)
def _(t):
    from dimflow.operators.windows import prior_value

    moves = prior_value(t.snapshot(), ["user_id"], ["rpt_dt"], "event_type", "prev_state", bounded=True)
    states = t.events.filter("event_type <> 'error'").select("event_type").distinct()
    states = states.withColumn("state_sk", surrogate_key("event_type"))
    roles = {"prev_sk": "prev_state", "new_sk": "event_type"}
    return J.lookup_roles(moves, states, roles, "event_type", "state_sk").select("user_id", "rpt_dt", "prev_sk", "new_sk")


@query(
    "jn_lookup_roles_asof",
    f"""WITH {VERSIONS}, pairs AS (
      SELECT o_orderkey, o_custkey AS buyer, (o_custkey * 7 + 3) % (SELECT max(c_custkey) + 1 FROM customer) AS payer, CAST(o_orderdate AS DATE) AS dt FROM orders)
    SELECT o_orderkey, coalesce(b.cust_sk, '-1') AS buyer_sk, coalesce(p.cust_sk, '-1') AS payer_sk FROM pairs
    LEFT JOIN prio_versions b ON b.o_custkey = buyer AND dt BETWEEN b.eff_dt AND b.disc_dt
    LEFT JOIN prio_versions p ON p.o_custkey = payer AND dt BETWEEN p.eff_dt AND p.disc_dt""",
)
def _(t):
    pairs = t.orders.select(
        "o_orderkey",
        F.col("o_custkey").alias("buyer"),
        ((F.col("o_custkey") * 7 + 3) % t.customer.agg(F.max("c_custkey") + 1).scalar()).alias("payer"),
        F.to_date("o_orderdate").alias("dt"),
    )
    out = J.lookup_roles(
        pairs, t.priority_versions(), {"buyer_sk": "buyer", "payer_sk": "payer"}, "o_custkey", "cust_sk", date_col="dt"
    )
    return out.select("o_orderkey", "buyer_sk", "payer_sk")


@query(
    "jn_multi_column",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, coalesce(d.pair_sk, '-1') AS pair_sk FROM lineitem l
    LEFT JOIN (SELECT DISTINCT l_partkey AS p, l_suppkey AS s,
        md5(CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)) AS pair_sk
      FROM lineitem WHERE l_returnflag = 'R') d ON d.p = l.l_partkey AND d.s = l.l_suppkey""",
)
def _(t):
    pairs = t.lineitem.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey").distinct()
    pairs = pairs.withColumn("pair_sk", surrogate_key("l_partkey", "l_suppkey"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    on = {"l_partkey": "l_partkey", "l_suppkey": "l_suppkey"}
    return J.lookup_sk(lines, pairs, on, "pair_sk").drop("l_suppkey")


def order_texts(t):
    """Orders with none, one or two ids in their text, in the two forms."""
    first = F.concat(F.lit("for r-"), padded("o_orderkey", 6), F.lit(" approved"))
    second = F.concat(F.lit("see R_"), padded("o_orderkey", 7))
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderdate").alias("bp_completed_dtm"),
        F.when(F.col("o_orderstatus") != "P", first).alias("subject"),
        F.when(F.col("o_orderpriority").startswith("1"), second).otherwise(F.lit("none")).alias("note"),
        F.concat(F.lit("P-"), padded("o_custkey", 8)).alias("place"),
    )


def requisition_dim(t):
    return t.orders.filter("o_orderpriority NOT LIKE '3%' AND o_orderstatus <> 'P'").select(
        F.concat(F.lit("R-"), padded("o_orderkey", 6)).alias("job_req_id")
    ).distinct().withColumn("job_req_sk", surrogate_key("job_req_id"))


ORDER_TEXTS = f"""texts AS (
  SELECT o_orderkey, o_orderdate AS bp_completed_dtm,
    CASE WHEN o_orderstatus <> 'P' THEN 'for r-' || {padded_sql('o_orderkey', 6)} || ' approved' END AS subject,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'see R_' || {padded_sql('o_orderkey', 7)} ELSE 'none' END AS note,
    'P-' || {padded_sql('o_custkey', 8)} AS place
  FROM orders)"""

TEXT_IDS = ORDER_TEXTS + f""",
found AS (
  SELECT *, list_sort(list_distinct(regexp_extract_all(
      upper(concat_ws(' ', coalesce(subject, ''), note, place)), '{any_of(REQUISITION_IDS)}'))) AS req_ids,
    list_sort(list_distinct(regexp_extract_all(
      upper(concat_ws(' ', coalesce(subject, ''), note, place)), 'P_[0-9]{{10}}|P_[0-9]{{9}}|P_[0-9]{{8}}|P-[0-9]{{10}}|P-[0-9]{{9}}|P-[0-9]{{8}}'))) AS pos_ids
  FROM texts),
reqs AS (
  SELECT DISTINCT 'R-' || {padded_sql('o_orderkey', 6)} AS job_req_id,
    md5('R-' || {padded_sql('o_orderkey', 6)}) AS job_req_sk
  FROM orders WHERE o_orderpriority NOT LIKE '3%' AND o_orderstatus <> 'P')"""


@query(
    "jn_lookup_ambiguous",
    f"""WITH {TEXT_IDS}
    SELECT o_orderkey, CASE WHEN len(req_ids) > 1 THEN '-2' WHEN len(req_ids) = 0 THEN '-1'
      ELSE coalesce(r.job_req_sk, '-1') END AS job_req_sk
    FROM found LEFT JOIN reqs r ON len(req_ids) = 1 AND r.job_req_id = req_ids[1]""",
)
def _(t):
    ids = requisition_ids(order_texts(t), ["subject", "note", "place"])
    return J.lookup_sk_multi(ids, requisition_dim(t), "req_ids", "job_req_id", "job_req_sk").select(
        "o_orderkey", "job_req_sk"
    )


@query(
    "jn_hash_key",
    """SELECT l.l_orderkey, l.l_linenumber, s.s_name FROM lineitem l JOIN supplier s
      ON md5(CAST(l.l_suppkey AS VARCHAR) || '-x') = md5(CAST(s.s_suppkey AS VARCHAR) || '-x')""",
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", surrogate_key("l_suppkey", F.lit("x")).alias("hk"))
    sup = t.supplier.select("s_name", surrogate_key("s_suppkey", F.lit("x")).alias("hk"))
    return lines.join(sup, "hk").drop("hk")


@query(
    "jn_trimmed_text",
    """SELECT c.c_custkey, n.n_name FROM (SELECT c_custkey, '  NATION_' || c_nationkey || ' ' AS nm FROM customer) c
    LEFT JOIN (SELECT n_name || ' ' AS n_name FROM nation WHERE n_regionkey <> 2) n ON trim(c.nm) = trim(n.n_name)""",
)
def _(t):
    people = t.customer.select(
        "c_custkey", F.concat(F.lit("  NATION_"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("nm")
    )
    nations = t.nation.filter("n_regionkey <> 2").select(F.concat("n_name", F.lit(" ")).alias("n_name"))
    return J.join_trimmed(people, nations, {"nm": "n_name"}).drop("nm")


@query(
    "jn_full_outer",
    """WITH c AS (SELECT c_nationkey + 3 AS k, count(*) AS n_customers FROM customer GROUP BY 1),
    s AS (SELECT s_nationkey AS k, count(*) AS n_suppliers FROM supplier GROUP BY 1)
    SELECT coalesce(c.k, s.k) AS zone, n_customers, n_suppliers FROM c FULL OUTER JOIN s ON c.k = s.k""",
)
def _(t):
    # Zones are shifted, so that both sides have some the other lacks.
    c = t.customer.groupBy((F.col("c_nationkey") + 3).alias("zone"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("zone"))
    n = F.count(F.lit(1))
    return c.agg(n.alias("n_customers")).join(s.agg(n.alias("n_suppliers")), "zone", "full_outer")


@query(
    "jn_per_key_max",
    """SELECT o.o_orderkey, o.o_custkey, m.last_order FROM orders o
    JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY 1) m ON m.o_custkey = o.o_custkey""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return J.join_per_key_max(rows, ["o_custkey"], "o_orderdate", "last_order").drop("o_orderdate")


@query(
    "jn_one_row",
    """SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE))
      AS days_before_last FROM orders""",
)
def _(t):
    last = t.orders.agg(F.max("o_orderdate").alias("last"))
    out = J.join_one_row(t.orders.select("o_orderkey", "o_orderdate"), last)
    days = F.datediff(F.to_date("last"), F.to_date("o_orderdate")).cast("long")
    return out.select("o_orderkey", days.alias("days_before_last"))


@query(
    "jn_unseen_keys",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')",
)
def _(t):
    known = t.orders.filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"))
    return J.unseen(t.customer.select("c_custkey", "c_name"), known, ["c_custkey"])


@query(
    "jn_seen_keys",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')",
)
def _(t):
    known = t.orders.filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"))
    return J.seen(t.customer.select("c_custkey", "c_name"), known, ["c_custkey"])


@query(
    "jn_version_next_start",
    f"""WITH {DAYS}, v AS (
      SELECT o_custkey, rpt_dt, row_number() OVER (PARTITION BY o_custkey ORDER BY rpt_dt) AS n FROM prio_days)
    SELECT a.o_custkey, a.rpt_dt, b.rpt_dt AS next_dt FROM v a LEFT JOIN v b ON b.o_custkey = a.o_custkey AND b.n = a.n + 1""",
)
def _(t):
    from dimflow.operators.windows import next_value

    out = next_value(t.priority_days(), ["o_custkey"], ["rpt_dt"], "rpt_dt", "next_dt", bounded=True)
    return out.select("o_custkey", "rpt_dt", "next_dt")


@query(
    "jn_any_of_two_columns",
    """WITH d AS (SELECT DISTINCT l_orderkey, CAST(l_shipdate AS DATE) AS shipped,
        CAST(l_shipdate - INTERVAL 30 DAY AS DATE) AS packed FROM lineitem)
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ordered, shipped, packed FROM orders LEFT JOIN d
      ON l_orderkey = o_orderkey AND (CAST(o_orderdate AS DATE) = shipped OR CAST(o_orderdate AS DATE) = packed)""",
)
def _(t):
    shipped = F.to_date("l_shipdate")
    d = t.lineitem.select("l_orderkey", shipped.alias("shipped"), F.date_sub(shipped, 30).alias("packed")).distinct()
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("ordered"))
    return J.join_any(o, d, {"o_orderkey": "l_orderkey"}, "ordered", ["shipped", "packed"]).drop("l_orderkey")


def nullable_sides(t):
    brand = F.when(F.col("p_size") % 5 != 0, F.col("p_brand"))
    kind = F.when(F.col("p_size") % 7 != 0, F.col("p_type"))
    base = t.part.select("p_partkey", brand.alias("brand"), kind.alias("kind"), F.col("p_size").alias("size"))
    left = base.select("p_partkey", F.col("brand").alias("l_brand"), F.col("kind").alias("l_kind"), "size")
    right = base.groupBy("brand", "kind", (F.col("size") + 1).alias("next_size")).agg(F.count(F.lit(1)).alias("n"))
    right = right.select(F.col("brand").alias("r_brand"), F.col("kind").alias("r_kind"), "next_size", "n")
    return left, right


NULLABLE = """base AS (
  SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_brand END AS brand,
    CASE WHEN p_size % 7 <> 0 THEN p_type END AS kind, p_size AS size FROM part),
grp AS (SELECT brand, kind, size + 1 AS next_size, count(*) AS n FROM base GROUP BY ALL)"""


@query(
    "jn_nullable_null_safe",
    f"""WITH {NULLABLE} SELECT p_partkey, b.size, g.n FROM base b LEFT JOIN grp g ON g.next_size = b.size
      AND g.brand IS NOT DISTINCT FROM b.brand AND g.kind IS NOT DISTINCT FROM b.kind""",
)
def _(t):
    left, right = nullable_sides(t)
    return J.join_nullable(left, right, ["brand", "kind"], {"size": "next_size"}).select("p_partkey", "size", "n")


@query(
    "jn_nullable_wildcard",
    f"""WITH {NULLABLE} SELECT p_partkey, b.size, g.brand AS r_brand, g.kind AS r_kind, g.n FROM base b
    LEFT JOIN grp g ON g.next_size = b.size
      AND (g.brand = b.brand OR g.brand IS NULL OR b.brand IS NULL)
      AND (g.kind = b.kind OR g.kind IS NULL OR b.kind IS NULL)""",
)
def _(t):
    left, right = nullable_sides(t)
    out = J.join_nullable(left, right, ["brand", "kind"], {"size": "next_size"}, null_safe=False)
    return out.select("p_partkey", "size", "r_brand", "r_kind", "n")


def customer_tree(t):
    """Each customer under customer number div 10, all in one open interval."""
    return t.customer.select(
        "c_custkey",
        F.expr("c_custkey div 10").alias("boss"),
        F.lit("2020-01-01").cast("date").alias("eff_dt"),
        F.lit("9999-12-31").cast("date").alias("disc_dt"),
    )


TREE = """tree AS (
  SELECT c_custkey, c_custkey // 10 AS boss FROM customer),
paths AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS path, 1 AS depth FROM tree WHERE c_custkey BETWEEN 1 AND 9
  UNION ALL
  SELECT t.c_custkey, p.path || ',' || t.c_custkey, p.depth + 1 FROM tree t JOIN paths p ON t.boss = p.c_custkey)"""


@query("jn_hierarchy", f"WITH RECURSIVE {TREE} SELECT c_custkey, path, CAST(depth AS BIGINT) AS depth FROM paths")
def _(t):
    paths = hierarchy_paths(customer_tree(t), "c_custkey", "boss", list(range(1, 10)))
    return paths.select(
        "c_custkey",
        F.array_join(F.col("path").cast("array<string>"), ",").alias("path"),
        F.size("path").cast("long").alias("depth"),
    )


@query(
    "jn_events_in_interval",
    f"""WITH {VERSIONS} SELECT v.o_custkey, v.eff_dt, o.o_orderkey FROM prio_versions v LEFT JOIN orders o
      ON o.o_custkey = v.o_custkey AND o.o_orderstatus = 'P' AND CAST(o.o_orderdate AS DATE) BETWEEN v.eff_dt AND v.disc_dt""",
)
def _(t):
    events = t.orders.filter("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("who"), "o_orderkey", F.to_date("o_orderdate").alias("dt")
    )
    out = J.events_in_interval(t.priority_versions(), events, {"o_custkey": "who"}, "dt")
    return out.select("o_custkey", "eff_dt", "o_orderkey")


@query(
    "jn_prefer",
    """SELECT c_custkey, coalesce(nullif(trim(CASE WHEN c_nationkey % 3 = 0 THEN ' ' WHEN c_nationkey % 3 = 1
      THEN ' ' || c_mktsegment || ' ' END), ''), n_name) AS label FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def _(t):
    first = F.when(F.col("c_nationkey") % 3 == 0, F.lit(" ")).when(
        F.col("c_nationkey") % 3 == 1, F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))
    )
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", prefer(first, "n_name").alias("label"))


@query(
    "flt_superseded",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority LIKE '5%'
      AND o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1
        HAVING count(DISTINCT o_orderstatus) > 1 AND count(*) FILTER (WHERE o_orderstatus = 'P') > 0))""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    ended = F.col("o_orderpriority").startswith("5")
    return J.exclude_superseded(rows, "o_custkey", "o_orderstatus", "P", ended).drop("o_orderpriority")
