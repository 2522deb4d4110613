"""Scalar functions and the registered SQL functions, over whole columns."""

import datetime as dt

from pyspark.sql import functions as F

from dimflow import functions as X
from dimflow.functions.text import REQUISITION_IDS
from dimflow.operators.reshape import stamp
from dimflow.queries.registry import padded, padded_sql, query

KEY6 = padded_sql("o_orderkey", 6)


def key6():
    return padded("o_orderkey", 6)


@query(
    "fn_surrogate_key",
    """SELECT o_orderkey, md5(coalesce(CAST(CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END AS VARCHAR), '') || '-' ||
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)) AS sk FROM orders""",
)
def _(t):
    who = F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey"))
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return t.orders.select("o_orderkey", X.surrogate_key(who, F.to_date("o_orderdate"), price).alias("sk"))


@query(
    "fn_row_hash",
    """SELECT p_partkey, md5(p_name || '-' || p_brand || '-' || p_type || '-' || CAST(p_size AS VARCHAR)) AS dbt_hash FROM part""",
)
def _(t):
    return t.part.select("p_partkey", X.row_hash("p_name", "p_brand", "p_type", "p_size").alias("dbt_hash"))


@query(
    "fn_conditionals",
    """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS a,
      CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'other' END AS b,
      CASE WHEN o_custkey > 700 THEN 'high' ELSE 'low' END AS c FROM orders""",
)
def _(t):
    s = F.col("o_orderstatus")
    decoded = F.expr("decode(o_orderstatus, 'F', 'final', 'O', 'open', 'other')")
    picked = F.expr("if(o_custkey > 700, 'high', 'low')")
    return t.orders.select(
        "o_orderkey", F.nvl(F.nullif(s, F.lit("P")), F.lit("pending")).alias("a"), decoded.alias("b"), picked.alias("c")
    )


@query(
    "fn_greatest_least",
    """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d1, CASE WHEN o_custkey % 3 <> 0 THEN DATE '1996-06-01' END AS d2 FROM orders)
    SELECT o_orderkey, CASE WHEN d2 IS NOT NULL THEN greatest(d1, d2) END AS hi, CASE WHEN d2 IS NOT NULL THEN least(d1, d2) END AS lo FROM d""",
)
def _(t):
    d1 = F.to_date("o_orderdate")
    d2 = F.when(F.col("o_custkey") % 3 != 0, F.lit("1996-06-01").cast("date"))
    return t.orders.select("o_orderkey", X.greatest_strict(d1, d2).alias("hi"), X.least_strict(d1, d2).alias("lo"))


@query(
    "fn_text_basics",
    "SELECT doc_id, md5(trim(text, ' ')) AS trimmed, upper(source) AS up, left(lang, 1) AS l1, length(text) AS n, length(replace(text, ' ', '')) AS m FROM documents",
)
def _(t):
    return t.documents.select(
        "doc_id",
        F.md5(F.trim("text")).alias("trimmed"),
        F.upper("source").alias("up"),
        F.left("lang", F.lit(1)).alias("l1"),
        F.length("text").cast("long").alias("n"),
        F.length(F.replace("text", F.lit(" "), F.lit(""))).cast("long").alias("m"),
    )


@query("fn_substring", "SELECT c_custkey, substring(c_name, 10, 4) AS a, substring(c_name, 14, 1000) AS b FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.substring("c_name", 10, 4).alias("a"), F.substring("c_name", 14, 1000).alias("b"))


@query(
    "fn_first_token",
    """SELECT p_partkey, trim(substring(p_name, 1, instr(trim(p_name), ' '))) AS a,
      trim(substring(p_brand, 1, instr(trim(p_brand), ' '))) AS b FROM part""",
)
def _(t):
    return t.part.select("p_partkey", X.first_token("p_name").alias("a"), X.first_token("p_brand").alias("b"))


@query(
    "fn_after_colon",
    f"""SELECT o_orderkey, trim(substring('Request: R-' || {KEY6} || ' (new)', instr('Request: R-', ':') + 1, 10)) AS req_id FROM orders""",
)
def _(t):
    text = F.concat(F.lit("Request: R-"), key6(), F.lit(" (new)"))
    return t.orders.select("o_orderkey", X.after_colon(text).alias("req_id"))


@query(
    "fn_split_part",
    """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS zero, split_part(o_orderpriority, '-', 2) AS two,
      split_part(o_orderpriority, '-', 5) AS five, split_part(split_part('x -' || o_orderpriority || ' -y', ' -', 2), '-', 2) AS nested FROM orders""",
)
def _(t):
    joined = F.concat(F.lit("x -"), "o_orderpriority", F.lit(" -y"))
    return t.orders.select(
        "o_orderkey",
        X.split_part_safe("o_orderpriority", "-", 0).alias("zero"),
        X.split_part_safe("o_orderpriority", "-", 2).alias("two"),
        X.split_part_safe("o_orderpriority", "-", 5).alias("five"),
        X.split_part_safe(X.split_part_safe(joined, " -", 2), "-", 2).alias("nested"),
    )


@query(
    "fn_strtok",
    """SELECT c_custkey, split_part(ltrim(regexp_replace('(' || c_name || '((' || c_mktsegment, '[(]+', '(', 'g'), '('), '(', 2) AS two,
      nullif(split_part(c_name, '(', 2), '') AS missing FROM customer""",
)
def _(t):
    text = F.concat(F.lit("("), "c_name", F.lit("(("), "c_mktsegment")
    return t.customer.select("c_custkey", X.strtok(text, "(", 2).alias("two"), X.strtok("c_name", "(", 2).alias("missing"))


@query(
    "fn_concat",
    """SELECT c_custkey, c_name || '/' || c_mktsegment AS a, concat_ws('|', c_name, CASE WHEN c_nationkey > 9 THEN c_mktsegment END, 'x') AS b FROM customer""",
)
def _(t):
    some = F.when(F.col("c_nationkey") > 9, F.col("c_mktsegment"))
    return t.customer.select(
        "c_custkey", F.concat("c_name", F.lit("/"), "c_mktsegment").alias("a"), F.concat_ws("|", "c_name", some, F.lit("x")).alias("b")
    )


CC = f"{padded_sql('o_custkey', 4)} || ' - ' || {padded_sql('o_orderkey', 4)} || ' - ' || left(o_orderpriority, 1) || '00'"


def cc_text():
    return F.concat(
        padded("o_custkey", 4),
        F.lit(" - "),
        padded("o_orderkey", 4),
        F.lit(" - "),
        F.left("o_orderpriority", F.lit(1)),
        F.lit("00"),
    )


@query(
    "fn_cost_center_code",
    f"""SELECT o_orderkey, 'CC_' || trim(split_part({CC}, '-', 1)) || trim(split_part({CC}, '-', 2)) || trim(split_part({CC}, '-', 3)) AS cc FROM orders""",
)
def _(t):
    return t.orders.select("o_orderkey", X.cost_center_code(cc_text()).alias("cc"))


@query(
    "fn_correct_cost_center",
    f"""WITH c AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_custkey % 50 = 0 THEN '0001 - ARCH - 100' ELSE {CC} END AS cc FROM orders)
    SELECT o_orderkey, CASE WHEN cc IS NULL THEN 'none' WHEN trim(substring(cc, 8, 4)) < '1000' OR trim(substring(cc, 8, 4)) = 'ARCH'
      THEN substring(cc, 1, 7) || '0000' || substring(cc, 12, 1000) ELSE cc END AS cc FROM c""",
)
def _(t):
    cc = F.when(F.col("o_orderstatus") == "P", None).when(F.col("o_custkey") % 50 == 0, "0001 - ARCH - 100").otherwise(cc_text())
    return t.orders.select("o_orderkey", X.correct_cost_center(cc, "none").alias("cc"))


@query(
    "fn_strip_code_prefix",
    """SELECT o_orderkey, trim(substring(o_orderpriority, 5, 200)) AS a, 'N' || o_orderpriority AS b FROM orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        X.strip_code_prefix("o_orderpriority").alias("a"),
        X.strip_code_prefix(F.concat(F.lit("N"), "o_orderpriority")).alias("b"),
    )


@query(
    "fn_first_id",
    f"""SELECT o_orderkey, nullif(regexp_extract(CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE 'x P_00' || {KEY6} || ' P_11' || {KEY6} END, 'P_[0-9]{{8}}'), '') AS id FROM orders""",
)
def _(t):
    text = F.when(F.col("o_orderstatus") == "P", "none").otherwise(F.concat(F.lit("x P_00"), key6(), F.lit(" P_11"), key6()))
    return t.orders.select("o_orderkey", X.first_id(text, "P_[0-9]{8}").alias("id"))


IDS_SQL = f"regexp_extract_all(upper('r-' || {KEY6} || ' R_' || {KEY6} || '7 ' || o_orderpriority), '{X.any_of(REQUISITION_IDS)}')"


def ids_text():
    return F.concat(F.lit("r-"), key6(), F.lit(" R_"), key6(), F.lit("7 "), "o_orderpriority")


@query("fn_all_ids", f"SELECT o_orderkey, {IDS_SQL} AS ids FROM orders")
def _(t):
    return t.orders.select("o_orderkey", X.all_ids(ids_text(), REQUISITION_IDS).alias("ids"))


@query(
    "fn_single_or_null",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN {IDS_SQL}[1] END AS id FROM orders""",
)
def _(t):
    ids = X.all_ids(ids_text(), REQUISITION_IDS)
    some = F.when(F.col("o_orderstatus") == "P", F.slice(ids, 1, 1)).when(F.col("o_orderstatus") == "F", ids)
    return t.orders.select("o_orderkey", X.single_or_null(some).alias("id"))


@query(
    "fn_day_arithmetic",
    "SELECT o_orderkey, CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS before, CAST(o_orderdate + INTERVAL 1 DAY AS DATE) AS after FROM orders",
)
def _(t):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", X.day_before(d).alias("before"), X.day_after(d).alias("after"))


@query(
    "fn_to_date",
    "SELECT event_id, CAST(ts AS DATE) AS a, CAST(strptime(strftime(ts, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS b, CAST(ts AS DATE) AS c FROM events",
)
def _(t):
    return t.events.select(
        "event_id",
        F.to_date("ts").alias("a"),
        F.to_date(F.date_format("ts", "dd/MM/yyyy"), "dd/MM/yyyy").alias("b"),
        F.date_format("ts", "yyyy-MM-dd").cast("date").alias("c"),
    )


@query(
    "fn_run_parameters",
    """SELECT c_custkey, DATE '2024-02-01' AS run_dt, CAST(20240201000000 AS BIGINT) AS ins_batch_id FROM customer""",
)
def _(t):
    # Today and now are parameters of a run, so that a run can be repeated.
    now = dt.datetime(2024, 2, 1)
    out = stamp(t.customer.select("c_custkey", F.lit(now.date()).alias("run_dt")), "x", now)
    return out.select("c_custkey", "run_dt", "ins_batch_id")


@query("fn_date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS k FROM orders")
def _(t):
    return t.orders.select("o_orderkey", X.date_key("o_orderdate").alias("k"))


DATE_TEXT = """CASE CAST(o_orderkey % 9 AS INTEGER) WHEN 0 THEN '99999999' WHEN 1 THEN NULL WHEN 2 THEN '2023' WHEN 3 THEN '19400101'
  WHEN 4 THEN '20231345' WHEN 5 THEN '16000101' WHEN 6 THEN '50000101' ELSE strftime(o_orderdate, '%Y%m%d') END"""


def date_text():
    k = F.col("o_orderkey") % 9
    out = F.when(k == 0, "99999999").when(k == 1, None).when(k == 2, "2023").when(k == 3, "19400101")
    out = out.when(k == 4, "20231345").when(k == 5, "16000101").when(k == 6, "50000101")
    return out.otherwise(F.date_format("o_orderdate", "yyyyMMdd"))


@query(
    "fn_parse_yyyymmdd",
    f"""WITH x AS (SELECT o_orderkey, {DATE_TEXT} AS s FROM orders), p AS (SELECT *, CAST(try_strptime(s, '%Y%m%d') AS DATE) AS d FROM x)
    SELECT o_orderkey, CASE WHEN s = '99999999' THEN DATE '1700-01-01' WHEN s IS NULL OR length(s) <> 8 OR d IS NULL THEN DATE '1900-01-01'
      WHEN d = DATE '1940-01-01' THEN DATE '1900-01-01' ELSE least(greatest(d, DATE '1700-01-01'), DATE '4000-12-30') END AS d FROM p""",
)
def _(t):
    return t.orders.select("o_orderkey", X.parse_yyyymmdd(date_text()).alias("d"))


@query(
    "fn_int_to_date_or_default",
    f"""SELECT o_orderkey, coalesce(CAST(try_strptime(CAST(TRY_CAST({DATE_TEXT} AS INTEGER) AS VARCHAR), '%Y%m%d') AS DATE), DATE '1900-01-01') AS d FROM orders""",
)
def _(t):
    number = date_text().try_cast("int")
    return t.orders.select("o_orderkey", X.int_to_date_or_default(number).alias("d"))


@query(
    "fn_parse_ts14",
    "SELECT event_id, date_trunc('second', ts) AS at, CAST(NULL AS TIMESTAMP) AS bad FROM events",
)
def _(t):
    return t.events.select(
        "event_id",
        X.parse_ts14(F.date_format("ts", "yyyyMMddHHmmss")).cast("timestamp_ntz").alias("at"),
        X.parse_ts14("event_type").cast("timestamp_ntz").alias("bad"),
    )


@query(
    "fn_to_bool_or_false",
    "SELECT o_orderkey, CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 0 THEN true WHEN 3 THEN true ELSE false END AS b FROM orders",
)
def _(t):
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, "true").when(k == 1, "false").when(k == 2, "maybe").when(k == 3, "1")
    return t.orders.select("o_orderkey", X.to_bool_or_false(text).alias("b"))


@query(
    "fn_to_int_or_null",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey AS DECIMAL(38,0)) END AS n FROM orders",
)
def _(t):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("x"), key6())).otherwise(key6())
    return t.orders.select("o_orderkey", X.to_int_or_null(text).alias("n"))


@query("fn_to_decimal", "SELECT p_partkey, CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(9,2)) AS d FROM part")
def _(t):
    return t.part.select("p_partkey", X.to_decimal(F.col("p_retailprice").cast("string"), 9, 2).alias("d"))


@query("fn_canonical_code", "SELECT c_custkey, CAST(CAST(substring(c_name, 10, 9) AS INTEGER) AS VARCHAR) AS code FROM customer")
def _(t):
    return t.customer.select("c_custkey", X.canonical_code(F.substring("c_name", 10, 9)).alias("code"))


@query(
    "fn_date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
      CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute, CAST(second(ts) AS INTEGER) AS second FROM events""",
)
def _(t):
    rows = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
    return X.add_date_parts(rows, "at", levels=("year", "month", "day", "hour", "minute", "second")).drop("at")


@query(
    "fn_flags",
    "SELECT p_partkey, CAST(p_brand IN ('Brand#2', 'Brand#5') AS INTEGER) AS brand_ind, CAST(p_size > 25 AS INTEGER) AS big_ind FROM part",
)
def _(t):
    return t.part.select(
        "p_partkey", X.flag(F.col("p_brand").isin("Brand#2", "Brand#5")).alias("brand_ind"), X.flag(F.col("p_size") > 25).alias("big_ind")
    )


@query(
    "fn_stringify",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS p,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders""",
)
def _(t):
    p = F.when(F.col("o_orderstatus") == "F", "nan").when(F.col("o_orderstatus") == "P", "<NA>").otherwise(F.col("o_orderpriority"))
    return X.stringify(t.orders.select("o_orderkey", p.alias("p"), F.to_date("o_orderdate").alias("d")))


def with_functions(t, sql: str, **tables):
    X.register_functions(t.spark)
    return t.spark.sql(sql, **tables)


@query("udf_datetoint", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS k FROM orders")
def _(t):
    return with_functions(t, "SELECT o_orderkey, datetoint(CAST(o_orderdate AS DATE)) AS k FROM {orders}", orders=t.orders)


@query("udf_inttodate", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def _(t):
    sql = "SELECT o_orderkey, inttodate(CAST(date_format(o_orderdate, 'yyyyMMdd') AS BIGINT)) AS d FROM {orders}"
    return with_functions(t, sql, orders=t.orders)


@query("udf_timestamptoint", "SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M%S%g') AS BIGINT) AS k FROM events")
def _(t):
    return with_functions(t, "SELECT event_id, timestamptoint(CAST(ts AS TIMESTAMP)) AS k FROM {events}", events=t.events)


@query("udf_inttotimestamp", "SELECT event_id, date_trunc('milliseconds', ts) AS at FROM events")
def _(t):
    sql = """SELECT event_id, CAST(inttotimestamp(timestamptoint(CAST(ts AS TIMESTAMP))) AS TIMESTAMP_NTZ) AS at FROM {events}"""
    return with_functions(t, sql, events=t.events)
