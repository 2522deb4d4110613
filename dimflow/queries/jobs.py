"""The composite jobs, each run over whole tables brought into the job's shape."""

import datetime as dt

from pyspark.sql import functions as F

from dimflow.functions.keys import surrogate_key
from dimflow.plans import employee, facts, landing, organization, pay, position, scd
from dimflow.queries.columns import INTERSECT, LOG, graded_snapshot
from dimflow.queries.incremental import SPLIT
from dimflow.queries.joins import TEXT_IDS, order_texts, requisition_dim
from dimflow.queries.sinks import stored
from dimflow.queries.registry import SHIPMENTS, SNAP, SNAP_VERSIONS, VERSIONS, padded, padded_sql, query

OPEN = "DATE '9999-12-31'"

# -- Type-1 and Type-2 dimensions ------------------------------------------------

RENAME = {"o_custkey": "customer_id", "o_orderkey": "order_id", "o_orderstatus": "status", "o_orderdate": "order_dtm"}


def newest():
    return [F.desc("order_dtm"), F.desc("order_id")]



@query(
    "job_scd1_full",
    """SELECT md5(CAST(o_custkey AS VARCHAR)) AS cust_sk, o_custkey AS customer_id, o_orderkey AS order_id, o_orderstatus AS status,
      o_orderdate AS order_dtm FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(t):
    return scd.build_scd1(t.orders, ["customer_id"], newest(), sk="cust_sk", rename=RENAME)


@query(
    "job_scd1_incremental",
    """SELECT md5(CAST(o_custkey AS VARCHAR)) AS cust_sk, o_custkey AS customer_id, o_orderkey AS order_id, o_orderstatus AS status,
      o_orderdate AS order_dtm, 'CRM' AS rec_src,
      CASE WHEN o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < DATE '1998-01-01') THEN 20240101000000 ELSE 20240201000000 END AS ins_batch_id,
      CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 20240201000000 ELSE 20240101000000 END AS upd_batch_id
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(t):
    old = t.orders.filter(F.col("o_orderdate") < F.lit(SPLIT).cast("date"))
    how = dict(sk="cust_sk", rename=RENAME, rec_src="CRM")
    target = stored(t, scd.build_scd1(old, ["customer_id"], newest(), now=dt.datetime(2024, 1, 1), **how), "scd1")
    return scd.build_scd1(
        t.orders, ["customer_id"], newest(), target=target, date_col="order_dtm", now=dt.datetime(2024, 2, 1), **how
    )


@query(
    "job_scd1_per_key_mark",
    """SELECT md5(CAST(o_custkey AS VARCHAR)) AS cust_sk, o_custkey AS customer_id, o_orderkey AS order_id, o_orderstatus AS status,
      o_orderdate AS order_dtm FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
        CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderkey DESC) = 1""",
)
def _(t):
    old = t.orders.filter("o_orderstatus = 'F'")
    target = stored(t, scd.build_scd1(old, ["customer_id"], newest(), sk="cust_sk", rename=RENAME), "scd1")
    return scd.build_scd1(
        t.orders, ["customer_id"], newest(), sk="cust_sk", rename=RENAME, target=target, date_col="order_dtm", per_key_mark=True
    )


SCD2_COLS = "user_id, event_type, rpt_dt, eff_dt, disc_dt"
SCD2_KEYS = """md5(CAST(user_id AS VARCHAR) || '-' || CAST(eff_dt AS VARCHAR)) AS user_sk, user_id, event_type, rpt_dt, eff_dt, disc_dt,
      disc_dt = DATE '9999-12-31' AS is_current, md5(event_type) AS dbt_hash"""


@query("job_scd2_islands", f"WITH {SNAP}, {SNAP_VERSIONS} SELECT {SCD2_KEYS} FROM snap_versions")
def _(t):
    return scd.build_scd2(t.snapshot(), ["user_id"], ["event_type"], "rpt_dt", sk="user_sk", one_row_a_day=True)


FIRST_SEEN = f"""{SNAP}, seen AS (SELECT user_id, event_type, min(rpt_dt) AS rpt_dt FROM snap WHERE %s GROUP BY 1, 2),
v AS (SELECT user_id, event_type, rpt_dt, rpt_dt AS eff_dt, lead(rpt_dt) OVER (PARTITION BY user_id ORDER BY rpt_dt, event_type) AS nxt FROM seen),
c AS (SELECT user_id, event_type, rpt_dt, eff_dt, CASE WHEN nxt IS NULL THEN {OPEN} WHEN nxt = eff_dt THEN eff_dt
  ELSE CAST(nxt - INTERVAL 1 DAY AS DATE) END AS disc_dt FROM v)"""


@query("job_scd2_first_seen", f"WITH {FIRST_SEEN % 'true'} SELECT {SCD2_KEYS} FROM c")
def _(t):
    return scd.build_scd2(t.snapshot(), ["user_id"], ["event_type"], "rpt_dt", sk="user_sk", method="first_seen", one_row_a_day=True)


@query("job_scd2_incremental", f"WITH {SNAP}, {SNAP_VERSIONS} SELECT {SCD2_KEYS} FROM snap_versions")
def _(t):
    # Loading up to a day and then the rest gives the same table as one full load.
    snap, day = t.snapshot(), dt.date(2024, 1, 15)
    how = dict(sk="user_sk", one_row_a_day=True)
    first = scd.build_scd2(snap.filter(F.col("rpt_dt") <= F.lit(day)), ["user_id"], ["event_type"], "rpt_dt", **how)
    how |= dict(arrived=F.col("rpt_dt") > F.lit(day), done=day)
    return scd.build_scd2(snap, ["user_id"], ["event_type"], "rpt_dt", target=stored(t, first, "scd2"), **how)


@query("job_scd2_late_reports", f"WITH {SNAP}, {SNAP_VERSIONS} SELECT {SCD2_KEYS} FROM snap_versions")
def _(t):
    # The second run brings the days after the first, and older days of some users that came late.
    snap, day = t.snapshot(), dt.date(2024, 1, 15)
    late = (F.pmod("user_id", F.lit(5)) == 0) & (F.dayofmonth("rpt_dt") == 9)
    arrived = (F.col("rpt_dt") > F.lit(day)) | late
    how = dict(sk="user_sk", one_row_a_day=True)
    first = scd.build_scd2(snap.filter(~arrived), ["user_id"], ["event_type"], "rpt_dt", **how)
    how |= dict(arrived=arrived, done=day)
    return scd.build_scd2(snap, ["user_id"], ["event_type"], "rpt_dt", target=stored(t, first, "scd2"), **how)


UNTIL = "rpt_dt <= DATE '2024-01-20'"


@query("job_scd2_history", f"WITH {FIRST_SEEN % UNTIL} SELECT {SCD2_KEYS} FROM c")
def _(t):
    from dimflow.plans.incremental import backfill_once

    path = t.scratch("history")
    for until in (dt.date(2024, 1, 20), dt.date(2024, 1, 25)):  # the second run finds the target and writes nothing
        backfill_once(
            t.spark,
            path,
            lambda: scd.load_scd2_history(
                t.snapshot(), ["user_id"], ["event_type"], "rpt_dt", sk="user_sk", until=until, one_row_a_day=True
            ),
        )
    return t.spark.read.parquet(path)


@query(
    "job_close_disappeared",
    f"""WITH {SNAP}, {SNAP_VERSIONS}, gone AS (
      SELECT user_id AS u, max(rpt_dt) AS last FROM snap GROUP BY 1 HAVING max(rpt_dt) <> (SELECT max(rpt_dt) FROM snap)),
    closed AS (SELECT user_id, event_type, rpt_dt, eff_dt, CASE WHEN disc_dt = {OPEN} AND last IS NOT NULL THEN last ELSE disc_dt END AS disc_dt
      FROM snap_versions LEFT JOIN gone ON u = user_id)
    SELECT {SCD2_KEYS} FROM closed""",
)
def _(t):
    snap = t.snapshot()
    dim = scd.build_scd2(snap, ["user_id"], ["event_type"], "rpt_dt", sk="user_sk", one_row_a_day=True)
    return scd.close_disappeared(dim, snap, ["user_id"], "rpt_dt")


# -- attribute logs ----------------------------------------------------------------


def finish_log(changes: str, key: str, deleted: str) -> str:
    return f"""marked AS (
      SELECT c.*, lead(eff_dt) OVER w AS next_eff, lead(current_value) OVER w AS next_value FROM {changes} c
      WINDOW w AS (PARTITION BY {key}, change_column ORDER BY eff_dt, current_value)),
    gone AS (SELECT {key} AS gone_key, max(rpt_dt) AS last FROM snap GROUP BY 1 HAVING max(rpt_dt) <> (SELECT max(rpt_dt) FROM snap)),
    flagged AS (SELECT *, coalesce(CAST(next_eff - INTERVAL 1 DAY AS DATE), {OPEN}) AS disc_dt, CAST(next_eff IS NULL AS INTEGER) AS is_current,
      CAST(next_eff IS NULL AND last IS NOT NULL AS INTEGER) AS is_deleted FROM marked LEFT JOIN gone ON gone_key = {key})
    SELECT md5(change_column || '-' || CAST({key} AS VARCHAR) || '-' || CAST(rpt_dt AS VARCHAR)) AS event_sk, change_column, {key},
      current_value, prior_value, next_value, eff_dt, disc_dt, is_current, is_deleted,
      CASE WHEN is_deleted = 1 THEN CAST(last + INTERVAL 1 DAY AS DATE) END AS deleted_dt,
      CASE WHEN is_deleted = 1 THEN '{deleted}' WHEN eff_dt > disc_dt THEN 'Rescind' END AS change_type FROM flagged"""


CHANGES = LOG.rsplit(",\nlog AS", 1)[0] + ", changes AS (SELECT *, rpt_dt AS eff_dt FROM chg)"


@query("job_attribute_log", f"WITH {CHANGES}, {finish_log('changes', 'user_id', 'Deleted')}")
def _(t):
    return scd.build_attribute_log(graded_snapshot(t), ["user_id"], ["state", "grade"], "rpt_dt", one_row_a_day=True)


def leavers(t):
    """Daily snapshot where an error day carries a termination date."""
    term = F.when(F.col("event_type") == "error", F.date_add("rpt_dt", (F.col("event_id") % 3).cast("int") - 1))
    return t.snapshot().select(
        "user_id",
        "rpt_dt",
        term.alias("termination_dt"),
        F.date_sub("rpt_dt", (F.col("event_id") % 30).cast("int")).alias("original_hire_dt"),
        F.col("event_type").alias("state"),
        (F.col("event_id") % 4).cast("string").alias("grade"),
    )


LEAVERS = f"""{SNAP}, leavers AS (SELECT user_id, rpt_dt, CASE WHEN event_type = 'error'
    THEN CAST(rpt_dt + INTERVAL (CAST(event_id % 3 AS INTEGER) - 1) DAY AS DATE) END AS term,
    CAST(rpt_dt - INTERVAL (CAST(event_id % 30 AS INTEGER)) DAY AS DATE) AS hire,
    event_type AS state, CAST(event_id % 4 AS VARCHAR) AS grade FROM snap),
  known AS (SELECT user_id, term FROM leavers WHERE term IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rpt_dt DESC) = 1),
  points AS (SELECT l.user_id, '1900-01-01' AS v, l.rpt_dt AS day FROM leavers l LEFT JOIN known k ON k.user_id = l.user_id
      WHERE l.term IS NULL AND (k.term IS NULL OR l.rpt_dt < k.term)
    UNION ALL SELECT user_id, CAST(term AS VARCHAR), term FROM known),
  lagged AS (SELECT *, lag(v) OVER (PARTITION BY user_id ORDER BY day, v) AS p FROM points),
  terms AS (SELECT 'TERMINATION_DT' AS change_column, user_id, nullif(v, '1900-01-01') AS current_value, nullif(p, '1900-01-01') AS prior_value,
    CASE WHEN v <> '1900-01-01' THEN CAST(day + INTERVAL 1 DAY AS DATE) ELSE day END AS eff_dt, day AS rpt_dt
    FROM lagged WHERE p IS NULL OR p <> v)"""


@query("job_termination_log", f"WITH {LEAVERS}, {finish_log('terms', 'user_id', 'Deleted')}")
def _(t):
    return scd.build_termination_log(leavers(t), "user_id", "termination_dt", "rpt_dt")


@query(
    "job_employee_log",
    f"""WITH {LEAVERS}, tall AS (SELECT user_id, rpt_dt, hire, 'state' AS change_column, state AS current_value FROM leavers
      UNION ALL SELECT user_id, rpt_dt, hire, 'grade', grade FROM leavers),
    chg AS (SELECT *, lag(current_value) OVER (PARTITION BY user_id, change_column ORDER BY rpt_dt) AS prior_value FROM tall
      QUALIFY prior_value IS NULL OR prior_value <> current_value),
    both_logs AS (SELECT change_column, user_id, current_value, prior_value,
        CASE WHEN prior_value IS NULL THEN greatest(hire, DATE '2023-12-20') ELSE rpt_dt END AS eff_dt, rpt_dt FROM chg
      UNION ALL SELECT * FROM terms), {finish_log('both_logs', 'user_id', 'Employee_Deleted')}""",
)
def _(t):
    return scd.build_employee_log(
        leavers(t),
        "user_id",
        ["state", "grade"],
        "rpt_dt",
        term_col="termination_dt",
        hire_col="original_hire_dt",
        first_report=dt.date(2023, 12, 20),
    )


@query(
    "job_wide_view",
    f"""WITH w AS ({INTERSECT})
    SELECT md5(CAST(user_id AS VARCHAR) || CAST(eff_dt AS VARCHAR)) AS emp_sk, * FROM w""",
)
def _(t):
    log = scd.build_attribute_log(graded_snapshot(t), ["user_id"], ["state", "grade"], "rpt_dt", one_row_a_day=True)
    return scd.wide_view(log, "user_id", ["state", "grade"])


# -- facts -------------------------------------------------------------------------

LINES_PK = "md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR))"
LINE_TOP = "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY ship_dt DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1"


def shipment_spec(t, customers=None):
    versions = t.priority_versions()
    if customers is not None:
        versions = versions.filter(customers)
    parts = t.part.select(F.col("p_partkey").alias("part_id"), surrogate_key("p_partkey").alias("part_sk"))
    return facts.FactSpec(
        pk="line_pk",
        pk_cols=["l_orderkey", "l_linenumber"],
        event_col="ship_dt",
        lookups=[
            facts.Lookup(versions, {"o_custkey": "o_custkey"}, "cust_sk", date_col="ship_dt"),
            facts.Lookup(parts, {"l_partkey": "part_id"}, "part_sk"),
        ],
        order=[F.desc("ship_dt"), F.desc("l_partkey"), F.desc("l_suppkey"), F.desc("l_quantity")],
        columns=["l_orderkey", "l_linenumber", "ship_dt", "l_quantity"],
    )


FACT_SQL = f"""WITH {VERSIONS}, {SHIPMENTS}, one AS (SELECT * FROM shipments {LINE_TOP})
    SELECT {LINES_PK} AS line_pk, coalesce(v.cust_sk, '-1') AS cust_sk, coalesce(md5(CAST(p_partkey AS VARCHAR)), '-1') AS part_sk,
      l_orderkey, l_linenumber, ship_dt, l_quantity
    FROM one LEFT JOIN prio_versions v ON v.o_custkey = one.o_custkey AND ship_dt BETWEEN v.eff_dt AND v.disc_dt
    LEFT JOIN part ON p_partkey = l_partkey"""


@query("job_fact", FACT_SQL)
def _(t):
    return facts.build_fact(t.shipments(), shipment_spec(t))


@query("job_fact_incremental", FACT_SQL)
def _(t):
    # First run: shipments up to a day, versions of one priority still unknown.
    early = t.shipments().filter(F.col("ship_dt") < F.lit("1999-01-01").cast("date"))
    first = facts.build_fact(early, shipment_spec(t, F.col("o_orderpriority") != "2-HIGH"))
    return facts.build_fact(t.shipments(), shipment_spec(t), target=stored(t, first, "fact", compression="zstd"))


@query(
    "job_requisition_fact",
    f"""WITH {TEXT_IDS}
    SELECT md5(CAST(o_orderkey AS VARCHAR)) AS job_req_event_pk, CASE WHEN len(req_ids) > 1 THEN '-2' WHEN len(req_ids) = 0 THEN '-1'
        ELSE coalesce(r.job_req_sk, '-1') END AS job_req_sk,
      CASE WHEN len(req_ids) > 1 THEN 'MULTIPLE' WHEN len(req_ids) = 1 THEN req_ids[1] END AS job_req_id,
      CASE WHEN len(pos_ids) > 1 THEN 'MULTIPLE' WHEN len(pos_ids) = 1 THEN pos_ids[1] END AS position_id,
      o_orderkey, bp_completed_dtm
    FROM found LEFT JOIN reqs r ON len(req_ids) = 1 AND r.job_req_id = req_ids[1]""",
)
def _(t):
    return facts.build_requisition_fact(
        order_texts(t),
        requisition_dim(t),
        pk_cols=["o_orderkey"],
        event_col="bp_completed_dtm",
        text_cols=["subject", "note", "place"],
        columns=["o_orderkey", "bp_completed_dtm"],
    )


def pay_lines(t):
    return t.orders.select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("pay_dt"), F.left("o_orderpriority", F.lit(1)).alias("pay_code")
    )


def payroll_spec(t, codes):
    names = t.orders.select(F.left("o_orderpriority", F.lit(1)).alias("pay_cd")).distinct().filter(codes)
    names = names.withColumn("pay_cd_sk", surrogate_key("pay_cd"))
    staffed = t.priority_versions().withColumnRenamed("cust_sk", "emp_sk")
    return facts.FactSpec(
        pk="line_pk",
        pk_cols=["o_orderkey"],
        event_col="pay_dt",
        lookups=[
            facts.Lookup(staffed, {"o_custkey": "o_custkey"}, "emp_sk", date_col="pay_dt"),
            facts.Lookup(names, {"pay_code": "pay_cd"}, "pay_cd_sk"),
        ],
        columns=["o_custkey", "pay_dt"],
    )


@query(
    "job_payroll_fact",
    f"""WITH {VERSIONS} SELECT md5(CAST(o_orderkey AS VARCHAR)) AS line_pk, coalesce(v.cust_sk, '-1') AS emp_sk,
      md5(left(o.o_orderpriority, 1)) AS pay_cd_sk, o.o_custkey, CAST(o_orderdate AS DATE) AS pay_dt
    FROM orders o LEFT JOIN prio_versions v ON v.o_custkey = o.o_custkey AND CAST(o_orderdate AS DATE) BETWEEN v.eff_dt AND v.disc_dt""",
)
def _(t):
    # First run: without one segment's customers, one pay code unknown. The second run adds
    # each known customer's rows past their own mark, retries the unknown code
    # and takes new customers whole.
    lines = pay_lines(t)
    known = t.customer.filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    early = lines.filter(F.col("pay_dt") < F.lit(SPLIT).cast("date")).join(known, "o_custkey", "left_semi")
    first = facts.build_payroll_fact(early, payroll_spec(t, F.col("pay_cd") != "3"), entity="o_custkey")
    target = stored(t, first, "payroll")
    return facts.build_payroll_fact(lines, payroll_spec(t, F.lit(True)), entity="o_custkey", target=target)


PURCHASE_STATE = f"""WITH {SNAP}, {SNAP_VERSIONS}
    SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS event_dt, v.event_type AS state, v.eff_dt, v.disc_dt,
      coalesce(md5(CAST(v.user_id AS VARCHAR) || '-' || CAST(v.eff_dt AS VARCHAR)), '-1') AS user_sk
    FROM events e LEFT JOIN snap_versions v ON v.user_id = e.user_id AND CAST(e.ts AS DATE) BETWEEN v.eff_dt AND v.disc_dt
    WHERE e.event_type = 'purchase'"""


@query("job_purchase_state", PURCHASE_STATE)
def purchase_state(t):
    """For each purchase: the version of the user's daily state valid on that day."""
    versions = scd.type2_versions(
        t.snapshot(), ["user_id"], ["event_type"], "rpt_dt", sk="user_sk", one_row_a_day=True
    ).select(F.col("user_id").alias("who"), F.col("event_type").alias("state"), "eff_dt", "disc_dt", "user_sk")
    buys = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", F.to_date("ts").alias("event_dt"))
    valid = F.col("event_dt").between(F.col("eff_dt"), F.col("disc_dt"))
    met = buys.join(versions, (F.col("user_id") == F.col("who")) & valid, "left").drop("who")
    return met.withColumn("user_sk", F.coalesce("user_sk", F.lit("-1")))


# -- employee and position dimensions ------------------------------------------------


def staff(t):
    """Daily employee snapshot and event feed made from the event table."""
    snap = t.snapshot()
    k = F.col("event_id")
    wid = F.col("user_id").cast("string")
    snapshots = snap.select(
        F.col("user_id").alias("ein"),
        F.col("rpt_dt").alias("rpt_effective_dt"),
        F.col("event_type").alias("job_code"),
        F.when(k % 7 == 0, "Contingent Worker").otherwise("Employee").alias("worker_type"),
        F.when(F.col("event_type") == "error", "Terminated").otherwise("Active").alias("status"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("active_status"),
        (F.col("user_id") % 5 == 0).cast("int").alias("is_rehire"),
        F.lit("2020-01-01").cast("date").alias("original_hire_dt"),
        F.concat(F.lit("2000 - "), F.lpad((F.col("user_id") * 40).cast("string"), F.greatest(F.length((F.col("user_id") * 40).cast("string")), F.lit(4)), F.lit("0")), F.lit(" - 300")).alias("cost_center_id"),
        F.when(k % 2 == 0, F.col("rpt_dt")).alias("termination_dt"),
    )
    day = F.to_date("ts")
    kind = (
        F.when(F.col("event_type") == "signup", "Hire")
        .when(F.col("event_type") == "error", "Termination")
        .otherwise("Other")
    )
    events = t.events.select(
        F.col("user_id").alias("ein"),
        kind.alias("bp_type"),
        F.when(k % 6 == 0, "Canceled").otherwise("Successfully Completed").alias("bp_transaction_status"),
        day.alias("bp_effective_dt"),
        F.date_add(day, (k % 3).cast("int")).alias("bp_event_completed_dt"),
        F.concat(F.lit("Leave > Own > Reason "), (k % 4).cast("string"), F.lit(" (inactive)")).alias("bp_reason_sens"),
        (k % 2).cast("string").alias("term_eligible_for_rehire_ind_sens"),
        F.date_add(day, 14).alias("term_pay_through_dt"),
        F.concat(F.lit("w"), F.lpad(k.cast("string"), F.greatest(F.length(k.cast("string")), F.lit(12)), F.lit("0"))).alias("overall_bp_wid"),
    )
    return snapshots, events, wid


STAFF = f"""{SNAP}, stage AS (SELECT user_id AS ein, rpt_dt, event_type AS job_code,
    CASE WHEN event_id % 7 = 0 THEN 'Contingent Worker' ELSE 'Employee' END AS worker_type,
    CASE WHEN event_type = 'error' THEN 'Terminated' ELSE 'Active' END AS status,
    CAST(event_type <> 'error' AS INTEGER) AS active_status, CAST(user_id % 5 = 0 AS INTEGER) AS is_rehire,
    CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN rpt_dt END AS termination_dt FROM snap),
  kept AS (SELECT * FROM stage WHERE NOT (worker_type = 'Contingent Worker' AND status = 'Terminated' AND ein IN (
    SELECT ein FROM stage GROUP BY 1 HAVING count(DISTINCT worker_type) > 1))),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY ein ORDER BY rpt_dt)
    - row_number() OVER (PARTITION BY ein, job_code, worker_type, status, active_status, is_rehire, termination_dt ORDER BY rpt_dt) AS run FROM kept),
  versions AS (SELECT ein, job_code, worker_type, status, is_rehire, min(rpt_dt) AS eff_dt FROM numbered
    GROUP BY ein, job_code, worker_type, status, active_status, is_rehire, termination_dt, run),
  feed AS (SELECT user_id AS ein, event_id, event_type, CAST(ts AS DATE) AS eff, CAST(ts + INTERVAL (CAST(event_id % 3 AS INTEGER)) DAY AS DATE) AS done
    FROM events WHERE event_id % 6 <> 0),
  hired AS (SELECT v.*, CASE WHEN EXISTS (SELECT 1 FROM feed f WHERE f.ein = v.ein AND f.event_type = 'signup' AND f.eff = v.eff_dt) THEN v.eff_dt END AS h FROM versions v),
  grouped AS (SELECT *, count(h) OVER (PARTITION BY ein ORDER BY eff_dt) AS g FROM hired),
  hires AS (SELECT *, coalesce(max(h) OVER (PARTITION BY ein, g), DATE '2020-01-01') AS hire_dt FROM grouped),
  ends AS (SELECT * FROM feed WHERE event_type = 'error'
    QUALIFY row_number() OVER (PARTITION BY ein, eff ORDER BY done DESC, event_id) = 1),
  met AS (SELECT h.*, e.event_id, e.eff, e.done FROM hires h LEFT JOIN ends e ON e.ein = h.ein AND (e.done = h.eff_dt OR e.eff = h.eff_dt)
    QUALIFY row_number() OVER (PARTITION BY h.ein, h.eff_dt ORDER BY e.done DESC NULLS LAST, e.eff DESC NULLS LAST) = 1),
  own AS (SELECT *, CASE WHEN is_rehire = 0 THEN eff END AS td, CASE WHEN is_rehire = 0 THEN done END AS tc,
    CASE WHEN is_rehire = 0 AND event_id IS NOT NULL THEN 'Reason ' || (event_id % 4) END AS tr,
    CASE WHEN is_rehire = 0 AND event_id IS NOT NULL THEN 'w' || {padded_sql("event_id", 12)} END AS tw FROM met),
  filled AS (SELECT *, max(td) OVER w AS mtd, max(tc) OVER w AS mtc, max(tr) OVER w AS mtr, max(tw) OVER w AS mtw,
    lead(eff_dt) OVER (PARTITION BY ein ORDER BY eff_dt) AS nxt FROM own WINDOW w AS (PARTITION BY ein ORDER BY eff_dt))"""


@query(
    "job_employee_dim",
    f"""WITH {STAFF}
    SELECT md5(CAST(ein AS VARCHAR) || '-' || CAST(eff_dt AS VARCHAR)) AS emp_sk, ein, job_code, worker_type, eff_dt,
      coalesce(CAST(nxt - INTERVAL 1 DAY AS DATE), {OPEN}) AS disc_dt, nxt IS NULL AS is_curr, hire_dt,
      CASE WHEN td IS NULL AND is_rehire = 0 THEN mtd ELSE td END AS term_dt,
      CASE WHEN tc IS NULL AND is_rehire = 0 THEN mtc ELSE tc END AS term_completed_dt,
      CASE WHEN tr IS NULL AND is_rehire = 0 THEN mtr ELSE tr END AS term_reason_sens,
      CASE WHEN tw IS NULL AND is_rehire = 0 THEN mtw ELSE tw END AS term_wid,
      CASE WHEN {padded_sql('ein * 40', 4)} < '1000' THEN 'CC_20000000300'
        ELSE 'CC_2000' || {padded_sql('ein * 40', 4)} || '300' END AS cost_center_cd
    FROM filled""",
)
def _(t):
    snapshots, events, _ = staff(t)
    out = employee.build_employee_dim(snapshots, events, one_row_a_day=True)
    return out.select(
        "emp_sk", "ein", "job_code", "worker_type", "eff_dt", "disc_dt", "is_curr", "hire_dt", "term_dt",
        "term_completed_dt", "term_reason_sens", "term_wid", "cost_center_cd",
    )


@query(
    "job_position_dim",
    f"""WITH {SNAP}, p AS (SELECT user_id AS position_id, rpt_dt, event_type AS job_cd, CAST(event_id % 3 = 0 AS INTEGER) AS ovl FROM snap),
    runs AS (SELECT * FROM p WINDOW w AS (PARTITION BY position_id ORDER BY rpt_dt)
      QUALIFY row_number() OVER w = 1 OR lag(job_cd) OVER w <> job_cd OR lag(ovl) OVER w <> ovl),
    v AS (SELECT *, lead(rpt_dt) OVER (PARTITION BY position_id ORDER BY rpt_dt) AS nxt,
      last_value(ovl) OVER (PARTITION BY position_id ORDER BY rpt_dt ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS newest FROM runs),
    o AS (SELECT position_id, rpt_dt, lead(rpt_dt) OVER (PARTITION BY position_id ORDER BY rpt_dt) AS next_ovl FROM runs WHERE ovl = 1),
    d AS (SELECT v.*, CASE WHEN v.ovl = 1 THEN
        CASE WHEN next_ovl IS NOT NULL THEN CAST(next_ovl - INTERVAL 1 DAY AS DATE) WHEN newest = 1 THEN {OPEN} ELSE CAST(nxt - INTERVAL 1 DAY AS DATE) END
        ELSE coalesce(CAST(nxt - INTERVAL 1 DAY AS DATE), {OPEN}) END AS disc_dt
      FROM v LEFT JOIN o ON o.position_id = v.position_id AND o.rpt_dt = v.rpt_dt)
    SELECT md5(CAST(position_id AS VARCHAR) || '-' || CAST(rpt_dt AS VARCHAR)) AS position_sk, position_id, job_cd, ovl AS has_overlap_worker_ind,
      rpt_dt AS rpt_eff_dt, rpt_dt AS eff_dt, disc_dt, disc_dt = {OPEN} AS is_current, md5(job_cd || '-' || ovl) AS dbt_hash FROM d""",
)
def _(t):
    rows = t.snapshot().select(
        F.col("user_id").alias("position_id"),
        F.col("event_type").alias("job_cd"),
        (F.col("event_id") % 3 == 0).cast("int").alias("has_overlap_worker_ind"),
        F.col("rpt_dt").alias("rpt_eff_dt"),
    )
    return position.build_position_dim(rows, one_row_a_day=True)


@query(
    "job_manager_hierarchy",
    """WITH RECURSIVE pos AS (
      SELECT c_custkey AS position_id, c_custkey AS emp, c_custkey // 10 AS mgr, DATE '2020-01-01' + CAST(c_custkey % 3 AS INTEGER) AS eff_dt,
        CASE WHEN c_custkey % 10 = 5 THEN DATE '2020-01-02' ELSE DATE '9999-12-31' END AS disc_dt FROM customer),
    paths AS (
      SELECT position_id, emp, eff_dt, disc_dt, CAST(emp AS VARCHAR) AS path, 1 AS depth FROM pos WHERE emp BETWEEN 1 AND 9
      UNION ALL
      SELECT c.position_id, c.emp, c.eff_dt, c.disc_dt, p.path || ',' || c.emp, p.depth + 1 FROM pos c JOIN paths p
        ON c.mgr = p.emp AND c.eff_dt BETWEEN p.eff_dt AND p.disc_dt),
    members AS (SELECT position_id, string_split(path, ',')[i] AS manager_hier, i AS level, min(eff_dt) AS eff_dt
      FROM paths, range(1, depth + 1) AS r(i) GROUP BY ALL),
    dated AS (SELECT *, lead(eff_dt) OVER (PARTITION BY position_id, level ORDER BY eff_dt, manager_hier) AS nxt FROM members)
    SELECT md5(CAST(position_id AS VARCHAR) || '-' || CAST(level AS VARCHAR) || '-' || CAST(eff_dt AS VARCHAR)) AS manager_sk, position_id,
      manager_hier, CAST(level AS BIGINT) AS level, eff_dt, coalesce(CAST(nxt - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS disc_dt,
      nxt IS NULL AS is_current FROM dated""",
)
def _(t):
    key = F.col("c_custkey")
    end = F.when(key % 10 == 5, F.lit("2020-01-02").cast("date")).otherwise(F.lit("9999-12-31").cast("date"))
    rows = t.customer.select(
        key.alias("position_id"),
        key.cast("string").alias("emp_id"),
        F.expr("cast(c_custkey div 10 as string)").alias("mgr_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (key % 3).cast("int")).alias("eff_dt"),
        end.alias("disc_dt"),
    )
    out = position.build_manager_hierarchy(rows, [str(i) for i in range(1, 10)])
    return out.withColumn("level", F.col("level").cast("long"))


# -- organisation --------------------------------------------------------------------


def org_inputs(t):
    """Hierarchy and company feeds: one place per customer."""
    key = F.col("c_custkey")
    # Division and department together tell customers apart; the department keeps all higher digits.
    div = F.lpad((key % 10_000).cast("string"), 4, "0")
    high = F.expr("c_custkey div 10000").cast("string")
    dept = F.lpad(high, F.greatest(F.length(high), F.lit(3)), F.lit("0"))
    local = F.when(key % 4 == 0, None).otherwise(F.lpad((1000 + key % 7).cast("string"), 4, "0"))
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    levels = {
        "region_nbr": F.col("n_regionkey").cast("string"), "region_nm": F.concat(F.lit(" R"), F.col("n_regionkey").cast("string")),
        "area_nbr": F.col("n_nationkey").cast("string"), "area_nm": F.col("n_name"),
        "bu_nbr": F.left("c_mktsegment", F.lit(2)), "bu_desc": F.col("c_mktsegment"),
        "div_nbr": div, "div_nm": F.col("c_name"),
        "lob": F.lit("L1"), "lob_desc": F.lit("  "), "lob_category": F.lit("LC"),
        "sub_lob": dept, "sub_lob_desc": F.concat(F.lit("dept "), dept),
        "local_use": local, "local_desc": F.concat(F.lit("local "), local),
    }
    own = {n: c for n, c in levels.items() if not n.startswith("local")}
    hier = places.select(
        *[c.alias(n) for n, c in levels.items()],
        *[c.alias(f"cur_{n}") for n, c in own.items()],
        F.when(F.col("c_mktsegment") == "MACHINERY", "XX").otherwise("OFC").alias("source_system"),
        F.when(key % 5 == 0, F.lit("1900-01-01")).otherwise(F.lit("2020-05-01")).cast("date").alias("eff_dt"),
        F.when(key % 3 == 0, None).when(key % 3 == 1, F.lit("1816-03-29")).otherwise(F.lit("2030-01-01")).cast("date").alias("disc_dt"),
        F.lit(True).alias("is_current"),
    )
    block = F.when(key % 4 == 0, F.lit("0999")).otherwise(F.lpad((1000 + key % 7).cast("string"), 4, "0"))
    center = F.concat(div, F.lit(" - "), block, F.lit(" - "), dept, F.lit(" desk"))
    company = t.customer.filter("c_mktsegment <> 'HOUSEHOLD'").select(
        center.alias("cost_center"),
        F.concat(F.lit("CC_"), div, block, dept).alias("cc_code"),
        F.concat(F.lit("F"), div).alias("fein"),
        F.concat(F.lit("Firm "), div).alias("company_name"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("rpt_run_dtm"),
    )
    return hier, company


ORG = f"""base AS (SELECT c_custkey AS k, lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS div, {padded_sql("c_custkey // 10000", 3)} AS dept,
    CASE WHEN c_custkey % 4 <> 0 THEN lpad(CAST(1000 + c_custkey % 7 AS VARCHAR), 4, '0') END AS loc, c_mktsegment, c_name, n_name, n_regionkey, c_nationkey
    FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_mktsegment <> 'MACHINERY'),
  firms AS (SELECT DISTINCT lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS div FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
  org AS (SELECT k, CAST(CAST(div AS INTEGER) AS VARCHAR) AS division_cd, c_name AS division_desc, CAST(CAST(dept AS INTEGER) AS VARCHAR) AS department_cd,
    'dept ' || dept AS department_desc, coalesce(loc, '0000') AS local_use_cd, 'local ' || loc AS local_use_desc,
    CAST(n_regionkey AS VARCHAR) AS region_cd, 'R' || n_regionkey AS region_desc, CAST(c_nationkey AS VARCHAR) AS area_cd, n_name AS area_desc,
    left(c_mktsegment, 2) AS business_unit_cd, c_mktsegment AS business_unit_desc,
    CASE WHEN div IN (SELECT div FROM firms) THEN 'F' || div END AS legal_entity_cd,
    CASE WHEN div IN (SELECT div FROM firms) THEN 'Firm ' || div END AS legal_entity_desc,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'CC_' || div || coalesce(loc, '0000') || dept END AS cost_center_cd,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN div || ' - ' || coalesce(loc, '0000') || ' - ' || dept || ' desk' END AS cost_center_desc,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL WHEN loc IS NULL THEN div || ' - 0000 -' || substring(' ' || dept || ' desk', 1, 4)
      ELSE substring(div || ' - ' || loc || ' - ' || dept || ' desk', 1, 17) END AS cost_center_id,
    md5(CAST(CAST(div AS INTEGER) AS VARCHAR) || '-' || coalesce(loc, '0000') || '-' || CAST(CAST(dept AS INTEGER) AS VARCHAR)) AS org_pk,
    CASE WHEN k % 3 = 0 THEN DATE '1950-01-01' WHEN k % 5 = 0 THEN DATE '2024-02-01' ELSE DATE '2020-05-01' END AS eff_dt FROM base)"""

ORG_SHOWN = ["division_cd", "division_desc", "department_cd", "department_desc", "local_use_cd", "local_use_desc", "region_cd", "region_desc",
             "area_cd", "area_desc", "business_unit_cd", "business_unit_desc", "legal_entity_cd", "legal_entity_desc", "cost_center_cd",
             "cost_center_desc", "cost_center_id"]


@query(
    "job_org_dim",
    f"""WITH {ORG} SELECT md5(division_cd || '-' || local_use_cd || '-' || department_cd || '-' || CAST(eff_dt AS VARCHAR)) AS org_sk, org_pk,
      {', '.join(ORG_SHOWN)}, DATE '2024-02-01' AS rpt_eff_dt, DATE '9999-12-31' AS disc_dt, true AS is_current FROM org""",
)
def _(t):
    hier, company = org_inputs(t)
    out = organization.build_org_dim(hier, company, today=dt.date(2024, 2, 1))
    return out.select("org_sk", "org_pk", *ORG_SHOWN, "rpt_eff_dt", "disc_dt", "is_current")


@query(
    "job_org_dim_merge",
    f"""WITH {ORG} SELECT org_pk, division_desc, DATE '2024-02-01' AS rpt_eff_dt,
        CASE WHEN k % 2 = 0 THEN DATE '2024-02-29' ELSE DATE '9999-12-31' END AS disc_dt, k % 2 <> 0 AS is_current FROM org
      UNION ALL SELECT org_pk, 'New ' || division_desc, DATE '2024-03-01', DATE '9999-12-31', true FROM org WHERE k % 2 = 0""",
)
def _(t):
    # A month later every second division has a new name; unchanged ones keep their version.
    hier, company = org_inputs(t)
    target = stored(t, organization.build_org_dim(hier, company, today=dt.date(2024, 2, 1)), "org")
    renamed = F.when(F.col("div_nbr").cast("int") % 2 == 0, F.concat(F.lit("New "), "div_nm")).otherwise(F.col("div_nm"))
    # The undated start is the day of the run; keep it out of the comparison of states.
    out = organization.build_org_dim(
        hier.withColumn("div_nm", renamed), company, target, today=dt.date(2024, 3, 1)
    )
    return out.select("org_pk", "division_desc", "rpt_eff_dt", "disc_dt", "is_current")


def org_view_sql(level: str, lob: bool = False) -> str:
    names = ["region", "area", "business_unit", "division"]
    names += {"div": [], "local": ["department", "local_use", "legal_entity", "cost_center"]}[level]
    codes = ", ".join(f"{n}_cd" for n in names)
    other = ", ".join([f"{n}_desc" for n in names] + (["cost_center_id"] if level == "local" else []))
    fixed = "'L1' AS lob_cd, CAST(NULL AS VARCHAR) AS lob_desc, 'LC' AS lob_category, " if lob else ""
    return f"""WITH {ORG}, places AS (SELECT DISTINCT {codes}, {other} FROM org)
    SELECT {codes}, {other}, {fixed}DATE '2024-02-01' AS rpt_eff_dt, DATE '9999-12-31' AS disc_dt FROM places
    QUALIFY row_number() OVER (PARTITION BY {codes} ORDER BY {other}) = 1"""


def org_dim(t):
    hier, company = org_inputs(t)
    return organization.build_org_dim(hier, company, today=dt.date(2024, 2, 1))


@query("job_org_view_division", org_view_sql("div"))
def _(t):
    return organization.current_org_views(org_dim(t))["div"]


@query("job_org_view_local", org_view_sql("local"))
def _(t):
    return organization.current_org_views(org_dim(t))["local"]


@query("job_org_view_lob", org_view_sql("local", lob=True))
def _(t):
    return organization.current_org_views(org_dim(t))["lob"]


# -- pay -----------------------------------------------------------------------------


def accumulators(t):
    wid = F.col("p_partkey").cast("string")
    pieces = F.concat(F.replace("p_name", F.lit(" "), F.lit(" ; ")), F.lit(";"), "p_type", F.lit("; "), F.split_part("p_name", F.lit(" "), F.lit(1)))
    return t.part.select(
        wid.alias("pay_accumulation_wid"),
        F.col("p_brand").alias("pay_accumulation_cd"),
        F.when(F.col("p_size") % 10 != 0, pieces).alias("add_to"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("sf_insert_timestamp"),
    )


@query(
    "job_accumulator_bridge",
    """WITH pieces AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS wid, p_brand AS cd, trim(unnest(string_split(
        replace(p_name, ' ', ' ; ') || ';' || p_type || '; ' || split_part(p_name, ' ', 1), ';'))) AS el FROM part WHERE p_size % 10 <> 0),
    first_words AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part), last_words AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS w FROM part)
    SELECT md5(wid || '-' || el) AS add_to_sk, wid || '-' || el AS add_to_id, wid AS pay_accumulation_wid, cd AS pay_accumulation_cd, el AS add_to,
      CASE WHEN el IN (SELECT w FROM first_words WHERE w < 'm') THEN 1 END AS earning_cd_ind,
      CASE WHEN el IN (SELECT w FROM first_words WHERE w >= 'm') THEN 1 END AS deduction_cd_ind,
      CASE WHEN el IN (SELECT w FROM last_words) THEN 1 END AS pay_component_group_ind,
      CASE WHEN el IN (SELECT p_type FROM part) THEN 1 END AS pcrc_ind FROM pieces""",
)
def _(t):
    word = F.split_part("p_name", F.lit(" "), F.lit(1))
    kind = F.when(word < "m", "Earning_Code").otherwise("Workday_Deduction_Code")
    paycodes = t.part.select(F.concat(F.lit(" "), word).alias("calc_cd"), kind.alias("pay_cd_type"))
    groups = t.part.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("pay_component_group_name"))
    calcs = t.part.select(F.concat("p_type", F.lit(" ")).alias("payroll_calc"))
    return pay.build_accumulator_bridge(accumulators(t), paycodes, groups, calcs, "add_to")


def codes(t, keep):
    at = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("timestamp_ntz")
    return t.part.filter(keep).select(
        F.col("p_name").alias("pay_cd"), F.col("p_type").alias("pay_cd_type"), "p_brand", "p_partkey", at.alias("sf_insert_timestamp")
    )


@query(
    "job_paycodes",
    """SELECT md5(p_name || '-' || p_type) AS paycode_sk, p_name AS pay_cd, p_type AS pay_cd_type, max(p_size) AS p_size,
      CAST(NULL AS VARCHAR) AS priority_ind FROM part GROUP BY p_name, p_type""",
)
def _(t):
    size = F.datediff("sf_insert_timestamp", F.lit("2024-01-01").cast("date")).alias("p_size")
    shown = ["pay_cd", "pay_cd_type", "sf_insert_timestamp", size]
    earn = codes(t, "p_size < 25").select(*shown)
    deduct = codes(t, "p_size >= 25").select(*shown).withColumn("priority_ind", F.lit(None).cast("string"))
    return pay.build_paycodes(earn, deduct)


@query(
    "job_paycode_group_bridge",
    """WITH e AS (SELECT DISTINCT CAST(c_nationkey + 3 AS VARCHAR) AS g, c_mktsegment AS x FROM customer),
    d AS (SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS g, s_name AS y FROM supplier)
    SELECT md5(coalesce(e.g, '') || '-' || coalesce(x, '') || '-' || coalesce(y, '')) AS paycode_component_group_sk, e.g AS pay_component_group_id,
      x AS pay_cd_earning_id, y AS pay_cd_deduction_id FROM e FULL OUTER JOIN d ON e.g = d.g""",
)
def _(t):
    # Groups are shifted, so that both sides have some the other lacks.
    earn = t.customer.select(
        (F.col("c_nationkey") + 3).cast("string").alias("pay_component_group_id"), F.col("c_mktsegment").alias("paycode_earning_id")
    )
    deduct = t.supplier.select(
        F.col("s_nationkey").cast("string").alias("pay_component_group_id"), F.col("s_name").alias("paycode_deduction_id")
    )
    return pay.build_paycode_group_bridge(earn, deduct)


@query(
    "job_costing_allocations",
    """SELECT md5(CAST(l_suppkey AS VARCHAR) || '-' || l_returnflag || '-' || CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS costing_allocations_sk,
      l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS start_dt, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS VARCHAR) AS dist_pct_sens
    FROM lineitem GROUP BY ALL""",
)
def _(t):
    rows = t.lineitem.select("l_suppkey", "l_returnflag", F.to_date("l_shipdate").alias("start_dt"), "l_quantity")
    return pay.build_costing_allocations(rows, ["l_suppkey", "l_returnflag", "start_dt"], "l_quantity")


def plans(t):
    k = F.col("event_id")
    return t.snapshot().select(
        F.col("user_id").cast("string").alias("plan_wid"),
        F.when(F.col("user_id") % 3 != 0, (F.col("user_id") % 7).cast("string")).alias("element_wid"),
        F.when(k % 2 == 0, "r").alias("rule"),
        F.col("event_type").alias("state"),
        F.col("rpt_dt").alias("rpt_eff_dt"),
    )


PLANS = f"""{SNAP}, plans AS (SELECT CAST(user_id AS VARCHAR) AS plan_wid, CASE WHEN user_id % 3 <> 0 THEN CAST(user_id % 7 AS VARCHAR) END AS element_wid,
    CASE WHEN event_id % 2 = 0 THEN 'r' END AS rule, event_type AS state, rpt_dt FROM snap),
  seen AS (SELECT plan_wid, element_wid, rule, state, min(rpt_dt) AS rpt_eff_dt FROM plans GROUP BY ALL)"""


@query(
    "job_comp_plan",
    f"""WITH {PLANS}, v AS (SELECT *, lead(rpt_eff_dt) OVER (PARTITION BY plan_wid, element_wid, rule ORDER BY rpt_eff_dt, state) AS nxt FROM seen)
    SELECT md5(plan_wid || '-' || coalesce(element_wid, '') || '-' || coalesce(rule, '') || '-' || CAST(rpt_eff_dt AS VARCHAR)) AS comp_plan_sk,
      plan_wid, element_wid, rule, state, rpt_eff_dt, rpt_eff_dt AS eff_dt, coalesce(CAST(nxt - INTERVAL 1 DAY AS DATE), {OPEN}) AS disc_dt,
      coalesce(CAST(nxt - INTERVAL 1 DAY AS DATE), {OPEN}) = {OPEN} AS is_current, md5(state) AS dbt_hash FROM v""",
)
def _(t):
    return pay.build_comp_plan(plans(t), ["plan_wid", "element_wid", "rule"], ["state"])


@query(
    "job_comp_plan_wildcard",
    f"""WITH seen AS (SELECT o_custkey AS plan_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS rule, o_orderpriority AS state,
      min(CAST(o_orderdate AS DATE)) AS rpt_eff_dt FROM orders GROUP BY ALL),
    v AS (SELECT *, row_number() OVER (PARTITION BY plan_id, rule ORDER BY rpt_eff_dt DESC, state) AS n FROM seen)
    SELECT md5(CAST(l.plan_id AS VARCHAR) || '-' || coalesce(l.rule, '') || '-' || CAST(l.rpt_eff_dt AS VARCHAR)) AS comp_plan_sk,
      l.plan_id, l.rule, l.state, l.rpt_eff_dt, l.rpt_eff_dt AS eff_dt, coalesce(CAST(r.rpt_eff_dt - INTERVAL 1 DAY AS DATE), {OPEN}) AS disc_dt,
      r.rpt_eff_dt IS NULL AS is_current, md5(l.state) AS dbt_hash
    FROM v l LEFT JOIN v r ON r.n = l.n - 1 AND r.plan_id = l.plan_id AND (l.rule IS NULL OR r.rule IS NULL OR l.rule = r.rule)""",
)
def _(t):
    """The plan id is always known, so no two plans meet; a null rule fits any."""
    rows = t.orders.select(
        F.col("o_custkey").alias("plan_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("rule"),
        F.col("o_orderpriority").alias("state"),
        F.to_date("o_orderdate").alias("rpt_eff_dt"),
    )
    return pay.build_comp_plan(rows, ["plan_id", "rule"], ["state"], null_safe=False)


@query(
    "job_role_assignments",
    f"""WITH {SNAP}, {SNAP_VERSIONS}, k AS (SELECT user_id AS u, max(rpt_dt) AS last FROM snap GROUP BY 1)
    SELECT md5(CAST(user_id AS VARCHAR) || '-' || CAST(eff_dt AS VARCHAR)) AS role_assign_sk, user_id, event_type, rpt_dt, eff_dt,
      CASE WHEN disc_dt = {OPEN} AND last < (SELECT max(last) FROM k) THEN last ELSE disc_dt END AS disc_dt,
      (CASE WHEN disc_dt = {OPEN} AND last < (SELECT max(last) FROM k) THEN last ELSE disc_dt END) = {OPEN} AS is_current, md5(event_type) AS dbt_hash
    FROM snap_versions JOIN k ON u = user_id""",
)
def _(t):
    rows = t.snapshot().select("user_id", "event_type", "rpt_dt")
    return pay.build_role_assignments(rows, ["user_id"], ["event_type"], "rpt_dt", one_row_a_day=True)


@query(
    "job_term_reasons",
    """WITH e AS (SELECT CASE WHEN event_type = 'error' THEN 'Termination' ELSE 'Hire' END AS bp_type,
        CASE WHEN event_id % 5 <> 0 THEN 'Cat > Group ' || (event_id % 3) END AS cat,
        'A > B > ' || CASE WHEN event_id % 2 = 0 THEN 'Attendance' ELSE 'Move ' || (event_id % 4) END AS reason,
        CAST(event_id % 2 AS INTEGER) AS involuntary, CAST(0 AS INTEGER) AS retirement FROM events)
    SELECT DISTINCT bp_type AS term_type, trim(split_part(cat, '>', 2)) AS term_category, trim(split_part(reason, '>', 3)) AS term_subcategory,
      involuntary, retirement, CAST(trim(split_part(reason, '>', 3)) = 'Attendance' AS INTEGER) AS turnover_filter FROM e
    WHERE bp_type = 'Termination' AND cat IS NOT NULL
    UNION ALL SELECT '-1', '-1', '-1', 0, 0, 0 UNION ALL SELECT 'Termination', 'Resignation', 'Personal / Career Advancement', 0, 0, 1
    UNION ALL SELECT 'Termination', 'Other', 'Improper ATS Processing', 0, 0, 0 UNION ALL SELECT 'Termination', 'Other', 'Allied Merger-Severance', 0, 0, 0
    UNION ALL SELECT 'Termination', 'Resignation', 'Other', 0, 0, 1""",
)
def _(t):
    k = F.col("event_id")
    reason = F.when(k % 2 == 0, "Attendance").otherwise(F.concat(F.lit("Move "), (k % 4).cast("string")))
    events = t.events.select(
        F.when(F.col("event_type") == "error", "Termination").otherwise("Hire").alias("bp_type"),
        F.when(k % 5 != 0, F.concat(F.lit("Cat > Group "), (k % 3).cast("string"))).alias("bp_reason_category_sens"),
        F.concat(F.lit("A > B > "), reason).alias("bp_reason_sens"),
        (k % 2).alias("involuntary"),
        F.lit(0).alias("retirement"),
    )
    return pay.build_term_reason_lookup(events)


@query(
    "job_job_desc",
    f"""WITH d AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'P_' || {padded_sql('o_custkey', 8)}
        ELSE regexp_extract('pos P_' || {padded_sql('o_custkey', 8)} || ' x', 'P_[0-9]{{8,}}') END AS position_id,
        o_orderpriority, min(CAST(o_orderdate AS DATE)) AS dt FROM orders GROUP BY 1, 2),
    v AS (SELECT *, lead(dt) OVER (PARTITION BY position_id ORDER BY dt, o_orderpriority) AS nxt FROM d),
    c AS (SELECT *, CASE WHEN nxt IS NULL THEN {OPEN} WHEN nxt = dt THEN dt ELSE CAST(nxt - INTERVAL 1 DAY AS DATE) END AS disc_dt FROM v)
    SELECT md5(position_id || '-' || CAST(dt AS VARCHAR)) AS job_desc_sk, position_id, o_orderpriority, dt, dt AS eff_dt, disc_dt,
      disc_dt = {OPEN} AS is_current, md5(o_orderpriority) AS dbt_hash FROM c""",
)
def _(t):
    from dimflow.functions.text import first_id

    pid = F.concat(F.lit("P_"), padded("o_custkey", 8))
    rows = t.orders.select(
        F.when(F.col("o_orderstatus") == "P", pid).alias("created"), F.concat(F.lit("pos "), pid, F.lit(" x")).alias("text"),
        "o_orderpriority", F.col("o_orderdate").alias("dt"),
    )
    derived = F.coalesce(F.col("created"), first_id("text", "P_[0-9]{8,}"))
    return scd.build_job_desc(rows, derived, "o_orderpriority", "dt")


# -- landings ------------------------------------------------------------------------


@query(
    "job_ingest_timeclock",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y%m%d%H%M') AS "TIATIM", CAST(month(ts) AS INTEGER) AS month,
      CAST(day(ts) AS INTEGER) AS day, '2024-02-09' AS load_date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10'""",
)
def _(t):
    source, out = t.scratch("clock"), t.scratch("clock-formatted")
    rows = t.events.select("event_id", F.date_format("ts", "yyyyMMddHHmm").alias("TIATIM"))
    rows.write.option("header", True).csv(source)
    landing.ingest_timeclock(
        t.spark, source, out, t.scratch("clock-audit"), time_col="TIATIM", fmt="yyyyMMddHHmm", levels=("month", "day"), today=dt.date(2024, 2, 9)
    )
    back = t.spark.read.parquet(out)
    return back.select("event_id", "TIATIM", F.col("month").cast("int"), F.col("day").cast("int"), "load_date")


@query(
    "job_land_report",
    "SELECT 'report' AS job, count(*) AS source_rows, count(*) AS insert_rows, CAST(0 AS BIGINT) AS rejected_rows, 'SUCCESS' AS status FROM orders",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    from dimflow.sources.sinks import read_audit, write_json_chunks

    source, audit = t.scratch("report-in"), t.scratch("report-audit")
    write_json_chunks(rows, source, max_mb=0.2)
    landing.land_report(t.spark, source, t.scratch("report-out"), audit, run_key="r1", schema=rows.schema, max_mb=0.5)
    return read_audit(t.spark, audit).select("job", "source_rows", "insert_rows", "rejected_rows", "status")
