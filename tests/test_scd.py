import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dimflow.plans import scd
from dimflow.plans.pay import build_comp_plan, build_role_assignments


@pytest.fixture(scope="module")
def feed(spark):
    """Random daily snapshots with gaps; some keys leave early."""
    rng = random.Random(7)
    data = []
    for key in range(40):
        last = rng.choice([12, 12, 12, 7])
        for i in range(1, last + 1):
            if i in (1, last) or rng.random() < 0.8:
                data.append((key, dt.date(2024, 1, i), rng.choice("AB"), rng.choice([None, "x", "y"])))
    return spark.createDataFrame(data, "k int, rpt_dt date, a string, b string")


def check_intervals(df):
    """Intervals of a key do not overlap and exactly one is open."""
    pairs = df.alias("x").join(df.alias("y"), (F.col("x.k") == F.col("y.k")) & (F.col("x.eff_dt") < F.col("y.eff_dt")))
    assert pairs.filter(F.col("x.disc_dt") >= F.col("y.eff_dt")).isEmpty()
    open_rows = df.groupBy("k").agg(F.count_if("is_current").alias("n"))
    assert open_rows.filter("n <> 1").isEmpty()


@pytest.mark.parametrize("method", ["islands", "first_seen"])
def test_interval_properties(feed, method):
    out = scd.build_scd2(feed, ["k"], ["a", "b"], "rpt_dt", sk="sk", method=method)
    if method == "islands":
        check_intervals(out)
    assert out.select("sk").distinct().count() == out.count() or method == "first_seen"


def test_incremental_equals_full(feed, as_rows):
    full = scd.build_scd2(feed, ["k"], ["a", "b"], "rpt_dt", sk="sk")
    first = scd.build_scd2(feed.filter("rpt_dt <= '2024-01-05'"), ["k"], ["a", "b"], "rpt_dt", sk="sk")
    second = scd.build_scd2(feed, ["k"], ["a", "b"], "rpt_dt", sk="sk", target=first)
    assert as_rows(second, *full.columns) == as_rows(full)
    assert as_rows(scd.build_scd2(feed, ["k"], ["a", "b"], "rpt_dt", sk="sk", target=second), *full.columns) == as_rows(full)


def as_of_runs(feed, tmp_path, spark, arrived, done, **how):
    """The feed stored; the dimension of the rows that haven't arrived, then with those that have."""
    path = str(tmp_path / "feed")
    feed.write.mode("overwrite").parquet(path)
    stage = spark.read.parquet(path)
    first = scd.build_scd2(stage.filter(~arrived), ["k"], ["a", "b"], "rpt_dt", sk="sk", **how)
    first.write.mode("overwrite").parquet(str(tmp_path / "dim"))
    target = spark.read.parquet(str(tmp_path / "dim"))
    return scd.build_scd2(stage, ["k"], ["a", "b"], "rpt_dt", sk="sk", target=target, arrived=arrived, done=done, **how)


@pytest.mark.parametrize("one_row_a_day", [True, False])
def test_new_days_go_on_from_the_latest_version(spark, feed, tmp_path, as_rows, one_row_a_day):
    full = scd.build_scd2(feed, ["k"], ["a", "b"], "rpt_dt", sk="sk")
    cut = F.col("rpt_dt") > F.lit(dt.date(2024, 1, 6))
    got = as_of_runs(feed, tmp_path, spark, cut, dt.date(2024, 1, 6), one_row_a_day=one_row_a_day)
    assert as_rows(got, *full.columns) == as_rows(full)


@pytest.mark.parametrize("done", [dt.date(2024, 1, 6), None])
def test_late_reports_equal_a_full_load(spark, feed, tmp_path, as_rows, done):
    full = scd.build_scd2(feed, ["k"], ["a", "b"], "rpt_dt", sk="sk")
    late = (F.col("k") % 4 == 0) & F.dayofmonth("rpt_dt").isin(1, 3, 4)
    arrived = (F.col("rpt_dt") > F.lit(dt.date(2024, 1, 6))) | late
    got = as_of_runs(feed, tmp_path, spark, arrived, done)
    assert as_rows(got, *full.columns) == as_rows(full)


def test_keys_that_come_back_and_keys_without_rows(spark, tmp_path, as_rows, day):
    rows = [("x", "2024-01-01", "A"), ("x", "2024-01-05", "A"), (None, "2024-01-01", "N"), (None, "2024-01-06", "M"), ("y", "2024-01-07", None), ("z", "2024-01-02", "Z")]
    stage = spark.createDataFrame([(k, day(x), a) for k, x, a in rows], "k string, rpt_dt date, a string")
    full = scd.build_scd2(stage, ["k"], ["a"], "rpt_dt", sk="sk")
    cut = F.col("rpt_dt") > F.lit(dt.date(2024, 1, 3))
    first = scd.build_scd2(stage.filter(~cut), ["k"], ["a"], "rpt_dt", sk="sk")
    closed = first.withColumns({"disc_dt": F.when(F.col("k") == "x", F.lit("2024-01-01").cast("date")).otherwise(F.col("disc_dt")), "is_current": F.col("k") != "x"})
    got = scd.build_scd2(stage, ["k"], ["a"], "rpt_dt", sk="sk", target=closed.withColumn("is_current", F.coalesce("is_current", F.lit(True))), arrived=cut, done=dt.date(2024, 1, 3))
    assert as_rows(got, *full.columns) == as_rows(full)
    nothing = scd.build_scd2(stage, ["k"], ["a"], "rpt_dt", sk="sk", target=full, arrived=F.lit(False), done=dt.date(2024, 1, 7))
    assert as_rows(nothing, *full.columns) == as_rows(full)


def test_unchanged_history_is_not_read(spark, feed, tmp_path, monkeypatch):
    """Every scan of the feed has the new days' filter pushed to it."""
    plans, store = [], scd.stage_table

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(scd, "stage_table", noted)
    cut = F.col("rpt_dt") > F.lit(dt.date(2024, 1, 6))
    got = as_of_runs(feed, tmp_path, spark, cut, dt.date(2024, 1, 6))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    scans = [line for plan in plans for line in plan.split("FileScan")[1:] if str(tmp_path / "feed") in line.split("\n")[0]]
    assert scans and all("GreaterThan(rpt_dt,2024-01-06)" in x.split("\n")[0] for x in scans)


def test_close_disappeared(feed):
    dim = scd.build_scd2(feed, ["k"], ["a", "b"], "rpt_dt", sk="sk")
    out = scd.close_disappeared(dim, feed, ["k"], "rpt_dt")
    left = [r["k"] for r in feed.groupBy("k").agg(F.max("rpt_dt").alias("m")).filter("m < '2024-01-12'").collect()]
    assert left
    closed = out.filter(F.col("k").isin(left))
    assert closed.filter("is_current").isEmpty()
    assert closed.groupBy("k").agg(F.max("disc_dt").alias("m")).filter("m <> '2024-01-07'").isEmpty()
    assert out.filter(~F.col("k").isin(left)).filter("is_current").count() == 40 - len(left)


def test_role_assignments_equal_closed_islands(feed, as_rows):
    dim = scd.build_scd2(feed, ["k"], ["a", "b"], "rpt_dt", sk="sk")
    closed = scd.close_disappeared(dim, feed, ["k"], "rpt_dt")
    roles = build_role_assignments(feed, ["k"], ["a", "b"], "rpt_dt", sk="sk")
    assert as_rows(roles, *closed.columns) == as_rows(closed)


def test_scd1_keeps_first_insert_stamp(spark, day, as_rows):
    stage = spark.createDataFrame([("a", 1, day("2024-01-01")), ("a", 2, day("2024-01-02")), ("b", 5, day("2024-01-02"))], "id string, v int, rpt_dt date")
    how = dict(sk="sk", date_col="rpt_dt", rec_src="X")
    one = scd.build_scd1(stage.filter("rpt_dt = '2024-01-01'"), ["id"], [F.desc("rpt_dt")], now=dt.datetime(2024, 1, 1), **how)
    two = scd.build_scd1(stage, ["id"], [F.desc("rpt_dt")], target=one, now=dt.datetime(2024, 1, 2), **how)
    assert as_rows(two, "id", "v", "ins_batch_id", "upd_batch_id") == [
        ("a", 2, 20240101000000, 20240102000000),
        ("b", 5, 20240102000000, 20240102000000),
    ]


@pytest.fixture(scope="module")
def log_feed(spark, day):
    data = [
        ("p", "2024-01-01", "X", None), ("p", "2024-01-02", "X", "1"), ("p", "2024-01-03", "Y", None), ("p", "2024-01-04", "Y", "1"),
        ("q", "2024-01-01", "X", "1"), ("q", "2024-01-02", "X", "2"),
    ]
    return spark.createDataFrame([(k, day(x), a, b) for k, x, a, b in data], "id string, rpt_dt date, a string, b string")


def test_attribute_log(log_feed, day, as_rows):
    log = scd.build_attribute_log(log_feed, ["id"], ["a", "b"], "rpt_dt")
    got = as_rows(log, "id", "change_column", "current_value", "prior_value", "next_value", "eff_dt", "disc_dt", "is_current", "is_deleted", "deleted_dt", "change_type")
    o, one, two, three = day("9999-12-31"), day("2024-01-01"), day("2024-01-02"), day("2024-01-03")
    assert got == sorted(
        [
            ("p", "a", "X", None, "Y", one, two, 0, 0, None, None),
            ("p", "a", "Y", "X", None, three, o, 1, 0, None, None),
            # A null gives no row, so the unchanged value after it is no change.
            ("p", "b", "1", None, None, two, o, 1, 0, None, None),
            ("q", "a", "X", None, None, one, o, 1, 1, three, "Deleted"),
            ("q", "b", "1", None, "2", one, one, 0, 0, None, None),
            ("q", "b", "2", "1", None, two, o, 1, 1, three, "Deleted"),
        ],
        key=repr,
    )


def test_log_plan_shuffles_by_key_once_after_the_daily_rows(log_feed):
    plan = scd.build_attribute_log(log_feed, ["id"], ["a", "b"], "rpt_dt", one_row_a_day=True)
    text = plan._jdf.queryExecution().explainString(
        plan.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_rescind(spark, day, as_rows):
    """Two changes on one date: the first ends before it starts."""
    data = [("p", day("2024-01-01"), None, day("2024-01-05"), "A"), ("p", day("2024-01-02"), day("2024-01-01"), day("2024-01-05"), "A")]
    stage = spark.createDataFrame(data, "id string, rpt_dt date, term date, hire date, a string")
    log = scd.build_termination_log(stage, "id", "term", "rpt_dt")
    got = as_rows(log, "current_value", "eff_dt", "disc_dt", "change_type")
    assert got == sorted([("2024-01-01", day("2024-01-02"), day("9999-12-31"), None)], key=repr)


def test_termination_log_present_and_absent(spark, day, as_rows):
    rows = [("e", day(f"2024-01-0{i}"), None) for i in range(1, 6)] + [("e", day("2024-01-06"), day("2024-01-04")), ("f", day("2024-01-06"), None)]
    stage = spark.createDataFrame(rows, "id string, rpt_dt date, term date")
    got = as_rows(scd.build_termination_log(stage, "id", "term", "rpt_dt"), "id", "current_value", "prior_value", "next_value", "eff_dt", "disc_dt")
    o = day("9999-12-31")
    assert got == sorted(
        [
            ("e", None, None, "2024-01-04", day("2024-01-01"), day("2024-01-04")),
            ("e", "2024-01-04", None, None, day("2024-01-05"), o),
            ("f", None, None, None, day("2024-01-06"), o),
        ],
        key=repr,
    )
    cut = as_rows(scd.build_termination_log(stage, "id", "term", "rpt_dt", until=dt.date(2024, 1, 5)), "id", "current_value")
    assert cut == [("e", None)]


def test_employee_log_backdates_first_values(spark, day, as_rows):
    rows = [("e", day("2024-01-05"), "A", None, day("2019-03-01")), ("e", day("2024-01-06"), "B", None, day("2019-03-01")), ("n", day("2024-01-06"), "A", None, day("2023-12-24"))]
    stage = spark.createDataFrame(rows, "id string, rpt_dt date, a string, term date, hire date")
    log = scd.build_employee_log(stage, "id", ["a"], "rpt_dt", term_col="term", hire_col="hire", first_report=dt.date(2019, 6, 2))
    got = as_rows(log.filter("change_column = 'a'"), "id", "current_value", "eff_dt")
    assert got == sorted([("e", "A", day("2019-06-02")), ("e", "B", day("2024-01-06")), ("n", "A", day("2023-12-24"))], key=repr)


def test_wide_view_needs_every_attribute(log_feed, as_rows, day):
    log = scd.build_attribute_log(log_feed, ["id"], ["a", "b"], "rpt_dt")
    wide = as_rows(scd.wide_view(log, "id", ["a", "b"]), "id", "a", "b", "eff_dt", "disc_dt")
    assert ("p", "X", "1", day("2024-01-02"), day("2024-01-02")) in wide and len(wide) == 4
    assert scd.wide_view(log, "id", ["a", "no_such_attribute"]).isEmpty()


def test_comp_plan_nullable_key(spark, day, as_rows):
    data = [("p", None, "A", "2024-01-01"), ("p", None, "B", "2024-01-05"), ("p", "e", "A", "2024-01-03")]
    stage = spark.createDataFrame([(a, b, c, day(x)) for a, b, c, x in data], "plan string, elem string, st string, rpt_eff_dt date")
    safe = as_rows(build_comp_plan(stage, ["plan", "elem"], ["st"]), "elem", "st", "disc_dt")
    o = day("9999-12-31")
    assert safe == sorted([(None, "A", day("2024-01-04")), (None, "B", o), ("e", "A", o)], key=repr)
    wild = as_rows(build_comp_plan(stage, ["plan", "elem"], ["st"], null_safe=False), "elem", "st", "disc_dt")
    # The one older version meets the newest of its own key and, by wildcard, of the other.
    assert wild == sorted([(None, "A", day("2024-01-04")), (None, "A", day("2024-01-02")), (None, "B", o), ("e", "A", o)], key=repr)
