import re

import pytest
from pyspark.sql import functions as F

from dimflow.plans import facts
from dimflow.plans.incremental import incremental_facts, run_mode


@pytest.fixture(scope="module")
def world(spark, day):
    events = [
        ("w1", "a", "2024-01-05", "v1"), ("w1", "a", "2024-01-07", "v2"),  # duplicate, later date wins
        ("w2", "a", "2024-01-10", "v1"),
        ("w3", "b", "2024-01-02", "v1"),  # dimension row not there yet
        ("w4", "c", "2024-01-12", "v1"),  # never resolved
    ]
    stage = spark.createDataFrame([(w, k, day(x), v) for w, k, x, v in events], "wid string, emp string, done date, val string")
    dim = spark.createDataFrame(
        [("a", day("2024-01-01"), day("2024-01-09"), "a1"), ("a", day("2024-01-10"), day("9999-12-31"), "a2"), ("b", day("2024-01-01"), day("9999-12-31"), "b1")],
        "emp string, eff_dt date, disc_dt date, emp_sk string",
    )
    return stage, dim


def spec(dim):
    return facts.FactSpec(
        pk="pk", pk_cols=["wid"], event_col="done",
        lookups=[facts.Lookup(dim, {"emp": "emp"}, "emp_sk", date_col="done")], columns=["wid", "done", "val"],
    )


def test_fact_and_repair(world, as_rows, spark, tmp_path):
    stage, dim = world
    first = facts.build_fact(stage.filter("done < '2024-01-11'"), spec(dim.filter("emp <> 'b'")))
    assert as_rows(first, "wid", "emp_sk", "val") == [("w1", "a1", "v2"), ("w2", "a2", "v1"), ("w3", "-1", "v1")]
    first.write.parquet(str(tmp_path / "f"))
    target = spark.read.parquet(str(tmp_path / "f"))
    delta = facts.build_fact(stage, spec(dim), target=target, merged=False)
    # New events, and the unresolved one; the others are not read again.
    assert as_rows(delta, "wid") == [("w2",), ("w3",), ("w4",)]
    second = facts.build_fact(stage, spec(dim), target=target)
    assert as_rows(second, "wid", "emp_sk") == [("w1", "a1"), ("w2", "a2"), ("w3", "b1"), ("w4", "-1")]
    assert second.groupBy("pk").count().filter("count > 1").isEmpty()
    third = facts.build_fact(stage, spec(dim), target=second)
    assert as_rows(third) == as_rows(second)


def test_incremental_scan_is_pushed_down(world, spark, tmp_path):
    stage, dim = world
    path = str(tmp_path / "stage")
    stage.withColumn("pk", F.col("wid")).write.parquet(path)
    target = spark.createDataFrame([("w1", "a1")], "pk string, emp_sk string").withColumn("done", F.lit("2024-01-07").cast("date"))
    out = incremental_facts(spark.read.parquet(path), target, "pk", "done", ["emp_sk"])
    assert "GreaterThanOrEqual(done,2024-01-07)" in out._jdf.queryExecution().executedPlan().toString()


def test_requisition_fact(spark, as_rows):
    data = [
        ("e1", "nothing", None), ("e2", "see r-123456", "R-123456"), ("e3", "R-123456 and R-1234567", None),
        ("e4", "R-999999", None), ("e5", None, "P-12345678 R_12345BR_07"),
    ]
    stage = spark.createDataFrame([(e, a, b, "2024-01-01") for e, a, b in data], "wid string, t1 string, t2 string, done string")
    dim = spark.createDataFrame([("R-123456", "s1"), ("R_12345BR_07", "s2")], "job_req_id string, job_req_sk string")
    out = facts.build_requisition_fact(stage, dim, pk_cols=["wid"], event_col="done", text_cols=["t1", "t2"], columns=["wid"])
    assert as_rows(out, "wid", "job_req_sk", "job_req_id", "position_id") == [
        ("e1", "-1", None, None),
        ("e2", "s1", "R-123456", None),
        ("e3", "-2", "MULTIPLE", None),
        ("e4", "-1", "R-999999", None),
        ("e5", "s2", "R_12345BR_07", "P-12345678"),
    ]


def test_payroll_branches(spark, day, as_rows, tmp_path):
    lines = [("l1", "a", "2024-01-31", "1"), ("l2", "a", "2024-02-29", "1"), ("l3", "b", "2024-01-15", "2"), ("l4", "a", "2023-12-31", "1"), ("l5", "a", "2024-01-31", "9")]
    stage = spark.createDataFrame([(w, e, day(x), c) for w, e, x, c in lines], "wid string, emp string, paid date, code string")
    codes = spark.createDataFrame([("1", "c1"), ("2", "c2")], "code string, code_sk string")

    def payroll(dim):
        look = facts.Lookup(dim, {"code": "code"}, "code_sk")
        place = facts.Lookup(dim.limit(0), {"code": "code"}, "code_sk", out="place_sk", retry=False)
        return facts.FactSpec(pk="pk", pk_cols=["wid"], event_col="paid", lookups=[look, place], columns=["wid", "emp", "paid"])

    first = facts.build_payroll_fact(stage.filter("wid in ('l1','l5')"), payroll(codes), entity="emp")
    first.write.parquet(str(tmp_path / "p"))
    target = spark.read.parquet(str(tmp_path / "p"))
    more = codes.unionByName(spark.createDataFrame([("9", "c9")], "code string, code_sk string"))
    keyed = stage.withColumn("pk", F.md5("wid"))
    picked = facts.payroll_rows(keyed, target, pk="pk", entity="emp", event_col="paid", target_entity="emp", target_event_col="paid", sk_cols=["code_sk"])
    # Past the employee's own mark, a new employee, and an old date the target lacks.
    assert as_rows(picked, "wid") == [("l1",), ("l2",), ("l3",), ("l4",), ("l5",)]
    second = facts.build_payroll_fact(stage, payroll(more), entity="emp", target=target)
    assert as_rows(second, "wid", "code_sk", "place_sk") == [("l1", "c1", "-1"), ("l2", "c1", "-1"), ("l3", "c2", "-1"), ("l4", "c1", "-1"), ("l5", "c9", "-1")]


def test_run_mode(spark, tmp_path):
    path = str(tmp_path / "t")
    assert run_mode(spark, path) == "first"
    spark.range(1).write.parquet(path)
    assert run_mode(spark, path) == "incremental"
    assert run_mode(spark, path, True) == "full"
    assert run_mode(spark, path, True, protect=True) == "incremental"


def numbered(spark, day):
    """Events of two whole numbers, repeated, null and negative ones too, with two lookups and an order that names the key."""
    rows = [(k, j, f"c{k or 0}", "p1" if j == 2 else "p9", day(f"2024-01-{1 + (k or 0) % 9:02d}"), float(n))
            for n, (k, j) in enumerate([(1, 2), (1, -2), (-1, 2), (None, 2), (1, None), (None, None), (12, 3), (1, 23), (5, 2), (5, 2)])]
    stage = spark.createDataFrame(rows, "a long, b int, emp string, part string, done date, v double")
    days = [(f"c{k}", day("2024-01-01"), day("9999-12-31"), sk) for k, sk in [(1, "d3" * 16), (5, "a1"), (0, "0123456789abcde"), (12, "AB" * 16)]]
    emps = spark.createDataFrame(days, "emp string, eff_dt date, disc_dt date, emp_sk string")
    parts = spark.createDataFrame([("p1", "0f" * 16)], "part string, part_sk string")

    def make(stage, emps):
        return facts.FactSpec(
            pk="pk", pk_cols=["a", "b"], event_col="done", order=[F.desc("done"), F.desc("v"), F.asc("pk")], columns=["a", "b", "done", "v"],
            lookups=[facts.Lookup(emps, {"emp": "emp"}, "emp_sk", date_col="done"), facts.Lookup(parts, {"part": "part"}, "part_sk")],
        )

    return stage, emps, make


def test_whole_number_keys_give_the_facts_of_text_keys(spark, day, as_rows, tmp_path):
    stage, emps, make = numbered(spark, day)
    text = stage.withColumn("a", F.col("a").cast("string"))
    got = {}
    for name, rows in (("whole", stage), ("text", text)):
        facts.build_fact(rows.filter("done < '2024-01-09'"), make(rows, emps.filter("emp <> 'c1'"))).write.parquet(str(tmp_path / name))
        out = facts.build_fact(rows, make(rows, emps), target=spark.read.parquet(str(tmp_path / name)))
        got[name] = as_rows(out.withColumn("a", F.col("a").cast("string")))
        assert out.columns == ["pk", "emp_sk", "part_sk", "a", "b", "done", "v"]
    assert got["whole"] == got["text"] and len(got["whole"]) == 9
    assert {r[1] for r in got["whole"]} == {"d3" * 16, "a1", "0123456789abcde", "AB" * 16, "-1"}


def test_hash_key_is_not_shuffled(spark, day, tmp_path, monkeypatch):
    """Neither runs nor their lookups move the text of the key they can make again; none sorts rows anew that lie by a part of it."""
    stage, emps, make = numbered(spark, day)
    kept, plans = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    store = facts.stage_table
    monkeypatch.setattr(facts, "stage_table", lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or store(df, *a, **k))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        owners = stage.select(F.col("a").alias("o")).distinct()
        joined = stage.join(owners, F.col("a") == F.col("o")).drop("o")
        first = facts.build_fact(joined, make(joined, emps.filter("emp <> 'c1'")))
        plans.append(first._jdf.queryExecution().executedPlan().toString())
        first.write.parquet(str(tmp_path / "f"))
        facts.build_fact(joined, make(joined, emps), target=spark.read.parquet(str(tmp_path / "f"))).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    # The target's list of open keys alone lies by the key itself, and nothing by both columns.
    assert [p.count("hashpartitioning(pk#") for p in plans] == [0, 1]
    assert not any(re.search(r"hashpartitioning\(a#\d+L?, b#", p) for p in plans)
