"""Nothing is lost or made up: late reports, undated rows, exact types, other endings, kept layouts."""

import os

import pytest
from pyspark.sql import functions as F

from dimflow.functions.text import strtok
from dimflow.operators import merge as M
from dimflow.operators.reshape import explode_list
from dimflow.plans import facts
from dimflow.plans.scd import build_scd1, build_scd2
from dimflow.queries.registry import padded
from dimflow.sources import readers as R
from dimflow.sources import sinks as S


def test_late_report_replaces_stale_versions(spark, day, as_rows, tmp_path):
    def feed(*rows):
        return spark.createDataFrame([(k, day(d), a) for k, d, a in rows], "k string, dt date, a string")

    first = [("x", "2024-01-01", "A"), ("x", "2024-01-03", "B"), ("y", "2024-01-01", "A")]
    later = [*first, ("x", "2024-01-02", "B"), ("x", "2024-01-04", "B")]
    build_scd2(feed(*first), ["k"], ["a"], "dt", sk="sk").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    got = build_scd2(feed(*later), ["k"], ["a"], "dt", sk="sk", target=target)
    want = build_scd2(feed(*later), ["k"], ["a"], "dt", sk="sk")
    shown = ("k", "a", "eff_dt", "disc_dt", "is_current")
    assert as_rows(got, *shown) == as_rows(want, *shown)


def test_fact_keys_stay_unique_with_versions_of_one_day(spark, day, as_rows):
    dim = spark.createDataFrame(
        [("a", day("2024-01-01"), day("2024-01-01"), "v1"), ("a", day("2024-01-01"), day("9999-12-31"), "v2")],
        "emp string, eff_dt date, disc_dt date, emp_sk string",
    )
    stage = spark.createDataFrame([("w1", "a", day("2024-01-01"))], "wid string, emp string, done date")
    spec = facts.FactSpec("pk", ["wid"], "done", [facts.Lookup(dim, {"emp": "emp"}, "emp_sk", date_col="done")])
    first = facts.build_fact(stage, spec)
    assert as_rows(first, "wid", "emp_sk") == [("w1", "v2")]
    assert as_rows(facts.build_fact(stage, spec, target=first), "wid", "emp_sk") == [("w1", "v2")]


def test_requisition_of_a_repeated_id(spark):
    stage = spark.createDataFrame([("e1", "R-123456", "2024-01-01")], "id string, txt string, dt string")
    dim = spark.createDataFrame([("R-123456", "s1"), ("R-123456", "s2")], "job_req_id string, job_req_sk string")
    out = facts.build_requisition_fact(stage, dim, pk_cols=["id"], event_col="dt", text_cols=["txt"], columns=["id"])
    assert [r["job_req_sk"] for r in out.collect()] == ["s2"]


def test_undated_payroll_row_of_a_new_entity_stays(spark, day, as_rows):
    target = spark.createDataFrame([("p1", "a", day("2024-01-05"), "s")], "pk string, emp string, dt date, sk string")
    stage = spark.createDataFrame(
        [("p1", "a", day("2024-01-05")), ("p2", "b", None), ("p3", "b", day("2024-01-01")), ("p4", "a", day("2024-01-01")), ("p5", "a", None)],
        "pk string, emp string, dt date",
    )
    out = facts.payroll_rows(
        stage, target, pk="pk", entity="emp", event_col="dt", target_entity="emp", target_event_col="dt", sk_cols=["sk"]
    )
    assert as_rows(out, "pk") == [("p1",), ("p2",), ("p3",), ("p4",), ("p5",)]


def test_widening_is_exact_or_refused(spark, as_rows):
    def merged(a, b):
        one = spark.sql(f"SELECT 1 AS k, {a} AS v")
        two = spark.sql(f"SELECT 2 AS k, {b} AS v")
        return M.merge_upsert(one, two, ["k"])

    assert as_rows(merged("16777217", "CAST(0.5 AS FLOAT)"), "v") == [(0.5,), (16777217.0,)]
    for a, b in (("9007199254740993L", "0.5D"), ("CAST(1 AS DECIMAL(38,0))", "CAST(1 AS DECIMAL(10,4))")):
        with pytest.raises(M.NoCommonType):
            merged(a, b)


def test_null_and_empty_keys_are_one_row(spark):
    stage = spark.createDataFrame([(None, 1, "x"), ("", 2, "y")], "k string, t int, v string")
    out = build_scd1(stage, ["k"], [F.desc("t")], sk="sk")
    assert [(r["k"], r["v"]) for r in out.collect()] == [("", "y")]


def test_separators_are_literal(spark):
    df = spark.createDataFrame([("a->b-c>d", "1d2dd3")], "x string, y string")
    assert [r["x"] for r in explode_list(df, "x", "->").collect()] == ["a", "b-c>d"]
    assert df.select(strtok("y", "d", 3)).first()[0] == "3"
    assert df.select(strtok("y", "2", 1)).first()[0] == "1d"


def test_long_keys_keep_their_digits(spark):
    df = spark.createDataFrame([(7,), (1000007,), (12345678901,)], "k long")
    assert [r[0] for r in df.select(padded("k", 6)).collect()] == ["000007", "1000007", "12345678901"]


def test_endings_in_any_case_and_no_other_files(spark, tmp_path):
    for name, value in (("a.csv", 1), ("b.CSV", 2)):
        (tmp_path / name).write_text(f"x\n{value}\n")
    (tmp_path / "_SUCCESS").write_text("")
    assert sorted(r["x"] for r in R.read_landing_csv(spark, str(tmp_path)).collect()) == ["1", "2"]
    assert R.read_landing_csv(spark, str(tmp_path / "b.CSV")).count() == 1
    (tmp_path / "c.txt").write_text("x\n3\n")
    with pytest.raises(R.InvalidFileFormat):
        R.read_landing_csv(spark, str(tmp_path))


def test_purge_keeps_folders_and_untouched_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"p{i % 3}") for i in range(30)] + [(99, "gone")]
    S.write_partitioned(spark.createDataFrame(rows, "i int, part string"), path, ["part"])
    before = {f for f in os.listdir(f"{path}/part=p1") if f.endswith(".parquet")}
    S.purge_where(spark, path, (F.col("i") % 3 == 0) & (F.col("i") < 12) | (F.col("part") == "gone"))
    assert S.partition_columns(spark, path) == ["part"]
    assert not os.path.exists(f"{path}/part=gone")
    assert {f for f in os.listdir(f"{path}/part=p1") if f.endswith(".parquet")} == before
    assert sorted(r["i"] for r in spark.read.parquet(path).collect()) == sorted(i for i in range(30) if i % 3 or i >= 12)
    S.publish_swap(spark.read.parquet(path), path)
    assert S.partition_columns(spark, path) == ["part"] and spark.read.parquet(path).count() == 26
