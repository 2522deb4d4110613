import pytest
from pyspark.sql import functions as F

from dimflow.functions.convert import mask_when
from dimflow.operators import quality as Q
from dimflow.operators import reshape as P
from dimflow.sources import readers as R


def test_checks_find_bad_rows(spark, as_rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert as_rows(Q.check_unique(df, ["k"])) == [(1, 2)]
    assert as_rows(Q.check_not_null(df, ["k", "v"])) == [("v", 1)]
    assert Q.require_not_null(df, ["k"]).count() == 3
    with pytest.raises(Exception, match="null in v"):
        Q.require_not_null(df, ["v"]).collect()


def test_masks(spark):
    df = spark.sql("SELECT 'secret' a, 'abcdefgh' b, 'abc' c, DATE '1980-05-06' d, DATE '1980-05-06' e, CAST(NULL AS STRING) f")
    out = Q.apply_masks(df, {"a": "string_full", "b": "string_partial", "c": "string_partial", "d": "date_full", "e": "date_partial", "f": "string_full"}).first()
    assert (out.a, out.b, out.c, str(out.d), str(out.e), out.f) == ("*****", "****efgh", "***", "1900-01-01", "1980-01-01", None)


def test_mask_when(spark, as_rows):
    df = spark.createDataFrame([("PAY", "10"), ("NAME", "x"), ("PAY", None)], "attr string, v string")
    assert as_rows(df.select("attr", mask_when("v", "attr", ["PAY"]).alias("v"))) == sorted([("PAY", "*****"), ("NAME", "x"), ("PAY", None)], key=repr)


def test_dedupe_intervals(spark, day, as_rows):
    data = [("k", "2024-01-01", "2024-01-05"), ("k", "2024-01-01", "2024-01-09"), ("k", "2024-02-01", "2024-02-03")]
    df = spark.createDataFrame([(k, day(a), day(b)) for k, a, b in data], "sk string, eff_dt date, disc_dt date")
    # A key with both single and repeated dates keeps one row per date.
    assert as_rows(Q.dedupe_intervals(df, "sk"), "disc_dt") == [(day("2024-01-09"),), (day("2024-02-03"),)]


def test_sequence_is_dense_and_repeatable(spark, as_rows):
    new = spark.range(1000).select(F.col("id").alias("n"))
    target = spark.createDataFrame([(41,)], "k bigint")
    out = Q.append_sequence(new, target, "k", ["n"])
    keys = sorted(r["k"] for r in out.collect())
    assert keys == list(range(42, 1042))
    assert as_rows(Q.append_sequence(new, target, "k", ["n"])) == as_rows(out)
    first = Q.append_sequence(new, None, "k", ["n"])
    assert first.agg(F.min("k"), F.max("k")).first()[:] == (1, 1000)


def test_reconcile(spark):
    Q.reconcile(10, 7, 3)
    with pytest.raises(ValueError):
        Q.reconcile(10, 7, 2)
    assert Q.reconcile_tables(spark.range(5), spark.range(3), spark.range(1)).first()["balanced"] is False


def test_watermarks(spark, as_rows):
    df = spark.range(6).select(F.col("id").alias("t"))
    target = spark.range(4).select(F.col("id").alias("m"))
    assert as_rows(R.since_watermark(df, target, "t", "m")) == [(4,), (5,)]
    assert as_rows(R.since_watermark(df, target, "t", "m", inclusive=True)) == [(3,), (4,), (5,)]
    # No target, an empty target and the switch turned off all mean no filter.
    assert R.since_watermark(df, None, "t", "m").count() == 6
    assert R.since_watermark(df, target.filter("m < 0"), "t", "m").count() == 6
    assert R.since_watermark(df, target, "t", "m", enabled=False).count() == 6


def test_unpivot_drops_nulls(spark, as_rows):
    df = spark.createDataFrame([(1, "a", None), (2, None, 5)], "k int, p string, q int")
    assert as_rows(P.unpivot_attrs(df, ["k"], ["p", "q"])) == [(1, "p", "a"), (2, "q", "5")]


def test_explode_list(spark, as_rows):
    df = spark.createDataFrame([(1, "x; y ;z"), (2, None)], "k int, l string")
    assert as_rows(P.explode_list(df, "l")) == [(1, "x"), (1, "y"), (1, "z")]


def test_profile_types(spark, as_rows):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "t", "c": null}',)], "js string")
    assert as_rows(P.profile_types(df, "js")) == [("a", "BIGINT,STRING"), ("b", "STRING"), ("c", "VOID")]


def test_corrections_apply_in_order(spark, as_rows):
    df = spark.createDataFrame([("20211131",), ("20220101",)], "d string")
    out = P.apply_corrections(df, [("d", F.col("d") == "20211131", "20211130"), ("d", F.col("d") == "20211130", "20211201")])
    assert as_rows(out) == [("20211201",), ("20220101",)]


def test_dedupe_table_and_backfill(spark, tmp_path, day):
    from dimflow.plans.incremental import backfill_once
    from dimflow.sources.sinks import dedupe_table

    path = str(tmp_path / "t")
    data = [("k", day("2024-01-01"), day("2024-01-05")), ("k", day("2024-01-01"), day("2024-01-09"))]
    rows = spark.createDataFrame(data, "sk string, eff_dt date, disc_dt date")
    assert backfill_once(spark, path, lambda: rows) and not backfill_once(spark, path, lambda: rows.limit(0))
    dedupe_table(spark, path, "sk")
    assert spark.read.parquet(path).collect() == [tuple(data[1])]
