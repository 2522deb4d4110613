import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StringType

from dimflow.operators import merge as M
from dimflow.sources import sinks as S


@pytest.fixture(scope="module")
def base(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    source = spark.createDataFrame([(2, "B", 21), (3, "c", 30)], "k int, v string, n int")
    return target, source


def test_upsert_all_listed_kept(base, as_rows):
    t, s = base
    assert as_rows(M.merge_upsert(t, s, ["k"])) == [(1, "a", 10), (2, "B", 21), (3, "c", 30)]
    assert as_rows(M.merge_upsert(t, s, ["k"], update_cols=["v"])) == [(1, "a", 10), (2, "B", 20), (3, "c", 30)]
    assert as_rows(M.merge_upsert(t, s, ["k"], no_update_cols=("v",))) == [(1, "a", 10), (2, "b", 21), (3, "c", 30)]


def test_upsert_without_key_only_inserts(base):
    t, s = base
    assert M.merge_upsert(t, s, []).count() == 4


def test_upsert_twice_changes_nothing(base, as_rows):
    t, s = base
    once = M.merge_upsert(t, s, ["k"], update_cols=["v"])
    assert as_rows(M.merge_upsert(once, s, ["k"], update_cols=["v"])) == as_rows(once)


def test_duplicate_source_keys_are_refused(base):
    t, s = base
    with pytest.raises(M.DuplicateKeyError):
        M.merge_upsert(t, s.unionByName(s), ["k"])
    with pytest.raises(M.DuplicateKeyError):
        M.scd2_merge(t, s.unionByName(s), ["k"], hash_col="v")


@pytest.fixture(scope="module")
def scd(spark, day):
    cols = "k string, dbt_hash string, rpt_eff_dt date, disc_dt date, is_current boolean"
    o = day("9999-12-31")
    target = [
        ("same", "h1", day("2024-01-01"), o, True),
        ("changed", "h1", day("2024-01-01"), o, True),
        ("back", "h1", day("2024-01-01"), day("2024-01-09"), False),
        ("back", "h2", day("2024-01-10"), o, True),
        ("quiet", "h1", day("2024-01-01"), o, True),
    ]
    d = day("2024-02-01")
    source = [("same", "h1", d, o, True), ("changed", "h2", d, o, True), ("back", "h1", d, o, True), ("new", "h1", d, o, True)]
    return spark.createDataFrame(target, cols), spark.createDataFrame(source, cols)


def test_scd2_merge(scd, as_rows, day):
    t, s = scd
    out = M.scd2_merge(t, s, ["k"])
    got = as_rows(out, "k", "dbt_hash", "disc_dt", "is_current")
    end, o = day("2024-01-31"), day("9999-12-31")
    assert got == sorted(
        [
            ("same", "h1", o, True),
            ("changed", "h1", end, False), ("changed", "h2", o, True),
            ("back", "h1", day("2024-01-09"), False), ("back", "h2", end, False), ("back", "h1", o, True),
            ("quiet", "h1", o, True),
            ("new", "h1", o, True),
        ],
        key=repr,
    )
    again = M.scd2_merge(out, s, ["k"])
    assert as_rows(again) == as_rows(out)
    open_rows = out.filter("is_current").groupBy("k").count().filter("count <> 1")
    assert open_rows.isEmpty()


def test_delete_insert(base, as_rows):
    t, s = base
    twice = s.unionByName(s)
    assert as_rows(M.delete_insert(t, twice, ["k"]), "k") == [(1,), (2,), (2,), (3,), (3,)]


def test_align_schema(spark):
    a = spark.sql("SELECT 1 AS x, 'p' AS y, CAST(1.5 AS DECIMAL(5,2)) AS z")
    b = spark.sql("SELECT 2L AS x, 3 AS z, 2.5D AS w")
    left, right = M.align_schema(a, b)
    assert left.schema.fieldNames() == ["x", "y", "z", "w"] == right.schema.fieldNames()
    types = [f.dataType for f in left.schema.fields]
    assert types == [LongType(), StringType(), DecimalType(12, 2), DoubleType()]
    assert M.wider(IntegerType(), StringType()) == StringType()
    for a, b in [(DecimalType(38, 10), DoubleType()), (DoubleType(), DecimalType(20, 0))]:
        with pytest.raises(M.NoCommonType):
            M.wider(a, b)
    assert left.unionByName(right).count() == 2


def test_update_from_touches_matching_rows_only(spark, as_rows):
    t = spark.createDataFrame([(1, "open", 5), (1, "done", 6), (2, "open", 7)], "k int, st string, n int")
    s = spark.createDataFrame([(1, 99)], "k int, m int")
    out = M.update_from(t, s, ["k"], {"n": "m", "st": F.lit("shut")}, F.col("st") == "open")
    assert as_rows(out) == sorted([(1, "shut", 99), (1, "done", 6), (2, "open", 7)], key=repr)


def test_publish_swap_reads_what_it_replaces(spark, tmp_path, as_rows):
    path = str(tmp_path / "t")
    S.publish_swap(spark.range(3), path)
    S.publish_swap(spark.read.parquet(path).filter("id > 0"), path)
    assert as_rows(spark.read.parquet(path)) == [(1,), (2,)]
    assert as_rows(spark.read.parquet(path + "_BKP")) == [(0,), (1,), (2,)]


def test_failed_build_leaves_the_old_table(spark, tmp_path, as_rows):
    path = str(tmp_path / "t")
    S.publish_swap(spark.range(2), path)
    broken = spark.range(2).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        S.publish_swap(broken, path)
    assert as_rows(spark.read.parquet(path)) == [(0,), (1,)]


def test_recover_after_a_cut_swap(spark, tmp_path, as_rows):
    path = tmp_path / "t"
    S.publish_swap(spark.range(2), str(path))
    path.rename(tmp_path / "t_BKP")
    assert S.recover(spark, str(path)) and as_rows(spark.read.parquet(str(path))) == [(0,), (1,)]
    assert not S.recover(spark, str(path))


def test_purge_keeps_rows_of_unknown_state(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, 0), (2, 1), (3, None)], "k int, gone int").write.parquet(path)
    S.purge_where(spark, path, F.col("gone") == 1)
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_run_status(spark, tmp_path):
    path = str(tmp_path / "audit")
    for key in ("r1", "r2"):
        S.append_audit(spark, path, {"run_key": key, "source_rows": 5, "status": "RUNNING"})
    S.set_run_status(spark, path, "r2", "SUCCESS")
    got = {r["run_key"]: (r["status"], r["source_rows"], r["updt_tmsp"] is None) for r in S.read_audit(spark, path).collect()}
    assert got == {"r1": ("RUNNING", 5, True), "r2": ("SUCCESS", 5, False)}
    with pytest.raises(ValueError):
        S.append_audit(spark, path, {"nonsense": 1})
    # A change beside another writer's row loses neither.
    S.append_audit(spark, path, {"run_key": "r9", "status": "RUNNING"})
    S.set_run_status(spark, path, "r2", "FAILED")
    got = {r["run_key"]: r["status"] for r in S.read_audit(spark, path).collect()}
    assert got["r2"] == "FAILED" and got["r9"] == "RUNNING"


def test_packed_keys_come_back(spark):
    from dimflow.functions.keys import packed, unpacked

    texts = [None, "", "-1", "é", "0f" * 16, "0F" * 16, "0f" * 8, "0f" * 15, "0f" * 17, *["x" * n for n in range(12, 20)], *["\x00" * n for n in range(12, 20)], "\x01\x00" + "y" * 13, "g" * 32]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed("t").alias("p"))
    got = rows.select("t", "p", unpacked("p").alias("u")).collect()
    assert [r["u"] for r in got] == texts
    assert len({bytes(r["p"]) for r in got if r["t"] is not None}) == len(set(texts)) - 1
    assert [len(r["p"]) for r in got if r["t"] == "0f" * 16] == [16]


def test_upsert_of_hash_columns(spark, as_rows):
    h = ["%032x" % (k * 7**30) for k in range(6)]
    target = spark.createDataFrame([(h[0], "a1", 1), (h[1], None, 2), ("-1", h[1], 3), (None, "-1", 4), (h[2].upper(), h[3], 5)], "k string, sk string, v int")
    source = spark.createDataFrame([(h[1], h[4], 20), ("-1", "x", 30), (h[2], None, 50), (None, h[5], 60)], "k string, sk string, v int")
    plain, short = M.merge_upsert(target, source, ["k"]), M.merge_upsert(target, source, ["k"], hashes=("k", "sk", "v"))
    assert short.columns == plain.columns and as_rows(short) == as_rows(plain)
    assert len(as_rows(short)) == 7


def test_repeated_text_keys_are_refused(spark):
    rows = [("a", None), (None, "a"), ("b", "c")]  # the first two have one hash
    df = spark.createDataFrame(rows, "k string, l string")
    M.merge_upsert(df, df, ["k", "l"])
    for more in rows:
        with pytest.raises(M.DuplicateKeyError):
            M.merge_upsert(df, df.union(spark.createDataFrame([more], df.schema)), ["k", "l"])
