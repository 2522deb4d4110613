import itertools
import random

import pytest
from pyspark.sql import functions as F

from dimflow.operators import joins as J
from dimflow.operators.hierarchy import hierarchy_paths


@pytest.fixture(scope="module")
def versions(spark, day):
    data = [("a", "2024-01-01", "2024-01-10", "a1"), ("a", "2024-01-11", "9999-12-31", "a2"), ("b", "2024-01-05", "9999-12-31", "b1")]
    return spark.createDataFrame([(k, day(e), day(x), s) for k, e, x, s in data], "k string, eff_dt date, disc_dt date, sk string")


def test_asof_includes_both_ends(spark, versions, day, as_rows):
    data = [(1, "a", "2024-01-01"), (2, "a", "2024-01-10"), (3, "a", "2024-01-11"), (4, "a", "2023-12-31"), (5, "z", "2024-01-01"), (6, None, "2024-01-01")]
    facts = spark.createDataFrame([(i, k, day(x)) for i, k, x in data], "i int, k string, dt date")
    out = J.lookup_indexed(facts, versions, {"k": "k"}, "dt", "sk")
    assert as_rows(out, "i", "sk") == [(1, "a1"), (2, "a1"), (3, "a2"), (4, "-1"), (5, "-1"), (6, "-1")]


@pytest.mark.parametrize("days", [1, 7, 400])
def test_bucketed_asof_equals_plain(spark, versions, as_rows, days):
    import datetime as dt

    rng = random.Random(2)
    start = dt.date(2023, 12, 25)
    data = [(i, rng.choice(["a", "b", "z", None]), start + dt.timedelta(rng.randint(0, 60))) for i in range(200)]
    facts = spark.createDataFrame(data, "i int, k string, dt date")
    plain = J.lookup_indexed(facts, versions, {"k": "k"}, "dt", "sk")
    assert as_rows(J.lookup_asof(facts, versions, {"k": "k"}, "dt", "sk", bucket_days=days)) == as_rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_events_in_interval(spark, versions, day, as_rows, how):
    data = [("a", "2024-01-02", 1), ("a", "2024-01-10", 2), ("a", "2023-01-01", 3), ("z", "2024-01-02", 4), (None, "2024-01-02", 5)]
    events = spark.createDataFrame([(k, day(x), i) for k, x, i in data], "who string, dt date, i int")
    got = as_rows(J.events_in_interval(versions, events, {"k": "who"}, "dt", how=how), "sk", "i")
    want = [("a1", 1), ("a1", 2)] + ([("a2", None), ("b1", None)] if how == "left" else [])
    assert got == sorted(want, key=repr)


def test_asof_on_a_timestamp_compares_days(spark, versions, as_rows):
    facts = spark.sql("SELECT 1 i, 'a' k, TIMESTAMP '2024-01-10 23:59:00' dt")
    assert as_rows(J.lookup_indexed(facts, versions, {"k": "k"}, "dt", "sk"), "sk") == [("a1",)]


def test_asof_is_one_hash_join(spark, versions):
    facts = spark.range(10).select(F.col("id").cast("string").alias("k"), F.current_date().alias("dt"))
    plan = J.lookup_indexed(facts, versions, {"k": "k"}, "dt", "sk")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ambiguous_lookup(spark, as_rows):
    facts = spark.createDataFrame([(1, []), (2, ["x"]), (3, ["x", "y"]), (4, ["q"]), (5, None)], "i int, ids array<string>")
    dim = spark.createDataFrame([("x", "sx"), ("y", "sy")], "id string, sk string")
    assert as_rows(J.lookup_sk_multi(facts, dim, "ids", "id", "sk"), "i", "sk") == [(1, "-1"), (2, "sx"), (3, "-2"), (4, "-1"), (5, "-1")]


def test_exclude_superseded(spark, as_rows):
    data = [(1, "old", "end"), (1, "old", "on"), (1, "new", "end"), (2, "old", "end"), (3, None, "end"), (3, "old", "end")]
    df = spark.createDataFrame(data, "k int, kind string, st string")
    out = J.exclude_superseded(df, "k", "kind", "old", F.col("st") == "end")
    assert (1, "old", "end") not in as_rows(out) and out.count() == 5


def test_join_any_meets_each_pair_once(spark, as_rows):
    left = spark.createDataFrame([(1, 5), (1, 6), (2, 5)], "k int, d int")
    right = spark.createDataFrame([(1, 5, 5, "p"), (1, 6, 7, "q"), (1, 9, 6, "r"), (2, 1, None, "s")], "rk int, a int, b int, t string")
    out = J.join_any(left, right, {"k": "rk"}, "d", ["a", "b"])
    assert as_rows(out, "k", "d", "t") == sorted([(1, 5, "p"), (1, 6, "q"), (1, 6, "r"), (2, 5, None)], key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_nullable_join_equals_brute_force(spark, as_rows, how, null_safe):
    rng = random.Random(11)
    pick = lambda: rng.choice([None, "x", "y"])
    a = [(i, pick(), pick(), rng.randint(1, 3)) for i in range(40)]
    b = [(i, pick(), pick(), rng.randint(1, 3)) for i in range(40)]
    left = spark.createDataFrame(a, "lid int, l_p string, l_q string, lv int")
    right = spark.createDataFrame(b, "rid int, r_p string, r_q string, rv int")
    got = as_rows(J.join_nullable(left, right, ["p", "q"], {"lv": "rv"}, null_safe=null_safe, how=how), "lid", "rid")

    def fits(x, y):
        return x == y if null_safe else (x == y or x is None or y is None)

    want = [(x[0], y[0]) for x, y in itertools.product(a, b) if x[3] == y[3] and fits(x[1], y[1]) and fits(x[2], y[2])]
    if how == "left":
        met = {w[0] for w in want}
        want += [(x[0], None) for x in a if x[0] not in met]
    assert got == sorted(want, key=repr)


def test_intersection_equals_self_joins(spark, day, as_rows):
    """Random non-overlapping intervals per attribute, with holes and open ends."""
    import datetime as dt

    rng = random.Random(3)
    data = []
    for key, attr in itertools.product(range(6), "abc"):
        at = 1
        for _ in range(rng.randint(0, 5)):
            start = at + rng.randint(0, 3)
            end = start + rng.randint(0, 4)
            at = end + 1
            data.append((key, attr, f"{attr}{start}", dt.date(2024, 1, 1) + dt.timedelta(start), dt.date(2024, 1, 1) + dt.timedelta(end)))
        if rng.random() < 0.5:
            data.append((key, attr, f"{attr}open", dt.date(2024, 1, 1) + dt.timedelta(at), dt.date(9999, 12, 31)))
    log = spark.createDataFrame(data, "k int, change_column string, current_value string, eff_dt date, disc_dt date")
    want = []
    by = {c: [r for r in data if r[1] == c] for c in "abc"}
    for combo in itertools.product(*by.values()):
        if len({r[0] for r in combo}) == 1:
            eff, disc = max(r[3] for r in combo), min(r[4] for r in combo)
            if eff <= disc:
                want.append((combo[0][0], *[r[2] for r in combo], eff, disc))
    got = as_rows(J.intersect_intervals(log, ["k"], ["a", "b", "c"]), "k", "a", "b", "c", "eff_dt", "disc_dt")
    assert got == sorted(want, key=repr) and want


def test_hierarchy(spark, day, as_rows):
    o = "9999-12-31"
    data = [
        ("boss", "boss", "2024-01-01", o),  # manages itself: a root
        ("mid", "boss", "2024-01-02", "2024-01-31"),
        ("leaf", "mid", "2024-01-10", o),
        ("late", "mid", "2024-02-10", o),  # starts after its manager's interval
        ("x", "y", "2024-01-01", o), ("y", "x", "2024-01-01", o),  # a cycle out of reach
        ("boss", "leaf", "2024-01-20", o),  # closes a cycle through the root
    ]
    df = spark.createDataFrame([(i, p, day(e), day(x)) for i, p, e, x in data], "id string, mgr string, eff_dt date, disc_dt date")
    out = hierarchy_paths(df, "id", "mgr", ["boss"])
    paths = {tuple(r["path"]) for r in out.collect()}
    assert paths == {("boss",), ("boss", "mid"), ("boss", "mid", "leaf")}


def test_hierarchy_deeper_than_a_hundred(spark, day):
    rows = [(str(i), str(i - 1), day("2024-01-01"), day("9999-12-31")) for i in range(1, 104)]
    rows.append(("0", "0", day("2024-01-01"), day("9999-12-31")))
    df = spark.createDataFrame(rows, "id string, mgr string, eff_dt date, disc_dt date")
    out = hierarchy_paths(df, "id", "mgr", ["0"])
    assert out.agg(F.max(F.size("path"))).first()[0] == 104


def test_asof_gives_one_row_per_fact(spark, day, as_rows):
    """Versions of one day, a nested version, a hot key over many years, facts without key or date."""
    dim = [
        ("a", "2024-01-01", "2024-01-01", "a1"), ("a", "2024-01-01", "2024-01-04", "a2"), ("a", "2024-01-05", "9999-12-31", "a3"),
        ("n", "2020-01-01", "2024-12-31", "n1"), ("n", "2022-03-01", "2022-03-02", "n2"),
    ]
    dim = spark.createDataFrame([(k, day(e), day(x), sk) for k, e, x, sk in dim], "id string, eff_dt date, disc_dt date, sk string")
    facts = [(1, "a", "2024-01-01"), (2, "a", "2024-01-04"), (3, "a", "2031-07-01"), (4, "n", "2021-06-01"), (5, "n", "2022-03-02"),
             (6, "n", "2023-01-01"), (7, None, "2024-01-01"), (8, "a", None), (9, "z", "2024-01-01"), (9, "z", "2024-01-01"), (10, "a", "2023-12-31")]
    facts = spark.createDataFrame([(i, k, day(d)) for i, k, d in facts], "i int, id string, dt date")
    ways = [J.lookup_asof(facts, dim, {"id": "id"}, "dt", "sk", bucket_days=days) for days in (365, 7)]
    many = [J.AsOf(dim, {"id": "id"}, "dt", "sk"), J.AsOf(dim, {"id": "id"}, "dt", "sk", out="sk2", default=None)]
    two = J.lookup_many(facts.distinct(), ["i"], many)
    assert two.filter("sk <> coalesce(sk2, '-1')").isEmpty() and two.count() == 10
    for out in (*ways, J.lookup_indexed(facts, dim, {"id": "id"}, "dt", "sk"), two.union(two.filter("i = 9")).drop("sk2")):
        out = as_rows(out, "i", "sk")
        assert out == sorted([(1, "a2"), (2, "a2"), (3, "a3"), (4, "n1"), (5, "n2"), (6, "-1"), (7, "-1"), (8, "-1"), (9, "-1"), (9, "-1"), (10, "-1")], key=repr)


def test_ways_of_dated_lookups_agree(spark, as_rows):
    """Random overlapping versions, a hot key among them, two key columns of unlike types."""
    import datetime as dt

    rng, day0 = random.Random(4), dt.date(2020, 1, 1)
    key = lambda: rng.choice(["hot"] * 5 + ["b", "c", None])
    dim = []
    for n in range(300):
        start = rng.randrange(400)
        dim.append((key(), rng.randrange(2), day0 + dt.timedelta(start), day0 + dt.timedelta(start + rng.randrange(-2, 60)), f"s{n:03d}"))
    dim = spark.createDataFrame(dim, "id string, part int, eff_dt date, disc_dt date, sk string")
    facts = [(i, key(), rng.choice([0, 1, None]), day0 + dt.timedelta(rng.randrange(-5, 480))) for i in range(400)]
    facts = spark.createDataFrame(facts, "i int, k string, p long, dt date")
    on = {"k": "id", "p": "part"}
    want = as_rows(J.lookup_asof(facts, dim, on, "dt", "sk"), "i", "sk")
    assert as_rows(J.lookup_indexed(facts, dim, on, "dt", "sk"), "i", "sk") == want
    assert as_rows(J.lookup_many(facts, ["i"], [J.AsOf(dim, on, "dt", "sk")]), "i", "sk") == want
    assert len({x for x in want if x[1] != "-1"}) > 150


def test_small_dimension_leaves_the_facts_unshuffled(spark, versions, tmp_path):
    spark.range(100).select(F.col("id").cast("string").alias("k"), F.current_date().alias("dt")).write.parquet(str(tmp_path / "f"))
    facts = spark.read.parquet(str(tmp_path / "f"))
    out = J.lookup_indexed(facts, versions, {"k": "k"}, "dt", "sk")
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_a_hot_key_of_a_large_dimension_is_split(spark, as_rows):
    """A third of the facts under one key: adaptive execution splits its partition."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.coalescePartitions.enabled"]
    was = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in zip(names, ["-1", "-1", "20k", "10k", "1.5", "false"]):
            spark.conf.set(n, v)
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        facts = spark.range(0, 60_000, 1, 8).select("id", key.alias("k"), F.lit("2024-05-05").cast("date").alias("dt"))
        dim = spark.range(60_000).select(key.alias("k"), F.lit("2024-01-01").cast("date").alias("eff_dt"), F.lit("9999-12-31").cast("date").alias("disc_dt"), F.concat(F.lit("s"), "id").alias("sk"))
        out = J.lookup_indexed(facts, dim, {"k": "k"}, "dt", "sk")
        assert out.filter("sk = '-1'").count() == 0
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in was.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def test_a_thousand_levels_take_few_rounds(spark, day, monkeypatch):
    from dimflow.operators import hierarchy

    stored = []
    monkeypatch.setattr(hierarchy, "stage_table", lambda df, name, f=hierarchy.stage_table: stored.append(name) or f(df, name))
    rows = [(i, max(0, i - 1), day("2024-01-01"), day("9999-12-31")) for i in range(1001)]
    rows += [(2000, 2001, day("2024-01-01"), day("9999-12-31")), (2001, 2000, day("2024-01-01"), day("9999-12-31"))]  # a cycle
    out = hierarchy_paths(spark.createDataFrame(rows, "id int, mgr int, eff_dt date, disc_dt date"), "id", "mgr", [0])
    assert out.agg(F.count("*"), F.max(F.size("path"))).first()[:] == (1001, 1001)
    assert out.filter("path[0] <> 0 or path[size(path) - 1] <> id").isEmpty()
    assert stored.count("ways") <= 11


def test_roots_below_roots_and_cycles_through_them(spark, day, as_rows):
    rows = [("r", "r"), ("s", "r"), ("a", "s"), ("b", "a"), ("c", "d"), ("d", "c"), ("e", "c"), ("t", "u"), ("u", "t")]
    df = spark.createDataFrame([(a, b, day("2024-01-01"), day("9999-12-31")) for a, b in rows], "id string, mgr string, eff_dt date, disc_dt date")
    out = [(r["id"], "".join(r["path"])) for r in hierarchy_paths(df, "id", "mgr", ["r", "s", "t"]).collect()]
    assert sorted(out) == sorted([("r", "r"), ("s", "s"), ("s", "rs"), ("a", "sa"), ("a", "rsa"), ("b", "sab"), ("b", "rsab"), ("t", "t"), ("u", "tu")])


def test_lookup_of_a_repeated_key_keeps_one_row(spark, as_rows):
    facts = spark.createDataFrame([(1, "a"), (2, "b")], "i int, id string")
    dim = spark.createDataFrame([("a", "s1"), ("a", "s2")], "id string, sk string")
    assert as_rows(J.lookup_sk(facts, dim, {"id": "id"}, "sk"), "i", "sk") == [(1, "s2"), (2, "-1")]


@pytest.fixture
def no_broadcast(spark):
    """Joins by shuffles, in four partitions that stay four."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    was = {n: spark.conf.get(n, None) for n in names}
    for n, v in zip(names, ["-1", "-1", "false"]):
        spark.conf.set(n, v)
    yield
    for n, v in was.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def test_facts_without_a_key_are_dealt_over_tasks(spark, no_broadcast):
    facts = spark.range(0, 4000, 1, 4).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    dim = spark.range(0, 4000, 20).select(F.col("id").alias("key"), F.concat(F.lit("s"), "id").alias("sk"))
    out = J.lookup_sk(facts, dim, {"k": "key"}, "sk")
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000
    assert out.columns == ["id", "k", "m", "sk"] and out.filter("sk <> '-1'").count() == 200
    assert out.filter("sk <> '-1' and sk <> concat('s', id)").isEmpty()


@pytest.mark.parametrize("carry", [True, False, None])
def test_lookup_many_carried_or_asked(spark, day, as_rows, carry):
    dim = spark.createDataFrame([(1, day("2024-01-01"), day("2024-01-31"), "a1"), (1, day("2024-02-01"), day("9999-12-31"), "a2"), (2, day("2024-01-01"), day("9999-12-31"), "b")], "k int, eff_dt date, disc_dt date, sk string")
    data = [(1, 1, 2, "2024-01-05"), (2, 1, 1, "2024-02-05"), (2, 1, 1, "2024-02-05"), (3, None, 2, "2024-02-05"), (4, 2, None, None), (5, 9, 1, "2023-01-01")]
    facts = spark.createDataFrame([(n, p, q, day(x)) for n, p, q, x in data], "n int, p int, q int, dt date")
    looks = [J.AsOf(dim, {"p": "k"}, "dt", "sk"), J.AsOf(dim, {"q": "k"}, "dt", "sk", out="p", default=None)]
    got = J.lookup_many(facts, ["p", "q", "dt"], looks, carry=carry)
    assert got.columns == ["n", "q", "dt", "sk", "p"]
    assert as_rows(got, "n", "sk", "p") == sorted([(1, "a1", "b"), (2, "a2", "a2"), (2, "a2", "a2"), (3, "-1", "b"), (4, "-1", None), (5, "-1", None)], key=repr)


def test_light_facts_ask_no_questions(spark, versions):
    """Rows with few fixed columns besides keys and dates aren't joined back; texts are."""
    facts = spark.sql("select 'a' as k, date'2024-01-02' as dt, 1L as n, 'x' as note")
    looks = [J.AsOf(versions, {"k": "k"}, "dt", "sk")]
    joins = [J.lookup_many(x, ["k", "dt"], looks)._jdf.queryExecution().optimizedPlan().toString().count("Join ") for x in (facts.drop("note"), facts)]
    assert joins == [1, 2]


def test_wildcard_join_repeats_no_left_row(spark, as_rows):
    """Only distinct values are repeated for each pattern of nulls; rows meet their partners once."""
    rng = random.Random(7)
    pick = lambda: rng.choice(["x", "y", None])
    ls = [(i, pick(), pick(), rng.choice([1, 2, None])) for i in range(120)] + [(0, "x", None, 1)] * 2
    rs = [(pick(), pick(), rng.choice([1, 3, None]), i % 9) for i in range(25)]
    left = spark.createDataFrame(ls, "i int, l_a string, l_b string, s int")
    right = spark.createDataFrame(rs, "r_a string, r_b string, t int, n int")
    fits = lambda x, y: x is None or y is None or x == y
    inner = [(*a, *b) for a in ls for b in rs if a[3] is not None and a[3] == b[2] and fits(a[1], b[0]) and fits(a[2], b[1])]
    outer = inner + [(*a, None, None, None, None) for a in ls if a not in [x[:4] for x in inner]]
    for how, want in (("inner", inner), ("left", outer)):
        out = J.join_nullable(left, right, ["a", "b"], {"s": "t"}, null_safe=False, how=how)
        assert as_rows(out) == sorted(want, key=repr)
        plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
        for at, line in enumerate(plan):  # what is repeated on the left was made distinct before
            if "Generate explode" in line and "__rm" in line:
                assert "Aggregate" in plan[at + 1], plan[at + 1]
    empty = J.join_nullable(left, right.limit(0), ["a", "b"], {"s": "t"}, null_safe=False)
    assert empty.count() == len(ls)
