import random

import pytest
from pyspark.sql import functions as F

from dimflow.operators import windows as W

SPECS = {
    "n": W.Number(),
    "lag": W.Lag("s"),
    "lead": W.Lead("v"),
    "top": W.RunMax("v"),
    "last": W.Carry("s"),
}


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows under one key, a null key, nulls and equal times."""
    rng = random.Random(5)
    data = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.5 else rng.choice([None, "a", "b", "c", "d", "e"])
        value = rng.randint(0, 99) if rng.random() < 0.6 else None
        text = rng.choice("xyz") if rng.random() < 0.5 else None
        data.append((key, rng.randint(0, 200), i, value, text))
    return spark.createDataFrame(data, "k string, t int, id int, v int, s string")


@pytest.mark.parametrize("down", [False, True])
def test_slices_equal_one_window(skewed, down):
    order = [F.desc("t"), F.col("id").asc()] if down else ["t", "id"]
    plain = W.keyed_window(skewed, ["k"], order, SPECS, bounded=True)
    part = F.floor(F.col("t") / 10)
    sliced = W.keyed_window(skewed, ["k"], order, SPECS, slice_by=-part if down else part)
    assert sliced.columns == plain.columns
    assert sorted(map(repr, sliced.collect())) == sorted(map(repr, plain.collect()))


def test_unbounded_key_needs_slices(skewed):
    with pytest.raises(ValueError):
        W.keyed_window(skewed, ["k"], ["t"], SPECS)


def test_latest_per_key_prunes_before_shuffle(skewed):
    plan = W.latest_per_key(skewed, ["k"], [F.desc("t"), "id"])._jdf.queryExecution().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning")
    assert "Partial" in plan


@pytest.fixture(scope="module")
def states(spark, day):
    data = [
        ("same", "2024-01-01", "A"), ("same", "2024-01-02", "A"),
        ("ab", "2024-01-01", "A"), ("ab", "2024-01-02", "B"),
        ("aba", "2024-01-01", "A"), ("aba", "2024-01-02", "B"), ("aba", "2024-01-03", "A"),
        ("gap", "2024-01-01", "A"), ("gap", "2024-01-03", "A"),
        ("nul", "2024-01-01", None), ("nul", "2024-01-02", ""), ("nul", "2024-01-03", None),
        ("gone", "2024-01-01", "A"), ("gone", "2024-01-02", "B"),
        ("live", "2024-01-03", "A"),
    ]
    return spark.createDataFrame([(k, day(x), a) for k, x, a in data], "k string, dt date, a string")


def per_key(df):
    return {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count("*").alias("n")).collect()}


def test_islands(states):
    n = per_key(W.islands(states, ["k"], ["a"], "dt"))
    assert n == {"same": 1, "ab": 2, "aba": 3, "gap": 1, "nul": 3, "gone": 2, "live": 1}


def test_islands_split_at_gaps(states):
    assert per_key(W.islands(states, ["k"], ["a"], "dt", gap_days=1))["gap"] == 2


def test_first_seen_loses_the_return(states):
    n = per_key(W.first_seen(states, ["k", "a"], "dt"))
    assert n["aba"] == 2 and n["ab"] == 2 and n["nul"] == 2


def test_disappeared(states, as_rows, day):
    gone = as_rows(W.disappeared(states, ["k"], "dt"))
    assert gone == sorted([(k, day("2024-01-02")) for k in ("same", "ab", "gone")], key=repr)


def test_close_intervals(spark, day, as_rows):
    df = spark.createDataFrame([(1, day("2024-01-01"), 1), (1, day("2024-01-01"), 2), (1, day("2024-01-05"), 3)], "k int, eff_dt date, v int")
    out = as_rows(W.close_intervals(df, ["k"], order=["eff_dt", "v"]), "v", "disc_dt", "is_current")
    assert out == [(1, day("2024-01-01"), False), (2, day("2024-01-04"), False), (3, day("9999-12-31"), True)]
    floor = as_rows(W.close_intervals(df, ["k"], order=["eff_dt", "v"], same_day=False), "v", "disc_dt")
    assert floor[0] == (1, day("2023-12-31"))
