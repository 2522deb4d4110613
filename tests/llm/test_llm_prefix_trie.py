"""The prefix trie against a plain tree of Python tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from dimflow.llm import prefix_trie
from dimflow.llm.queries import QUERIES

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain_trie(convs):
    """convs: id to a tuple of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted(
        (
            min(m),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(m),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    return out


def result(df):
    assert set(COLUMNS) <= set(df.columns)
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


def of_turns(spark, convs):
    rows = [(c, k, r, t) for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns, _ = prefix_trie.number_turns(prefix_trie.digest_turns(df))
    members = spark.createDataFrame([(c,) for c in convs], "conv_id long")
    return prefix_trie.prefix_trie(turns, members)


def write(spark, folder, rows, kind="long"):
    df = spark.createDataFrame(rows, f"conv_id {kind}, turn long, role string, text string")
    df.selectExpr("*", "1 as place", "2 as depth", "'x' as key").write.parquet(f"{folder}/conversations.parquet")


def test_query_keeps_its_contract(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 2)
    rng = random.Random(9)
    texts = ["", "é", "yes", "no", "what a long answer", None]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for c in range(3, 160) if c % 7 for t in range(rng.randrange(1, 12))]
    rows += [(500, None, "user", "null turn"), (500, 0, "user", "a"), (None, 0, "user", "lost"), (505, 3, "user", "x" * 100_000)]
    write(spark, str(tmp_path), rows)
    assert result(QUERIES["op12_prefix_trie"](spark, str(tmp_path))) == plain_trie(rebuilt(rows))


@pytest.mark.parametrize("local", [1, 7, 4096])
def test_components_split_over_tasks(spark, monkeypatch, local):
    monkeypatch.setattr(prefix_trie.subtree_totals, "__defaults__", (local,))
    rng = random.Random(10)
    convs = {c: tuple(("user", rng.choice("ab")) for _ in range(rng.randrange(7))) for c in range(60)}
    convs |= {c: (("user", "a"),) * 15 for c in range(60, 80)}  # a hot chain
    assert result(of_turns(spark, convs)) == plain_trie(convs)


def test_a_deep_chain_and_a_wide_node(spark):
    convs = {0: tuple(("u", str(k)) for k in range(1500))}
    convs |= {c: (("u", "0"), ("a", str(c))) for c in range(1, 300)}
    assert result(of_turns(spark, convs)) == plain_trie(convs)


def test_conversation_over_several_partitions(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        convs = {c: tuple(("u", str(k % 5)) for k in range(n)) for c, n in enumerate([0, 400, 3, 400, 1, 0, 399])}
        assert result(of_turns(spark, convs)) == plain_trie(convs)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_local_decomposition_of_random_trees():
    rng = random.Random(11)
    for _ in range(200):
        n = rng.randrange(1, 60)
        up = [-1] + [rng.randrange(max(0, k - rng.choice([1, 3, 60])), k) for k in range(1, n)]
        depth = [0] * n
        for k in range(1, n):
            depth[k] = depth[up[k]] + 1
        weights = [rng.randrange(1, 9) for _ in range(n)]
        values = [rng.randrange(9) for _ in range(n)]
        total, weight = values[:], weights[:]
        for k in range(n - 1, 0, -1):
            total[up[k]] += total[k]
            weight[up[k]] += weight[k]
        rows = [(0, 0, k, depth[k], up[k] if k else None, weight[k], values[k], 0) for k in range(n)]
        got = prefix_trie.component_totals(sorted(rows, key=lambda r: r[3]), 1)
        assert sorted(got) == sorted((k, depth[k], total[k]) for k in range(n))


def test_empty_table_and_turnless_conversations(spark, tmp_path):
    write(spark, str(tmp_path), [])
    assert QUERIES["op12_prefix_trie"](spark, str(tmp_path)).count() == 0
    convs = {4: (), 2: ()}
    assert result(of_turns(spark, convs)) == plain_trie(convs)
