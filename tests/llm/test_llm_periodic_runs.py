"""Runs of words against a plain search over all periods, and the registered query against its contract."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from dimflow.llm import periodic_runs
from dimflow.llm.periodic_runs import find_runs
from dimflow.llm.queries import QUERIES, replanted
from dimflow.llm.squares import SquareCatcher

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stretches(words):
    """Start, end and smallest period of every stretch of two periods or more, trying all periods."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = p
        while i < len(words):
            if words[i] != words[i - p]:
                i += 1
                continue
            j = i
            while j < len(words) and words[j] == words[j - p]:
                j += 1
            if j - i >= p:
                found.setdefault((i - p, j), p)
            i = j
    return sorted((a, b, p) for (a, b), p in found.items())


def strong(words):
    return sorted([(a, b - a, p) for a, b, p in stretches(words) if b - a >= max(6, 4 * p)], key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng, n):
    words, kinds = [], rng.choice([1, 2, 3, 6])
    while len(words) < n:
        if words and rng.random() < 0.3:
            words += words[-rng.randrange(1, min(len(words), 20) + 1) :] * rng.randrange(1, 6)
        else:
            words.append(rng.randrange(kinds))
    return words[:n]


def test_catcher_finds_all_runs_word_by_word_and_in_pieces():
    rng = random.Random(5)
    for _ in range(300):
        words = some_words(rng, rng.randrange(rng.choice([8, 40, 120])))
        step = rng.choice([1, 3, 7, 1000])
        catcher = SquareCatcher(len(words) // 2)
        for at in range(0, len(words), step):
            catcher.append(np.array(words[at : at + step], np.int64))
        assert catcher.runs() == stretches(words), (words, step)


def test_runs_known_so_far_are_those_of_the_words_so_far():
    rng = random.Random(6)
    words = some_words(rng, 80)
    catcher = SquareCatcher(40)
    for at, word in enumerate(words):
        catcher.append(np.array([word]))
        assert catcher.runs() == stretches(words[: at + 1])


def test_one_word_and_two_words_long():
    for words in (np.zeros(30_000, np.int64), np.arange(30_000) % 7000):
        catcher = SquareCatcher(len(words) // 2)
        for at in range(0, len(words), 5000):
            catcher.append(words[at : at + 5000])
        assert catcher.runs() == [(0, 30_000, 7000 if words.any() else 1)]


def test_operator(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE_BYTES", 300)
    monkeypatch.setattr(periodic_runs, "PIECE_WORDS", 50)
    monkeypatch.setattr(periodic_runs, "PIECE_BYTES", 40)
    rng = random.Random(7)
    texts = [rng.choice([" ", "\n ", "\t"]).join("wé%d" % w for w in some_words(rng, rng.randrange(60))) for _ in range(300)]
    texts += [None, "", " \n ", "a", "a a a a a a", "a A a A a A a A", "x y x y x y x y ", "long " * 30_000, "　 　 　 　 　 　"]
    texts += texts[:5]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "runs long, text string").selectExpr("runs", "text", "1 as collapsed", "2 as row")
    got = find_runs(df).collect()
    assert len(got) == len(texts)
    for r in got:
        words = WORD.findall(r["row"]["text"] or "")
        if len(words) > 1000:
            assert [tuple(x) for x in r["runs"]] == [(0, len(words), 1)] and r["collapsed"] == "long"
            continue
        want = strong(words)
        assert ([tuple(x) for x in r["runs"]], r["collapsed"]) == (want, kept(words, want)), words
    assert find_runs(df.filter("runs < 0")).count() == 0


def expected(doc, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = strong(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    digest = hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest()
    return doc, len(runs), *best, milli, digest, hashlib.sha256(kept(words, runs).encode()).hexdigest()


def test_query_keeps_its_contract(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, " ".join("w%d" % w for w in (some_words(rng, n) if k % 2 else range(n)))) for k in range(400) for n in [rng.randrange(70)]]
    rows += [(None, "a a a a a a a"), (9000, None), (9001, ""), (9002, "same same"), (9002, "same same")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in got.dtypes if not c.endswith("sha256")} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((expected(*r) for r in rows), key=repr)


def test_replanted_rows(spark):
    ids = [k for k in range(300) if zlib.crc32(str(k).encode()) % 10 == 0]
    rows = [(k, " ".join(map(str, range(30)))) for k in ids] + [(1, "  a  b ")]
    got = dict(map(tuple, replanted(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got[1] == "  a  b "
    changed = [k for k in ids if got[k] != rows[0][1]]
    assert len(changed) > len(ids) // 2


@pytest.mark.parametrize("kind", ["string", "int"])
def test_query_on_empty_tables(spark, tmp_path, kind):
    spark.createDataFrame([], f"doc_id {kind}, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op11_periodic_runs"](spark, str(tmp_path)).count() == 0
