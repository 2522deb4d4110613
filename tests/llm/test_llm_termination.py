"""Small inputs on which an operator has to come to its end, with whole results."""

import random

import pytest

from dimflow.llm import ngram_join


def some_text(rng, n=40):
    return " ".join(f"w{rng.randrange(100_000)}" for _ in range(n))


def joined(spark, rows, monkeypatch):
    """Components by doc_id; a join that goes on for more than ten turns is an error."""
    turns = []

    def pivots(postings, turn, own=ngram_join._pivots):
        turns.append(turn)
        assert len(turns) <= 10, "the turns don't end"
        return own(postings, turn)

    monkeypatch.setattr(ngram_join, "_pivots", pivots)
    found = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return sorted((r.doc_id, r.component_id) for r in found)


@pytest.mark.parametrize("n", [1, 5])
def test_similarity_join_of_texts_that_share_nothing(spark, monkeypatch, n):
    rng = random.Random(n)
    rows = [(k, some_text(rng)) for k in range(n)]
    assert joined(spark, rows, monkeypatch) == [(k, k) for k in range(n)]


def test_similarity_join_of_one_near_copy(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, some_text(rng)) for k in range(4)]
    rows.append((9, rows[2][1] + " more"))
    assert joined(spark, rows, monkeypatch) == [(0, 0), (1, 1), (2, 2), (3, 3), (9, 2)]


def test_similarity_join_of_copies_only(spark, monkeypatch):
    text = some_text(random.Random(4))
    assert joined(spark, [(k, text) for k in (5, 6, 7)], monkeypatch) == [(5, 5), (6, 5), (7, 5)]
