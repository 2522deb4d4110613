"""Entities of forms that have hardly more values than there are entities."""

import pytest

from dimflow.llm import surrogates


@pytest.fixture
def bounded(monkeypatch):
    """Few attempts; an assignment that goes on for long is an error."""
    calls = []

    def stage(df, name, own=surrogates.stage_table):
        calls.append(name)
        assert len(calls) <= 15, "the attempts don't end"
        return own(df, name)

    monkeypatch.setattr(surrogates, "stage_table", stage)
    monkeypatch.setattr(surrogates, "ATTEMPTS", 3, raising=False)


def test_all_values_of_a_short_form_get_surrogates(spark, bounded):
    real = [("phone", f"1{k:03d}", "1") for k in range(1000)] + [("phone", "2555", "2"), ("phone", "4930123456", "49")]
    real += [("secret", f"-----{k}", "n") for k in range(10)]
    found = surrogates.assign(spark.createDataFrame(real, "kind string, normal string, gender string"), "key").collect()
    assert sorted((r.kind, r.normal) for r in found) == sorted((k, n) for k, n, _ in real)
    assert len({(r.kind, r.surrogate) for r in found}) == len(real)
    assert all(r.surrogate != r.normal and len(r.surrogate) == len(r.normal) for r in found)
    long = [r.surrogate for r in found if r.normal == "4930123456"]
    assert long[0].startswith("49") and long[0] not in {n for _, n, _ in real}


def test_texts_with_all_numbers_of_a_code(spark, bounded):
    texts = [(k, f"a change of +1 {k:03d} here") for k in range(1000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.row.doc_id: r.text for r in surrogates.replace_entities(docs, "key").collect()}
    assert len(set(found.values())) == 1000
    assert all(found[k] != t and found[k].startswith("a change of +1 ") for k, t in texts)
