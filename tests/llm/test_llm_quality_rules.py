"""The quality verdict against a plain version, and on documents that no trusted one resembles."""

import math
import random
import re
import time
from collections import Counter

import pytest

from dimflow.llm import quality_rules as Q

xxhash = pytest.importorskip("xxhash")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def h64(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def features(text, buckets):
    def signed(x):
        return x - (1 << 64) if x >= 1 << 63 else x

    words = [h64(w.encode()) for w in WORD.findall(text or "")]
    as_long = lambda x: x.to_bytes(8, "little")
    pairs = [h64(as_long(b), h64(as_long(a))) for a, b in zip(words, words[1:])]
    return [signed(x) % buckets for x in words + pairs]


def half(doc):
    out = h64(b"half", h64(doc.to_bytes(8, "little", signed=True)))
    return (out - (1 << 64) if out >= 1 << 63 else out) % 2


def plain_scores(docs, good):
    """Scores and threshold over (doc_id, text), with ids of the trusted."""
    buckets = Q.BUCKETS
    grams = {k: features(t, buckets) for k, (_, t) in enumerate(docs)}
    raw, target = Counter(), Counter()
    for k, (doc, _) in enumerate(docs):
        raw.update(grams[k])
        if doc in good and half(doc) == 0:
            target.update(grams[k])
    n_raw, n_target = sum(raw.values()), sum(target.values())
    weight = {}
    ratio = lambda t, n: math.log((t + Q.PRIOR) / (n * n_target / n_raw + Q.PRIOR)) if n_target else 0.0
    rare = {b for b, n in raw.items() if not target[b] and abs(ratio(0, n)) < Q.NOISE}
    together = ratio(sum(n == 1 for n in target.values()), sum(raw[b] for b in rare))
    for b, n in raw.items():
        w = together if b in rare else ratio(target[b], n)
        weight[b] = round(w * Q.UNIT) if abs(w) >= Q.NOISE else 0
    return {k: sum(weight[b] for b in g) / max(1, len(g)) / Q.UNIT for k, g in grams.items()}


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(13)
    own = {lang: ["%s%d" % (lang, k) for k in range(400)] for lang in ("en", "de", "fr")}
    bad = ["scum%d" % k for k in range(5)]

    def text(lang, n, spoilt=0):
        words = [rng.choice(own[lang]) for _ in range(n)]
        for _ in range(spoilt):
            words[rng.randrange(n)] = rng.choice(bad)
        return " ".join(words)

    docs, labels, clean, spoilt = [], [], set(), set()
    for k in range(900):
        lang, is_bad = rng.choice(["en", "en", "de", "fr"]), k % 9 == 0
        docs.append((k, text(lang, rng.randrange(25, 120), 12 if is_bad else 0)))
        (spoilt if is_bad else clean).add(k)
        if rng.random() < 0.4:
            labels.append((k, 1, int(is_bad)))
    docs += [(5000 + k, text("en", 60) + " rare%d words%d here%d" % (k, k, k)) for k in range(20)]  # of no trusted one
    clean |= {5000 + k for k in range(20)}
    docs += [(None, text("en", 40)), (9000, None), (9001, ""), (3, docs[3][1])]
    return (
        docs,
        labels,
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(labels + [(9000, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"),
        clean,
        spoilt,
    )


def test_scores_equal_a_plain_version(spark, corpus):
    docs, labels, df, label_df, clean, spoilt = corpus
    fitted = Q.fit(df, label_df)
    got = Q.judge(df, fitted).select("row.doc_id", "row.text", "score", "kept", "base_failed").collect()
    good = {d for d, q, t in labels if q == 1 and t == 0}
    want = plain_scores(docs, good)
    assert sorted((repr((r["doc_id"], r["text"])), round(r["score"], 9)) for r in got) == sorted((repr(docs[k]), round(s, 9)) for k, s in want.items())
    held = sorted(want[k] for k, (d, t) in enumerate(docs) if d in good and half(d) == 1 and t)
    at = Q.HELD_OUT_LOSS * (len(held) - 1)
    low = held[int(at)] + (held[int(at) + 1] - held[int(at)]) * (at - int(at))
    assert fitted.threshold == pytest.approx(min(Q.HIGHEST, low))
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= fitted.threshold) for r in got)


def test_unlabelled_clean_documents_stay_and_spoilt_ones_go(corpus):
    docs, labels, df, label_df, clean, spoilt = corpus
    kept = {r["doc_id"] for r in Q.keep_good(df, label_df).collect()}
    labelled = {d for d, *_ in labels}
    assert len(kept & (clean - labelled)) >= 0.95 * len(clean - labelled)
    assert {5000 + k for k in range(20)} <= kept
    assert len(kept & spoilt) <= 0.1 * len(spoilt)


def test_filters_on_the_result_are_as_fast_as_a_write(spark, corpus):
    df, label_df = corpus[2], corpus[3]
    judged = Q.judge(df, Q.fit(df, label_df))
    began = time.time()
    judged.write.format("noop").mode("overwrite").save()
    took = time.time() - began
    for condition in ("kept", "not base_failed"):
        began = time.time()
        judged.filter(condition).count()
        assert time.time() - began < 5 * took + 5


def test_without_labels_and_without_rows(spark, corpus):
    df, label_df = corpus[2], corpus[3]
    assert Q.judge(df, Q.fit(df, label_df.limit(0))).filter("score <> 0").count() == 0
    assert Q.keep_good(df.limit(0), label_df).count() == 0
