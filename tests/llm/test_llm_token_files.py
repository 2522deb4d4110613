"""Token files: encoding against whole texts, the file's lookups against its ids, the corpus against a plain loop."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from dimflow.llm import token_files
from dimflow.llm.wavelet import BLOCK, WaveletFile, encode

P = pytest.importorskip("public_tokenizers")
VOCABULARY = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def whole(bpe, text):
    return bpe.encode(text or "", add_special_tokens=False).ids


def test_units_give_the_ids_of_whole_texts(bpe):
    rng = random.Random(1)
    parts = ["a", "The", "word's", ",", ".", "\n", " ", "  ", "\t", " ", "　", "\x85", "\x1c", "<|endoftext|>", "​", "12", "é", "漢字", "'s", "!?", "\r\n", "\x0b", "😀", "﻿", "᠎"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(30))) for _ in range(2000)]
    texts += ["", " ", "  ", "\n", " a", "a ", "x" * 5000, "word " * 5000]
    encoder = token_files.Encoder(VOCABULARY)
    for _ in range(2):  # the second time all units are known
        ids, at = encoder.encode(pa.array(texts, pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [whole(bpe, x) for x in texts]


def test_forgotten_units_are_learnt_again(bpe, monkeypatch):
    monkeypatch.setattr(token_files, "UNITS", 40)
    rng = random.Random(2)
    encoder = token_files.Encoder(VOCABULARY)
    for _ in range(30):
        texts = [" ".join("w%d" % rng.randrange(60) for _ in range(12)) for _ in range(3)]
        ids, at = encoder.encode(pa.array(texts, pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [whole(bpe, x) for x in texts]


class Noted:
    """A tokenizer that notes how many characters it is given at once."""

    def __init__(self, inner, most):
        self.inner, self.most = inner, most

    def encode_batch_fast(self, texts, **how):
        self.most.append(sum(map(len, texts)))
        return self.inner.encode_batch_fast(texts, **how)


def test_new_units_are_given_to_the_library_few_at_a_time(bpe):
    """Its memory is many times what it is given."""
    texts = [" ".join(f"{kind}{k:07d}" for k in range(30_000)) for kind in ("w", "\u6f22")]  # of both ways to learn a unit
    encoder, most = token_files.Encoder(VOCABULARY), []
    encoder.parts, encoder.bpe = Noted(encoder.parts, most), Noted(encoder.bpe, most)
    ids, at = encoder.encode(pa.array(texts, pa.large_string()))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [whole(bpe, x) for x in texts]
    assert sum(most) > 500_000 and max(most) < 100_000


@pytest.mark.parametrize("ids", [[], [7], [5] * 300, list(range(200)) * 3, [70000, 3, 70000, 9], None])
def test_file_lookups(tmp_path, ids):
    rng = np.random.default_rng(3)
    ids = rng.zipf(1.3, 2 * BLOCK + 77).clip(0, 50_256) if ids is None else ids
    ids = np.array(ids, np.uint32)
    path = tmp_path / "a.wavelet"
    path.write_bytes(encode(ids, pa.array(["x", None]), np.array([0, len(ids)])))
    file = WaveletFile(str(path))
    assert file.n == len(ids) and (file.ids() == ids).all()
    owners, at = file.documents()
    assert owners.to_pylist() == ["x", None] and at.tolist() == [0, len(ids), len(ids)]
    for i in rng.integers(0, len(ids), 40) if len(ids) else []:
        assert file.access(int(i)) == ids[i]
        places = np.flatnonzero(ids == ids[i])
        a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert file.count(int(ids[i])) == len(places)
        assert file.count(int(ids[i]), a, b) == ((places >= a) & (places < b)).sum()
        k = int(rng.integers(0, len(places)))
        assert file.occurrence(int(ids[i]), k) == places[k]
        assert file.occurrence(int(ids[i]), len(places)) is None
    assert file.count(60_001) == 0 and file.occurrence(60_001, 0) is None
    with pytest.raises(IndexError):
        file.access(len(ids))


def expected(bpe, rows):
    out, start = [], 0
    for doc, text in rows:
        ids = np.array([*whole(bpe, text), 0], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_ids", [1, 50, 1 << 22])
def test_corpus(spark, bpe, shard_ids):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice(["river", "town", "été", "a,b", "x\ny"]) for _ in range(rng.randrange(40)))) for k in range(120)]
    rows += [(None, "no id"), (200, None), (201, ""), (202, "long " * 20_000), (203, "<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.selectExpr("doc_id", "text", "'x' as start", "1 as part", "2 as path", "3 as h")
    files = token_files.write_token_files(docs, VOCABULARY, shard_ids=shard_ids)
    got = sorted(map(tuple, token_files.read_documents(files).collect()), key=lambda r: r[1])
    want = expected(bpe, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert got == want
    ids = [x for _, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for x in [*whole(bpe, text), 0]]
    found = {r["token"]: (r["n"], r["first"]) for r in token_files.count_ids(files, [0, ids[0], 50_000]).collect()}
    assert found == {x: (ids.count(x), ids.index(x) if x in ids else None) for x in {0, ids[0], 50_000}}


def test_repeated_ids_and_empty_table(spark, bpe):
    rows = [(1, "same"), (1, "same"), (1, "other text"), (None, None), (None, "b")]
    files = token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY)
    got = token_files.read_documents(files).collect()
    assert sorted((r[0] or 0, r[2], r[3]) for r in got) == sorted((r[0] or 0, r[2], r[3]) for r in expected(bpe, rows))
    assert sorted(r["start"] for r in got)[0] == 0 and len({r["start"] for r in got}) == len(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    files = token_files.write_token_files(empty, VOCABULARY)
    assert files.count() == 0 and token_files.read_documents(files).count() == 0


def test_text_ids(spark, bpe):
    rows = [("b", "two words"), ("a", "one")]
    files = token_files.write_token_files(spark.createDataFrame(rows, "doc_id string, text string"), VOCABULARY)
    got = sorted(map(tuple, token_files.read_documents(files, "string").collect()))
    assert got == expected(bpe, sorted(rows))
