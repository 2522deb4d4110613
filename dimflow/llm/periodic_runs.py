"""Periodic runs of words: stretches that repeat themselves at once, and texts without the repeats.

A run is a stretch of words with smallest period q, at least `min_exponent` periods and
`min_length` words long, that no neighbouring word extends keeping the period. Squares
are caught online (see `squares`) while words are appended; the squares of a trail merge
into its run. The collapsed text keeps of every run its first period: a word goes if it
lies in any run after that run's first q words.

Each text is worked on by itself, in the task that reads it, without a shuffle. Texts of
about equal length are caught in one sequence, with words numbered anew for each text so
that no run crosses a border; a long text is appended in pieces. Memory is some numbers a
word of the longest text and its distinct words.

Defined results: words are runs of characters other than \\x20 and \\x09-\\x0D, compared
byte by byte. A null or empty text has no runs and collapses to an empty text. Every row
is judged by itself, so repeated rows give repeated results. An empty table gives no rows.
The columns to keep are passed on in a struct of their own, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.squares import SquareCatcher

MIN_EXPONENT = 4
MIN_LENGTH = 6
#: Bytes of text that are caught in one sequence (a longer text is one of its own).
SLICE_BYTES = 1 << 20
#: Words that are appended at once.
PIECE_WORDS = 1 << 16
#: Bytes of a text that are split into words at once.
PIECE_BYTES = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class _Numbers(dict):
    """Numbers words in the order in which they come, from `first` on."""

    def __init__(self, first: int):
        super().__init__()
        self.first = first

    def __missing__(self, word: bytes) -> int:
        self[word] = number = self.first + len(self)
        return number


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; cuts are made at white space."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        cut = at + PIECE_BYTES
        while cut < len(text) and text[cut] not in SPACES:
            cut += 1
        yield text[at:cut].split()
        at = cut
    yield (text[at:] if at else text).split()


def runs_of(texts: list[bytes], min_exponent: int, min_length: int) -> list[list[tuple[int, int, int]]]:
    """Start, length and period of the runs of each text, by start, then period."""
    codes, first = [], 0
    for text in texts:
        numbers = _Numbers(first)
        parts = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in _pieces(text)]
        codes.append(np.concatenate(parts))
        first += len(numbers)
    ends = np.cumsum([len(x) for x in codes])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    catcher = SquareCatcher(max(map(len, codes), default=0) // min_exponent)
    words = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    for at in range(0, len(words), PIECE_WORDS):
        catcher.append(words[at : at + PIECE_WORDS])
    for start, end, period in catcher.runs():
        if end - start >= max(min_length, min_exponent * period):
            k = int(np.searchsorted(ends, start, "right"))
            found[k].append((start - int(ends[k] - len(codes[k])), end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside the repeats of the runs, joined by one space."""
    if not runs:
        return b" ".join(b" ".join(words) for words in _pieces(text) if words)
    gone = np.zeros(max(a + n for a, n, _ in runs), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    parts, at = [], 0
    for words in _pieces(text):
        drop = gone[at : at + len(words)].tolist()
        kept = [w for w, d in zip(words, drop) if not d] + words[len(drop) :]
        at += len(words)
        if kept:
            parts.append(b" ".join(kept))
    return b" ".join(parts)


def _slices(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in slices of about SLICE_BYTES, by length, so that a slice looks for periods its texts can have."""
    order = np.argsort(sizes, kind="stable")
    ends, first = np.cumsum(sizes[order]), 0
    while first < len(order):
        done = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield order[first:last]
        first = last


def _find(min_exponent: int, min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1])
            runs: list = [None] * len(texts)
            kept: list = [None] * len(texts)
            for rows in _slices(sizes):
                part = [texts[k].as_py() for k in rows.tolist()]
                for k, text, found in zip(rows.tolist(), part, runs_of(part, min_exponent, min_length)):
                    runs[k] = found
                    kept[k] = collapsed(text, found).decode()
            flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
            fields = [pa.array(flat[:, k]) for k in range(3)]
            ends = np.cumsum([0, *map(len, runs)])
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(RUNS.value_type)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), column, pa.array(kept, pa.string())], names=["row", "runs", "collapsed"])

    return run


def find_runs(
    df: DataFrame,
    text: str | Column = "text",
    keep: list[str] | None = None,
    min_exponent: int = MIN_EXPONENT,
    min_length: int = MIN_LENGTH,
) -> DataFrame:
    """Of every row the struct `row` of the columns to keep (all by default), its `runs` and its `collapsed` text."""
    text = F.col(text) if isinstance(text, str) else text
    rows = df.select(F.struct(*(df.columns if keep is None else keep)).alias("row"), text.cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(_find(min_exponent, min_length), schema)


def strongest(runs: Column) -> Column:
    """The run of the greatest exponent; of equals the one with the smallest start, then period. Null if there is none.

    Exponents are compared as fractions, without rounding.
    """

    def better(best: Column, run: Column) -> Column:
        ahead = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | ahead, run).otherwise(best)

    empty = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, empty, better)


def runs_text(runs: Column) -> Column:
    """`start,length,period` and a line feed for every run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
