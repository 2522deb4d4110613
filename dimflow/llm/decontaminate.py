"""Benchmark decontamination: pigeonhole edit matching of test items in whole documents.

An item of length m may differ from a passage by k = floor(m * budget) edits. It is
split into k + 1 pieces; a passage within k edits holds one of them unchanged. One
pass over each text finds exact piece hits (Aho-Corasick); around each hit, Myers'
bit-parallel distance verifies the whole item against the text.

The test items are the query side: they are handled in blocks of at most BLOCK_CHARS
characters, each of which is sent to the tasks; every block passes over all documents,
so a benchmark of any size works within bounded memory.

Both sides are lower-cased, and each run of white space counts as one space.

Defined results: a null or empty text matches nothing; items that are null, empty or
shorter than MIN_CHARS are left out, since anything holds them. Equal items each match.
Repeated rows match alike. Columns other than id and text aren't touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed as a share of the item's length.
BUDGET = 0.08
#: Items below this length don't identify a passage.
MIN_CHARS = 40
#: Characters of test items in one block.
BLOCK_CHARS = 4_000_000

MATCHES = "item_id long, distance long, start long, stop long"
_SPACE = re.compile(r"\s+")


def normal(text: str | None) -> str:
    return _SPACE.sub(" ", text or "").strip().lower()


def pieces(item: str, budget: float = BUDGET) -> list[tuple[int, str]]:
    """Offsets and texts of the error-budget-plus-one pieces of an item."""
    parts = int(len(item) * budget) + 1
    cuts = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_end(item: str, masks: dict[str, int], window: str) -> tuple[int, int]:
    """Smallest edit distance of the item to any part of the window, and the first end of such a part.

    One bit for each character of the item; one step for each of the window.
    """
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for at, c in enumerate(window, 1):
        eq = masks.get(c, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        plus = down | (~(diag | up) & full)
        minus = up & diag
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best, end = score, at
        plus = (plus << 1) & full  # a match may start anywhere
        minus = (minus << 1) & full
        up = minus | (~(diag | plus) & full)
        down = plus & diag
    return best, end


def _masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], budget: float):
        import ahocorasick

        self.items = [(i, t, int(len(t) * budget), _masks(t)) for i, t in items]
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text, _, _) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                where.setdefault(piece, []).append((k, offset))
        self.pieces = ahocorasick.Automaton()
        for piece, at in where.items():
            self.pieces.add_word(piece, (len(piece), at))
        self.pieces.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """Best match of each item: item_id, distance, start (the earliest it may have) and stop in the normal text."""
        windows: dict[int, list[list[int]]] = {}
        for last, (size, at) in self.pieces.iter(text):
            for k, offset in at:
                _, item, most, _ = self.items[k]
                start = last + 1 - size - offset
                low, high = max(0, start - most), min(len(text), start + len(item) + most)
                spans = windows.setdefault(k, [])
                # Hits come in the order of their ends; those of one diagonal share a window.
                if spans and low <= spans[-1][1] and high - spans[-1][0] <= 2 * (len(item) + 2 * most):
                    spans[-1] = [min(low, spans[-1][0]), max(high, spans[-1][1])]
                else:
                    spans.append([low, high])
        found = []
        for k, spans in windows.items():
            item_id, item, most, masks = self.items[k]
            best = None
            for low, high in spans:
                distance, end = best_end(item, masks, text[low:high])
                if distance <= most and (best is None or distance < best[1]):
                    stop = low + end
                    best = (item_id, distance, max(0, stop - len(item) - most), stop)
            if best:
                found.append(best)
        return sorted(found)


def _search(items: list[tuple[int, str]], budget: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, budget)
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column("text")):
                for match in matcher.find(normal(text.as_py())):
                    rows.append(row)
                    found.append(match)
            picked = batch.column(0).take(pa.array(rows, pa.int64()))
            cols = [pa.array([m[k] for m in found], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([picked, *cols], names=names)

    return run


def blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The normal items that count, a bounded list at a time."""
    block: list[tuple[int, str]] = []
    size = 0
    for item_id, text in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        text = normal(text)
        if item_id is None or len(text) < MIN_CHARS:
            continue
        block.append((item_id, text))
        size += len(text)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def matches(docs: DataFrame, items: DataFrame, budget: float = BUDGET, key: str = "doc_id") -> DataFrame:
    """One row per row of `docs` and item found in it: the key, `item_id`, `distance`, `start`, `stop`."""
    rows = docs.select(F.col(key).alias("key"), "text")
    schema = f"key {rows.schema['key'].dataType.simpleString()}, {MATCHES}"
    found = None
    for block in blocks(items):
        part = rows.mapInArrow(_search(block, budget, ["key", *(x.split()[0] for x in MATCHES.split(", "))]), schema)
        found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.withColumnRenamed("key", key)


def _clean(items: list[tuple[int, str]], budget: float, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, budget)
        for batch in batches:
            keep = [not matcher.find(normal(t.as_py())) for t in batch.column(text)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def without_leaks(docs: DataFrame, items: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The documents in which no item is found, with their own columns; one pass for each block, no shuffle."""
    at = docs.columns.index("text")
    for block in blocks(items):
        docs = docs.mapInArrow(_clean(block, budget, at), docs.schema)
    return docs
