"""Token counts of a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton of the vocabulary enumerates every piece that ends at each
character; dynamic programming carries the best score up to each character and the
number of pieces that gives it. Pieces that start earlier are tried first and only a
strictly better score replaces, which is the tokenizer's rule for ties. A character
that no piece covers alone costs the lowest score minus ten and counts as its bytes
where all byte pieces exist, else as one unknown; neighbouring unknowns are one.

A space becomes U+2581 and one is put in front. Only pieces in which that mark comes
before all else are used, so a word with the marks before it is solved by itself; a
task keeps the counts of the words it met last. A text of any length is counted word
by word.

Defined results: null and empty texts have no tokens. Repeated rows count alike. Null
ids pass through. Other columns aren't read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: A sentencepiece model; its pieces in their order are the vocabulary. Executors must reach the file.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words of which a task keeps the counts.
KEPT_WORDS = 500_000
_WORD = re.compile(f"{MARK}+[^{MARK}]*")


def vocabulary(path: str = VOCABULARY) -> tuple[list[tuple[str, float]], bool]:
    """Pieces with a score, and whether every byte has a piece.

    The file orders its pieces by merges and has no probabilities; a piece of rank r
    scores -log(r + 1). Control and byte pieces match no text.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, n_bytes = [], 0
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            n_bytes += 1
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces.append((model.id_to_piece(i), -math.log(len(pieces) + 2)))
    return pieces, n_bytes == 256


class Counter:
    """Counts of words under one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool, kept: int = KEPT_WORDS):
        import ahocorasick

        used = [(p, s) for p, s in pieces if MARK not in p.lstrip(MARK)]
        self.tree = ahocorasick.Automaton()
        for piece, score in used:
            self.tree.add_word(piece, (len(piece), score))
        self.tree.make_automaton()
        self.single = {p for p, _ in used if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_pieces, self.kept, self.seen = byte_pieces, kept, {}

    def word(self, text: str) -> int:
        n = len(text)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        # The automaton reports at each end the longest piece first, so starts ascend.
        for last, (size, score) in self.tree.iter(text):
            ends[last + 1].append((last + 1 - size, score))
        best, count, open_ = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            c = text[end - 1]
            found = ends[end]
            if c not in self.single:
                found = [*found, (end - 1, self.unknown)]
            top = None
            for start, score in found:
                total = best[start] + score
                if top is None or total > top:
                    top, pick = total, start
            best[end] = top
            unknown = pick == end - 1 and c not in self.single
            if not unknown:
                count[end] = count[pick] + 1
            elif self.byte_pieces:
                count[end] = count[pick] + len(c.encode())
            else:
                count[end] = count[pick] + (not open_[pick])
            open_[end] = unknown
        return count[n]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        total, seen = 0, self.seen
        for m in _WORD.finditer(MARK + text.replace(" ", MARK)):
            word = m[0]
            n = seen.get(word)
            if n is None:
                n = self.word(word)
                if len(seen) >= self.kept:
                    seen.clear()
                if len(word) < 100:
                    seen[word] = n
            total += n
        return total


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*vocabulary(path))
        for batch in batches:
            counts = [counter.text(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """`doc_id` and `n_tokens` of every row; no shuffle."""
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(_count(path), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long")
