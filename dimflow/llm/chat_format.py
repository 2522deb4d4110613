"""Conversations as token ids with a loss mask, assembled segment by segment.

A turn is <turn> role <text> content <end>; the four marks are ids beyond the
tokenizer's vocabulary, spliced between segments that are encoded separately, so no
text can produce them and no token spans a border. What a text says of the marks'
written forms is escaped in the text: each ESCAPE is doubled, and a control string
gets an ESCAPE after its first character; both are undone on reading back.

Every turn is encoded by itself. Its place in the conversation comes from prefix sums
of the lengths, and the loss mask from prefix sums of +1 and -1 at the ends of the
segments that count: the contents of assistant turns. No row holds a conversation.

Defined results: rows are ordered by turn (null first), then role, then text; equal
rows stay, as turns of their own. A null role or text is empty. Rows without a conv_id
form one conversation without an id. An empty table gives no rows. Other columns
aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranks of a byte-level BPE vocabulary in the tiktoken format; executors must reach the file.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Split pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Written forms of the marks; each begins with '<'.
TURN, TEXT, END, CLOSE = "<|turn|>", "<|text|>", "<|end|>", "<|close|>"
MARKS = [TURN, TEXT, END, CLOSE]
#: Strings with a meaning in this or other common templates, escaped in texts.
CONTROL = [*MARKS, "<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
ESCAPE = "\\"

_ESCAPED = re.compile("|".join(re.escape(x) for x in [ESCAPE, *sorted(CONTROL, key=len, reverse=True)]))
_UNESCAPED = re.compile(re.escape(ESCAPE) + "(.?)", re.DOTALL)

ROLE_WITH_LOSS = "assistant"
#: Characters that are encoded at once: a text is cut before a space, where no token spans the cut.
CHUNK_CHARS = 1 << 20
TOKENS = "conv_id {kind}, turn {turn}, sort string, ids array<int>, edges array<int>, formatted_chars long"


def escape(text: str) -> str:
    def one(m: re.Match) -> str:
        found = m[0]
        return ESCAPE * 2 if found == ESCAPE else found[0] + ESCAPE + found[1:]

    return _ESCAPED.sub(one, text)


def unescape(text: str) -> str:
    """Inverse of `escape`: a doubled ESCAPE is one, a single one is dropped."""
    return _UNESCAPED.sub(lambda m: ESCAPE if m[1] == ESCAPE else m[1], text)


class Encoder:
    def __init__(self, vocabulary: str):
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        first = max(ranks.values()) + 1
        self.marks = {mark: first + k for k, mark in enumerate(MARKS)}
        self.first = first

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        while len(text) > CHUNK_CHARS:
            cut = text.rfind(" ", 1, CHUNK_CHARS)
            cut = cut if cut > 0 else CHUNK_CHARS
            ids += self.bpe.encode_ordinary(text[:cut])
            text = text[cut:]
        return ids + self.bpe.encode_ordinary(text)

    def turn(self, role: str, text: str) -> tuple[list[int], list[int]]:
        """Ids of a turn, and where the loss begins and ends in it (empty if it doesn't)."""
        head = [self.marks[TURN], *self.encode(escape(role)), self.marks[TEXT]]
        body = self.encode(escape(text))
        edges = [len(head), len(head) + len(body)] if role == ROLE_WITH_LOSS else []
        return [*head, *body, self.marks[END]], edges


def _encode(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            ids, edges, chars, sort = [], [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                role, text = role or "", text or ""
                out = encoder.turn(role, text)
                ids.append(out[0])
                edges.append(out[1])
                chars.append(len(TURN) + len(escape(role)) + len(TEXT) + len(escape(text)) + len(END))
                sort.append(hashlib.sha256(f"{role}\n{text}".encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    pa.array(sort, pa.string()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(edges, pa.list_(pa.int32())),
                    pa.array(chars, pa.int64()),
                ],
                names=["conv_id", "turn", "sort", "ids", "edges", "formatted_chars"],
            )

    return run


def encode_turns(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Token ids of every turn, without a shuffle: `ids`, and `edges`, where its loss begins and ends."""
    rows = turns.select("conv_id", "turn", "role", "text")
    schema = TOKENS.format(kind=rows.schema["conv_id"].dataType.simpleString(), turn=rows.schema["turn"].dataType.simpleString())
    return rows.mapInArrow(_encode(vocabulary), schema)


def format_conversations(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row a turn: `ids`, its `mask` (1 where the loss counts) and `start`, its first place in the conversation.

    The mask is the running sum of +1 and -1 at the edges.
    """
    rows = encode_turns(turns, vocabulary)
    order = Window.partitionBy("conv_id").orderBy("turn", "sort").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.size("ids")).over(order), F.lit(0)).cast("bigint")
    return rows.withColumn("start", start).mapInArrow(_masked, f"{rows.schema.simpleString()[7:-1].replace(':', ' ')}, start long, mask array<tinyint>")


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks = [loss_mask(len(ids), edges) for ids, edges in zip(batch.column("ids"), batch.column("edges").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(masks, pa.list_(pa.int8()))], names=[*batch.schema.names, "mask"])


def loss_mask(n: int, edges: list[int]) -> np.ndarray:
    steps = np.zeros(n + 1, np.int8)
    for k, at in enumerate(edges):
        steps[at] += 1 if k % 2 == 0 else -1
    return np.cumsum(steps[:n], dtype=np.int8)


class Reader:
    """Reads one conversation back from its tokens, a turn at a time, and digests it."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, mask: np.ndarray, formatted_chars: int) -> None:
        def text(part: np.ndarray) -> str:
            return unescape(self.encoder.bpe.decode_bytes(part.tolist()).decode())

        marks = np.flatnonzero(ids >= self.encoder.first)
        head, middle, end = marks.tolist()
        role, content = text(ids[head + 1 : middle]), text(ids[middle + 1 : end])
        self.turns.update(f"{role}\n{content}\n".encode())
        counted = text(ids[mask == 1])
        self.loss.update(counted.encode())
        self.loss_chars += len(counted)
        self.n_turns += 1
        self.formatted_chars += formatted_chars

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(vocabulary: str):
    """Digests of the conversations of a partition sorted by conv_id and turn; one turn is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, reader, now, done = Encoder(vocabulary), None, None, []

        def out(kind: pa.DataType) -> pa.RecordBatch:
            cols = [pa.array([x[0] for x in done], kind)]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            cols += [pa.array([x[1][k] for x in done], t) for k, t in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(cols, names=["conv_id", *(x.split()[0] for x in DIGESTS.split(", "))])

        kind = None
        for batch in batches:
            kind = batch.column("conv_id").type
            convs = batch.column("conv_id").to_pylist()
            ids, masks = batch.column("ids"), batch.column("mask")
            chars = batch.column("formatted_chars").to_pylist()
            for k, conv in enumerate(convs):
                if reader is None or conv != now:
                    if reader is not None:
                        done.append((now, reader.row()))
                    reader, now = Reader(encoder), conv
                reader.add(ids[k].values.to_numpy(), masks[k].values.to_numpy(), chars[k])
            if done:
                yield out(kind)
                done.clear()
        if reader is not None:
            done.append((now, reader.row()))
            yield out(kind)

    return run


def digests(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row a conversation, read back from the formatted turns.

    A digest runs over the whole conversation, so one task reads it, in order, a turn at a time.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "sort")
    rows = rows.select("conv_id", "ids", "mask", "formatted_chars")
    return rows.mapInArrow(_read_back(vocabulary), f"conv_id {kind}, {DIGESTS}")
