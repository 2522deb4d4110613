"""Token ids of a corpus in binary shards, each a wavelet matrix in one file (see `wavelet`).

Documents are sorted by doc_id over range partitions; a task encodes its documents and
closes a file after the document that reaches SHARD_IDS ids, so its memory is bounded by
that and the longest document. The files go to the shared folder under names of their
own; the manifest, a table with a row a file, names those of the attempts that count, so
a lost executor's task is simply done again. The manifest has each file's offset within
its partition, and the partitions' totals (a row a partition) give the offset of all.

Texts are encoded by the tokenizers library. Its byte-level pattern always begins a token
at a space between two other characters that are no white space, so what lies between
such spaces is encoded apart, once a worker as long as the worker remembers it (UNITS
entries), and put together with numpy. The result equals that of whole texts.

Defined results: a null text counts as empty, and an empty text has the end id alone.
Rows are ordered by doc_id (null first), then by the hash of the text; rows with the same
doc_id stay, each for itself. An empty table gives no files and no rows. Special tokens
written in a text are encoded as the library does by default. Other columns aren't read.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.llm.wavelet import WaveletFile, encode, filesystem
from dimflow.session import scratch_path, stage_table

END_ID = 0
#: A shard ends after the document that reaches so many ids.
SHARD_IDS = 1 << 22
#: Units that a worker remembers the ids of, in some 40 bytes each.
UNITS = 1_500_000
#: Texts of about so many bytes are encoded at once.
SLICE_BYTES = 1 << 22
#: Units whose ids are put together at once.
PIECE = 1 << 15
#: New units that the library is given at once.
LEARNT = 1 << 12
#: White space in any of the definitions that the libraries use.
_WHITE = r"\s\v\x1c-\x1f\x{85}\x{180e}\x{feff}\p{Z}"
UNSAFE_SPACE = rf"[{_WHITE}] | [{_WHITE}]"
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Characters that all libraries put into the same class: letters, digits, and marks but the apostrophe.
_LETTER, _DIGIT, _MARK = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}", "0-9", r"!-&(-/:-@\[-`{-~"
SIMPLE = rf"^[{_LETTER}{_DIGIT}{_MARK}]+(?:\n[{_LETTER}{_DIGIT}{_MARK}]+)*$"
#: In a simple unit a token of the pattern ends where the class changes.
BETWEEN_LETTERS = rf"([{_MARK}]+|[{_DIGIT}]+|\n)"
CUT = "\x01"
#: How the vocabulary writes the bytes that are no printable characters, but for the CUT: by numbers from 256 on.
_HIDDEN = [b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0xAD or 0xAE <= b)]
WRITTEN = {b: chr(256 + k) for k, b in enumerate(_HIDDEN) if chr(b) != CUT}
#: The same as an array of UTF-16 units, by byte.
WRITING = np.array([ord(WRITTEN.get(b, chr(b))) for b in range(256)], "<u2")
SPACE = WRITTEN[0x20]
#: Tells the hashes of units without a space in front from the others.
BARE = 0x5DEECE66D



class Encoder:
    """Ids of texts under a byte-level BPE file of the tokenizers library.

    Known units are found by two 64-bit hashes, in arrays sorted by the first; a unit
    whose first hash belongs to another one is encoded anew each time.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.bpe = Tokenizer.from_file(vocabulary)
        size = self.bpe.get_vocab_size(with_added_tokens=True)
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.special = [x.content for x in self.bpe.get_added_tokens_decoder().values()]
        self.after_space = np.array([(self.bpe.id_to_token(k) or "").startswith(SPACE) for k in range(size)])
        # For units whose parts are known, in the vocabulary's writing, with a CUT between them.
        self.parts = Tokenizer.from_file(vocabulary)
        self.parts.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(CUT)
        self._forget()

    def _forget(self) -> None:
        self.first, self.second = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.slot = np.zeros(0, np.int32)
        self.flat, self.ends = np.zeros(0, self.kind), np.zeros(1, np.int64)
        self.seen = np.zeros(0, bool)

    def _learn(self, units: pa.Array, spaced: bool) -> None:
        """Add the ids of units to the end of the store; `spaced` ones have a space in front."""
        simple = pc.match_substring_regex(units, SIMPLE).to_numpy(zero_copy_only=False) & spaced
        for special in self.special:
            simple &= ~pc.match_substring(units, special).to_numpy(zero_copy_only=False)
        plain, alone = np.flatnonzero(simple), np.flatnonzero(~simple)
        lengths = np.zeros(len(units), np.int64)
        parts = []
        # Few at a time, since the library takes many bytes for each byte of a text.
        for a in range(0, len(plain), LEARNT):
            few = plain[a : a + LEARNT]
            cut = pc.replace_substring_regex(units.take(few), BETWEEN_LETTERS, f"{CUT}\\1{CUT}")
            said = " " + f"{CUT} ".join(_strings(pc.ascii_ltrim(cut, CUT)))
            # Each byte as the character that the vocabulary writes for it.
            written = WRITING[np.frombuffer(said.encode(), np.uint8)].tobytes().decode("utf-16-le")
            (got,) = self.parts.encode_batch_fast([written], add_special_tokens=False)
            parts.append(np.array(got.ids, self.kind))
            at = np.flatnonzero(self.after_space[parts[-1]])
            lengths[few] = np.diff(np.append(at, len(parts[-1])))
        for a in range(0, len(alone), LEARNT):
            few = alone[a : a + LEARNT]
            each = self.bpe.encode_batch_fast([" " * spaced + x for x in _strings(units.take(few))], add_special_tokens=False)
            each = [np.array(x.ids, self.kind) for x in each]
            lengths[few] = [len(x) for x in each]
            parts += each
        order = np.concatenate((plain, alone))
        ends = np.empty(len(units), np.int64)
        ends[order] = np.cumsum(lengths[order])
        flat = np.concatenate([np.zeros(0, self.kind), *parts])
        self.flat = np.concatenate((self.flat, flat[_ranges(ends - lengths, ends)]))
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(lengths)))
        self.seen = np.concatenate((self.seen, np.zeros(len(units), bool)))

    def _keep_common(self) -> None:
        """Forget the units met in one slice only; all, if that leaves too many."""
        kept = self.seen[self.slot]
        if kept.sum() > UNITS // 2:
            return self._forget()
        slots = self.slot[kept].astype(np.int64)
        starts, ends = self.ends[slots], self.ends[slots + 1]
        self.flat, self.ends = self.flat[_ranges(starts, ends)], np.concatenate(([0], np.cumsum(ends - starts)))
        self.first, self.second = self.first[kept], self.second[kept]
        self.slot, self.seen = np.arange(len(slots), dtype=np.int32), np.ones(len(slots), bool)

    def _find(self, units: pa.Array, spaced: bool) -> np.ndarray:
        """Slots of units, all different."""
        names, salt = _strings(units), "s" if spaced else "b"
        first = np.fromiter(map(hash, names), np.int64, len(units)) ^ (0 if spaced else BARE)
        second = np.fromiter([hash(x + salt) for x in names], np.int64, len(units))
        order = np.argsort(first)  # a sorted search stays in the caches
        at = np.empty(len(units), np.int64)
        at[order] = np.searchsorted(self.first, first[order])
        inside = at < len(self.first)
        there = np.zeros(len(units), bool)
        there[inside] = self.first[at[inside]] == first[inside]
        known = there.copy()
        known[there] = self.second[at[there]] == second[there]
        slots = np.empty(len(units), np.int64)
        slots[known] = self.slot[at[known]]
        self.seen[slots[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            slots[new] = np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(new))
            self._learn(units.take(new), spaced)
            new = np.flatnonzero(~there)  # those of another unit's hash are not remembered
            new = new[np.argsort(first[new], kind="stable")]
            new = new[np.append(True, first[new][1:] != first[new][:-1])] if len(new) else new
            where = np.searchsorted(self.first, first[new])
            self.first = np.insert(self.first, where, first[new])
            self.second = np.insert(self.second, where, second[new])
            self.slot = np.insert(self.slot, where, slots[new])
        return slots

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets of each; no null."""
        rows = pc.split_pattern(texts, " ")
        unsafe = pc.indices_nonzero(pc.match_substring_regex(texts, UNSAFE_SPACE)).to_pylist()
        if unsafe:
            lists = rows.to_pylist()
            for k in unsafe:
                lists[k] = SAFE_SPACE.split(texts[k].as_py())
            rows = pa.array(lists, pa.list_(texts.type))
        at = rows.offsets.to_numpy().astype(np.int64)
        words = rows.flatten().dictionary_encode()
        at, index, names = at - at[0], words.indices.to_numpy(), words.dictionary
        # The first unit of a text has no space before it.
        heads, head_of = np.unique(index[at[:-1]], return_inverse=True)
        inner = np.ones(len(index), bool)
        inner[at[:-1]] = False
        is_tail = np.zeros(len(names), bool)
        is_tail[index[inner]] = True
        tails = np.flatnonzero(is_tail)
        if len(self.ends) + len(heads) + len(tails) > UNITS:
            self._keep_common()
        slot_of = np.zeros(len(names), np.int64)
        slot_of[tails] = self._find(names.take(tails), True)
        # The ids of this slice's units, side by side: tails by their numbers, then heads.
        units = np.concatenate((slot_of, self._find(names.take(heads), False)))
        index = index.astype(np.int64)
        index[at[:-1]] = len(names) + head_of
        starts = self.ends[units]
        lengths = np.where(np.append(is_tail, np.ones(len(heads), bool)), self.ends[units + 1] - starts, 0)
        local = self.flat[_ranges(starts, starts + lengths)]
        ends = np.cumsum(lengths)
        total = np.concatenate(([0], np.cumsum(lengths[index])))
        ids = np.empty(int(total[-1]), self.kind)
        for a in range(0, len(index), PIECE):  # a piece's arrays stay in the caches
            own = index[a : a + PIECE]
            ids[total[a] : total[a + len(own)]] = local[_ranges(ends[own] - lengths[own], ends[own])]
        return ids, total[at]


def _strings(texts: pa.Array) -> list[str]:
    """Much faster than ``to_pylist``."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one range after the other."""
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    kind = np.int32 if len(ends) and max(int(ends.max()), int(lengths.sum())) < 1 << 31 else np.int64
    out = np.repeat((starts - before).astype(kind), lengths)
    out += np.arange(len(out), dtype=kind)
    return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    """A worker's encoder stays from task to task."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        done = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield first, last
        first = last


MANIFEST = "part int, number int, path string, n_docs long, n_ids long, before long"


def _write(folder: str, vocabulary: str, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(vocabulary), TaskContext.get().partitionId()
        owners, ids, lengths, held, number, before = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal owners, ids, lengths, held, number, before
            path = f"{folder}/{part:06d}-{number:06d}-{uuid.uuid4().hex[:8]}.wavelet"
            system, at = filesystem(path)
            sizes = np.concatenate(lengths)
            data = encode(np.concatenate(ids), pa.concat_arrays(owners), np.cumsum(sizes) - sizes)
            with system.open_output_stream(at) as out:
                out.write(data)
            row = [part, number, path, len(sizes), held, before]
            number, before = number + 1, before + held
            owners, ids, lengths, held = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["part", "number", "path", "n_docs", "n_ids", "before"]).cast(
                pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("before", pa.int64())])
            )

        for batch in batches:
            texts = batch.column("text")
            for a, b in _slices(texts):
                got, at = encoder.encode(texts.slice(a, b - a).cast(pa.large_string()).fill_null(""))
                pa.default_memory_pool().release_unused()
                # The end id follows each document.
                whole = np.insert(got, at[1:], END_ID)
                sizes = np.diff(at) + 1
                ends, done = np.cumsum(sizes), 0
                names = batch.column("doc_id").slice(a, b - a)
                while done < len(sizes):
                    start = int(ends[done - 1]) if done else 0
                    upto = min(len(sizes), int(np.searchsorted(ends, start + shard_ids - held)) + 1)
                    owners.append(names.slice(done, upto - done))
                    ids.append(whole[start : ends[upto - 1]])
                    lengths.append(sizes[done:upto])
                    held += int(ends[upto - 1]) - start
                    done = upto
                    if held >= shard_ids:
                        yield close()
        if held:
            yield close()

    return run


def write_token_files(docs: DataFrame, vocabulary: str, folder: str | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the corpus' token files; the stored manifest, with `start`, the ids before each file.

    `folder` must be one that executors and readers reach; by default it is made under
    spark.checkpoint.dir. `vocabulary` must be readable on executors.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    system, at = filesystem(folder)
    system.create_dir(at, recursive=True)
    rows = docs.select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")
    files = stage_table(rows.mapInArrow(_write(folder, vocabulary, shard_ids), MANIFEST), "manifest")
    # One row a partition, whatever the size of the corpus.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("of_parts"))
    return files.join(parts, "part").select(*files.columns, (F.col("of_parts") + F.col("before")).alias("start"))


def _read(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                file = WaveletFile(path)
                owners, at = file.documents()
                ids = file.ids().astype("<u4", copy=False)
                file.close()
                data = memoryview(ids).cast("B")
                crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                cols = [owners, pa.array(start + at[:-1]), pa.array(np.diff(at)), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_documents(files: DataFrame, doc_id: str = "long") -> DataFrame:
    """Every document as the files have it: its first place in the corpus, its length and the checksum of its ids."""
    # A number of its own, since Spark would put so few bytes into one task.
    rows = files.select("path", "start").repartition(max(1, files.count()), "path")
    return rows.mapInArrow(_read(doc_id), f"doc_id {doc_id}, start long, n_tokens long, ids_crc32 long")


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[int, int, int | None]] = []
        for path, start, tokens in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "tokens"))):
            file = WaveletFile(path)
            for token in tokens:
                first = file.occurrence(token, 0)
                out.append((token, file.count(token), None if first is None else start + first))
            file.close()
        cols = [pa.array([x[k] for x in out], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays(cols, names=["token", "n", "first"])


def count_ids(files: DataFrame, tokens: list[int]) -> DataFrame:
    """Occurrences of each id in all files and its first place in the corpus, without decoding a file."""
    rows = files.select("path", "start", F.array([F.lit(int(x)) for x in tokens]).alias("tokens")).repartition("path")
    found = rows.mapInArrow(_look_up, "token long, n long, first long")
    return found.groupBy("token").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
