"""Removal of repeated byte strings: bytes of a document covered by a string of 50 bytes that
also starts in a document with a smaller doc_id.

1. Equal texts are one node with its smallest doc_id; every other copy goes whole.
2. Each string of 50 bytes is named by the least hash of the 16-byte strings in it.
   Neighbours mostly share their name, so a text falls into about one segment for 18
   bytes. Names are counted; only those in two nodes or more can matter.
3. Segments with such names are dealt to shards by name, so equal strings meet in one.
   Equal segments of a shard are one. Where a name has different segments, the parts of
   them whose strings may occur again (by hash) are kept, and their suffixes are sorted
   by external induced sorting (`induced_sort`); strings that begin neighbouring suffixes
   and share 50 bytes form a group, and the group's smallest doc_id decides for all.
4. The decided byte ranges go back to the texts.

The common prefix of two neighbours matters up to 50 bytes only and is compared there,
after sorting. Texts are shuffled twice, segments of shared names once.

Defined results: a null text is empty; texts below 50 bytes lose nothing. Rows with one
doc_id never count as smaller than each other. A null doc_id is larger than all others.
Repeated rows have equal results. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.induced_sort import suffix_array
from dimflow.llm.ngram_join import COUNT_ROWS, HEAD, PARTS, SHARED, _long, _names, _pack, _shared
from dimflow.llm.text_hash import BASE, GRAM_SHIFT, INVERSE, U, mix, slices, text_bytes
from dimflow.session import stage_table

LENGTH = 50
#: Bytes of the strings whose least hash names a string of LENGTH bytes.
NAME_BYTES = 16
#: Strings in one segment, at most.
MOST_STRINGS = 200
#: Names that one counting task holds, and bytes of segments in one shard, about.
BUCKET_NAMES = 3_000_000
SHARD_BYTES = 4_000_000
NO_ID = np.iinfo(np.int64).max

CUTS = "bucket int, body binary"
RANGES = "h long, starts array<int>, ends array<int>"
RESULT = "h long, n_removed long, n_spans long, kept_sha256 string"
OWNER = np.dtype([("h", np.int64), ("first", np.int64)])
SEGMENT = np.dtype([("owner", np.uint32), ("start", np.uint32), ("length", np.uint16), ("name", U)])


def segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text: starts, numbers of strings and names of its segments."""
    width = LENGTH - NAME_BYTES + 1
    for first, last in slices(offsets):
        at = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        n = len(part)
        if n < LENGTH:
            for _ in range(last - first):
                yield np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
            continue
        powers = np.ones(n + 1, U)
        powers[1:] = BASE
        np.cumprod(powers, out=powers)
        sums = np.zeros(n + 1, U)
        np.cumsum((part.astype(U) + U(1)) * powers[:-1], out=sums[1:])
        powers[1:] = INVERSE
        powers[0] = 1
        np.cumprod(powers, out=powers)
        least = mix((sums[NAME_BYTES:] - sums[:-NAME_BYTES]) * powers[: n - NAME_BYTES + 1]) >> GRAM_SHIFT
        done = 1
        while 2 * done <= width:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        rest = width - done
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        # A string may not reach over the end of its text.
        edge = np.zeros(n + 1, np.int64)
        for a, b in zip(at[:-1], at[1:]):
            edge[max(a, b - LENGTH + 1)] += 1
            edge[b] -= 1
        starts = np.flatnonzero(np.cumsum(edge)[: len(least)] == 0)
        if not len(starts):
            for _ in range(last - first):
                yield np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
            continue
        names = least[starts]
        new = np.concatenate(([True], (starts[1:] != starts[:-1] + 1) | (names[1:] != names[:-1])))
        # Long runs of one name are cut.
        run = np.flatnonzero(new)
        since = np.arange(len(starts)) - np.repeat(run, np.diff(np.append(run, len(starts))))
        cut = np.flatnonzero(since % MOST_STRINGS == 0)
        sizes = np.diff(np.append(cut, len(starts)))
        starts, names = starts[cut], names[cut]
        where = np.searchsorted(starts, at)
        for k in range(last - first):
            own = slice(where[k], where[k + 1])
            yield starts[own] - at[k], sizes[own], names[own]


def _name_parts(buckets: int):
    """The names of each text dealt into buckets, as bodies that `_shared` reads.

    A name that several texts of a batch have is known to be shared: two of them go on
    to tell other batches, and all get it back in rows without a body.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, COUNT_ROWS):
                yield from one(whole.slice(start, COUNT_ROWS))

    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = text_bytes(batch.column(1))
        hs, sets, seen = [], [], set()
        for h, (_, _, names) in zip(batch.column(0).to_pylist(), segments(data, offsets)):
            if h not in seen and len(names):
                seen.add(h)
                hs.append(h)
                sets.append(np.unique(names))
        if not sets:
            return
        h = np.array(hs, np.int64)
        owner, names = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets)
        order = np.argsort(names, kind="stable")
        owner, names = owner[order], names[order]
        first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
        counts = np.diff(np.append(first, len(names)))
        place = np.arange(len(names)) - np.repeat(first, counts)
        many = np.repeat(counts > 1, counts)
        if many.any():
            at = np.argsort(owner[many], kind="stable")
            who, grams = owner[many][at], names[many][at]
            own = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
            ends = pa.array(np.append(own, len(who)).astype(np.int32))
            keys = h[who[own]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((keys % buckets).astype(np.int32)),
                    pa.nulls(len(own), pa.binary()),
                    pa.array(keys),
                    pa.array(np.zeros(len(own), np.int64)),
                    pa.ListArray.from_arrays(ends, pa.array(_long(grams))),
                ],
                names=_names(PARTS),
            )
        told = place < 2
        owner, names = owner[told], names[told]
        bucket = (names % U(buckets)).astype(np.int64)
        order = np.lexsort((owner, bucket))
        owner, names, bucket = owner[order], names[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        keys, bodies = np.flatnonzero(np.diff(cuts)), []
        for k in keys:
            who, counts = np.unique(owner[cuts[k] : cuts[k + 1]], return_counts=True)
            head = np.zeros(len(who), HEAD)
            head["h"], head["count"] = h[who].view(U), counts
            bodies.append(np.array([len(who)], U).tobytes() + head.tobytes() + _pack(names[cuts[k] : cuts[k + 1]]))
        m = len(bodies)
        cols = [pa.array(keys, pa.int32()), pa.array(bodies, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())]
        yield pa.RecordBatch.from_arrays([*cols, pa.nulls(m, pa.list_(pa.int64()))], names=_names(PARTS))

    return run


def _cut(shards: int):
    """The segments with shared names of each text, dealt to shards by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, COUNT_ROWS):
                yield from one(whole.slice(start, COUNT_ROWS))

    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = text_bytes(batch.column("text"))
        owners = np.zeros(batch.num_rows, OWNER)
        owners["h"] = batch.column("h").to_numpy()
        owners["first"] = batch.column("first").fill_null(NO_ID).to_numpy()
        found, seen = [], set()
        for k, (at, sizes, names) in enumerate(segments(data, offsets)):
            if owners["h"][k] in seen:
                continue
            seen.add(owners["h"][k])
            lists = batch.column("grams")[k].as_py()
            shared = np.unique(np.concatenate([np.array(x, np.int64) for x in lists]).view(U))
            have = np.isin(names, shared)
            part = np.zeros(int(have.sum()), SEGMENT)
            part["owner"], part["start"], part["name"] = k, at[have], names[have]
            part["length"] = sizes[have] + LENGTH - 1
            found.append(part)
        rows = np.concatenate(found) if found else np.zeros(0, SEGMENT)
        if not len(rows):
            return
        shard = (rows["name"] % U(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        rows, shard = rows[order], shard[order]
        cuts = np.searchsorted(shard, np.arange(shards + 1))
        keys, bodies = np.flatnonzero(np.diff(cuts)), []
        for k in keys:
            part = rows[cuts[k] : cuts[k + 1]]
            who, local = np.unique(part["owner"], return_inverse=True)
            text = data[_spread(offsets[part["owner"]] + part["start"], part["length"])]
            part = part.copy()
            part["owner"] = local
            sizes = np.array([len(who), len(part)], U)
            bodies.append(sizes.tobytes() + owners[who].tobytes() + part.tobytes() + text.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(bodies, pa.binary())], names=_names(CUTS))

    return run


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges that begin at `starts`."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def _read(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owners, rows, texts, base = [], [], [], 0
    for body in bodies:
        n, m = (int(x) for x in np.frombuffer(body, U, 2))
        owners.append(np.frombuffer(body, OWNER, n, 16))
        at = 16 + n * OWNER.itemsize
        part = np.frombuffer(body, SEGMENT, m, at).copy()
        part["owner"] += base
        base += n
        rows.append(part)
        texts.append(np.frombuffer(body, np.uint8, offset=at + m * SEGMENT.itemsize))
    return np.concatenate(owners), np.concatenate(rows), np.concatenate(texts)


def _distinct(rows: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each different segment, and for every segment the number of its like."""
    lengths = rows["length"].astype(np.int64)
    ends = np.cumsum(lengths)
    sums = np.zeros(len(text) + 1, U)
    powers = np.full(int(lengths.max()), BASE).cumprod()
    place = np.arange(len(text)) - np.repeat(ends - lengths, lengths)
    np.cumsum((text.astype(U) + U(1)) * powers[place], out=sums[1:])
    key = mix(sums[ends] - sums[ends - lengths] + lengths.astype(U))
    _, first, like = np.unique(key, return_index=True, return_inverse=True)
    other = first[like]
    differ = (lengths != lengths[other]).any() or (
        text != text[_spread((ends - lengths)[other], lengths)]
    ).any()
    if differ:  # two texts of one hash
        own = [text[b - n : b].tobytes() for b, n in zip(ends, lengths)]
        _, first, like = np.unique(np.array(own, object), return_index=True, return_inverse=True)
    return first, like


def _smallest(first: np.ndarray, low: np.ndarray, rows: np.ndarray, text: np.ndarray, folder: str) -> np.ndarray:
    """For each string of the different segments: the smallest doc_id in which it starts.

    `first` has the rows of those segments, `low` the smallest doc_id of each. Where a
    name has several segments, their strings that occur once in the shard are left as
    they are, and the pieces of segments that remain are sorted.
    """
    lengths = rows["length"].astype(np.int64)
    begins = np.cumsum(lengths) - lengths
    counts = lengths[first] - LENGTH + 1
    least = np.repeat(low, counts)
    _, like, many = np.unique(rows["name"][first], return_inverse=True, return_counts=True)
    several = np.flatnonzero(many[like] > 1)
    if not len(several):
        return least
    # Hashes of the strings: equal ones have one hash, so a lone hash is a lone string.
    own = text[_spread(begins[first[several]], lengths[first[several]])]
    powers = np.full(len(own), BASE).cumprod()
    sums = np.zeros(len(own) + 1, U)
    np.cumsum((own.astype(U) + U(1)) * powers, out=sums[1:])
    starts = np.cumsum(lengths[first[several]]) - lengths[first[several]]
    place = _spread(starts, counts[several])
    back = np.full(len(own), INVERSE).cumprod()
    hashes = (sums[place + LENGTH] - sums[place]) * back[place]
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    again = np.zeros(len(hashes), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    # Pieces: runs of strings that occur again, within a segment.
    segment = np.repeat(several, counts[several])
    into = _spread(np.cumsum(counts)[several] - counts[several], counts[several])
    new = again.copy()
    new[1:] &= ~again[:-1] | (segment[1:] != segment[:-1])
    begin = np.flatnonzero(new)
    if not len(begin):
        return least
    number = np.cumsum(new) - 1
    sizes = np.bincount(number[again], minlength=len(begin))
    pieces = np.zeros(len(begin), SEGMENT)
    pieces["length"], pieces["name"] = sizes + LENGTH - 1, rows["name"][first[segment[begin]]]
    said = own[_spread(place[begin], pieces["length"])]
    head, alike = _distinct(pieces, said)
    smallest = np.full(len(head), NO_ID)
    np.minimum.at(smallest, alike, low[segment[begin]])
    found = _sorted_strings(head, smallest, pieces, said, folder)
    offsets = np.cumsum(sizes[head]) - sizes[head]
    least[into[again]] = found[_spread(offsets[alike], sizes)]
    return least


def _sorted_strings(head: np.ndarray, low: np.ndarray, pieces: np.ndarray, said: np.ndarray, folder: str) -> np.ndarray:
    """As `_smallest`, from the sorted suffixes of the pieces of all names that have several."""
    size = pieces["length"].astype(np.int64)
    begins = np.cumsum(size) - size
    counts = size[head] - LENGTH + 1
    least = np.repeat(low, counts)
    _, like, many = np.unique(pieces["name"][head], return_inverse=True, return_counts=True)
    several = np.flatnonzero(many[like] > 1)
    if not len(several):
        return least
    size = size[head[several]]
    where = np.cumsum(size + 1) - (size + 1)
    joined = np.ones(int((size + 1).sum()) + 1, np.int64)  # 1 parts the pieces, 0 ends the text
    joined[-1] = 0
    joined[_spread(where, size)] = said[_spread(begins[head[several]], size)].astype(np.int64) + 2
    order = suffix_array(joined, folder)
    # Of the suffixes only those that begin a string count.
    target = np.full(len(joined), -1, np.int64)
    offsets = np.cumsum(counts) - counts
    target[_spread(where, counts[several])] = _spread(offsets[several], counts[several])
    order = order[target[order] >= 0]
    narrow = joined.astype(np.int16)
    same = np.zeros(len(order), bool)
    step = 1 << 16
    for a in range(1, len(order), step):
        b = min(a + step, len(order))
        wide = narrow[order[a - 1 : b, None] + np.arange(LENGTH)]
        same[a:b] = (wide[1:] == wide[:-1]).all(axis=1)
    groups = np.flatnonzero(~same)
    mins = np.minimum.reduceat(least[target[order]], groups)
    least[target[order]] = np.repeat(mins, np.diff(np.append(groups, len(order))))
    return least


def _covered(bodies: list[bytes]) -> pa.RecordBatch:
    """Byte ranges of each text that a shard finds in smaller documents."""
    owners, rows, text = _read(bodies)
    first, like = _distinct(rows, text)
    mine = owners["first"][rows["owner"]]
    low = np.full(len(first), NO_ID)
    np.minimum.at(low, like, mine)
    with tempfile.TemporaryDirectory() as folder:
        least = _smallest(first, low, rows, text, folder)
    counts = rows["length"].astype(np.int64) - LENGTH + 1
    offsets = np.cumsum(counts[first]) - counts[first]
    found = least[_spread(offsets[like], counts)] < np.repeat(mine, counts)
    row = np.repeat(np.arange(len(rows)), counts)
    begin = found.copy()
    begin[1:] &= ~found[:-1] | (row[1:] != row[:-1])
    end = found.copy()
    end[:-1] &= ~found[1:] | (row[1:] != row[:-1])
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(rows["start"].astype(np.int64), counts)
    starts, ends, who = place[begin], place[end] + LENGTH, rows["owner"][row[begin]]
    h = owners["h"][who]
    order = np.argsort(h, kind="stable")
    h, starts, ends = h[order], starts[order], ends[order]
    own = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, int)
    cuts = pa.array(np.append(own, len(h)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (starts, ends)]
    return pa.RecordBatch.from_arrays([pa.array(h[own]), *lists], names=_names(RANGES))


def _sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Works on the shards of a partition sorted by shard, one after the other."""
    bodies, now = [], None
    for batch in batches:
        for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != now and bodies:
                yield _covered(bodies)
                bodies = []
            now = key
            bodies.append(body)
    if bodies:
        yield _covered(bodies)


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of what is left of each text without its ranges."""
    for batch in batches:
        rows = []
        for h, text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("h", "text", "starts", "ends"))):
            data = (text or "").encode()
            a = np.concatenate([np.array(x, np.int64) for x in starts])
            b = np.concatenate([np.array(x, np.int64) for x in ends])
            depth = np.zeros(len(data) + 1, np.int64)
            np.add.at(depth, a, 1)
            np.add.at(depth, b, -1)
            gone = np.cumsum(depth[:-1]) > 0
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            rows.append((h, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        cols = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(cols, names=_names(RESULT))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256` of every row of `docs` (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    seed = 0
    while True:
        hashed = docs.withColumn("h", F.xxhash64("text", F.lit(seed)))
        thin = hashed.select(
            "doc_id",
            "h",
            F.xxhash64("text", F.lit(seed + 1), F.lit("other")).alias("h2"),
            F.octet_length("text").cast("bigint").alias("n_bytes"),
            F.sha2("text", 256).alias("whole"),
        )
        thin = stage_table(thin, "texts")
        classes = thin.groupBy("h").agg(
            F.min("doc_id").alias("first"),
            F.min("n_bytes").alias("n_bytes"),
            ((F.min("h2") != F.max("h2")) | (F.min("n_bytes") != F.max("n_bytes"))).alias("clash"),
        )
        classes = stage_table(classes, "classes")
        total, clash = classes.agg(F.sum("n_bytes"), F.max("clash")).first()
        if not clash:
            break
        seed += 2
    total = total or 0
    buckets = max(12, 2 * total // (LENGTH - NAME_BYTES + 2) // BUCKET_NAMES)
    parts = hashed.select("h", "text").mapInArrow(_name_parts(buckets), PARTS)
    shared = parts.groupBy("bucket").applyInArrow(_shared, SHARED).select("h", "grams")
    names = shared.groupBy("h").agg(F.collect_list("grams").alias("grams")).join(classes.select("h", "first"), "h")
    names = stage_table(names, "names")
    size = F.aggregate("grams", F.lit(0).cast("bigint"), lambda n, x: n + F.size(x))
    n_shared = names.agg(F.sum(size)).first()[0] or 0
    shards = max(12, n_shared * (LENGTH + 18) // SHARD_BYTES)
    texts = hashed.withColumnRenamed("h", "key").join(
        names, (F.col("key") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("first"))
    )
    cuts = texts.select("h", "first", "grams", "text").mapInArrow(_cut(shards), CUTS)
    cuts = cuts.repartition("bucket").sortWithinPartitions("bucket")
    ranges = cuts.mapInArrow(_sort_shards, RANGES)
    ranges = ranges.groupBy("h").agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))
    ranges = stage_table(ranges.join(classes.select("h", "first"), "h"), "ranges")
    again = hashed.withColumnRenamed("h", "key").join(
        ranges, (F.col("key") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("first"))
    )
    results = again.select("h", "text", "starts", "ends").mapInArrow(_cleaned, RESULT).dropDuplicates(["h"])
    out = thin.join(classes.select("h", "first"), "h").join(results, "h", "left")
    copy = (F.col("n_bytes") >= LENGTH) & F.coalesce(F.col("doc_id") > F.col("first"), F.col("doc_id").isNull() & F.col("first").isNotNull())
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
