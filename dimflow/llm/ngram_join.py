"""Similarity join of documents on sets of word n-grams, by rare-first prefix filtering.

Two documents link when 100 * |A and B| >= percent * |A or B|. Every set is sorted
rare-first. Linked sets must share an n-gram among their first
n - ceil(percent / 100 * n) + 1, so only those prefixes are joined. Length,
positional and suffix filters (a lower bound on the Hamming distance of the sets
from 512-bit signatures) are conditions of that join. A pair that passes is verified
once, on its sets.

* Equal sets are one node, so exact copies never form pairs.
* How rare an n-gram is (in how many nodes it occurs) is counted exactly. An
  n-gram of one node only can't join; it never leaves the counting task, and a
  node whose whole prefix is of that kind is done.
* N-grams in more than a hundredth of the documents come last in the order and
  aren't shuffled for counting. Their number is at most a hundred times the mean
  set size, which bounds what is broadcast.
* Links are wanted as components. An n-gram first joins its nodes with one pivot, then
  with a few others a turn, and only nodes of different components. The last turn
  joins all of those, so no link between components is missed.

Defined results: null texts and texts without words have an empty set and link with
nothing. Repeated rows are copies. Texts with one doc_id count as one document. A
null doc_id takes its text's component and is never one. An empty table gives an
empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.llm.components import connected_components
from dimflow.llm.text_hash import U, mix, shingle_sets
from dimflow.session import stage_table

WIDTH = 4
PERCENT = 85
#: N-grams in more than one of so many documents come last.
COMMON_IN = 100
#: Shingles that one counting task holds, about.
BUCKET_SHINGLES = 3_000_000
SIGNATURE = 8
SIG = [f"s{k}" for k in range(SIGNATURE)]
#: Rows of which a task counts frequent shingles at once.
COUNT_ROWS = 2_000

SETS = "doc_id long, n long, h long, h2 long, " + ", ".join(f"{s} long" for s in SIG) + ", gram long, docs long"
PARTS = "bucket int, body binary, h long, n long, grams array<long>"
SHARED = "h long, n long, grams array<long>, counts array<long>"
PROFILE = "h long, n long, rare long, grams array<long>"


def _long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _lists(arrays: list[np.ndarray], kind=np.int64) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind)))


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def _signature(grams: np.ndarray) -> np.ndarray:
    """Parity of the shingles of each bit: what two sets share cancels out of the difference of theirs."""
    bits = np.zeros(SIGNATURE, U)
    place = grams % U(64 * SIGNATURE)
    np.bitwise_xor.at(bits, (place >> U(6)).astype(int), U(1) << (place & U(63)))
    return bits


def _sets(width: int, seed: int):
    """Set size, hashes and signature of each document; and the frequent shingles of every COUNT_ROWS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, COUNT_ROWS):
                batch = whole.slice(start, COUNT_ROWS)
                ids, out, fresh, seen = batch.column(0), [], [], set()
                for grams in shingle_sets(batch.column(1), width, seed):
                    h, h2 = mix(grams, 1).sum(dtype=U), mix(grams, 2).sum(dtype=U)
                    out.append((len(grams), h, h2, *_signature(grams)))
                    if len(grams) and h not in seen:
                        seen.add(h)
                        fresh.append(grams)
                table = np.array([x[1:] for x in out], U).reshape(len(out), SIGNATURE + 2)
                null = pa.nulls(len(out), pa.int64())
                cols = [ids, pa.array([x[0] for x in out], pa.int64())]
                cols += [pa.array(_long(np.ascontiguousarray(table[:, k]))) for k in range(SIGNATURE + 2)]
                yield pa.RecordBatch.from_arrays(cols + [null, null], names=_names(SETS))
                if fresh:
                    grams, counts = np.unique(np.concatenate(fresh), return_counts=True)
                    many = counts * 2 * COMMON_IN > batch.num_rows
                    null = pa.nulls(int(many.sum()), pa.int64())
                    cols = [null] * (SIGNATURE + 4)
                    cols += [pa.array(_long(grams[many])), pa.array(counts[many].astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(cols, names=_names(SETS))

    return run


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _pack(grams: np.ndarray) -> bytes:
    return grams.view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpack(body: bytes) -> np.ndarray:
    out = np.zeros((len(body) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(body, np.uint8).reshape(-1, 7)
    return out.reshape(-1).view(U)


HEAD = np.dtype([("h", U), ("n", np.uint32), ("count", np.uint32)])


def _parts(width: int, seed: int, buckets: int, common: np.ndarray):
    """The shingles of each distinct set of a batch, dealt into buckets by their hash.

    A body holds for each set its hash, its size and how many shingles follow, then
    all shingles. Common shingles go, by set, in rows without a body.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, COUNT_ROWS):
                yield from one(whole.slice(start, COUNT_ROWS))

    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        heads, sets, seen, known = [], [], set(), []
        for grams in shingle_sets(batch.column(0), width, seed):
            h = mix(grams, 1).sum(dtype=U)
            if not len(grams) or h in seen:
                continue
            seen.add(h)
            n = len(grams)
            if len(common):
                at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
                is_common = common[at] == grams
                if is_common.any():
                    known.append((h, n, grams[is_common]))
                    grams = grams[~is_common]
            heads.append((h, n, 0))
            sets.append(grams)
        if known:
            h = np.array([x[0] for x in known], U)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((h % U(buckets)).astype(np.int32)),
                    pa.nulls(len(known), pa.binary()),
                    pa.array(_long(h)),
                    pa.array([x[1] for x in known], pa.int64()),
                    _lists([_long(x[2]) for x in known]),
                ],
                names=_names(PARTS),
            )
        if not sets:
            return
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        grams = np.concatenate(sets)
        bucket = (grams % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        head = np.array(heads, HEAD)
        keys, bodies = np.flatnonzero(np.diff(cuts)), []
        for k in keys:
            own = order[cuts[k] : cuts[k + 1]]
            who, counts = np.unique(owner[own], return_counts=True)
            part = head[who]
            part["count"] = counts
            bodies.append(np.array([len(who)], U).tobytes() + part.tobytes() + _pack(grams[own]))
        m = len(bodies)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int32()),
                pa.array(bodies, pa.binary()),
                pa.nulls(m, pa.int64()),
                pa.nulls(m, pa.int64()),
                pa.nulls(m, pa.list_(pa.int64())),
            ],
            names=_names(PARTS),
        )

    return run


def _shared(parts: pa.Table) -> pa.Table:
    """The shingles of one bucket that occur in two sets or more, by set, with the number of sets."""
    heads, grams = [np.zeros(0, HEAD)], [np.zeros(0, U)]
    for body in parts.column("body").drop_null().to_pylist():
        k = int(np.frombuffer(body, U, 1)[0])
        heads.append(np.frombuffer(body, HEAD, k, 8))
        grams.append(_unpack(body[8 + HEAD.itemsize * k :]))
    head, gram = np.concatenate(heads), np.concatenate(grams)
    del heads, grams
    owner = np.repeat(np.arange(len(head)), head["count"])
    order = np.argsort(gram)
    gram, owner = gram[order], owner[order]
    same = gram[1:] == gram[:-1]
    twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
    gram, owner = gram[twice], owner[twice]
    # A set comes from each batch that holds a copy; one row of each remains.
    order = np.lexsort((head["h"][owner], gram))
    gram, owner = gram[order], owner[order]
    h = head["h"][owner]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (h[1:] != h[:-1])
    gram, owner, h = gram[new], owner[new], h[new]
    _, at, counts = np.unique(gram, return_inverse=True, return_counts=True)
    count = counts[at] if len(gram) else np.zeros(0, np.int64)
    many = count > 1
    gram, owner, h, count = gram[many], owner[many], h[many], count[many]
    order = np.argsort(h, kind="stable")
    gram, owner, h, count = gram[order], owner[order], h[order], count[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, int)
    ends = pa.array(np.append(first, len(h)).astype(np.int32))
    out = [
        pa.array(_long(np.ascontiguousarray(h[first]))),
        pa.array(head["n"][owner[first]].astype(np.int64)),
        pa.ListArray.from_arrays(ends, pa.array(_long(gram))),
        pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int64))),
    ]
    done = pa.Table.from_arrays(out, names=_names(SHARED))
    known = parts.filter(parts.column("h").is_valid())
    if not known.num_rows:
        return done
    grams = known.column("grams").combine_chunks()
    last = pa.ListArray.from_arrays(grams.offsets, pa.array(np.full(len(grams.values), LAST)))
    passed = [known.column("h").combine_chunks(), known.column("n").combine_chunks(), grams, last]
    return pa.concat_tables([done, pa.Table.from_arrays(passed, names=_names(SHARED))])


#: Stands for the count of a common shingle.
LAST = np.int64(1 << 62)


def _profiles(percent: int):
    """Sorts the shared shingles of each set rare-first; keeps sets whose prefix reaches them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, n, grams, counts in zip(*(c.to_pylist() for c in batch.columns)):
                g = np.concatenate([np.array(x, np.int64) for x in grams])
                c = np.concatenate([np.array(x, np.int64) for x in counts])
                g, at = np.unique(g, return_index=True)
                g = g[np.lexsort((g, c[at]))]
                rare = n - len(g)
                if rare < n - (percent * n + 99) // 100 + 1:
                    rows.append((h, n, rare, g))
            cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*cols, _lists([r[3] for r in rows])], names=_names(PROFILE))

    return run


def _meets(percent: int):
    """Whether the filters let the pair x, y of postings pass."""
    n, m = F.col("x.n"), F.col("y.n")
    least = F.lit(percent) * (n + m)
    ahead = F.least("x.pos", "y.pos") + 1 + F.least(n - 1 - F.col("x.pos"), m - 1 - F.col("y.pos"))
    differ = sum((F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in SIG), F.lit(0))
    return (
        (100 * F.least(n, m) >= percent * F.greatest(n, m))
        & ((100 + percent) * ahead >= least)
        & ((100 + percent) * (n + m - differ) >= 2 * least)
    )


#: Nodes of a shingle that all others are compared with in each turn after the first.
PIVOTS = 8


def _pivots(postings: DataFrame, turn: int) -> DataFrame:
    """For each shingle a few of its nodes: at first the one with the smallest doc_id, later others each turn."""
    rank = F.col("first") if turn == 0 else F.xxhash64("h", F.lit(turn))
    order = Window.partitionBy("gram").orderBy(rank, "h")
    ranked = postings.withColumn("at", F.row_number().over(order))
    return ranked.filter(F.col("at") <= (1 if turn == 0 else PIVOTS)).drop("at")


def _links(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b of nodes whose sets are similar, each verified once."""
    sets = profiles.select("h", "n", "grams")
    left = sets.select(F.col("h").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("h").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    both = pairs.distinct().join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    return both.filter(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")


#: The pivots go on while a turn joins more than one in so many of the components that still meet others.
WORTHWHILE = 20


def link_classes(postings: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """`node`, `component` of the nodes that link with another.

    Turns with pivots take as many pairs as there are postings, times a constant, and
    leave few links between components; the last turn takes all pairs of different
    components that share a prefix shingle and pass the filters. There is none where
    no shingle has nodes of different components left.
    """
    spark = postings.sparkSession
    edges = spark.createDataFrame([], "a long, b long")
    parts = spark.createDataFrame([], "node long, component long")
    turn, apart, last = 0, None, False
    while True:
        now = postings.join(parts.withColumnRenamed("node", "h"), "h", "left")
        now = now.withColumn("component", F.coalesce("component", "h"))
        if turn:
            many = now.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y"))
            now = stage_table(now.join(many.filter("x <> y").select("gram"), "gram", "left_semi"), "postings")
            before, apart = apart, now.select("component").distinct().count()
            if not apart:
                return parts
            last = before is not None and (before - apart) * WORTHWHILE <= before
        x = (now if last else _pivots(now, turn)).alias("x")
        y = now.alias("y")
        order = F.col("x.h") < F.col("y.h") if last else F.col("x.h") != F.col("y.h")
        apart_ = F.col("x.component") != F.col("y.component")
        met = x.join(y, (F.col("x.gram") == F.col("y.gram")) & order & apart_ & _meets(percent))
        pairs = met.select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b"))
        edges = stage_table(edges.union(_links(pairs, profiles, percent)), "links")
        parts = connected_components(edges)
        if last:
            return parts
        turn += 1


def similar_documents(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """`doc_id`, `n_shingles` and `component_id` of every row of `docs` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seed = 0
    while True:
        rows = stage_table(docs.mapInArrow(_sets(width, seed), SETS), "sets")
        sets = rows.filter("n is not null")
        classes = sets.filter("n > 0").groupBy("h").agg(
            F.min("doc_id").alias("first"),
            F.min("n").alias("n"),
            *[F.first(s).alias(s) for s in SIG],
            ((F.min("n") != F.max("n")) | (F.min("h2") != F.max("h2"))).alias("clash"),
        )
        classes = stage_table(classes, "classes")
        total, clash, n_docs = classes.agg(F.sum("n"), F.max("clash"), F.count("*")).first()
        if not clash:
            break
        seed += 1
    if not total:
        return sets.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    frequent = rows.filter("gram is not null").groupBy("gram").agg(F.sum("docs").alias("docs"))
    frequent = frequent.filter(F.col("docs") * COMMON_IN > max(n_docs, COMMON_IN * 10))
    common = np.sort(np.array([r[0] for r in frequent.select("gram").collect()], np.int64).view(U))
    buckets = max(12, -(-total // BUCKET_SHINGLES))
    parts = docs.select("text").mapInArrow(_parts(width, seed, buckets, common), PARTS)
    shared = parts.groupBy("bucket").applyInArrow(_shared, SHARED)
    by_set = shared.groupBy("h").agg(
        F.first("n").alias("n"), F.collect_list("grams").alias("grams"), F.collect_list("counts").alias("counts")
    )
    profiles = stage_table(by_set.mapInArrow(_profiles(percent), PROFILE), "profiles")
    prefix = F.col("n") - F.floor((percent * F.col("n") + 99) / 100).cast("long") + 1 - F.col("rare")
    postings = profiles.select(
        "h", "n", "rare", F.posexplode(F.slice("grams", F.lit(1), prefix.cast("int"))).alias("i", "gram")
    ).select("gram", "h", (F.col("rare") + F.col("i")).alias("pos"))
    postings = postings.join(classes.select("h", "n", "first", *SIG), "h")
    postings = stage_table(postings, "postings")
    parts = link_classes(postings, profiles, percent)
    return _answer(sets, classes, parts)


def _answer(sets: DataFrame, classes: DataFrame, parts: DataFrame) -> DataFrame:
    """Component of every row: the smallest doc_id among the classes that hang together."""
    # One doc_id with several texts joins their classes.
    texts = sets.filter("n > 0 and doc_id is not null").select("doc_id", "h")
    least = texts.groupBy("doc_id").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b")
    if not least.isEmpty():
        more = texts.join(least, "doc_id").select("a", F.col("h").alias("b"))
        parts = connected_components(parts.select(F.col("component").alias("a"), F.col("node").alias("b")).union(more))
    parts = parts.select(F.col("node").alias("h"), "component")
    roots = classes.select("h", "first").join(parts, "h", "left").withColumn("root", F.coalesce("component", "h"))
    ids = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    answer = roots.join(ids, "root").select("h", "component_id")
    found = sets.filter("n > 0").join(answer, "h")
    none = sets.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    cols = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return found.select(*cols).union(none.select(*cols))
