"""Mixing of sources to target weights by Pfair scheduling.

Documents of a source are put in a keyed random order and cut into blocks of
BLOCK_CHARS characters. One block is written per slot. A source with c of H slots
releases its j-th block at floor((j - 1) * H / c) and must have placed it by
ceil(j * H / c); in each slot the released block with the earliest deadline runs.
With shares that add up to H every slot is used and every deadline met, so after
any number of slots a source is less than one block away from its share. The
schedule repeats after H slots, so it is made once for H slots, whatever the size of
the corpus, and joined to the blocks. A source that has run out leaves its slots
empty; the others keep their proportions. No document is dropped or repeated.

The order within a source comes from sums by small hash ranges and offsets of those
ranges, so no task holds a source.

Defined results: a null source is a source of its own; a null or empty text has no
characters and stays in the block where it falls; a text longer than a block starts
one and fills the next ones too. Repeated rows stay beside each other. A weight that
is null, zero or negative or a source without a weight counts as the smallest share,
one slot. Other columns pass by untouched.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_CHARS = 100_000
#: Slots of the repeated schedule, at least; more where there are many sources.
SLOTS = 1_000
SLOTS_A_SOURCE = 20
#: Target weight of a source for each power of its characters: below 1, small sources count for more.
POWER = 0.5
#: Rows of a hash range, about.
RANGE_ROWS = 2_000


def shares(weights: dict[str | None, float], slots: int = SLOTS) -> dict[str | None, int]:
    """Whole slots for each source, one at least, that add up to the length of the schedule (largest remainders)."""
    total = max(slots, SLOTS_A_SOURCE * len(weights))
    known = {s: max(0.0, float(w or 0.0)) for s, w in weights.items()}
    sum_ = sum(known.values()) or 1.0
    order = sorted(known, key=lambda s: (s is not None, s or ""))
    free = total - len(order)
    ideal = {s: known[s] / sum_ * free for s in order}
    out = {s: 1 + int(ideal[s]) for s in order}
    rest = total - sum(out.values())
    for i in range(rest):
        by_rest = sorted(order, key=lambda s: (int(ideal[s]) - ideal[s], s is not None, s or ""))
        out[by_rest[i % len(order)]] += 1
    return out


def schedule(slots_of: dict[str | None, int]) -> list[tuple[str | None, int, int]]:
    """(source, number of its block, slot) over one round, by the earliest deadline of the released blocks."""
    total = sum(slots_of.values())
    order = sorted(slots_of, key=lambda s: (s is not None, s or ""))
    released: dict[int, list[tuple[int, int, int]]] = {}
    for k, s in enumerate(order):
        c = slots_of[s]
        for j in range(c):
            released.setdefault(j * total // c, []).append((-(-(j + 1) * total // c), k, j))
    ready: list[tuple[int, int, int]] = []
    out = []
    for slot in range(total):
        for block in released.get(slot, []):
            heapq.heappush(ready, block)
        deadline, k, j = heapq.heappop(ready)
        assert slot < deadline
        out.append((order[k], j, slot))
    return out


def _source(col: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), col), F.lit("n"))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    seed: int = 0,
    block_chars: int = BLOCK_CHARS,
    slots: int = SLOTS,
) -> DataFrame:
    """`docs` as the struct `row` with `block` (of its source), `slot` and `offset` (characters before it in its source).

    Read in the order of `slot`, `offset` it is the mixed stream.
    """
    spark = docs.sparkSession
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("chars"))
    sizes = {r["source"]: (r["n"], r["chars"]) for r in sizes.collect()}
    if weights is None:
        weights = {s: float(chars) ** POWER for s, (_, chars) in sizes.items()}
    slots_of = shares({s: weights.get(s) for s in sizes}, slots) if sizes else {}
    length = sum(slots_of.values())
    ranges = max(1, max((n for n, _ in sizes.values()), default=0) // RANGE_ROWS)
    rows = docs.select(
        F.struct("*").alias("row"),
        _source(F.col("source")).alias("s"),
        F.xxhash64("doc_id", "text", F.lit(seed)).alias("h"),
        F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("chars"),
    )
    rows = rows.withColumn("range", F.pmod(F.shiftrightunsigned("h", 16), F.lit(ranges)))
    # Offsets of the ranges: one row a source and range.
    sums = rows.groupBy("s", "range").agg(F.sum("chars").alias("all"))
    before = Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "range", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("start"))
    inside = (
        Window.partitionBy("s", "range").orderBy("h", "row.doc_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("inside", F.coalesce(F.sum("chars").over(inside), F.lit(0)))
    rows = rows.join(sums, ["s", "range"]).withColumn("offset", F.col("start") + F.col("inside"))
    rows = rows.withColumn("block", F.floor(F.col("offset") / block_chars).cast("bigint"))
    counts = F.create_map(*[x for s, c in slots_of.items() for x in (F.lit("n" if s is None else "s" + s), F.lit(c))]) if slots_of else F.lit(None)
    rows = rows.withColumn("c", F.coalesce(counts[F.col("s")], F.lit(1)) if slots_of else F.lit(1))
    plan = [("n" if s is None else "s" + s, j, slot) for s, j, slot in schedule(slots_of)] if slots_of else []
    plan = spark.createDataFrame(plan, "s string, j long, first long")
    rows = rows.withColumn("j", F.col("block") % F.col("c"))
    # The schedule has `length` rows at any corpus size.
    rows = rows.join(F.broadcast(plan), ["s", "j"])
    slot = F.floor(F.col("block") / F.col("c")).cast("bigint") * length + F.col("first")
    return rows.select("row", "block", slot.alias("slot"), "offset")


def mixed_stream(docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = 0) -> DataFrame:
    """The documents with `mix_block` and `mix_slot`, range-partitioned and sorted into the mixed order."""
    rows = mix(docs, weights, seed)
    rows = rows.repartitionByRange("slot", "offset").sortWithinPartitions("slot", "offset")
    return rows.select("row.*", F.col("block").alias("mix_block"), F.col("slot").alias("mix_slot"))
