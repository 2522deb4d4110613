"""The prefix trie of conversations, with totals of subtrees by centroid decomposition.

A node is a distinct sequence of first turns; it is named by its smallest member, a
conversation that starts with it, and its depth. Turns enter as digests; the key of a
prefix is a polynomial of them modulo a prime of 127 bits, summed along range-sorted
partitions, so that a conversation may lie in several of them: each partition sums from 0
and gets the state of those before it from a summary of one row a partition.

Totals go up the parent edges by centroid decomposition. The weight of a node is its
number of members, so the weight of its subtree, the turns from it to the ends of its
members, is known without a rollup. In each component of the forest the nodes that hold
half its weight or more are a path from its top; the lowest of them is the centroid. Its
subtree's total within the component is added to all nodes of that path, the centroid's
subtree is cut off and falls apart into those of its children. No component keeps more
than half of the weight, so a node is reached by a logarithmic number of totals, however
deep the trie is. All components are split at once, by joins and sums; one of LOCAL nodes
or less is finished in the task that holds it, in the same way.

Defined results: turns are ordered by `turn` (null first), then by their digest; equal
rows stay, as turns of their own. A null role or text is empty. Rows without a conv_id
belong to no conversation and are left out. An empty table gives no rows, not even a
root. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.session import stage_table

#: Components of so many nodes or less are finished in one task.
LOCAL = 4096
#: Ids in a piece of a node's list of ends.
ENDS = 4096
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix trie").digest()[:15], "big")


def digest_turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, `said` (a digest of role and text) and `n_bytes` (of the text) of every row with a conv_id."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.unhex(F.sha2(F.concat(F.length(role), F.lit(":"), role, text).cast("binary"), 256))
    rows = df.filter("conv_id is not null")
    return rows.select("conv_id", "turn", said.alias("said"), F.octet_length(text).cast("bigint").alias("n_bytes"))


def number_turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with `place`, their turn's number in its conversation from 0, and a table conv_id, n.

    Rows are numbered through the whole sorted table, then from the first of their
    conversation, so no task needs a conversation whole.
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "said"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("at", F.monotonically_increasing_id())  # partition << 33 | row
    rows = stage_table(rows, "turns")
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    parts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rows = rows.withColumn("part", part).join(parts, "part").withColumn("number", F.col("before") + row)
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.min("number").alias("first"))
    convs = stage_table(convs, "conversations")
    rows = rows.join(convs.drop("n"), "conv_id").withColumn("place", F.col("number") - F.col("first"))
    return rows.select("conv_id", "place", "said", "n_bytes"), convs.select("conv_id", "n")


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of prefixes from sorted rows; of a conversation that began in an earlier partition, from its first row here."""
    part, now, key, terms, open_ = TaskContext.get().partitionId(), None, 0, 0, False
    for batch in batches:
        keys, counts, opens = [], [], []
        for conv, place, said in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "said"))):
            if conv != now:
                now, key, terms, open_ = conv, 0, 0, place > 0
            key, terms = (key * BASE + int.from_bytes(said[:16], "big") + 1) % PRIME, terms + 1
            keys.append(key.to_bytes(16, "big"))
            counts.append(terms)
            opens.append(open_)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("place"),
                batch.column("n_bytes"),
                pa.array([part] * len(keys), pa.int32()),
                pa.array(counts, pa.int64()),
                pa.array(opens, pa.bool_()),
                pa.array(keys, pa.binary()),
            ],
            names=["conv_id", "place", "n_bytes", "part", "terms", "open", "key"],
        )


def _carry(before: dict[int, int]):
    """Put the state of earlier partitions under the keys of conversations that began there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            opens = batch.column("open").to_pylist()
            if any(opens):
                parts, terms = batch.column("part").to_pylist(), batch.column("terms").to_pylist()
                for k, is_open in enumerate(opens):
                    if is_open:
                        key = before[parts[k]] * pow(BASE, terms[k], PRIME) + int.from_bytes(keys[k], "big")
                        keys[k] = (key % PRIME).to_bytes(16, "big")
            columns = [batch.column("conv_id"), batch.column("place"), batch.column("n_bytes"), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "place", "n_bytes", "key"])

    return run


def prefix_keys(turns: DataFrame) -> DataFrame:
    """conv_id, depth, n_bytes and `key` of every prefix of a turn or more; `turns` are numbered without gaps."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", "place", "said", "n_bytes")
    rows = rows.repartitionByRange("conv_id", "place").sortWithinPartitions("conv_id", "place")
    schema = f"conv_id {kind}, place long, n_bytes long, part int, terms long, open boolean, key binary"
    summed = stage_table(rows.mapInArrow(_sum_up, schema), "keys")
    # The last row of each partition: at most one conversation goes on from it.
    last = F.max_by(F.struct("open", "terms", "key"), F.struct("conv_id", "place"))
    state, before = 0, {}
    for part, row in sorted(map(tuple, summed.groupBy("part").agg(last).collect())):
        before[part] = state
        key = int.from_bytes(row["key"], "big")
        state = (state * pow(BASE, row["terms"], PRIME) + key) % PRIME if row["open"] else key
    done = summed.mapInArrow(_carry(before), f"conv_id {kind}, place long, n_bytes long, key binary")
    return done.select("conv_id", (F.col("place") + 1).alias("depth"), "n_bytes", "key")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations.

    `turns`: conv_id, place (from 0, without gaps), said (binary of 16 bytes or more),
    n_bytes. `members`: the conv_id of every conversation once, turnless ones too.

    A row a node: conv_id, its smallest member; depth; parent_conv_id; n_convs, its
    members; n_children; n_leaves, childless nodes in its subtree; saved_tokens, summed
    over its subtree, (n_convs - 1) * n_bytes; ends_sha256, a digest of the ids, ascending
    and joined by commas, of the members that end there.
    """
    keys = stage_table(prefix_keys(turns), "prefixes")
    lengths = keys.groupBy("conv_id").agg(F.max("depth").alias("length"))
    lengths = members.select("conv_id").join(lengths, "conv_id", "left").na.fill(0, ["length"])
    lengths = stage_table(lengths, "lengths")
    kind, none = lengths.schema["conv_id"].dataType, F.lit(0).cast("bigint")
    at_root = lengths.groupBy(none.alias("depth")).agg(
        F.min("conv_id").alias("top"), F.count("*").alias("n_convs"), F.sum(F.col("length") + 1).alias("weight")
    )
    at_root = at_root.select("*", none.alias("n_bytes"), F.lit(None).cast(kind).alias("parent"))
    root = lengths.agg(F.min("conv_id")).first()[0]

    rows = keys.join(lengths, "conv_id")
    nodes = rows.groupBy("depth", "key").agg(
        F.min("conv_id").alias("top"),
        F.count("*").alias("n_convs"),
        F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    nodes = stage_table(nodes, "nodes")
    # The node that each conversation passes at each depth.
    paths = keys.join(nodes.select("depth", "key", "top"), ["depth", "key"]).select("conv_id", "depth", "top")
    paths = stage_table(paths, "paths")

    above = paths.select(F.col("conv_id").alias("top"), (F.col("depth") + 1).alias("depth"), F.col("top").alias("parent"))
    parent = F.when(F.col("depth") == 1, F.lit(root)).otherwise(F.col("parent"))
    nodes = nodes.drop("key").join(above, ["top", "depth"], "left").withColumn("parent", parent)
    nodes = stage_table(nodes.unionByName(at_root.select("top", "depth", "n_convs", "n_bytes", "weight", "parent")), "edges")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("top"), (F.col("depth") - 1).alias("depth"))
    nodes = nodes.join(children.agg(F.count("*").alias("n_children")), ["top", "depth"], "left").na.fill(0, ["n_children"])
    nodes = stage_table(nodes, "nodes")

    own = {"leaves": (F.col("n_children") == 0).cast("bigint"), "saved": (F.col("n_convs") - 1) * F.col("n_bytes")}
    forest = nodes.select("top", "depth", "parent", "weight", *[x.alias(k) for k, x in own.items()])
    totals = subtree_totals(forest, paths, list(own))
    ends = paths.join(lengths.withColumnRenamed("length", "depth"), ["conv_id", "depth"])
    ends = ends.unionByName(lengths.filter("length = 0").select("conv_id", none.alias("depth"), F.lit(root).cast(kind).alias("top")))
    found = nodes.join(totals, ["top", "depth"]).join(end_digests(ends), ["top", "depth"], "left")
    return found.select(
        F.col("top").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def subtree_totals(forest: DataFrame, paths: DataFrame, values: list[str], local: int = LOCAL) -> DataFrame:
    """top, depth and the sum of each value over the node's subtree.

    `forest`: top, depth, parent (the top of the node above), weight (of the whole subtree)
    and the values. `paths`: conv_id, depth, top of the node that a conversation passes;
    it is needed for the conversations that name a node, and tells who is below a centroid.
    """
    name = forest.schema["top"].dataType.simpleString()
    got = {v: f"got_{v}" for v in values}
    # All belong to the component of the root, which is known by the node at its top.
    root = forest.filter("depth = 0").select("top").first()
    part = F.struct(F.lit(root and root[0]).cast(name).alias("top"), F.lit(0).cast("bigint").alias("depth"))
    state = forest.select("*", part.alias("part"), *[F.lit(0).cast("bigint").alias(g) for g in got.values()])
    results: list[DataFrame] = []
    kept = ["top", "depth", *values]
    while True:
        parts = state.groupBy("part").agg(F.count("*").alias("n"), F.max("weight").alias("of_part"))
        state = stage_table(state.join(parts, "part"), "components")
        small = state.filter(F.col("n") <= local)
        results.append(_finish(small, values, name))
        state = state.filter(F.col("n") > local)
        if state.isEmpty():
            break
        heavy = F.col("weight") * 2 >= F.col("of_part")
        lowest = F.max_by(F.struct("top", "depth", "weight"), "depth").alias("centroid")
        state = state.join(state.filter(heavy).groupBy("part").agg(lowest), "part").withColumn("heavy", heavy)
        state = stage_table(_below(state, paths), "centroids")
        under = state.filter("below").groupBy("part").agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
        state = state.join(under, "part")
        is_centroid = (F.col("top") == F.col("centroid.top")) & (F.col("depth") == F.col("centroid.depth"))
        plus = {v: F.col(got[v]) + F.col(f"sum_{v}") for v in values}
        results.append(state.filter(is_centroid).select("top", "depth", *[plus[v].alias(v) for v in values]))
        on_path = F.col("heavy") & ~F.col("below")
        child = F.struct(F.col("child").alias("top"), (F.col("centroid.depth") + 1).alias("depth"))
        state = state.filter(~is_centroid).select(
            "top",
            "depth",
            "parent",
            F.when(on_path, F.col("weight") - F.col("centroid.weight")).otherwise(F.col("weight")).alias("weight"),
            *values,
            F.when(F.col("below"), child).otherwise(F.col("part")).alias("part"),
            *[F.when(on_path, plus[v]).otherwise(F.col(got[v])).alias(got[v]) for v in values],
        )
    done = results[0].select(*kept)
    for more in results[1:]:
        done = done.unionByName(more.select(*kept))
    return done


def _below(state: DataFrame, paths: DataFrame) -> DataFrame:
    """`state` with `below`, whether a node is in its centroid's subtree, and `child`, the centroid's child above it.

    Both are read from the path of the conversation that names the node, once for all
    nodes of that name in a component.
    """
    at = F.col("centroid.depth")
    asked = state.filter(F.col("depth") >= at).select(F.col("top").alias("conv_id"), at.alias("at")).distinct()
    asked = asked.select("conv_id", "at", F.explode(F.array("at", F.col("at") + 1)).alias("depth"))
    found = asked.join(paths, ["conv_id", "depth"], "left")
    # The root is on every path, but in no list of nodes passed.
    found = found.groupBy("conv_id", "at").agg(
        F.max(F.when(F.col("depth") == F.col("at"), F.col("top"))).alias("passed"),
        F.max(F.when(F.col("depth") > F.col("at"), F.col("top"))).alias("child"),
    )
    found = found.select(F.col("conv_id").alias("top"), F.col("at").alias("of"), "passed", "child")
    state = state.withColumn("of", at).join(found, ["top", "of"], "left")
    is_below = (F.col("depth") >= F.col("of")) & ((F.col("of") == 0) | F.coalesce(F.col("passed") == F.col("centroid.top"), F.lit(False)))
    return state.withColumn("below", is_below).drop("of", "passed")


def _finish(small: DataFrame, values: list[str], name: str) -> DataFrame:
    """The totals of components that fit a task."""
    rows = small.select("part", "top", "depth", "parent", "weight", *values, *[f"got_{v}" for v in values])
    rows = rows.repartition("part").sortWithinPartitions("part", "depth")
    rows = rows.select(F.col("part.top").alias("of"), F.col("part.depth").alias("at"), *rows.columns[1:])
    schema = f"top {name}, depth long, " + ", ".join(f"{v} long" for v in values)
    return rows.mapInArrow(_decompose(len(values)), schema)


def _decompose(n_values: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            names, kinds = batch.schema.names, batch.schema.types
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:2] != held[0][:2]:
                    out += component_totals(held, n_values)
                    held = []
                held.append(row)
            if out:
                yield _rows(out, names[2:4] + names[6 : 6 + n_values], kinds[2:4] + kinds[6 : 6 + n_values])
        if held:
            yield _rows(component_totals(held, n_values), names[2:4] + names[6 : 6 + n_values], kinds[2:4] + kinds[6 : 6 + n_values])

    return run


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def component_totals(rows: list[tuple], n_values: int) -> list[tuple]:
    """top, depth and totals of the nodes of one component, by centroid decomposition.

    `rows`, by depth: two columns that name the component, top, depth, parent, weight, the
    values, and what the nodes have got from below the component.
    """
    place = {(row[2], row[3]): k for k, row in enumerate(rows)}
    above = [place.get((row[4], row[3] - 1), -1) for row in rows]
    weight = [row[5] for row in rows]
    own = [row[6 : 6 + n_values] for row in rows]
    got = [list(row[6 + n_values : 6 + 2 * n_values]) for row in rows]
    waiting = [list(range(len(rows)))]  # nodes of a component, from its top downwards
    while waiting:
        part = waiting.pop()
        half = weight[part[0]]
        heavy = [k for k in part if 2 * weight[k] >= half]
        centroid = heavy.pop()  # the lowest: each depth has one at most
        total = list(own[centroid])
        child: dict[int, int] = {}
        split: dict[int, list[int]] = {}
        rest = []
        for k in part:
            if k == centroid:
                continue
            top = k if above[k] == centroid else child.get(above[k])
            if top is None:
                rest.append(k)
                continue
            child[k] = top
            split.setdefault(top, []).append(k)
            total = [a + b for a, b in zip(total, own[k])]
        for k in heavy:
            weight[k] -= weight[centroid]
            got[k] = [a + b for a, b in zip(got[k], total)]
        got[centroid] = [a + b for a, b in zip(got[centroid], total)]
        waiting += [x for x in (rest, *split.values()) if x]
    return [(row[2], row[3], *got[k]) for k, row in enumerate(rows)]


def end_digests(ends: DataFrame) -> DataFrame:
    """top, depth and the digest of the ascending ids of the conversations that end at a node.

    Ids are put together in pieces of ENDS over sorted ranges; a node's pieces are then
    digested in order, one at a time.
    """
    kind = ends.schema["top"].dataType.simpleString()
    order = ["top", "depth", "conv_id"]
    rows = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = rows.mapInArrow(_join_ids, f"top {kind}, depth long, conv_id {kind}, ids string")
    pieces = pieces.repartition("top", "depth").sortWithinPartitions(*order)
    return pieces.mapInArrow(_digest, f"top {kind}, depth long, ends_sha256 string")


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("top", "depth", "conv_id")]
        out: list[tuple] = []
        now, ids = None, []
        for top, depth, conv in zip(*columns):
            if now != (top, depth) or len(ids) == ENDS:
                if ids:
                    out.append((*now, ids[0], ",".join(map(str, ids))))
                now, ids = (top, depth), []
            ids.append(conv)
        if ids:
            out.append((*now, ids[0], ",".join(map(str, ids))))
            kind = batch.column("top").type
            yield _rows(out, ["top", "depth", "conv_id", "ids"], [kind, pa.int64(), kind, pa.string()])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest, kind = None, None, None
    for batch in batches:
        out, kind = [], batch.column("top").type
        for top, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("top", "depth", "ids"))):
            if now == (top, depth):
                digest.update(b",")
            else:
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = (top, depth), hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield _rows(out, ["top", "depth", "ends_sha256"], [kind, pa.int64(), pa.string()])
    if now is not None:
        yield _rows([(*now, digest.hexdigest())], ["top", "depth", "ends_sha256"], [kind, pa.int64(), pa.string()])


def rebuild(turns: DataFrame, convs: DataFrame, lender: Column, take: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from another one, and their ids.

    Of `turns` (conv_id, place, ...) and `convs` (conv_id, n): the conversation `lender`, an
    expression over conv_id, lends its first `take` turns, `most` at the most; all, if it
    has fewer, none, if it is absent. The own turns from `take` on follow.
    """
    wanted = convs.select("conv_id", lender.alias("lender"), take.cast("bigint").alias("take"))
    lenders = convs.select(F.col("conv_id").alias("lender"), F.col("n").alias("lent"))
    wanted = stage_table(wanted.join(lenders, "lender", "left").na.fill(0, ["lent"]), "rebuilt")
    others = [c for c in turns.columns if c not in ("conv_id", "place")]
    own = turns.join(wanted, "conv_id").filter("place >= take")
    place = F.col("place") - F.col("take") + F.least("take", "lent")
    own = own.select("conv_id", place.alias("place"), *others)
    lent = turns.filter(F.col("place") < most).withColumnRenamed("conv_id", "lender")
    lent = lent.join(wanted.select("conv_id", "lender", "take"), "lender").filter("place < take")
    return own.unionByName(lent.select("conv_id", "place", *others)), wanted.select("conv_id")
