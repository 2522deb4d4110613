"""Dated parent/child hierarchies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.session import stage_table


def hierarchy_paths(
    df: DataFrame,
    id_col: str,
    parent_col: str,
    roots: list,
    *,
    eff: str = "eff_dt",
    disc: str = "disc_dt",
) -> DataFrame:
    """Every row reachable from the roots, with the array of ids from root to row.

    A child follows a parent version when its own start lies in that version's
    interval. A row whose parent is itself has no parent. A path never visits
    an id twice, so cycles end and so does the loop.

    Paths double: a round knows all paths from a root of fewer than 2^k steps and all
    ways up of just 2^k steps, and puts the one on top of the other; so a tree of depth
    n takes log2(n) rounds. The nodes are stored once, keyed by a number of their own,
    and so is each round: the plan stays one join deep, and a lost executor costs a
    reread, not the rounds before.
    """
    parent = F.when(F.col(parent_col) != F.col(id_col), F.col(parent_col))
    nodes = df.repartition(F.col(parent_col)).withColumns({"__parent": parent, "__no": F.monotonically_increasing_id()})
    nodes = stage_table(nodes, "nodes")
    up = nodes.select(
        F.col("__no").alias("__above"),
        F.col(id_col).alias("__pid"),
        F.col(eff).alias("__peff"),
        F.col(disc).alias("__pdisc"),
    )
    follows = (F.col("__parent") == F.col("__pid")) & F.col(eff).between(F.col("__peff"), F.col("__pdisc"))
    ways = nodes.join(up, follows).select("__no", "__above", F.array(id_col).alias("__way"))
    ways = stage_table(ways, "ways")
    paths = nodes.filter(F.col(id_col).isin(roots)).select("__no", F.array(id_col).alias("path"))
    rounds = [stage_table(paths, "paths")]
    while True:
        known = reduce(DataFrame.unionByName, rounds)
        longer = _on_top(ways, known.select(F.col("__no").alias("__above"), F.col("path").alias("__on")))
        longer = stage_table(longer.select("__no", F.concat("__on", "__way").alias("path")), "paths")
        if longer.isEmpty():
            return nodes.join(known, "__no").select(*df.columns, "path")
        rounds.append(longer)
        further = ways.select(F.col("__no").alias("__above"), F.col("__above").alias("__top"), F.col("__way").alias("__on"))
        ways = _on_top(ways, further)
        ways = stage_table(ways.select("__no", F.col("__top").alias("__above"), F.concat("__on", "__way").alias("__way")), "ways")


def _on_top(ways: DataFrame, upper: DataFrame) -> DataFrame:
    """Ways up with what goes on from their upper ends, without those that meet an id twice."""
    return ways.join(upper, "__above").filter(~F.arrays_overlap("__way", "__on"))
