"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.session import stage_table


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node` and `component` (its smallest node) of every node that has an edge to another.

    Each step is one aggregate and one join on the node; minima are combined
    before the shuffle, so a hub costs a row per task. The edges of each round are
    stored in the shared folder. Null ends and loops are left out. Terminates when
    every edge joins a node with its component's smallest node.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    pairs = stage_table(_ordered(pairs), "edges")
    while True:
        pairs = stage_table(_small_star(_large_star(pairs)), "edges")
        # Done when the edges are stars around smaller nodes: no lower end is an upper end, no upper end has two lower ones.
        ends = pairs.select("u", F.lit(1).alias("up")).union(pairs.select(F.col("v").alias("u"), F.lit(0)).distinct())
        if ends.groupBy("u").agg(F.sum("up").alias("up"), F.min("up").alias("low")).filter("up > low").isEmpty():
            break
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.union(roots).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(pairs: DataFrame) -> DataFrame:
    """Joins each larger neighbour of a node with the smallest node beside it."""
    both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Joins a node and its smaller neighbours with the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
