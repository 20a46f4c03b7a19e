"""Connected components of a graph in DataFrames, by alternating large and small stars.

A round links every node to the least node next to it: large stars move the larger neighbours of a node to its least
neighbour, small stars the smaller ones.  Rounds go on until only stars around least nodes are left; their number grows with the logarithm of
the longest path.  Each round is aggregates by key and joins, so a node with very many neighbours is split like any
skewed join, and each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireloom.llm.storage import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, F.col("a") == F.col("c")).select(F.col("m").alias("a"), "b").filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Of edges with a < b: the smaller neighbours of b, and b, move to b's least neighbour."""
    least = edges.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "c")
    moved = edges.join(least, F.col("b") == F.col("c")).filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), F.col("c").alias("b")))


def _settled(edges: DataFrame) -> bool:
    """Whether edges (a < b) are stars around their least nodes: no b is met twice or is an a as well."""
    ends = edges.select(F.col("a").alias("n"), F.lit(0).alias("below")).unionByName(edges.select(F.col("b").alias("n"), F.lit(1).alias("below")))
    met = ends.groupBy("n").agg(F.sum("below").alias("below"), F.count("*").alias("ends"))
    return met.filter("below > 1 or (below = 1 and ends > 1)").isEmpty()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of every node with an edge to another one; the component is its least node.

    Edges with a null end, loops and repeated edges are harmless.
    """
    first = edges.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"), F.col(left).isNotNull() & F.col(right).isNotNull())
    now = stored(first.filter(first[2]).filter("a <> b").select("a", "b").distinct(), "edges")
    while not _settled(now):
        stars = stored(_large_star(now).distinct(), "edges")
        discard(now)
        now = stored(_small_star(stars).distinct(), "edges")
        discard(stars)
    members = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
