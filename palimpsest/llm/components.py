"""Connected components by alternating large-star and small-star rounds, each stored before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palimpsest.session import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def state(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is the smallest node that can be reached.

    A node of high degree costs partial minima and a join that adaptive execution splits, never one task's list.
    Edges from a node to itself and edges with a null end are dropped. The number of rounds grows with the
    logarithm of the longest path.
    """
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    named = edges.where("u is not null and v is not null").select(F.explode(F.array("u", "v")).alias("node"))
    current = stored(pairs.distinct(), "edges")
    before, now = None, state(current)
    while now[0] and now != before:
        current = stored(small_star(large_star(current).distinct()).distinct(), "edges")
        before, now = now, state(current)
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = named.distinct().join(stars.select("node"), "node", "left_anti")
    return stars.union(roots.select("node", F.col("node").alias("component")))
