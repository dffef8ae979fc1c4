"""Connected components of an edge table, by alternating stars; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import saved

#: Rounds double what a star reaches, so even a path of 2**40 nodes ends well before.
MAX_ROUNDS = 100


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour is tied to the smallest of a node and its neighbours."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them. Edges point to the smaller end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    ties = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return ties.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _print(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs of long ids to (node, root): each node with an edge, and its component's smallest node."""
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = saved(pairs, "edges")
    before = _print(state)
    for _ in range(MAX_ROUNDS):
        state = saved(_small_star(_large_star(state)), "edges")
        after = _print(state)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    roots = state.select(F.col("v").alias("node")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
