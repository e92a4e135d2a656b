"""Connected components of an undirected graph that is kept as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.storage import cut, discard


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "low").alias("low"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = down.join(_lowest(down), "u")
    return (
        tied.select(F.col("v").alias("u"), F.col("low").alias("v"))
        .union(tied.select("u", F.col("low").alias("v")))
        .where("u <> v")
        .distinct()
    )


def _run_is_done(edges: DataFrame) -> bool:
    """Whether every node hangs on one other that hangs on none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    roles = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return not roles.where("below > 1 or below = 1 and above = 1").head(1)


def run_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (u, v; longs): the least node that it is connected with.

    Large-star and small-star steps alternate until all nodes hang on their least one, a number of
    rounds that grows with the logarithm of the longest path. Each round is a few sums by node and joins on it, so a
    node with very many edges is combined before the shuffle or split by the join. Loops, repeated
    edges and nulls are ignored.
    """
    current = cut(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while not _run_is_done(current):
        following = cut(_small_star(_large_star(current)))
        discard(current)
        current = following
    lows = current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).union(lows)
