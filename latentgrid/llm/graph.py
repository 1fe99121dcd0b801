"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentgrid.llm.common import written

MAX_ROUNDS = 60


def _big_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest node of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them (edges have u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges(a, b)``; root is the smallest node reachable.

    Every round is a pair of joins and is written to the shared scratch folder. Nothing but
    one row of counts reaches the driver. Rounds grow with the logarithm of the longest path.
    Loops, repeated edges and null ends are ignored; an empty table gives an empty one.
    """
    a, b = F.col("a"), F.col("b")
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .where(a.isNotNull() & b.isNotNull() & (a != b)).distinct(), "edges")
    mark = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before = now.agg(*mark).first()
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        now = written(_small_star(_big_star(now)), "edges")
        after = now.agg(*mark).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    node = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return node.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
