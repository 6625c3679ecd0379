"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from almsflow.runtime import cut_lineage


def _lowest_neighbour(edges: DataFrame) -> DataFrame:
    """For each node the lowest of itself and its neighbours; partial minima are taken before the shuffle."""
    return edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected edges ``(a, b)``; the root is the smallest node.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its
    lowest neighbour, then every node hands its smaller ones. Each halves the depth, and the number
    of edges never grows. A node with very many neighbours is a hot key only of joins, which
    adaptive execution can split.
    """
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut_lineage(_lowest_neighbour(both))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct())
        large = cut_lineage(large)
        low = cut_lineage(_lowest_neighbour(large))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b")).where("a <> b")
        edges = cut_lineage(small.distinct())
