"""Connected components of a distributed edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlane.llm import common


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round on edges (a, b); smaller ends become parents. Hubs meet their minimum in a splittable join."""
    if large:
        pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = pairs.join(least, "a")
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(least.filter("a != m").select("a", F.col("m").alias("b")))
    return common.materialise(out.filter("a != b").distinct())


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the component's smallest node. Self-loops are ignored.

    Rounds grow with the logarithm of the components' diameters. Nothing but two numbers a round reaches the driver.
    Settled edges point from each node to its root; where each node has one edge and no root has any, they are.
    """
    edges = common.materialise(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(most_rounds):
        if _settled(edges):
            break
        edges = _star(_star(edges, True), False)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Is every node the larger end of one edge only, or else the smaller end of some?"""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.filter("up + down > 1").isEmpty()
