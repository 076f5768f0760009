"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.session import stage

MAX_ROUNDS = 60


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a smaller node that has none; a round would change nothing then."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return not per_node.agg(F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("root") == 1)))).first()[0]


def stars(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of longs become one edge (u, v) from every node but the smallest of its component to that node.

    A round joins every neighbour to the smallest one, first among larger, then among smaller nodes. Only the
    smallest neighbour of a node is aggregated, so a node with many edges is never gathered. Every round is
    written to the shared folder; the driver sees one number of it. Rounds end once the edges are stars.
    """
    edges = stage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "edges"
    )
    for _ in range(MAX_ROUNDS):
        if _settled(edges):
            return edges
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = stage(small.filter("u != v").distinct(), "edges")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
