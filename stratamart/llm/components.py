"""Connected components of a large graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the least node near it."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).union(least)


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b) but the least node of each component, its root.

    Each round is written to the shared folder; minima are aggregated before the shuffle and joined
    back, so a node with very many neighbours is never gathered into one task.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = written(edges, "edges"), None
    while before != (now := tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())):
        before = now
        if not now[0]:
            break
        edges = written(_small_star(_large_star(edges).distinct()).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
