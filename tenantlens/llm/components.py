"""Connected components by alternating large and small stars, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantlens.llm.common import stored


def _both(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.unionByName(turned)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    around = _both(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes with an edge (a, b).

    Hubs are split by adaptive execution in the joins and merged by the partial
    minimum before the groupings. Each round ends in a written table.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, before = stored(pairs.distinct(), "edges"), None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        current = stored(_small_star(_large_star(current).distinct()).distinct(), "edges")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
