"""Connected components of a graph whose edges are a DataFrame, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.llm.common import release, stash


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the least node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, component) for every node that has an edge to another; component is the least node of its component.

    Edges from a node to itself and edges with a null end are left out; repeated edges and either
    direction count once; no edges give no rows.
    Each round writes its edges to the shared folder; only counts and sums reach the driver.
    """
    edges = stash(edges.filter("a <> b"))
    seen = None
    while True:
        old, edges = edges, stash(_small(_large(edges)))
        release(old)
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if now["n"] == 0 or (now["n"], now["x"]) == seen:
            break
        seen = (now["n"], now["x"])
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
