"""Connected components by alternating large-star and small-star rounds (Kiveris and others, 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._shared import staged


def _stars(edges: DataFrame) -> bool:
    """Whether each u has one v and no v is a u: then every v is the root of its component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")).distinct())
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least")).filter("up > 1 or (up = 1 and least = 0)").isEmpty()


def components(links: DataFrame, name: str) -> DataFrame:
    """node, root for every node of links(u, v); root is the smallest node reachable. Nodes are of one sortable type.

    Each round is two joins and aggregates over the links left. Minima are taken by partition first; the joins by node
    rely on adaptive execution to split the links of a hub over tasks. The rounds grow with the logarithm of the longest path.
    """
    edges = staged(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = staged(small.distinct(), f"{name}-links")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
