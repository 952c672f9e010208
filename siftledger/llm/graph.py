"""Connected components of undirected links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftledger.session import materialise, release


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's greater (or its own and smaller) neighbours, linked to its least one."""
    both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    if large:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) for every node with a link.

    ``edges``: u and v, long, not NULL. Rounds repeat until all links lead to roots; each
    is written to the shared folder, so a lost executor costs one round at most.
    """
    edges = materialise(edges.where("u <> v").select("u", "v").distinct(), "edges")
    while True:
        for large in (True, False):
            starred = materialise(_stars(edges, large).where("u <> v").distinct(), "edges")
            release(edges)
            edges = starred
        # Done when all links are from greater nodes to roots: no node is on both sides.
        tops = edges.select(F.col("v").alias("u")).distinct()
        if edges.join(tops, "u", "left_semi").isEmpty() and _single(edges):
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(own)


def _single(edges: DataFrame) -> bool:
    return edges.groupBy("u").count().where("count > 1").isEmpty()
