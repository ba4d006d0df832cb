"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewire.llm.shared import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Each round links the neighbours of a node to the smallest of them, first those
    above it, then those below, until all edges run from a node to a root. Neighbourhoods are never
    gathered: a round is a minimum and a join, and a node with very many links is
    split by the join.
    """
    edges = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    while True:
        edges = _star(edges, large=True)
        edges = _star(edges, large=False)
        if _all_stars(edges):
            break
    root = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return settle(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(root), "components")


def _all_stars(edges: DataFrame) -> bool:
    """True when every node has one edge to a smaller one, which itself has none."""
    n = edges.agg(F.count("*").alias("edges"), F.count_distinct("a").alias("nodes")).first()
    if n["edges"] != n["nodes"]:
        return False
    return edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round on edges that run from the larger node ``a`` to the smaller ``b``."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = settle(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    linked = both.join(least, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return settle(out.where("a <> b").distinct(), "stars")
