"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import kept


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge, the component being its smallest node.

    Self-links and repeated links do no harm; no links give no rows. A node with very many links is
    never gathered in one task: it meets them in minima with map-side combine and in joins.
    """
    edges = kept(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    )
    state = None
    while True:
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if found == state:
            break
        state = found
        edges = kept(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
