"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylog.llm.common import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links(a, b)``; the root is the smallest node reachable.

    Every round is two groupings with partial minima and two joins on the node. A node with very many
    links is a skewed join key, which adaptive execution splits; its links are never gathered.
    Rounds grow with the logarithm of the size of the largest component. Each round's table is
    written to the shared folder. Links of a node to itself count as none; a null end drops the link.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    size = _size(edges)
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = _size(edges)
        if now == size:  # number of links and sum of ends: neither changes at the fixed point only
            break
        size = now
    # Every edge now leads from a node to its root.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _size(edges: DataFrame) -> tuple:
    ends = [F.sum(F.col(c).cast("decimal(38,0)")) for c in ("u", "v")]
    return tuple(edges.agg(F.count(F.lit(1)), *ends).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the smallest of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, link to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    to_least = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_least.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
