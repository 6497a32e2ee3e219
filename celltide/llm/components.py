"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.llm.common import staged
from celltide.storage import shared_root


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = staged(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (``a``, ``b`` long); a component is named by its smallest node.

    Each round is cut off by ``checkpoint()``, and each node's smallest neighbour is written before it is joined, so that the
    neighbours of a node that very many have can be dealt anew; rounds go on until the edges stay the same, when each node has one edge,
    to its component.  Null ends and loops are ignored.
    """
    shared_root(edges.sparkSession)  # where checkpoints go
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = _state(edges)
    while before[0]:
        edges = _small_star(_large_star(edges)).checkpoint()
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
