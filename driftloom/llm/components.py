"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import cut


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of node and neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge; component is its smallest reachable node.

    ``edges`` has columns a and b of one type; loops and repeated edges are
    allowed. Rounds go on until the edges are a forest of stars, which takes a
    number of rounds logarithmic in the number of nodes. Each round is
    a few aggregations with partial sums and joins that Spark may split when a
    node is hot; only a count and a checksum reach the driver.
    """
    edges = cut(edges.select("a", "b").where("a <> b").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = cut(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
