"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import stored


def _least(edges: DataFrame) -> DataFrame:
    """Each edge a, b with m, the smallest neighbour of a (a hot a is a row of the sums and a skewed join, not a group)."""
    return edges.join(edges.groupBy("a").agg(F.min("b").alias("m")), "a")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node in it) of every node on an edge; `edges`: columns a and b of one type.

    Every round is written to the shared folder. Edges with a null end and loops are ignored.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    was = _state(edges)
    while was[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _least(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        near = _least(large)
        small = near.select("a", F.col("m").alias("b")).unionByName(near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        edges = stored(small, "edges")
        now = _state(edges)
        if now == was:
            break
        was = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
