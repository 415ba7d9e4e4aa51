"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, skew_join


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v), root being the smallest node reachable.

    Alternating large-star and small-star rounds: each is one aggregate with
    partial minima and one join, and the edge list never leaves the executors.
    A node with very many edges is joined apart (`skew_join`).  Only a count and
    a checksum of the edges come to the driver, to see when nothing changes.
    Rounds grow with the logarithm of a component's diameter.  Loops and
    repeated edges are harmless; no edges give no rows.
    """
    edges = checkpointed(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        large = _large_star(edges, now[0])
        edges = checkpointed(_small_star(large, now[0]))
    # Stars are left: every edge leads from a node to its root.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Each node connects its larger neighbours to the smallest one near it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return skew_join(both, _least(both), "u", "n", 2 * n).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Each node connects itself and its smaller neighbours to the smallest of them; edges come as u > v."""
    joined = skew_join(edges, _least(edges), "u", "n", n)
    return joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
