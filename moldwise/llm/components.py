"""Connected components of an edge table by large-star and small-star rounds (joins and aggregates only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moldwise.session import reliable_checkpoint


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the node's smallest neighbour (or the node)."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours and the node itself are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of the edges (a, b) can reach.

    Rounds go on until the edges no longer change; each is checkpointed in the
    shared folder.  Loops and repeated edges change nothing; no edges, no rows.
    """
    now = reliable_checkpoint(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(now)
    while before[0]:
        now = reliable_checkpoint(_small_star(_large_star(now)))
        after = _state(now)
        if after == before:
            break
        before = after
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
