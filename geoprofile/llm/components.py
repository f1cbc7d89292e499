"""Connected components of an edge table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_checkpoint


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Join every node's neighbours (all, or the smaller ones) to the least of them and itself."""
    u, v = F.col("u"), F.col("v")
    both = edges.unionByName(edges.select(v.alias("u"), u.alias("v"))) if larger_only else edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if larger_only:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of every node of ``edges`` (u, v: long); loops and repeats are allowed.

    Every round's edges are written to the shared checkpoint folder.  The rounds
    grow with the logarithm of the longest chain, not with the number of nodes.
    """
    now = shared_checkpoint(edges.select("u", "v").filter("u <> v").distinct())
    mark = None
    while True:
        now = shared_checkpoint(_star(_star(now, True), False))
        # ends when a round changes nothing: count and checksum of the edges
        found = tuple(now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).first())
        if found == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = found
