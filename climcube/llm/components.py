"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation and an equi-join on node identifiers; a node of high degree is
combined before the shuffle and split by AQE in the join.  The edges of each round are written to
the shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` has u > v throughout."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """node, root (its smallest reachable node) for every node that has an edge to another one."""
    edges = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct()
    edges = cut(edges)
    before = None
    while True:
        digest = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if before == digest or not digest[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", F.col("v").alias("root")).distinct()
            )
        before = digest
        edges = cut(_small_star(_large_star(edges)))
