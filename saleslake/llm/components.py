"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is two grouped minima with map-side combine and two equi-joins, so a hub that
touches a third of all edges is combined before the shuffle (the minima) or split by the
skew join.  Rounds are cut by tables in the shared folder; the number of rounds grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: columns u, v (long).  Returns node, root for every node that has an edge to
    another node; root is the smallest node of its component (root itself included).

    Self-loops and repeated or reversed edges change nothing; nulls are dropped; no edges give no rows.
    """
    e = written(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = written(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    members = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
