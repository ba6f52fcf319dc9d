"""Connected components as DataFrame rounds; no link or label reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finecast.llm.shared import written


def _low(edges: DataFrame) -> DataFrame:
    """Smallest of each node's neighbours and itself (combined before the shuffle)."""
    return edges.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): component is the smallest node reachable, itself included.

    Rounds of large-star and small-star (each a minimum per node, combined
    map-side, and one join) until the stars no longer change; the number of
    rounds grows with the logarithm of the longest path.  Joins are the only
    steps keyed by a node, so a hub of any degree is a skewed join, which
    adaptive execution splits.  Each round is written to the shared folder.
    Null ends, self links and repeated links are ignored.  Nodes without a link
    do not appear.
    """
    edges = (
        links.select(F.col(left).alias("a"), F.col(right).alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = written(edges, "stars")
    before = _state(edges)
    while before[0]:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where("v > u").join(_low(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = written(large.distinct(), "stars")
        low = _low(large)
        small = (
            large.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = written(small, "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
