"""Row sets: union, distinct keys, key differences, first/last-wins dedup."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_chunks(*frames: DataFrame) -> DataFrame:
    """U-01: stack frames by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U-02."""
    return df.select(*keys).distinct()


def key_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U-03: every key once with its side: LEFT_ONLY, RIGHT_ONLY or BOTH.

    One shuffle on the key; map-side combine keeps hot keys to one row per task.
    """
    tagged = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    both = tagged.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    side = (
        F.when((F.col("l") == 1) & (F.col("r") == 1), "BOTH")
        .when(F.col("l") == 1, "LEFT_ONLY")
        .otherwise("RIGHT_ONLY")
    )
    return both.select(*keys, side.alias("side"))


def dedupe(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], keep: str = "last"
) -> DataFrame:
    """U-04: one row per key, the first or last by ``order``.

    Written as an aggregate, not a ranked window: partial ``max_by`` leaves one
    candidate per key and task before the shuffle, so a hot key costs nothing
    extra.  The remaining columns break ties, which makes the choice
    reproducible after a lost executor.
    """
    if keep not in ("first", "last"):
        raise ValueError(keep)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    wanted = [F.col(o) if isinstance(o, str) else o for o in order]
    rank = F.struct(
        *[o.alias(f"o{i}") for i, o in enumerate(wanted)], *[F.col(c).alias(f"t_{c}") for c in rest]
    )
    pick = F.max_by if keep == "last" else F.min_by
    row = pick(F.struct(*rest), rank).alias("_row")
    out = df.groupBy(*keys).agg(row)
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
