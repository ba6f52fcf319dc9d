"""Where queries and their SQL twins are declared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finecast.plans.frames import Frames

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Sums of doubles depend on their order in the last bits.  Both engines shift
# by less than any printed digit before rounding, so that exact halves (which
# means of hundredths do hit) fall on the same side.
NUDGE = 1.1e-9


def settled(df: DataFrame, digits: int) -> DataFrame:
    """Double columns rounded for comparison."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`") + F.lit(NUDGE), digits).alias(f.name)
            if f.dataType.typeName() == "double"
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def r(expr: str, digits: int = 4) -> str:
    """SQL text of the same rounding; ``+ 0.0`` turns minus zero into zero."""
    return f"(round(({expr}) + {NUDGE!r}, {digits}) + 0.0)"


def query(name: str, sql: str | None = None, digits: int = 4):
    """Register ``fn(frames) -> DataFrame`` under ``name`` with its SQL twin."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} declared twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return settled(fn(Frames(spark, sf_dir)), digits)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep
