"""Small helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finecast.session import materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``lower`` is much faster than ``translate`` and gives the same wherever it
    leaves the characters beyond ASCII alone.
    """
    beyond = F.regexp_replace(c, r"[\x00-\x7F]+", "")
    return F.when(F.lower(beyond) == beyond, F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def present(c: Column) -> Column:
    """Null text counts as empty."""
    return F.coalesce(c.cast("string"), F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """Copy in the shared folder: read by several jobs and safe from lost executors."""
    return materialise(df, f"llm-{label}")


def slices(batches, rows: int = 256):
    """Arrow batches cut into pieces of few rows, so that Python holds few texts at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
