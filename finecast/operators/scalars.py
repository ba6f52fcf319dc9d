"""Single values as scalar subqueries, so that no join is needed to use them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def one_row(spark: SparkSession, values: dict[str, DataFrame]) -> DataFrame:
    """One row from frames that hold one value each: ``{column name: frame}``."""
    return spark.range(1).select(*[df.scalar().alias(n) for n, df in values.items()])
