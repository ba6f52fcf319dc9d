"""Rules that stop a job.

Each guard runs one aggregate (plus a bounded example fetch when it fails) and
raises ``DataContractError``.  Report-style versions return a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.errors import DataContractError

EXAMPLES = 10


def examples(df: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """T-05: the first few offending rows, in a fixed order."""
    return df.orderBy(*df.columns).limit(n)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise DataContractError(f"missing columns: {missing}")
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    bad = duplicate_keys(df, keys).limit(EXAMPLES).collect()
    if bad:
        raise DataContractError(f"{what}: duplicate keys {[r.asDict() for r in bad]}")
    return df


def require_none(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """Raise when any row satisfies ``bad``."""
    hits = df.filter(bad).limit(EXAMPLES).collect()
    if hits:
        raise DataContractError(f"{message}: {[r.asDict() for r in hits]}")
    return df


def fail_when(bad: Column, message: str, value: Column) -> Column:
    """``value``, or a run-time error in the same pass when ``bad`` holds."""
    return F.when(bad, F.raise_error(F.lit(message))).otherwise(value)


def report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row per named check: violations, PASS or FAIL.  A single aggregate."""
    sums = df.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    return (
        sums.unpivot([], list(checks), "check_name", "n_bad")
        .withColumn("status", F.when(F.col("n_bad") == 0, "PASS").otherwise("FAIL"))
    )
