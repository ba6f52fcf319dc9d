"""Hourly payloads that arrive as parallel arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finecast.errors import DataContractError


def read_payloads(spark: SparkSession, path: str, variables: Sequence[str], ids: str) -> DataFrame:
    """Landed JSON responses, one document per line: ids plus ``hourly.{time, variable...}``."""
    arrays = ", ".join(f"{v}: array<double>" for v in variables)
    return spark.read.schema(f"{ids}, hourly struct<time: array<string>, {arrays}>").json(path)


def explode_hourly(df: DataFrame, keys: Sequence[str], variables: Sequence[str], strict: bool = True, root: str = "hourly") -> DataFrame:
    """S-02: one row per hour.

    Strict: a variable missing from the schema or absent in a payload fails.
    Lenient: it becomes NULL.  In both, an array of another length than ``time``
    and a time that cannot be read fail the job.
    """
    present = {f.name for f in df.schema[root].dataType.fields}
    gone = [v for v in variables if v not in present]
    if gone and strict:
        raise DataContractError(f"payload lacks variables: {gone}")
    n = F.size(f"{root}.time")
    arrays = []
    for v in variables:
        nulls = F.array_repeat(F.lit(None).cast("double"), n)
        if v in gone:
            a = nulls
        else:
            a = F.col(f"{root}.{v}")
            absent = F.raise_error(F.lit(f"{v}: absent from a payload")).cast("array<double>") if strict else nulls
            wrong = F.raise_error(F.lit(f"{v}: length differs from time")).cast("array<double>")
            a = F.when(a.isNull(), absent).when(F.size(a) == n, a).otherwise(wrong)
        arrays.append(a.alias(v))
    zipped = F.arrays_zip(F.col(f"{root}.time").alias("time"), *arrays)
    out = df.select(*keys, F.explode(zipped).alias("h")).select(*keys, "h.*")
    raw = F.col("time").cast("string")
    read = F.coalesce(F.try_to_timestamp(raw), F.raise_error(F.concat(F.lit("not a time: "), F.coalesce(raw, F.lit("NULL")))).cast("timestamp"))
    return out.withColumn("time", read)
