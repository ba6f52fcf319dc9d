"""Reading, publishing and describing tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finecast.errors import DataContractError
from finecast.functions.names import match_key
from finecast.sources.ledger import Ledger

#: Layers that a published table holds before they become one.
LAYERS = 8


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet") -> DataFrame:
    """S-01: CSV or parquet scan with a declared schema.

    A CSV header with a repeated label is refused before the scan.
    """
    if fmt == "csv":
        head = spark.read.text(path).limit(1).first()
        labels = [] if head is None else [c.strip().strip('"') for c in head[0].split(",")]
        repeated = sorted({c for c in labels if labels.count(c) > 1})
        if repeated:
            raise DataContractError(f"duplicate columns: {repeated}")
        reader = spark.read.option("header", True).option("enforceSchema", False)
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    if fmt != "parquet":
        raise ValueError(fmt)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite") -> None:
    """S-07: one folder per key combination.

    Rows are rebalanced by key: adaptive execution splits what a key holds by
    its measured size, so a hot key is written by as many tasks as it needs and
    a small one by one.
    """
    df.hint("rebalance", *[F.col(k) for k in keys]).write.mode(mode).partitionBy(*keys).parquet(path)


def publish(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """S-08: readers see the old data until all new ones are written, then the new ones, at every moment one of them.

    Data go to a folder of their own, a layer; a ledger beside it then lists it.
    With keys, rows whose keys are among the new data's are replaced and the
    others stay: a layer keeps its distinct keys beside its rows, and readers
    leave out older rows that a newer layer has the keys of.  So files follow
    the size of the data, not the number of keys, and a publish reads nothing
    but what it wrote; ``LAYERS`` layers are merged into one.  Of two writers
    that start from one state the second fails with ``ConcurrentWrite``; a
    failed job leaves everything as it was.  Read with :func:`published`.
    """
    spark, ledger, keys = df.sparkSession, Ledger(df.sparkSession, path), list(keys)
    version, state = ledger.head()
    layers = state.get("layers", []) if keys else []
    new = {"folder": _write_layer(df, ledger.path, keys), "by": keys}
    if not keys:
        layers = [new]
    elif not spark.read.parquet(f"{ledger.path}/{new['folder']}/keys").isEmpty():
        layers = [*layers, new]
    if len(layers) > LAYERS:
        layers = [{"folder": _write_layer(_merged(spark, ledger.path, layers), ledger.path, keys), "by": keys}]
    ledger.commit(version, {"layers": layers, "folders": [x["folder"] for x in layers]})


def _write_layer(df: DataFrame, path: str, keys: Sequence[str]) -> str:
    """Folder of a new layer: its rows, near each other by key, and its distinct keys."""
    folder = f"data-{uuid.uuid4().hex}"
    near = df.hint("rebalance", *[F.col(k) for k in keys]).sortWithinPartitions(*keys) if keys else df
    near.write.parquet(f"{path}/{folder}/rows")
    if keys:
        df.sparkSession.read.schema(df.schema).parquet(f"{path}/{folder}/rows").select(*keys).distinct().write.parquet(f"{path}/{folder}/keys")
    return folder


def _merged(spark: SparkSession, path: str, layers: Sequence[Mapping], schema: StructType | str | None = None) -> DataFrame:
    """Rows of all layers, oldest first, without those whose keys a newer layer has."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    parts = [reader.parquet(f"{path}/{x['folder']}/rows").withColumn("_layer", F.lit(i)) for i, x in enumerate(layers)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for by in sorted({tuple(x["by"]) for x in layers[1:]}):
        named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(by)]
        found = [spark.read.parquet(f"{path}/{x['folder']}/keys").select(*named, F.lit(i).alias("_newer")) for i, x in enumerate(layers) if i and tuple(x["by"]) == by]
        newest = reduce(DataFrame.unionByName, found).groupBy(*[f"_key{i}" for i in range(len(by))]).agg(F.max("_newer").alias("_newer"))
        same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(by)]
        rows = rows.join(newest, reduce(lambda a, b: a & b, [*same, F.col("_layer") < F.col("_newer")]), "left_anti")
    return rows.drop("_layer")


def published(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """What was last published at ``path``; a ``schema`` has the keys too."""
    ledger = Ledger(spark, path)
    layers = ledger.head()[1].get("layers", [])
    if not layers:
        raise DataContractError(f"nothing was published at {path}")
    return _merged(spark, ledger.path, layers, schema)


def manifest(df: DataFrame, keys: Sequence[str], date_col: str | None = None, policy: Mapping[str, bool] | None = None) -> DataFrame:
    """S-09: one row: rows, columns, distinct and repeated keys, date range, policy flags as JSON."""
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *([F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi")] if date_col else [])
    )
    out = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.lit(len(df.columns)).alias("column_count"),
        F.count(F.lit(1)).alias("distinct_keys"), F.count_if(F.col("_n") > 1).alias("repeated_keys"),
        *([F.min("_lo").alias("first_date"), F.max("_hi").alias("last_date")] if date_col else []),
    )
    return out.withColumn("policy", F.lit(json.dumps(dict(policy or {}), sort_keys=True)))


def write_manifest(row: DataFrame, path: str) -> None:
    """One JSON object; the frame has a single row by construction."""
    row.coalesce(1).write.mode("overwrite").json(path)


def check_contract(df: DataFrame, required: Sequence[str], location: Mapping[str, str] | None = None) -> DataFrame:
    """S-10: has the columns, at least one row, and only rows of the location (names compared loosely)."""
    missing = [c for c in required if c not in df.columns]
    away = F.lit(False)
    for c, v in (location or {}).items():
        if c in df.columns:
            key = "".join(ch for ch in v.lower() if ch.isalnum())
            away = away | ~match_key(F.col(c)).eqNullSafe(F.lit(key))
    r = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(away).alias("foreign_rows"))
    met = (F.col("n_rows") > 0) & (F.col("foreign_rows") == 0) & F.lit(not missing)
    return r.select(
        "n_rows", "foreign_rows", F.lit(",".join(missing)).alias("missing_columns"),
        F.when(met, "PASS").otherwise("FAIL").alias("status"),
    )


def resolve_location(requests: DataFrame, registry: DataFrame, names: Sequence[str]) -> DataFrame:
    """S-06: requests matched by letters and digits only: RESOLVED, AMBIGUOUS or MISSING.

    The registry is first reduced to one row per normalised key with the
    number of official spellings behind it, so the join cannot multiply rows.
    """
    keys = [f"_k_{n}" for n in names]

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({k: match_key(F.col(n)) for k, n in zip(keys, names)})

    official = keyed(registry.select(*names).distinct()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_matches"), F.min(F.struct(*names)).alias("_o")
    )
    j = keyed(requests).join(official, keys, "left")
    n = F.coalesce("n_matches", F.lit(0))
    return j.select(
        *requests.columns, n.alias("n_matches"), *[F.when(n == 1, F.col(f"_o.{c}")).alias(f"official_{c}") for c in names],
        F.when(n == 1, "RESOLVED").when(n > 1, "AMBIGUOUS").otherwise("MISSING").alias("status"),
    )


def require_resolved(resolved: DataFrame) -> DataFrame:
    bad = resolved.filter("status <> 'RESOLVED'").limit(10).collect()
    if bad:
        raise DataContractError(f"locations not resolved: {[r.asDict() for r in bad]}")
    return resolved
