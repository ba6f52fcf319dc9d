"""Keyed archive: batches are appended in buckets of their keys and merged when read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from finecast.operators.sets import dedupe
from finecast.sources.ledger import ConcurrentWrite, Ledger

#: Segments that a level holds before they become one of the level above.
FANOUT = 8


class KeyedArchive:
    """I-03, Z-01: newest arrival per key over any number of batches; ``order`` decides inside a batch.

    A batch becomes one segment: a folder with a subfolder per bucket of its
    keys, so an upsert writes the buckets it has keys in and reads nothing.
    Segments are listed in a ledger, which also knows the last batch applied of
    every source: a batch that comes again is let be, whatever became of the
    job that sent it.  ``FANOUT`` segments of a level are merged into one of the
    next, newest levels first, so a row is rewritten once per level and a
    reader meets a few segments for any number of batches.  The number of
    buckets is fixed when the archive is made.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.order = spark, path.rstrip("/"), schema, list(keys), list(order)
        self.ledger = Ledger(spark, path)
        self.buckets = self.ledger.head()[1].get("buckets", buckets)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """Folder and buckets of a new segment."""
        folder = f"segment-{uuid.uuid4().hex}"
        spread = rows.withColumn("_bucket", self._bucket()).repartition(F.col("_bucket"))
        spread.write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        return folder, [int(n.split("=")[1]) for n in self.ledger.names(folder) if n.startswith("_bucket=")]

    def _commit(self, change) -> None:
        """Apply ``change(state)``, over again while other writers come first; None leaves the state."""
        while True:
            version, state = self.ledger.head()
            new = change({"buckets": self.buckets, "segments": [], "applied": {}, "seq": 0} | state)
            if new is None:
                return
            try:
                self.ledger.commit(version, new | {"folders": [s["folder"] for s in new["segments"]]})
                return
            except ConcurrentWrite:
                continue

    def append(self, batch: DataFrame, source: str | None = None, batch_no: int = 0) -> None:
        """Add a batch; one that the ledger knows from ``source`` already is skipped."""
        if source is not None and self.ledger.head()[1].get("applied", {}).get(source, -1) >= batch_no:
            return
        typed = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        folder, buckets = self._write(dedupe(typed, self.keys, self.order, keep="last"))

        def change(state: dict) -> dict | None:
            if source is not None and state["applied"].get(source, -1) >= batch_no:
                return None
            seq = state["seq"] + 1
            added = [{"folder": folder, "buckets": buckets, "level": 0, "seq": seq}] if buckets else []
            applied = state["applied"] | ({source: batch_no} if source is not None else {})
            return state | {"segments": state["segments"] + added, "applied": applied, "seq": seq}

        self._commit(change)
        self.compact()

    def _rows(self, segments: list[dict], only: set[int] | None) -> DataFrame:
        full = StructType(list(self.schema.fields)).add("_bucket", IntegerType())
        parts = []
        for s in segments:
            paths = [f"{self.path}/{s['folder']}/_bucket={b}" for b in s["buckets"] if only is None or b in only]
            if paths:
                parts.append(self.spark.read.schema(full).option("basePath", f"{self.path}/{s['folder']}").parquet(*paths).withColumn("_seq", F.lit(s["seq"])))
        none = self.spark.createDataFrame([], StructType(list(full.fields)).add("_seq", IntegerType()))
        return reduce(DataFrame.unionByName, parts) if parts else none

    def _merged(self, segments: list[dict], only: set[int] | None = None) -> DataFrame:
        return dedupe(self._rows(segments, only), self.keys, ["_seq", *self.order], keep="last").select(*self.schema.names)

    def read(self, wanted: DataFrame | None = None) -> DataFrame:
        """Current rows; with ``wanted`` (keys) only theirs, from the buckets those keys are in."""
        segments = self.ledger.head()[1].get("segments", [])
        if wanted is None:
            return self._merged(segments)
        keys = wanted.select(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys]).distinct()
        only = {r[0] for r in keys.select(self._bucket()).distinct().collect()}
        same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"w.{k}")) for k in self.keys])
        return self._merged(segments, only).alias("r").join(keys.alias("w"), same, "left_semi")

    def compact(self) -> None:
        """Merge every level that is full; older levels stay as they are."""
        while True:
            segments = self.ledger.head()[1].get("segments", [])
            full = [x for x in sorted({s["level"] for s in segments}) if sum(s["level"] == x for s in segments) >= FANOUT]
            if not full:
                return
            old = [s for s in segments if s["level"] == full[0]]
            folder, buckets = self._write(self._merged(old))
            gone = {s["folder"] for s in old}

            def change(state: dict, old=old, gone=gone, folder=folder, buckets=buckets, level=full[0] + 1) -> dict | None:
                if not gone <= {s["folder"] for s in state["segments"]}:
                    return None
                merged = {"folder": folder, "buckets": buckets, "level": level, "seq": max(s["seq"] for s in old)}
                return state | {"segments": [s for s in state["segments"] if s["folder"] not in gone] + [merged]}

            self._commit(change)
