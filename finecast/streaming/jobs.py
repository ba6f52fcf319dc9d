"""Structured Streaming forms of the incremental pulls.

All jobs run with ``availableNow``: they take what has landed, checkpoint and
stop, so a scheduler can start them as often as new files arrive.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructType

from finecast.sources.keyed import KeyedArchive
from finecast.sources.ledger import Ledger


def landed(spark: SparkSession, src: str, schema: StructType, files_per_batch: int = 1000, pattern: str | None = None) -> DataFrame:
    """Parquet files as a stream, oldest first.  ``pattern`` narrows the folder to one table."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(src)


def _start(df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .outputMode(mode).trigger(availableNow=True).start()
    )


def _each(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _name(batch: DataFrame, checkpoint: str) -> str:
    """Id of the query that keeps ``checkpoint``, which names it before its first batch."""
    return json.loads(batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def start_archive(
    stream: DataFrame, sink: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]
) -> StreamingQuery:
    """Z-01: exactly-once archive; the newest arrival per key wins.

    Each micro-batch is one append to a :class:`KeyedArchive`, named by the
    query's id and the batch number.  A batch repeated after a failure is known
    to the archive's ledger and skipped; a query with a fresh checkpoint has
    another id, so its batches are appended behind what is there.
    """
    spark, schema = stream.sparkSession, StructType(stream.schema.fields)

    def write(batch: DataFrame, batch_no: int) -> None:
        KeyedArchive(spark, sink, schema, keys, order).append(batch, _name(batch, checkpoint), batch_no)

    return _each(stream, checkpoint, write)


def read_archive(spark: SparkSession, sink: str, schema: StructType, keys: Sequence[str], order: Sequence[str], wanted: DataFrame | None = None) -> DataFrame:
    """Current state of the archive, or of ``wanted`` keys."""
    return KeyedArchive(spark, sink, schema, keys, order).read(wanted)


def compact_archive(spark: SparkSession, sink: str, target: str, schema: StructType, keys: Sequence[str], order: Sequence[str]) -> None:
    """Write the current state elsewhere, for readers that want plain parquet."""
    read_archive(spark, sink, schema, keys, order).write.mode("overwrite").parquet(target)


def daily_completeness(stream: DataFrame, ts: str, by: Sequence[str], value: str, delay: str = "1 day") -> DataFrame:
    """Z-02: tumbling daily mean, sum and number of distinct hours.

    Hours are a 24-bit set in the aggregation state, so the state stays a few
    bytes per group whatever the number of rows.
    """
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("w"), *by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"), F.avg(value).alias("mean_value"), F.sum(value).alias("sum_value"),
            F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(ts)))).alias("n_hours"),
        )
        .select(F.to_date("w.start").alias("day"), *by, "n_rows", "mean_value", "sum_value", "n_hours",
                (F.col("n_hours") == 24).alias("complete"))
    )


def start_daily(stream: DataFrame, sink: str, checkpoint: str, ts: str, by: Sequence[str], value: str, delay: str = "1 day") -> StreamingQuery:
    return _start(daily_completeness(stream, ts, by, value, delay), sink, checkpoint)


def start_dedup(stream: DataFrame, sink: str, checkpoint: str, keys: Sequence[str], ts: str, delay: str = "7 days") -> StreamingQuery:
    """Z-03: first arrival per key within the watermark; for last-wins use the archive job."""
    return _start(stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys)), sink, checkpoint)


def sliding_means(stream: DataFrame, ts: str, by: Sequence[str], value: str, length: str = "7 days", step: str = "1 day",
                  delay: str = "1 day") -> DataFrame:
    """Z-04: sliding look-back means."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, length, step).alias("w"), *by)
        .agg(F.avg(value).alias("mean_value"), F.count(value).alias("n_values"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "mean_value", "n_values")
    )


def start_sliding(stream: DataFrame, sink: str, checkpoint: str, ts: str, by: Sequence[str], value: str, **windows) -> StreamingQuery:
    return _start(sliding_means(stream, ts, by, value, **windows), sink, checkpoint)


def start_guarded(stream: DataFrame, sink: str, checkpoint: str, ts: str, delay: str = "7 days") -> StreamingQuery:
    """Z-05: rows in time and late rows side by side, with the counts of every batch.

    A row is late when its ``ts`` lies more than ``delay`` before the newest
    ``ts`` of all earlier batches; a row without ``ts`` is late too.  Each batch
    is written once, split in two folders; its counts are those of the rows
    written, kept in a file of their own, so neither their number nor a restart
    limits them.  The newest ``ts`` is in a ledger beside the rows: a batch that
    comes again is written over itself or skipped, and a fresh checkpoint goes
    on behind the same mark.  Absent dates stay absent: no job here fills a gap.

    Read with :func:`in_time`, :func:`late_rows` and :func:`late_counts`.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_no: int) -> None:
        ledger, source = Ledger(spark, sink), _name(batch, checkpoint)
        version, state = ledger.head()
        if state.get("applied", {}).get(source, -1) >= batch_no:
            return
        no, mark = state.get("batches", 0), F.lit(state.get("newest")).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.coalesce(F.col(ts).isNull() | (F.col(ts) < mark), F.lit(False))
        path = f"{sink}/rows/batch_no={no}"
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(path)
        full = StructType(list(batch.schema.fields)).add("late", BooleanType())
        n, n_late, newest = spark.read.schema(full).parquet(path).agg(
            F.count(F.lit(1)), F.count_if("late"), F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        ).first()
        newest = max(filter(None, (newest, state.get("newest"))), default=None)
        ledger.write(f"counts/{no:09d}.json", json.dumps({"batch_no": no, "rows_in": n, "rows_late": n_late}))
        ledger.commit(version, {"applied": state.get("applied", {}) | {source: batch_no}, "batches": no + 1, "newest": newest, "folders": []})

    return _each(stream, checkpoint, write)


def _guarded(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType(list(schema.fields)).add("late", BooleanType()).add("batch_no", LongType())).parquet(f"{sink}/rows")


def in_time(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    """Rows of :func:`start_guarded` that were in time, with ``batch_no``."""
    return _guarded(spark, sink, schema).filter("not late").drop("late")


def late_rows(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    """Rows that came behind the mark, with ``batch_no``."""
    return _guarded(spark, sink, schema).filter("late").drop("late")


def late_counts(spark: SparkSession, sink: str) -> DataFrame:
    """(batch_no, rows_in, rows_late) of every batch there ever was."""
    return spark.read.schema("batch_no long, rows_in long, rows_late long").json(f"{sink}/counts")


def late_policy(progress: list[dict]) -> dict[str, int]:
    """Rows read and rows that a stateful step dropped, summed over the progress records at hand (the last ones only).

    For counts of all batches and the rows themselves put :func:`start_guarded` before the step.
    """
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p.get("stateOperators", []))
    return {"rows_in": sum(p.get("numInputRows", 0) for p in progress), "rows_dropped_late": dropped}


def finish(query: StreamingQuery) -> dict[str, int]:
    """Wait for an availableNow job and return its late-row counts."""
    query.awaitTermination()
    return late_policy([p if isinstance(p, dict) else json.loads(p.json) for p in query.recentProgress])
