"""Streams equal batch on the same files, survive restarts, count late rows."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType, TimestampType

from finecast.operators.sets import dedupe
from finecast.streaming import jobs

SCHEMA = StructType().add("k", LongType()).add("ts", TimestampType()).add("area", StringType()).add("v", DoubleType())


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def hour(day, h, minute=0):
    return dt.datetime(2024, 1, day, h, minute)


@pytest.fixture
def dirs(tmp_path):
    return {n: str(tmp_path / n) for n in ("src", "sink", "ckpt", "flat")}


def test_archive_keeps_last_across_restarts(spark, dirs):
    def run():
        s = jobs.landed(spark, dirs["src"], SCHEMA)
        jobs.start_archive(s, dirs["sink"], dirs["ckpt"], ["k"], ["ts"]).awaitTermination()
        return {r["k"]: r["v"] for r in jobs.read_archive(spark, dirs["sink"], SCHEMA, ["k"], ["ts"]).collect()}

    land(spark, dirs["src"], [(1, hour(1, 0), "a", 1.0), (1, hour(1, 1), "a", 2.0), (2, hour(1, 0), "a", 5.0)])
    assert run() == {1: 2.0, 2: 5.0}
    assert run() == {1: 2.0, 2: 5.0}
    land(spark, dirs["src"], [(1, hour(1, 0), "a", 9.0), (3, hour(1, 0), "a", 7.0)])
    assert run() == {1: 9.0, 2: 5.0, 3: 7.0}
    jobs.compact_archive(spark, dirs["sink"], dirs["flat"], SCHEMA, ["k"], ["ts"])
    assert spark.read.parquet(dirs["flat"]).count() == 3


def test_archive_survives_the_loss_of_its_checkpoint(spark, dirs):
    def run(ckpt):
        s = jobs.landed(spark, dirs["src"], SCHEMA, files_per_batch=1)
        jobs.start_archive(s, dirs["sink"], ckpt, ["k"], ["ts"]).awaitTermination()
        return {r["k"]: r["v"] for r in jobs.read_archive(spark, dirs["sink"], SCHEMA, ["k"], ["ts"]).collect()}

    for i in range(3):
        land(spark, dirs["src"], [(i, hour(1, i), "a", float(i))])
    assert run(dirs["ckpt"]) == {0: 0.0, 1: 1.0, 2: 2.0}
    # The files so far have expired; a job with a fresh checkpoint counts batches from 0 again.
    for n in [n for n in os.listdir(dirs["src"]) if n.endswith(".parquet")]:
        os.remove(f"{dirs['src']}/{n}")
    land(spark, dirs["src"], [(9, hour(2, 0), "a", 9.0), (2, hour(2, 0), "a", 20.0)])
    assert run(dirs["ckpt"] + "-2") == {0: 0.0, 1: 1.0, 2: 20.0, 9: 9.0}


def day_rows(day, skip=()):
    return [(day * 100 + h, hour(day, h), "a", float(h)) for h in range(24) if h not in skip]


def test_daily_completeness_equals_batch(spark, dirs):
    land(spark, dirs["src"], day_rows(1) + day_rows(2, skip=(5,)) + [(9, hour(5, 0), "a", 1.0)])
    s = jobs.landed(spark, dirs["src"], SCHEMA)
    jobs.start_daily(s, dirs["sink"], dirs["ckpt"], "ts", ["area"], "v", delay="1 hour").awaitTermination()
    got = {r["day"].day: (r["n_rows"], r["n_hours"], r["complete"], r["mean_value"]) for r in spark.read.parquet(dirs["sink"]).collect()}
    assert got == {1: (24, 24, True, 11.5), 2: (23, 23, False, pytest.approx((276 - 5) / 23))}


def test_duplicates_and_late_rows(spark, dirs):
    def run():
        s = jobs.landed(spark, dirs["src"], SCHEMA, files_per_batch=1)
        return jobs.finish(jobs.start_dedup(s, dirs["sink"], dirs["ckpt"], ["k"], "ts", delay="1 day"))

    land(spark, dirs["src"], [(1, hour(1, 0), "a", 1.0), (1, hour(1, 0), "a", 1.0)])
    land(spark, dirs["src"], [(2, hour(20, 0), "a", 1.0)])
    run()
    assert sorted(r["k"] for r in spark.read.parquet(dirs["sink"]).collect()) == [1, 2]
    land(spark, dirs["src"], [(3, hour(2, 0), "a", 1.0), (4, hour(20, 1), "a", 1.0)])
    counts = run()
    assert counts["rows_dropped_late"] == 1
    assert sorted(r["k"] for r in spark.read.parquet(dirs["sink"]).collect()) == [1, 2, 4]


def test_late_rows_are_kept_and_counted_over_more_than_a_hundred_batches(spark, dirs):
    """Every 5th file holds a row behind the mark and every 9th one without a time; the job starts three times, once with a fresh checkpoint."""
    def run(ckpt):
        s = jobs.landed(spark, dirs["src"], SCHEMA, files_per_batch=1)
        jobs.start_guarded(s, dirs["sink"], ckpt, "ts", "2 hours").awaitTermination()

    start, planted, no = dt.datetime(2024, 1, 1), [], 0

    def deliver(n):
        nonlocal no
        for _ in range(n):
            at = start + dt.timedelta(hours=no)
            rows = [(no * 10, at, "a", 1.0), (no * 10 + 1, at - dt.timedelta(hours=1), "a", 1.0)]
            if no % 5 == 4:
                rows.append((no * 10 + 2, at - dt.timedelta(hours=3, seconds=1), "a", 1.0))
            if no % 9 == 8:
                rows.append((no * 10 + 3, None, "a", 1.0))
            planted.extend(r[0] for r in rows[2:])
            os.makedirs(dirs["src"], exist_ok=True)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.timestamp("us", "UTC"), pa.string(), pa.float64()), strict=True)]
            pq.write_table(pa.table(columns, names=SCHEMA.names), f"{dirs['src']}/{no:04d}.parquet")
            no += 1

    deliver(40)
    run(dirs["ckpt"])
    run(dirs["ckpt"])
    deliver(50)
    run(dirs["ckpt"])
    for n in [n for n in os.listdir(dirs["src"]) if n.endswith(".parquet")]:
        os.remove(f"{dirs['src']}/{n}")
    deliver(14)
    run(dirs["ckpt"] + "-2")
    counts = {r["batch_no"]: (r["rows_in"], r["rows_late"]) for r in jobs.late_counts(spark, dirs["sink"]).collect()}
    assert counts == {i: (2 + (i % 5 == 4) + (i % 9 == 8), (i % 5 == 4) + (i % 9 == 8)) for i in range(104)}
    assert sorted(r["k"] for r in jobs.late_rows(spark, dirs["sink"], SCHEMA).collect()) == sorted(planted)
    assert jobs.in_time(spark, dirs["sink"], SCHEMA).count() == 208


def test_sliding_means_equal_batch(spark, dirs):
    land(spark, dirs["src"], [(d, hour(d, 12), "a", float(d)) for d in range(1, 21)])
    s = jobs.landed(spark, dirs["src"], SCHEMA)
    jobs.start_sliding(s, dirs["sink"], dirs["ckpt"], "ts", ["area"], "v", length="7 days", step="1 day", delay="1 hour").awaitTermination()
    got = {r["window_end"].day: (r["mean_value"], r["n_values"]) for r in spark.read.parquet(dirs["sink"]).collect() if r["window_end"].month == 1 and r["window_end"].year == 2024}
    assert got[10] == (6.0, 7) and got[20] == (16.0, 7) and 21 not in got


def test_batch_form_is_the_same_function(spark):
    df = spark.createDataFrame([(1, hour(1, 0), "a", 1.0), (1, hour(1, 2), "a", 3.0)], SCHEMA)
    assert dedupe(df, ["k"], ["ts"]).first()["v"] == 3.0
    day = jobs.daily_completeness(df, "ts", ["area"], "v").first()
    assert (day["n_hours"], day["complete"]) == (2, False)
    assert df.select(F.count("*")).first()[0] == 2


def test_late_rows_query_keeps_parts_of_a_second(spark, tmp_path):
    """Deliveries change within a second of the first event; the twin does not cut it off."""
    import duckdb

    from finecast.plans.catalog import ORACLES, QUERIES

    first = dt.datetime(2024, 1, 1, 0, 0, 0, 900_000)
    part = dt.timedelta(days=30) / 12
    times = [first + part * n - dt.timedelta(seconds=s) for n in range(1, 12) for s in (0.2, -0.2, 70_000)] + [first, first + part * 12 - dt.timedelta(seconds=1)]
    pq.write_table(pa.table({"event_id": pa.array(range(len(times)), pa.int64()), "ts": pa.array(times, pa.timestamp("us"))}), f"{tmp_path}/events.parquet")
    got = QUERIES["z05_late_rows"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    names = ", ".join(got.columns)
    want = con.execute(f"SELECT {names} FROM ({ORACLES['z05_late_rows']}) ORDER BY batch_no").fetchall()
    assert [tuple(r) for r in got.orderBy("batch_no").collect()] == want and len(want) == 12
