"""Streaming jobs run to completion over the event files, with batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finecast.plans.frames import with_
from finecast.plans.registry import query, r
from finecast.session import fresh_dir, materialise
from finecast.streaming import jobs


def events(f, **options):
    """The event table as a file stream."""
    schema = f.table("events").schema
    s = jobs.landed(f.spark, f.dir, schema, pattern="events.parquet", **options)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def read(f, sink, df):
    return f.spark.read.schema(df.schema).parquet(sink)


@query("z01_incremental_archive", f"SELECT user_id, event_type, MAX(event_id) AS event_id, MAX(ts) AS ts, {r('arg_max(value, event_id)')} AS value FROM events GROUP BY user_id, event_type")
def _(f):
    """Latest event per user and type, kept by the archive job."""
    s = events(f).select("user_id", "event_type", "event_id", "ts", "value")
    sink, ckpt = fresh_dir(f.spark, "archive"), fresh_dir(f.spark, "archive-state")
    keys, order = ["user_id", "event_type"], ["event_id"]
    jobs.start_archive(s, sink, ckpt, keys, order).awaitTermination()
    return jobs.read_archive(f.spark, sink, StructType(s.schema.fields), keys, order)


CLOSED = "SELECT MAX(ts) - INTERVAL 1 DAY AS mark FROM events"


@query(
    "z02_daily_completeness",
    with_("", f"""SELECT CAST(ts AS DATE) AS day, user_id % 3 AS area, COUNT(*) AS n_rows, {r('avg(value)')} AS mean_value, {r('SUM(value)')} AS sum_value, CAST(COUNT(DISTINCT hour(ts)) AS INTEGER) AS n_hours, COUNT(DISTINCT hour(ts)) = 24 AS complete
    FROM events GROUP BY 1, 2 HAVING CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <= (SELECT mark FROM m)""", m=CLOSED),
)
def _(f):
    """Days are emitted once the watermark has passed their end."""
    s = events(f).select("ts", (F.col("user_id") % 3).alias("area"), "value")
    sink, ckpt = fresh_dir(f.spark, "daily"), fresh_dir(f.spark, "daily-state")
    jobs.start_daily(s, sink, ckpt, "ts", ["area"], "value").awaitTermination()
    return read(f, sink, jobs.daily_completeness(s, "ts", ["area"], "value"))


@query("z03_duplicate_removal", "SELECT user_id, COUNT(*) AS n, COUNT(DISTINCT event_id) AS n_ids, MIN(ts) AS first_ts FROM events GROUP BY user_id")
def _(f):
    """Every event arrives twice; one copy remains."""
    s = events(f).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).select("event_id", "user_id", "ts", "copy")
    sink, ckpt = fresh_dir(f.spark, "dedup"), fresh_dir(f.spark, "dedup-state")
    jobs.start_dedup(s, sink, ckpt, ["event_id"], "ts", delay="40 days").awaitTermination()
    return read(f, sink, s).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_ids"), F.min("ts").alias("first_ts"))


@query(
    "z04_sliding_means",
    with_("", f"""SELECT s AS window_start, s + INTERVAL 7 DAY AS window_end, area, {r('avg(value)')} AS mean_value, COUNT(value) AS n_values FROM (SELECT user_id % 3 AS area, value, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS s FROM events, (SELECT unnest(range(0, 7)) AS k))
    WHERE s + INTERVAL 7 DAY <= (SELECT mark FROM m) GROUP BY 1, 2, 3""", m=CLOSED),
)
def _(f):
    s = events(f).select("ts", (F.col("user_id") % 3).alias("area"), "value")
    sink, ckpt = fresh_dir(f.spark, "sliding"), fresh_dir(f.spark, "sliding-state")
    jobs.start_sliding(s, sink, ckpt, "ts", ["area"], "value").awaitTermination()
    return read(f, sink, jobs.sliding_means(s, "ts", ["area"], "value"))


SLOTS = 12
ARRIVALS = f"""SELECT event_id, ts, least({SLOTS - 1}, CAST(floor({SLOTS} * (epoch(ts) - epoch(lo)) / (epoch(hi) - epoch(lo) + 1)) AS BIGINT) + CASE WHEN event_id % 17 = 0 THEN 3 ELSE 0 END) AS slot
  FROM events, (SELECT MIN(ts) AS lo, MAX(ts) AS hi FROM events)"""


@query(
    "z05_late_rows",
    with_("", """SELECT slot AS batch_no, COUNT(*) AS rows_in, COUNT(*) FILTER (late) AS rows_late, COUNT(*) FILTER (NOT late) AS rows_in_time, MIN(event_id) FILTER (late) AS first_late_id
    FROM (SELECT *, coalesce(ts < (SELECT MAX(p.ts) - INTERVAL 2 DAY FROM arrivals p WHERE p.slot < a.slot), false) AS late FROM arrivals a) GROUP BY slot""", arrivals=ARRIVALS),
)
def _(f):
    """Events arrive in twelve deliveries by time, every 17th three deliveries later; what is behind the mark is counted and kept aside."""
    e = f.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    seconds = lambda t: F.unix_micros(t) / 1e6
    lo, hi = e.select(seconds(F.min("ts"))).scalar(), e.select(seconds(F.max("ts"))).scalar()
    slot = F.floor(F.lit(SLOTS) * (seconds("ts") - lo) / (hi - lo + 1)) + F.when(F.col("event_id") % 17 == 0, 3).otherwise(0)
    arrivals = materialise(e.withColumn("slot", F.least(F.lit(SLOTS - 1), slot)), "arrivals")
    src, sink, ckpt = (fresh_dir(f.spark, f"late{x}") for x in ("-src", "", "-state"))
    for n in range(SLOTS):
        # The job runs after each delivery, so its batches do not hang on how finely a store keeps file times.
        arrivals.filter(F.col("slot") == n).drop("slot").write.mode("append").parquet(src)
        jobs.start_guarded(jobs.landed(f.spark, src, e.schema, files_per_batch=1_000_000), sink, ckpt, "ts", "2 days").awaitTermination()
    late = jobs.late_rows(f.spark, sink, e.schema).groupBy("batch_no").agg(F.min("event_id").alias("first_late_id"))
    kept = jobs.in_time(f.spark, sink, e.schema).groupBy("batch_no").agg(F.count(F.lit(1)).alias("rows_in_time"))
    return jobs.late_counts(f.spark, sink).join(kept, "batch_no", "left").join(late, "batch_no", "left").na.fill(0, ["rows_in_time"])
