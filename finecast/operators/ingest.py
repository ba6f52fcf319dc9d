"""Incremental archives: windows to fetch, merges, gaps, latest cycles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finecast.errors import DataContractError
from finecast.functions.columns import close
from finecast.operators import guards
from finecast.operators.sets import dedupe, union_chunks
from finecast.session import bounded_tasks, materialise


def next_window(
    stored: DataFrame, date_col: str, anchor: Column, today: Column, by: Sequence[str] = (),
    step_days: int = 1,
) -> DataFrame:
    """I-01: where the next pull starts and ends.

    The day after the newest stored date, or the anchor on a first run;
    ``step_days=0`` restarts on the newest date itself.  Status is
    FUTURE_DATA when the store is ahead of today, UP_TO_DATE when nothing is
    left, else FETCH.
    """
    newest = stored.groupBy(*by).agg(F.max(date_col).alias("last_date"))
    start = F.coalesce(F.date_add("last_date", step_days), anchor)
    return newest.select(
        *by,
        "last_date",
        start.alias("window_start"),
        today.alias("window_end"),
        F.when(F.col("last_date") > today, "FUTURE_DATA")
        .when(start > today, "UP_TO_DATE")
        .otherwise("FETCH")
        .alias("status"),
    )


def require_no_future(stored: DataFrame, date_col: str, today: Column) -> DataFrame:
    return guards.require_none(stored.select(date_col), F.col(date_col) > today, "dates after today")


def append_new(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """I-02: add rows with unseen keys only; a stored row always wins.

    Keys are compared null-safe, so a key with a NULL in it is stored once too.
    """
    return existing.unionByName(unseen(existing, new, keys, order))


def unseen(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The rows of ``new`` that ``append_new`` adds."""
    fresh = dedupe(new, keys, list(order) or list(keys), keep="first").alias("a")
    seen = existing.select(*keys).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    return fresh.join(seen, same, "left_anti")


def upsert_latest(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """I-03: the newest arrival per key wins; ``order`` ranks rows inside one batch."""
    stacked = existing.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return dedupe(stacked, keys, ["_batch", *order], keep="last").drop("_batch")


def conflicts(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], rtol: float = 1e-10, atol: float = 1e-12
) -> DataFrame:
    """Keys of ``new`` whose rows disagree, with each other or with stored ones, and the columns that differ.

    One partial aggregate over both tables (extremes and counts per key), so
    neither repeated keys nor a hot one multiply rows.  It keeps one entry per
    key, so it runs at once, in small tasks.
    """
    values = [c for c in existing.columns if c not in keys]
    numeric = {f.name for f in existing.schema.fields if f.dataType.typeName() in ("double", "float")}
    both = existing.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    parts = [x for i, c in enumerate(values) for x in (F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}"), F.count(c).alias(f"_n{i}"))]
    g = both.groupBy(*keys).agg(F.bool_or("_new").alias("_new"), F.count(F.lit(1)).alias("_n"), *parts).filter("_new AND _n > 1")

    def differs(i: int, c: str) -> Column:
        lo, hi, n = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_n{i}")
        apart = ~(close(hi, lo, rtol, atol) | hi.eqNullSafe(lo)) if c in numeric else ~hi.eqNullSafe(lo)
        return apart | ((n > 0) & (n < F.col("_n")))

    named = F.array_compact(F.array(*[F.when(differs(i, c), F.lit(c)) for i, c in enumerate(values)]))
    with bounded_tasks(existing.sparkSession, scans=True):
        return materialise(g.select(*keys, named.alias("differing")).filter(F.size("differing") > 0), "conflicts")


def append_strict(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], rtol: float = 1e-10, atol: float = 1e-12
) -> DataFrame:
    """I-04: identical repeats are ignored; a changed repeat raises, be it of a stored row or inside the delivery.

    Both tables are read twice, by the check and by the merge, which run at once
    in small tasks.  Only the rows added are written here.
    """
    bad = conflicts(existing, new, keys, rtol, atol).limit(guards.EXAMPLES).collect()
    if bad:
        raise DataContractError(f"same key, different values: {[r.asDict() for r in bad]}")
    with bounded_tasks(existing.sparkSession, scans=True):
        fresh = materialise(unseen(existing, new, keys), "append-strict")
    return existing.unionByName(fresh)


def date_spine(start: Column, end: Column) -> Column:
    """I-06: array of days from start to end inclusive."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def missing_keys(entities: DataFrame, start: Column, end: Column, present: DataFrame,
                 keys: Sequence[str], date_col: str) -> DataFrame:
    """I-05: expected entity x day grid minus the keys that are there."""
    grid = entities.select(*keys, F.explode(date_spine(start, end)).alias(date_col))
    return grid.join(present.select(*keys, date_col), [*keys, date_col], "left_anti")


def date_buckets(spans: DataFrame, days: int, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """I-06: consecutive buckets of ``days`` days, the last one cut at the end.

    ``bucket_stop`` is exclusive, ``bucket_end`` inclusive.
    """
    firsts = F.sequence(F.col(start), F.col(end), F.make_dt_interval(F.lit(days)))
    out = spans.withColumn("bucket_start", F.explode(firsts))
    last = F.least(F.date_add("bucket_start", days - 1), F.col(end))
    return out.withColumn("bucket_end", last).withColumn("bucket_stop", F.date_add(last, 1))


def month_buckets(spans: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """I-06: calendar months touching the span, cut to it."""
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.make_ym_interval(F.lit(0), F.lit(1)))
    out = spans.withColumn("month_start", F.explode(months))
    return out.withColumn("bucket_start", F.greatest("month_start", F.col(start))).withColumn(
        "bucket_end", F.least(F.last_day("month_start"), F.col(end))
    )


def listed_buckets(dates: DataFrame, date_col: str, days: int, anchor: Column, by: Sequence[str] = ()) -> DataFrame:
    """I-06: group only the dates that occur into N-day buckets; gaps stay gaps."""
    idx = F.floor(F.datediff(F.col(date_col), anchor) / days).cast("int")
    return (
        dates.select(*by, date_col, idx.alias("bucket_no"))
        .distinct()
        .groupBy(*by, "bucket_no")
        .agg(
            F.min(date_col).alias("bucket_start"),
            F.max(date_col).alias("bucket_end"),
            F.count(F.lit(1)).alias("n_dates"),
        )
    )


def latest_cycle(df: DataFrame, cycle_col: str, by: Sequence[str] = ()) -> DataFrame:
    """I-07: every row of the newest retrieval cycle.

    The newest cycle is a small aggregate joined back, not a window over the
    whole archive.
    """
    newest = df.groupBy(*by).agg(F.max(cycle_col).alias(cycle_col))
    return df.join(newest, [*by, cycle_col], "left_semi")


def latest_dates(df: DataFrame, date_col: str, n: int, by: Sequence[str] = ()) -> DataFrame:
    """I-08: rows of the newest ``n`` distinct dates of each area (``by``), joined back.

    Only distinct (area, date) pairs are ranked, so the rank sorts calendars,
    not rows; an area whose last run is old keeps its own newest dates.  The join
    is null-safe: rows without an area form one.
    """
    by = list(by)
    dates = df.select(*by, date_col).filter(F.col(date_col).isNotNull()).distinct()
    order = Window.partitionBy(*by).orderBy(F.col(date_col).desc())
    keep = dates.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n) if by else dates.orderBy(F.col(date_col).desc()).limit(n)
    a, b = df.alias("a"), keep.select(*by, date_col).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, date_col]])
    return a.join(b, same, "left_semi").select(*df.columns)


def trim_before(df: DataFrame, date_col: str, anchor: Column) -> DataFrame:
    """I-09."""
    return df.filter(F.col(date_col) >= anchor)


def entity_windows(
    entities: DataFrame, stored: DataFrame, keys: Sequence[str], date_col: str, start: Column, end: Column
) -> DataFrame:
    """I-10: entities without stored rows get the full history, others the rest."""
    newest = stored.groupBy(*keys).agg(F.max(date_col).alias("last_date"))
    first = F.coalesce(F.date_add("last_date", 1), start)
    return entities.select(*keys).join(newest, list(keys), "left").select(
        *keys,
        "last_date",
        first.alias("window_start"),
        end.alias("window_end"),
        F.when(F.col("last_date").isNull(), "FULL_HISTORY")
        .when(first > end, "UP_TO_DATE")
        .otherwise("INCREMENTAL")
        .alias("mode"),
    )


def check_store(
    stored: DataFrame, keys: Sequence[str], date_col: str, master: DataFrame, id_col: str
) -> DataFrame:
    """I-11: report on a stored table before anything is appended to it."""
    guards.require_columns(stored, [*keys, date_col])
    base = guards.report(
        stored,
        {
            "invalid_date": F.col(date_col).isNull(),
            "blank_id": F.col(id_col).isNull() | (F.trim(F.col(id_col).cast("string")) == ""),
        },
    )
    unknown = stored.select(id_col).distinct().join(master.select(id_col), id_col, "left_anti")
    extra = unknown.agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit("unknown_id").alias("check_name"), "n_bad")
    dup = guards.duplicate_keys(stored, keys).agg(F.count(F.lit(1)).alias("n_bad"))
    extra = extra.unionByName(dup.select(F.lit("duplicate_key").alias("check_name"), "n_bad"))
    status = F.when(F.col("n_bad") == 0, "PASS").otherwise("FAIL")
    return union_chunks(base, extra.withColumn("status", status))
