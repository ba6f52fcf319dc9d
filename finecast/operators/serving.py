"""Tables a front end can read without further work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.functions import geo
from finecast.operators.ingest import latest_dates
from finecast.operators.scalars import one_row
from finecast.operators.sets import dedupe

# Land-cover classes, forecast days shown.
LANDCOVER_CLASSES = (
    "water", "trees", "grass", "flooded_vegetation", "crops", "shrub", "built", "bare", "snow_ice",
)
FORECAST_DAYS = 7


def nested_forecast(fc: DataFrame, entity: str, date_col: str, day: str, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per entity with its days as a sorted array.

    The newest seven dates of each area (``by``) are kept, one row per entity
    and date, which bounds the array.
    """
    recent = dedupe(latest_dates(fc, date_col, FORECAST_DAYS, by), [entity, date_col], [day], keep="last")
    days = F.sort_array(F.collect_list(F.struct(day, F.col(date_col).alias("date"), *values)))
    return recent.groupBy(entity).agg(days.alias("forecast"))


def fractions_map(prefix_classes: Sequence[str] = LANDCOVER_CLASSES, suffix: str = "_fraction") -> Column:
    """Land-cover map without its NULL members."""
    full = F.create_map(*[x for c in prefix_classes for x in (F.lit(c), F.col(f"{c}{suffix}"))])
    return F.map_filter(full, lambda k, v: v.isNotNull())


def serving_frame(
    fc: DataFrame, master: DataFrame, landcover: DataFrame | None, overrides: Sequence[DataFrame], entity: str,
    date_col: str, day: str, values: Sequence[str], fields: Sequence[str], by: Sequence[str] = (),
) -> DataFrame:
    """J-20: nested forecast with master, land cover and later non-NULL overrides.

    ``master`` and each override carry ``entity`` plus some of ``fields``; the
    last non-NULL value wins.
    """
    out = nested_forecast(fc, entity, date_col, day, values, by).join(master, entity, "left")
    if landcover is not None:
        out = out.join(landcover.select(entity, fractions_map().alias("land_use_fractions")), entity, "left")
    for i, o in enumerate(overrides):
        cols = [c for c in o.columns if c != entity]
        out = out.join(o.select(entity, *[F.col(c).alias(f"_{i}_{c}") for c in cols]), entity, "left")
    chosen = {}
    for f in fields:
        layers = [F.col(f"_{i}_{f}") for i in reversed(range(len(overrides))) if f in overrides[i].columns]
        chosen[f] = F.coalesce(*layers, F.col(f)) if f in master.columns else F.coalesce(*layers)
    drop = [f"_{i}_{c}" for i, o in enumerate(overrides) for c in o.columns if c != entity]
    return out.withColumns(chosen).drop(*drop)


def compare(fc: DataFrame, points: DataFrame, pairs: DataFrame, entity: str, day: str, rain: str, temperature: str,
            humidity: str, wind_ms: str) -> DataFrame:
    """A-31: an entity beside its neighbours: extremes, rain, means, distance, direction.

    ``pairs(entity, other)`` come from the neighbour job; ``points(entity, lat, lon)``.
    """
    s = fc.groupBy(entity).agg(
        F.max(temperature).alias("max_temp"), F.min(temperature).alias("min_temp"),
        F.max(F.when(F.col(day) == 1, F.col(rain))).alias("day_rain"), F.sum(rain).alias("total_rain"),
        F.avg(humidity).alias("mean_humidity"), (F.avg(wind_ms) * 3.6).alias("wind_kmh"),
    )
    a = points.select(F.col(entity), F.col("lat").alias("_la"), F.col("lon").alias("_lo"))
    b = points.select(F.col(entity).alias("other"), F.col("lat").alias("_lb"), F.col("lon").alias("_lob"))
    args = [F.col(c) for c in ("_la", "_lo", "_lb", "_lob")]
    return (
        pairs.select(entity, "other").join(a, entity).join(b, "other")
        .join(s.withColumnRenamed(entity, "other"), "other")
        .select(
            entity, "other", "max_temp", "min_temp", "day_rain", "total_rain", "mean_humidity", "wind_kmh",
            geo.haversine_km(*args).alias("distance_km"), geo.compass_point(geo.bearing_degrees(*args)).alias("direction"),
        )
    )


def validate_forecast(fc: DataFrame, master: DataFrame, manifest: DataFrame, entity: str, date_col: str, today: Column) -> DataFrame:
    """S-11: one row saying whether a forecast may be published, and why not.

    ``manifest`` has one row: synthetic_target, interpolated_target,
    block_actual_copied_to_gp, gp_count.
    """
    ids = fc.select(entity).distinct()
    unknown = ids.join(master.select(entity).distinct(), entity, "left_anti").agg(F.count(F.lit(1)).alias("unknown_ids"))
    n = ids.agg(F.count(F.lit(1)).alias("n_ids"))
    newest = fc.agg(F.max(date_col).alias("last_target"))
    flags = ("synthetic_target", "interpolated_target", "block_actual_copied_to_gp", "gp_count")
    j = one_row(
        fc.sparkSession,
        {"n_ids": n, "unknown_ids": unknown, "last_target": newest} | {c: manifest.select(c) for c in flags},
    )
    clear = F.lit(True)
    for flag in flags[:3]:
        clear = clear & F.coalesce(~F.col(flag), F.lit(False))
    reasons = F.array_compact(
        F.array(
            F.when(~clear, "manifest flags"), F.when(F.col("n_ids") == 0, "no forecast rows"),
            F.when(F.col("unknown_ids") > 0, "unknown ids"), F.when(F.col("n_ids") != F.col("gp_count"), "id count differs"),
            F.when(F.coalesce(F.col("last_target") < today, F.lit(True)), "forecast is out of date"),
        )
    )
    return j.select(
        "n_ids", "unknown_ids", "last_target", (F.size(reasons) == 0).alias("publishable"), F.array_join(reasons, "; ").alias("reasons")
    )
