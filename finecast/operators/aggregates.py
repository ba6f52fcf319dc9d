"""Daily, zonal and profile aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from finecast.functions.columns import circular_mean, safe_ratio, weighted_mean_strict
from finecast.operators import guards
from finecast.operators.ingest import missing_keys
from finecast.operators.quantiles import exact_quantiles, medians_wide

# Root-zone layer depths in cm, radar and optical variables.
ROOT_ZONE = {"0-5cm": 5.0, "5-15cm": 10.0, "15-30cm": 15.0}
RADAR_VARIABLES = ("vv_db", "vh_db", "vv_vh_diff_db", "incidence_angle_deg", "valid_pixel_fraction")
OPTICAL_INDICES = ("NDVI", "EVI", "SAVI", "NDMI", "NBR")
NODE_LIMIT = 2


def daily_forecast(hourly: DataFrame, by: Sequence[str], ts: str = "time") -> DataFrame:
    """A-01: hourly to daily per lead: means, precipitation summed, gust maximum."""
    return hourly.groupBy(*by, F.to_date(ts).alias("date")).agg(
        F.avg("temperature").alias("temp_mean"),
        F.avg("humidity").alias("rh_mean"),
        F.sum("precipitation").alias("precip"),
        F.avg("cloud_cover").alias("cloud_cover"),
        F.avg("wind_speed").alias("wind_speed"),
        F.avg("wind_direction").alias("wind_direction"),
        F.max("wind_gust").alias("wind_gust"),
        F.avg("vpd").alias("vpd"),
    )


def daily_current(hourly: DataFrame, by: Sequence[str], ts: str = "time") -> DataFrame:
    """A-03: ten daily values of the current forecast; incomplete days are kept."""
    return hourly.groupBy(*by, F.to_date(ts).alias("target_date")).agg(
        F.avg("temperature").alias("temp_mean_c"),
        F.max("temperature").alias("temp_max_c"),
        F.min("temperature").alias("temp_min_c"),
        F.avg("humidity").alias("rh_mean_pct"),
        F.sum("precipitation").alias("precipitation_sum_mm"),
        F.avg("cloud_cover").alias("cloud_cover_mean_pct"),
        F.avg("wind_speed").alias("wind_speed_mean_ms"),
        F.max("wind_gust").alias("wind_gust_max_ms"),
        F.avg("pressure").alias("surface_pressure_mean_hpa"),
        F.avg("vpd").alias("vpd_mean_kpa"),
    )


def gp_daily(samples: DataFrame, by: Sequence[str]) -> DataFrame:
    """A-04."""
    return samples.groupBy(*by).agg(
        F.avg("temperature").alias("temperature_mean"),
        F.avg("humidity").alias("humidity_mean"),
        F.sum("precipitation").alias("precipitation_sum"),
        F.avg("wind_speed").alias("wind_speed_mean"),
    )


def daily_nodes(df: DataFrame, by: Sequence[str], node: str, values: Sequence[str], max_nodes: int = NODE_LIMIT) -> DataFrame:
    """A-05: mean over source nodes; more than ``max_nodes`` distinct nodes on one key fails.

    Rows are first reduced to one per key and node, so the distinct count and
    the mean share one further aggregate.
    """
    per_node = df.groupBy(*by, node).agg(
        *[F.sum(v).alias(f"s_{v}") for v in values], *[F.count(v).alias(f"c_{v}") for v in values]
    )
    n = F.count(F.lit(1))
    return per_node.groupBy(*by).agg(
        n.alias("n_nodes"),
        *[
            guards.fail_when(n > max_nodes, "more source nodes than allowed",
                             safe_ratio(F.sum(f"s_{v}"), F.sum(f"c_{v}"))).alias(v)
            for v in values
        ],
    )


def satellite_daily(df: DataFrame, by: Sequence[str], values: Sequence[str], prefix: str) -> DataFrame:
    """A-06: daily means of scene statistics and the number of acquisitions."""
    return df.groupBy(*by).agg(
        *[F.avg(v).alias(f"{prefix}{v}") for v in values],
        F.count(F.lit(1)).alias(f"{prefix}acquisition_count"),
    )


def zonal_stats(pixels: DataFrame, by: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """A-07: mean, population std, min and max per zone and scene."""
    return pixels.groupBy(*by).agg(
        *[
            f(b).alias(f"{b}_{name}")
            for b in bands
            for name, f in (("mean", F.avg), ("stdDev", F.stddev_pop), ("min", F.min), ("max", F.max))
        ],
        F.count(F.lit(1)).alias("pixel_count"),
    )


def landcover_fractions(pixels: DataFrame, zone: str, pixel: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """A-08: annual mean probability per pixel, then zone means and the valid share.

    A pixel is valid when it has at least one observation of the first class.
    """
    per_pixel = pixels.groupBy(zone, *pixel).agg(*[F.avg(c).alias(c) for c in classes])
    return per_pixel.groupBy(zone).agg(
        *[F.avg(c).alias(f"{c}_fraction") for c in classes],
        F.avg(F.col(classes[0]).isNotNull().cast("int")).alias("valid_pixel_fraction"),
    )


def monthly_composite(
    pixels: DataFrame, zones: DataFrame, zone: str, pixel: Sequence[str], ts: str, value: str,
    start: Column, end: Column,
) -> DataFrame:
    """A-09: per-pixel monthly median over scenes, then the zone mean.

    Months without a scene stay in the grid with NULL.
    """
    monthly = pixels.withColumn("month_start", F.trunc(F.to_date(ts), "MM"))
    per_pixel = exact_quantiles(monthly, [zone, *pixel, "month_start"], value, {"_m": 0.5})
    per_zone = per_pixel.groupBy(zone, "month_start").agg(F.avg("_m").alias(f"{value}_median"))
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.make_ym_interval(F.lit(0), F.lit(1)))
    grid = zones.select(zone, F.explode(months).alias("month_start"))
    return grid.join(per_zone, [zone, "month_start"], "left")


def lst_profile(monthly: DataFrame, zone: str, value: str) -> DataFrame:
    """A-10: mean, median, population std (0 for one month) and valid months; empty zones are absent."""
    return (
        monthly.filter(F.col(value).isNotNull())
        .groupBy(zone)
        .agg(
            F.avg(value).alias("lst_mean"),
            F.median(value).alias("lst_median"),
            F.stddev_pop(value).alias("lst_std"),
            F.count(F.lit(1)).alias("valid_months"),
        )
    )


def _std_or_zero(c: Column) -> Column:
    return F.when(F.count(c) == 1, F.lit(0.0)).otherwise(F.stddev_samp(c))


def sar_profile(
    obs: DataFrame, by: Sequence[str], variables: Sequence[str], date_col: str, image: str, orbit: str,
    passes: Mapping[str, str],
) -> DataFrame:
    """A-11: radar statistics per entity, overall and per orbit direction.

    Sample std, 0.0 for a single value.  ``passes`` maps orbit value to the
    label used in column names.  All but the medians are conditional measures
    of one aggregate; medians come from the sliced exact quantiles, since an
    entity may hold any number of observations.
    """
    scopes = {}
    for v in variables:
        scopes[v] = F.col(v)
        for o, label in passes.items():
            scopes[f"{v}_{label}"] = F.when(F.col(orbit) == o, F.col(v))
    aggs = [F.count(F.lit(1)).alias("observation_count"), F.min(date_col).alias("first_date"),
            F.max(date_col).alias("last_date")]
    for name, c in scopes.items():
        aggs += [
            F.avg(c).alias(f"{name}_mean"),
            _std_or_zero(c).alias(f"{name}_std"),
            F.min(c).alias(f"{name}_min"),
            F.max(c).alias(f"{name}_max"),
            F.count(c).alias(f"{name}_count"),
        ]
    images = obs.select(*by, image).distinct().groupBy(*by).agg(F.count(image).alias("distinct_images"))
    return (
        obs.groupBy(*by).agg(*aggs)
        .join(images, list(by))
        .join(medians_wide(obs, by, scopes), list(by), "left")
    )


def optical_profile(obs: DataFrame, by: Sequence[str], indices: Sequence[str], date_col: str, image: str) -> DataFrame:
    """A-12: index statistics with sample std (NULL for a single value)."""
    aggs = [F.count(F.lit(1)).alias("observation_count"), F.count_distinct(image).alias("distinct_images"),
            F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date")]
    for v in indices:
        aggs += [F.avg(v).alias(f"{v}_mean"), F.stddev_samp(v).alias(f"{v}_std"), F.min(v).alias(f"{v}_min"),
                 F.max(v).alias(f"{v}_max"), F.count(v).alias(f"{v}_count")]
    return obs.groupBy(*by).agg(*aggs)


def aspect_summary(df: DataFrame, by: Sequence[str], sin: str, cos: str) -> DataFrame:
    """A-13: circular mean direction and resultant length per zone."""
    m = df.groupBy(*by).agg(F.avg(sin).alias("_s"), F.avg(cos).alias("_c"))
    direction, length = circular_mean(F.col("_s"), F.col("_c"))
    return m.select(*by, direction.alias("aspect_mean_deg"), length.alias("aspect_resultant_length"))


def root_zone(df: DataFrame, keys: Sequence[str], properties: Sequence[str], layers: Mapping[str, float] = ROOT_ZONE) -> DataFrame:
    """A-14: thickness-weighted 0-30 cm means from ``soil_<property>_<layer>``; NULL if a layer is NULL."""
    return df.select(
        *keys,
        *[
            weighted_mean_strict([F.col(f"`soil_{p}_{l}`") for l in layers], list(layers.values())).alias(
                f"soil_{p}_rootzone_0_30cm"
            )
            for p in properties
        ],
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def profile(df: DataFrame) -> DataFrame:
    """A-15: one row per column: rows, NULLs, infinities, constant and all-NULL flags, range.

    One aggregate over the table, then a reshape of its single row.
    Constancy comes from min = max, so no distinct count is needed.
    """
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    numeric = set(numeric_columns(df))
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        real = F.when(~F.isnan(v), v) if c in floats else v
        aggs += [
            F.count(real).alias(f"n{i}"),
            (F.count_if(F.abs(v) == float("inf")) if c in floats else F.lit(0).cast("long")).alias(f"i{i}"),
            (F.min(real) == F.max(real)).alias(f"k{i}"),
            (F.min(real).cast("double") if c in numeric else F.lit(None).cast("double")).alias(f"lo{i}"),
            (F.max(real).cast("double") if c in numeric else F.lit(None).cast("double")).alias(f"hi{i}"),
        ]
    row = df.agg(*aggs)
    parts = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                F.col("rows").alias("row_count"),
                (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
                F.col(f"i{i}").alias("infinite_count"),
                (F.col(f"n{i}") == 0).alias("all_null"),
                F.coalesce(F.col(f"k{i}"), F.lit(False)).alias("constant_non_null"),
                F.col(f"lo{i}").alias("min_value"),
                F.col(f"hi{i}").alias("max_value"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return row.select(F.explode(parts).alias("p")).select("p.*")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """A-15: surplus copies of equal rows."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def numeric_quality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A-16: missing and non-finite cells per numeric column, with a ``__total__`` row."""
    cols = list(columns or numeric_columns(df))
    per = profile(df.select(*cols)).select("column_name", "null_count", "infinite_count")
    total = per.agg(
        F.lit("__total__").alias("column_name"),
        F.sum("null_count").alias("null_count"),
        F.sum("infinite_count").alias("infinite_count"),
    )
    return per.unionByName(total)


def date_quality(
    df: DataFrame, by: Sequence[str], date_col: str, variables: Sequence[str], low: Column, high: Column
) -> DataFrame:
    """A-17: rows, range, missing and repeated dates, out-of-range dates, completeness per variable.

    Works on one row per entity and date, so distinct dates are plain counts.
    """
    per_date = df.groupBy(*by, date_col).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(v).alias(f"_c_{v}") for v in variables]
    )
    n_rows = F.sum("_n")
    span = F.datediff(F.max(date_col), F.min(date_col)) + 1
    return per_date.groupBy(*by).agg(
        n_rows.alias("row_count"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        (span - F.count(date_col)).cast("long").alias("missing_dates"),
        F.sum(F.when(F.col(date_col).isNotNull(), F.col("_n") - 1)).alias("duplicate_dates"),
        F.coalesce(F.sum(F.when((F.col(date_col) < low) | (F.col(date_col) > high), F.col("_n"))), F.lit(0)).alias(
            "out_of_range_dates"
        ),
        *[(F.lit(100.0) * F.sum(f"_c_{v}") / n_rows).alias(f"{v}_completeness_pct") for v in variables],
    )


def missing_dates(df: DataFrame, by: Sequence[str], date_col: str) -> DataFrame:
    """A-17: calendar days absent between an entity's first and last date."""
    spans = df.groupBy(*by).agg(F.min(date_col).alias("_a"), F.max(date_col).alias("_b"))
    return missing_keys(spans, F.col("_a"), F.col("_b"), df, by, date_col)


def qc(
    obs: DataFrame, expected: DataFrame, entity: str, keys: Sequence[str], batch: str,
    ranges: Mapping[str, tuple[float, float]], core: Sequence[str],
) -> DataFrame:
    """A-18: per batch: out-of-range and missing core cells, duplicates, absent entities, status.

    PASS_EMPTY marks an expected batch without rows; FAIL any violation.
    ``expected`` holds (batch, entity).
    """
    bad_range = [~F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()]
    any_bad = bad_range[0]
    for b in bad_range[1:]:
        any_bad = F.coalesce(any_bad, F.lit(False)) | F.coalesce(b, F.lit(False))
    no_core = F.col(core[0]).isNull()
    for c in core[1:]:
        no_core = no_core | F.col(c).isNull()
    per_key = obs.groupBy(batch, *keys).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(any_bad).alias("_range"), F.count_if(no_core).alias("_core")
    )
    per_entity = per_key.groupBy(batch, entity).agg(
        F.sum("_n").alias("_n"), F.sum("_range").alias("_range"), F.sum("_core").alias("_core"),
        F.count_if(F.col("_n") > 1).alias("_dup"),
    )
    joined = expected.select(batch, entity, F.lit(1).alias("_want")).join(per_entity, [batch, entity], "full_outer")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = joined.groupBy(batch).agg(
        zero("_n").alias("n_rows"),
        zero("_range").alias("out_of_range"),
        zero("_core").alias("missing_core"),
        zero("_dup").alias("duplicate_keys"),
        F.count_if(F.col("_n").isNull()).alias("missing_entities"),
        F.count_if(F.col("_want").isNull()).alias("unexpected_entities"),
    )
    status = (
        F.when(F.col("n_rows") == 0, "PASS_EMPTY")
        .when(F.col("out_of_range") + F.col("missing_core") + F.col("duplicate_keys") + F.col("unexpected_entities") > 0, "FAIL")
        .otherwise("PASS")
    )
    return out.withColumn("status", status)


def catalogue(fc: DataFrame, location: Sequence[str], entity: str, date_col: str) -> DataFrame:
    """A-19: entities and sorted forecast dates per location (dates bounded by the calendar)."""
    n = fc.select(*location, entity).distinct().groupBy(*location).agg(F.count(F.lit(1)).alias("gp_count"))
    dates = (
        fc.select(*location, date_col).distinct().groupBy(*location)
        .agg(F.sort_array(F.collect_list(date_col)).alias("forecast_dates"))
    )
    return n.join(dates, list(location)).withColumn("available", F.lit(True))


def identity_master(parts: DataFrame, key: str) -> DataFrame:
    """A-20: one row per logical entity with an identity status by ordered rules.

    ``parts(key, name, signature, valid, area, inside_area, cross_block)``.
    The selected part of the area is ``inside_area``; areas are additive here
    because parts are counted once per distinct outline.
    """
    shapes = parts.groupBy(key, "signature").agg(
        F.count(F.lit(1)).alias("_n"), F.max("area").alias("_area"), F.max("inside_area").alias("_inside"),
        F.min("name").alias("_name_lo"), F.max("name").alias("_name_hi"), F.bool_and("valid").alias("_valid"),
        F.bool_or("cross_block").alias("_cross"),
    )
    g = shapes.groupBy(key).agg(
        F.sum("_n").alias("source_feature_count"),
        F.count(F.lit(1)).alias("source_unique_geometry_count"),
        F.min("_name_lo").alias("gp_name"),
        (F.min("_name_lo") != F.max("_name_hi")).alias("_names_differ"),
        F.bool_and("_valid").alias("source_geometry_valid"),
        F.bool_or("_cross").alias("_cross"),
        F.sum("_area").alias("source_area"),
        F.sum("_inside").alias("analysis_area"),
    )
    coverage = F.coalesce(safe_ratio(F.col("analysis_area") * 100.0, F.col("source_area")), F.lit(0.0))
    status = (
        F.when(F.col("_names_differ"), "NAME_CONFLICT")
        .when(~F.col("source_geometry_valid"), "GEOMETRY_INVALID")
        .when(F.col("source_feature_count") == 1, "VALID_SINGLE")
        .when(F.col("source_unique_geometry_count") == 1, "EXACT_DUPLICATE")
        .when(F.col("_cross"), "CROSS_BLOCK_SOURCE")
        .when(coverage < 99.999999, "PARTIAL_BLOCK_INTERSECTION")
        .otherwise("VALID_MULTIPART")
    )
    resolutions = {
        "EXACT_DUPLICATE": "DEDUPE_IDENTICAL_GEOMETRY",
        "VALID_SINGLE": "DISSOLVE_BY_GP_ID",
        "VALID_MULTIPART": "DISSOLVE_BY_GP_ID",
        "CROSS_BLOCK_SOURCE": "RETAIN_SOURCE_AND_CLIP_FOR_ANALYSIS",
        "PARTIAL_BLOCK_INTERSECTION": "RETAIN_SOURCE_AND_CLIP_FOR_ANALYSIS",
    }
    table = F.create_map(*[F.lit(x) for kv in resolutions.items() for x in kv])
    return g.withColumn("analysis_coverage_pct_of_source", coverage).withColumn("geometry_status", status).withColumn(
        "resolution", F.coalesce(F.try_element_at(table, F.col("geometry_status")), F.lit("RETAIN_FLAGGED"))
    ).drop("_names_differ", "_cross")


def kde(df: DataFrame, by: Sequence[str], value: str, points: int = 41) -> DataFrame:
    """A-32: Gaussian kernel density on ``points`` abscissae per group.

    Equal values are merged with their multiplicity before the sums, so the
    work follows distinct values; every kernel sum is a plain grouped
    aggregate of (value, abscissa) terms.
    """
    weights = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_w"))
    lo, hi = F.least(F.lit(0.0), F.min(value)), F.max(value)
    span = F.greatest(F.lit(1.0), hi - lo)
    shape = weights.groupBy(*by).agg(lo.alias("_lo"), span.alias("_span"), F.sum("_w").alias("_n"))
    shape = shape.withColumn("_h", F.greatest(F.lit(0.8), F.col("_span") / 5.0))
    terms = weights.join(shape, list(by)).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("_lo") + F.col("_span") * F.col("i") / float(points - 1)
    u = (x - F.col(value)) / F.col("_h")
    scale = F.any_value(F.col("_n") * F.col("_h")) * F.sqrt(F.lit(2.0) * F.pi())
    return terms.groupBy(*by, "i").agg(
        F.any_value(x).alias("x"), (F.sum(F.col("_w") * F.exp(F.lit(-0.5) * u * u)) / scale).alias("density")
    )


def window_pair(obs: DataFrame, by: Sequence[str], date_col: str, values: Sequence[str], end: Column, days: int = 30) -> DataFrame:
    """A-34: mean and count over the last ``days`` days and the ``days`` before, half-open at ``end``."""
    d = F.col(date_col)
    now = (d >= F.date_sub(end, days)) & (d < end)
    before = (d >= F.date_sub(end, 2 * days)) & (d < F.date_sub(end, days))
    aggs = []
    for v in values:
        for tag, cond in (("current", now), ("previous", before)):
            c = F.when(cond, F.col(v))
            aggs += [F.avg(c).alias(f"{v}_{tag}_mean"), F.count(c).alias(f"{v}_{tag}_count")]
    return obs.groupBy(*by).agg(*aggs)
