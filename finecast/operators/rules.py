"""Risk rules, advisories, watch ranges and what-if scenarios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.errors import DataContractError
from finecast.functions.columns import clip
from finecast.functions.weather import KMH_PER_MS

# Risk steps per code: (lower bound, severity, score), highest first.
HEAT_STEPS = ((40.0, "CRITICAL", 0.95), (35.0, "HIGH", 0.85))
RAIN_STEPS = ((64.0, "CRITICAL", 0.96), (35.0, "HIGH", 0.88), (20.0, "MEDIUM", 0.65))
WIND_STEPS = ((60.0, "CRITICAL", 0.97), (40.0, "HIGH", 0.87), (25.0, "MEDIUM", 0.65))
HUMIDITY_STEPS = ((90.0, "HIGH", 0.90), (80.0, "MEDIUM", 0.72))
SEVERITY_WEIGHT = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}
# Watch thresholds, scenario limits.
WATCH_RAIN_MM, WATCH_HUMIDITY_PCT, WATCH_WIND_MS, WATCH_WARMER_C = 10.0, 80.0, 7.0, 3.0
SCENARIO_TEMPERATURE = (-80.0, 65.0)
SAFE_CODE = "SAFE_WEATHER"


def _risk(cond: Column, code: str, severity: str, score: float) -> Column:
    return F.when(cond, _entry(code, severity, score))


def _entry(code: str, severity: str, score: float) -> Column:
    return F.struct(
        F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(score).alias("score"),
        F.lit(SEVERITY_WEIGHT[severity]).alias("weight"),
    )


def _steps(value: Column, code: str, steps) -> Column:
    out = None
    for bound, severity, score in steps:
        hit, entry = value >= bound, _entry(code, severity, score)
        out = F.when(hit, entry) if out is None else out.when(hit, entry)
    return out


def risk_array(temperature: Column, humidity: Column, rain: Column, wind_kmh: Column, soil: Column) -> Column:
    """R-01: all risks of one entity-day as an array, in rule order.

    A NULL input raises no risk.  Pure column arithmetic: no join, no shuffle.
    """
    found = F.array(
        _steps(temperature, "HEAT_STRESS", HEAT_STEPS),
        _steps(rain, "HEAVY_RAIN", RAIN_STEPS),
        _steps(wind_kmh, "STRONG_WIND", WIND_STEPS),
        _steps(humidity, "HIGH_HUMIDITY", HUMIDITY_STEPS),
        _risk((humidity >= 85) & temperature.between(18, 32) & (rain >= 5), "FUNGAL_RISK", "HIGH", 0.88),
        _risk((wind_kmh >= 20) | (rain >= 5), "SPRAYING_UNFAVORABLE", "MEDIUM", 0.78),
        _risk((soil >= 80) & (rain >= 10), "EXCESS_MOISTURE", "HIGH", 0.86),
        _risk(rain <= 2, "LOW_RAINFALL", "MEDIUM", 0.60),
        _risk(temperature <= 5, "FROST_RISK", "HIGH", 0.90),
    )
    return F.array_compact(found)


def weather_risks(df: DataFrame, keys: Sequence[str], temperature="temperature", humidity="humidity", rain="rainfall",
                  wind_kmh="wind_kmh", soil="soil_moisture") -> DataFrame:
    """R-01 as rows (keys, rule_no, code, severity, score, weight)."""
    arr = risk_array(*[F.col(c) for c in (temperature, humidity, rain, wind_kmh, soil)])
    return df.select(*keys, F.posexplode(arr).alias("rule_no", "r")).select(*keys, "rule_no", "r.*")


def ranked_risks(df: DataFrame, keys: Sequence[str], n: int = 4, **cols) -> DataFrame:
    """T-02 / W-12: most severe first, then score, then rule order; at most nine per day.

    Sorted inside the row's own array, so ranking needs no shuffle.
    """
    args = dict(temperature="temperature", humidity="humidity", rain="rainfall", wind_kmh="wind_kmh", soil="soil_moisture") | cols
    arr = risk_array(*[F.col(args[c]) for c in ("temperature", "humidity", "rain", "wind_kmh", "soil")])
    keyed = F.transform(arr, lambda r, i: F.struct((-r["weight"]).alias("w"), (-r["score"]).alias("s"), i.alias("rule_no"), r.alias("r")))
    top = F.slice(F.array_sort(keyed), 1, n)
    return df.select(*keys, F.posexplode(top).alias("p", "t")).select(
        *keys, (F.col("p") + 1).alias("rank"), F.col("t.r.code").alias("code"), F.col("t.r.severity").alias("severity"),
        F.col("t.r.score").alias("score"),
    )


def advisories(df: DataFrame, keys: Sequence[str], templates: DataFrame, language: str, secondary: int = 3, **cols) -> DataFrame:
    """R-02: primary risk and up to three more per entity-day with their texts.

    Days without a risk get SAFE_WEATHER.  ``templates(code, language, text)``
    is a small table; Spark broadcasts it by its measured size.
    """
    ranked = ranked_risks(df, keys, 1 + secondary, **cols)
    safe = df.select(*keys).join(ranked.select(*keys).distinct(), list(keys), "left_anti").select(
        *keys, F.lit(1).alias("rank"), F.lit(SAFE_CODE).alias("code"), F.lit("LOW").alias("severity"), F.lit(0.0).alias("score")
    )
    rows = ranked.unionByName(safe).withColumn("role", F.when(F.col("rank") == 1, "PRIMARY").otherwise("SECONDARY"))
    return rows.join(templates.filter(F.col("language") == language).drop("language"), "code", "left")


def watch_ranges(fc: DataFrame, by: Sequence[str], day: str, rain: str, humidity: str, wind_ms: str, temperature: str) -> DataFrame:
    """R-03: first and last forecast day meeting each watch threshold, matches and available days."""
    means = fc.groupBy(*by).agg(F.avg(temperature).alias("_mean"))
    j = fc.join(means, list(by))
    rules = {
        "rainfall": (rain, F.col(rain) >= WATCH_RAIN_MM),
        "humidity": (humidity, F.col(humidity) >= WATCH_HUMIDITY_PCT),
        "wind": (wind_ms, F.col(wind_ms) >= WATCH_WIND_MS),
        "temperature": (temperature, F.col(temperature) > F.col("_mean") + WATCH_WARMER_C),
    }
    cells = F.array(
        *[F.struct(F.lit(n).alias("watch"), F.col(c).isNotNull().alias("present"), hit.alias("hit")) for n, (c, hit) in rules.items()]
    )
    long = j.select(*by, F.col(day).alias("_d"), F.explode(cells).alias("w"))
    return (
        long.groupBy(*by, F.col("w.watch").alias("watch"))
        .agg(
            F.min(F.when(F.col("w.hit"), F.col("_d"))).alias("first_day"), F.max(F.when(F.col("w.hit"), F.col("_d"))).alias("last_day"),
            F.count_if(F.col("w.hit")).alias("matches"), F.count_if(F.col("w.present")).alias("available"),
        )
        .filter("matches > 0")
    )


SCENARIO_LIMIT = 1000


def apply_scenarios(fc: DataFrame, scenarios: DataFrame, rain: str, temperature: str, humidity: str, wind_ms: str) -> DataFrame:
    """R-04: every forecast row under every scenario; NULL stays NULL.

    The scenario table (what a person typed in, a handful of rows) becomes one
    array value, so each forecast row is read once and multiplied inside its
    own task.  More than ``SCENARIO_LIMIT`` scenarios are refused before any is
    gathered.
    """
    if scenarios.limit(SCENARIO_LIMIT + 1).count() > SCENARIO_LIMIT:
        raise DataContractError(f"more than {SCENARIO_LIMIT} scenarios")
    packed = scenarios.agg(F.collect_list(F.struct(*scenarios.columns)).alias("_s"))
    j = fc.select(*fc.columns, F.explode(packed.scalar()).alias("_s")).select(*fc.columns, "_s.*")
    return j.withColumns(
        {
            rain: clip(F.col(rain) * (F.lit(1.0) + F.col("rainfall_delta_pct") / 100.0), 0.0),
            temperature: clip(F.col(temperature) + F.col("temperature_delta_c"), *SCENARIO_TEMPERATURE),
            humidity: clip(F.col(humidity) + F.col("humidity_delta_pct"), 0.0, 100.0),
            wind_ms: clip(F.col(wind_ms) + F.col("wind_delta_kmh") / KMH_PER_MS, 0.0),
        }
    )


def rainfall_status(rain: Column, threshold: Column) -> Column:
    """R-05."""
    return (
        F.when(rain.isNull(), "Rainfall status unavailable")
        .when(rain >= threshold, "Rainfall threshold reached")
        .otherwise("Below rainfall threshold")
    )


def planning_flags(mean_rain: Column, threshold: Column, soil_class: Column) -> tuple[Column, Column]:
    """R-05: water planning status and agricultural signal from mean rain and a soil class."""
    below = F.coalesce(mean_rain < threshold, F.lit(False))
    water = (
        F.when(mean_rain.isNull(), "UNAVAILABLE")
        .when(below & (soil_class == "low"), "DRYNESS_WATCH")
        .when(below, "BELOW_THRESHOLD")
        .when(soil_class == "high", "WET_CONDITION_REVIEW")
        .otherwise("THRESHOLD_MET")
    )
    signal = (
        F.when(below & (soil_class == "low"), "IRRIGATION_REVIEW")
        .when(~below & (soil_class == "high"), "DRAINAGE_REVIEW")
        .otherwise("NONE")
    )
    return water, signal


def question_facts(fc: DataFrame, by: Sequence[str], date_col: str, rain: str, wind: str, today: Column) -> DataFrame:
    """R-06: total rain, wettest day (earliest on ties), strongest wind, next day's rain."""
    d, r = F.col(date_col), F.col(rain)
    peak_key = F.when(r.isNotNull(), F.struct((-r).alias("drier"), d.alias("day")))
    after = F.when(d > today, F.struct(d, r))
    return fc.groupBy(*by).agg(
        F.sum(r).alias("total_rain_mm"), F.min(peak_key).getField("day").alias("peak_date"), F.max(r).alias("peak_rain_mm"),
        F.max(wind).alias("max_wind"), F.min(after).getField(rain).alias("tomorrow_rain_mm"),
    )


def forecast_sanity(fc: DataFrame, by: Sequence[str], synthetic: str, actual_input: str, fallback: str, expected: int = 7) -> DataFrame:
    """R-07: synthetic or observed-as-input flags fail, fallback warns, row count is checked."""
    g = fc.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(synthetic).alias("synthetic_rows"),
        F.count_if(actual_input).alias("actual_input_rows"), F.count_if(fallback).alias("fallback_rows"),
    )
    bad = (F.col("synthetic_rows") > 0) | (F.col("actual_input_rows") > 0) | (F.col("n_rows") != expected)
    return g.withColumn("status", F.when(bad, "FAIL").when(F.col("fallback_rows") > 0, "WARN").otherwise("PASS"))


def wettest(fc: DataFrame, by: Sequence[str], entity: str, value: str) -> DataFrame:
    """A-31: entity with the largest value per group, smallest id on ties."""
    return fc.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.min_by(entity, F.struct(-F.col(value), F.col(entity))).alias(entity), F.max(value).alias(value)
    )

