"""Training frames and chronological splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finecast.errors import DataContractError
from finecast.functions import weather
from finecast.functions.columns import clip, finite, within
from finecast.operators import joins
from finecast.operators.clean import PHYSICAL_RANGES
from finecast.operators.ordered import position
from finecast.operators.quantiles import medians_wide
from finecast.operators.sets import dedupe

# Split shares, fixed years, target columns.
TRAIN_SHARE, VALIDATION_END = 0.70, 0.85
YEAR_SHARES = (0.60, 0.20)
FIXED_YEARS = {2024: "train", 2025: "validation", 2026: "test"}
TARGETS = (
    "actual_precipitation_sum", "actual_temperature_2m_mean", "actual_relative_humidity_2m_mean",
    "actual_wind_speed_10m_mean", "actual_surface_pressure_mean",
)


def reference_targets(raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """F-01: reanalysis in stored units to target variables.

    ``raw(keys, temp_k, dew_k, precip_m, u, v)``.  Repeats keep the last by
    value order; values outside physical limits become NULL, rows stay.
    """
    one = dedupe(raw, keys, [], keep="last")
    t, d = weather.kelvin_to_celsius(finite(F.col("temp_k"))), weather.kelvin_to_celsius(finite(F.col("dew_k")))
    r = PHYSICAL_RANGES
    return one.select(
        *keys,
        within(t, *r["temperature"]).alias("temperature_c"),
        within(d, *r["temperature"]).alias("dewpoint_c"),
        within(weather.relative_humidity(t, d), *r["humidity"]).alias("humidity_pct"),
        within(weather.metres_to_mm(finite(F.col("precip_m"))), *r["precipitation"]).alias("precipitation_mm"),
        within(weather.wind_speed(finite(F.col("u")), finite(F.col("v"))), *r["wind"]).alias("wind_ms"),
    )


def stage_two_frame(
    gps: DataFrame, forecast_wide: DataFrame, targets: DataFrame, area: str, entity: str, date_col: str, required: str
) -> DataFrame:
    """F-02: entity x date frame with area forecasts and reference targets.

    Dates are those on which the required forecast (day-one temperature) exists.
    """
    usable = forecast_wide.filter(F.col(required).isNotNull())
    grid = joins.expand(gps, usable.select(area, date_col), [area], date_col)
    return joins.attach(grid, usable, targets, [area, date_col], [entity, date_col])


def horizon_dataset(
    forecast: DataFrame, gps: DataFrame, target: DataFrame, area: str, entity: str, target_date: str,
    issue_date: str, lead: str, predictors: Sequence[str], labels: Sequence[str], strict: bool = False,
) -> DataFrame:
    """F-03: leakage-safe samples entity x date x lead, all leads at once.

    Every row must satisfy ``target - issue = lead`` with a positive lead, or
    the job fails.  Only the named predictors are kept; rows are dropped for a
    missing label only.  ``strict`` (F-03b) also fails on a NULL predictor.
    """
    leaked = [p for p in predictors if p in labels or p.startswith("actual_")]
    if leaked:
        raise DataContractError(f"targets among predictors: {leaked}")
    gap = F.datediff(F.col(target_date), F.col(issue_date))
    bad = gap.isNull() | F.col(lead).isNull() | (gap != F.col(lead)) | (F.col(lead) < 1)
    checked_lead = F.when(bad, F.raise_error(F.lit("forecast breaks target - issue = lead"))).otherwise(F.col(lead))
    values = [
        (F.when(F.col(p).isNull(), F.raise_error(F.lit(f"{p} is missing"))).otherwise(F.col(p)) if strict else F.col(p)).alias(p)
        for p in predictors
    ]
    safe = forecast.select(area, target_date, F.col(issue_date), checked_lead.alias(lead), *values)
    # Samples grow only at the last join: each (entity, date) label meets the
    # few leads of its area and date.
    side = joins.spread_side(target.select(entity, target_date, *labels), [entity, target_date], "target")
    labelled = gps.select(entity, area).join(side.dropna(how="all", subset=list(labels)), entity)
    return labelled.join(safe, [area, target_date])


def block_dataset(
    forecast: DataFrame, target: DataFrame, area: str, target_date: str, issue_date: str, lead: str,
    predictors: Sequence[str], labels: Sequence[str],
) -> DataFrame:
    """F-03b: area-level samples without the entity join; a missing predictor fails."""
    areas = forecast.select(area).distinct().withColumn("_entity", F.col(area))
    renamed = target.withColumn("_entity", F.col(area)).drop(area)
    return horizon_dataset(
        forecast, areas, renamed, area, "_entity", target_date, issue_date, lead, predictors, labels, strict=True
    ).drop("_entity")


def _split_label(index: Column, n: Column) -> Column:
    return (
        F.when(index < F.floor(n * F.lit(TRAIN_SHARE)), "train")
        .when(index < F.floor(n * F.lit(VALIDATION_END)), "validation")
        .otherwise("test")
    )


def date_split(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """M-01: 70/15/15 by distinct date; all entities of a date stay together.

    Ranks are taken over distinct dates (calendar-sized), then joined back.
    """
    dates = df.select(*by, date_col).distinct()
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    idx = F.row_number().over(part.orderBy(date_col)) - 1
    labels = dates.select(*by, date_col, _split_label(idx, F.count(F.lit(1)).over(part)).alias("split"))
    return df.join(labels, [*by, date_col])


def row_split(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), chunk: Column | None = None) -> DataFrame:
    """M-02: 70/15/15 by row after sorting; one date may be cut in two.

    Positions come from numbering inside bounded pieces plus their offsets,
    not from a global sort in one task.
    """
    placed = position(df, by, order, chunk, "_pos")
    total = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    joined = placed.join(total, list(by)) if by else placed.withColumn("_n", total.scalar())
    return joined.withColumn("split", _split_label(F.col("_pos"), F.col("_n"))).drop("_pos", "_n")


def year_split(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """M-03: whole calendar years, about 60/20/20, at least one year each; < 3 years fails.

    Year counts are rounded half to even.
    """
    years = df.select(*by, F.year(date_col).alias("_y")).filter("_y is not null").distinct()
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    idx, n = F.row_number().over(part.orderBy("_y")) - 1, F.count(F.lit(1)).over(part)
    ranked = years.select(*by, "_y", idx.alias("_i"), n.alias("_n"))
    c = F.col("_n")

    def share(p: float) -> Column:
        return F.greatest(F.lit(1), F.bround(c * F.lit(p), 0).cast("int"))

    train0, val0 = share(YEAR_SHARES[0]), share(YEAR_SHARES[1])
    val1 = F.when(c - train0 - val0 < 1, c - train0 - 1).otherwise(val0)
    train = F.when(c == 3, 1).when(val1 < 1, c - 1 - F.greatest(c - train0 - val0, F.lit(1))).otherwise(train0)
    val = F.when(c == 3, 1).otherwise(F.greatest(val1, F.lit(1)))
    train = F.when(c < 3, F.raise_error(F.lit("at least 3 calendar years are needed"))).otherwise(train)
    label = (
        F.when(F.col("_i") < train, "train").when(F.col("_i") < train + val, "validation").otherwise("test")
    )
    labels = ranked.select(*by, "_y", label.alias("split"))
    return df.withColumn("_y", F.year(date_col)).join(labels, [*by, "_y"]).drop("_y")


def fixed_year_split(df: DataFrame, date_col: str, years: Mapping[int, str] = FIXED_YEARS) -> DataFrame:
    """M-04: split named per calendar year; other years are left out."""
    label = F.lit(None).cast("string")
    for y, s in years.items():
        label = F.when(F.year(date_col) == y, s).otherwise(label)
    return df.withColumn("split", label).filter(F.col("split").isNotNull())


def require_splits(df: DataFrame, names: Sequence[str] = ("train", "validation", "test")) -> DataFrame:
    got = {r["split"] for r in df.groupBy("split").count().collect()}
    if set(names) - got:
        raise DataContractError(f"empty splits: {sorted(set(names) - got)}")
    return df


def median_imputer(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """M-05: exact medians of the training rows only (one small row reaches the driver)."""
    row = medians_wide(train, [], {c: F.col(c) for c in columns}).first()
    return {c: row[f"{c}_median"] for c in columns if row is not None and row[f"{c}_median"] is not None}


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    return df.na.fill(dict(medians))


def impute_by_train_median(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """M-05 as one plan: the medians enter as scalar subqueries, nothing is collected."""
    med = medians_wide(df.filter(F.col(split) == "train"), [], {c: F.col(c) for c in columns})
    return df.withColumns({c: F.coalesce(F.col(c), med.select(f"{c}_median").scalar()) for c in columns})


def forbid_actuals(columns: Sequence[str]) -> Sequence[str]:
    """M-06."""
    bad = [c for c in columns if c.lower().startswith("actual_") or c in TARGETS]
    if bad:
        raise DataContractError(f"observed values among predictors: {bad}")
    return columns


def residual_targets(df: DataFrame, truth: Mapping[str, str]) -> DataFrame:
    """M-07: truth minus forecast per variable: ``{forecast column: truth column}``."""
    return df.withColumns({f"residual_{f}": F.col(t) - F.col(f) for f, t in truth.items()})


def feature_contract(horizons: Sequence[int], features: Sequence[str], labels: Sequence[str], spark) -> DataFrame:
    """M-14: (horizon, position, feature, role) rows that go with a saved model."""
    rows = [(h, i, c, "predictor") for h in horizons for i, c in enumerate(features)]
    rows += [(h, i, c, "label") for h in horizons for i, c in enumerate(labels)]
    return spark.createDataFrame(rows, "horizon int, position int, feature string, role string")


def blended_rain(raw: Column, specialised: Column, weight: float = 0.7) -> Column:
    return clip(F.lit(weight) * specialised + F.lit(1.0 - weight) * raw, 0.0)
