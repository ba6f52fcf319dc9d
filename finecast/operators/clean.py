"""Cleaning, column selection, physical limits, completeness filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from finecast.errors import DataContractError
from finecast.functions.columns import clip, finite, within
from finecast.functions.names import name_has_role
from finecast.operators import guards

# Where a date column is looked for, physical limits, sets of names.
DATE_CANDIDATES = (
    "date", "target_date", "valid_date", "forecast_date", "datetime", "target_datetime", "timestamp",
    "time",
)
ID_CANDIDATES = ("gp_id", "gpid", "gp_code", "gp_lgd", "id")
PHYSICAL_RANGES = {
    "temperature": (-60.0, 60.0),
    "humidity": (0.0, 100.0),
    "precipitation": (0.0, 1000.0),
    "wind": (0.0, 100.0),
}
CLAMP_STAGE_ONE = {
    "temperature": (None, None),
    "humidity": (0.0, 100.0),
    "precipitation": (0.0, None),
    "wind": (0.0, None),
}
CLAMP_STAGE_TWO = {**CLAMP_STAGE_ONE, "temperature": (-60.0, 60.0)}
STATIC_EXCLUDED = (
    "actual", "forecast", "target", "pressure", "lst__", "date", "time", "timestamp", "year", "month",
    "day", "issue", "retriev", "source", "model", "gp_id", "gp_name", "block_lgd", "block_code",
    "state", "district",
)
STATIC_PREFIXES = (
    "terrain__", "landcover__", "soil__", "elevation", "slope", "aspect", "curvature", "tpi", "tri",
)
COORDINATES = (
    "latitude", "longitude", "lat", "lon", "gp_lat", "gp_lon", "landcover__centroid_lat",
    "landcover__centroid_lon",
)
PREDICTOR_FAMILIES = (
    "temperature", "temp", "humidity", "precip", "rain", "wind", "pressure", "cloud", "radiation",
)
PREDICTOR_BLOCKED = (
    "forecast_lead_days_", "forecast_issued_date_", "forecast_issue_date_", "forecast_run",
    "forecast_retrieved", "forecast_rule_", "forecast_source_", "forecast_model_", "target_date",
    "target_datetime", "valid_time", "acquisition_date", "system_index", "source_dataset",
    "source_file", "provenance",
)
# What a lead column may not be about, and how past-only columns begin.
PREDICTOR_META = ("lead", "issued_date", "issue_date", "run", "retrieved", "rule", "source", "model")
PREDICTOR_HISTORY = ("hist__", "rainfall_", "wet_day_", "calendar_", "time__", "historical_")
PREDICTOR_BLOCKED_NAMES = (
    "date", "latitude", "longitude", "actual_is_reference_only", "synthetic_data_present",
    "interpolation_present",
)


def with_date_key(df: DataFrame, candidates: Sequence[str] = DATE_CANDIDATES, name: str = "date") -> DataFrame:
    """P-01: canonical date from the first candidate present; unparseable rows go."""
    found = next((c for c in candidates if c in df.columns), None)
    if found is None:
        raise DataContractError(f"no date column among {list(candidates)}")
    parsed = F.to_date(F.try_to_timestamp(F.col(found).cast("string")))
    return df.withColumn(name, parsed).filter(F.col(name).isNotNull())


def prefix_columns(df: DataFrame, prefix: str, protected: Iterable[str]) -> DataFrame:
    """P-02: ``prefix`` + name for all but protected and already prefixed columns."""
    keep = set(protected)
    return df.withColumnsRenamed(
        {c: f"{prefix}{c}" for c in df.columns if c not in keep and not c.startswith(prefix)}
    )


def detect_column(df: DataFrame, candidates: Sequence[str], parse: bool = False, share: float = 0.8) -> str:
    """P-04: exact name, then any case, then (dates) the first that parses for >= 80 % of rows."""
    for c in candidates:
        if c in df.columns:
            return c
    low = {c.lower(): c for c in reversed(df.columns)}
    for c in candidates:
        if c.lower() in low:
            return low[c.lower()]
    if parse:
        likely = [c for c in df.columns if any(t in c.lower() for t in ("date", "datetime", "timestamp"))]
        if likely:
            ratios = parse_ratios(df, likely).first()
            for c in likely:
                if ratios[c] is not None and ratios[c] >= share:
                    return c
    raise DataContractError(f"none of {list(candidates)} found in {df.columns}")


def parse_ratios(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of rows per column that parse as a timestamp, in one pass."""
    return df.agg(
        *[F.avg(F.try_to_timestamp(F.col(c).cast("string")).isNotNull().cast("int")).alias(c) for c in columns]
    )


def detect_date(df: DataFrame) -> str:
    return detect_column(df, DATE_CANDIDATES, parse=True)


def detect_id(df: DataFrame) -> str:
    return detect_column(df, ID_CANDIDATES)


def normalise(df: DataFrame) -> DataFrame:
    """P-05: trimmed text, infinities and NaN as NULL; nothing is imputed."""
    def fix(f):
        if isinstance(f.dataType, StringType):
            return F.trim(f.name).alias(f.name)
        if f.dataType.typeName() in ("double", "float"):
            return finite(F.col(f.name)).alias(f.name)
        return F.col(f.name)

    return df.select(*[fix(f) for f in df.schema.fields])


def clean(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P-05: normalised distinct rows, and a one-row report.

    The distinct is a hash aggregate over all columns: equal rows meet in the
    map-side combine, so copies of one row cannot pile up in a task.
    """
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    fixed = normalise(df)
    inf = reduce(
        lambda a, b: a + b, [F.count_if(F.abs(F.col(c)) == float("inf")) for c in floats], F.lit(0).cast("long")
    )
    before = df.agg(F.count(F.lit(1)).alias("rows_in"), inf.alias("infinite_cells"))
    out = fixed.distinct()
    after = out.agg(F.count(F.lit(1)).alias("rows_out"))
    report = before.withColumn("rows_out", after.scalar())
    return out, report.withColumn("duplicate_rows", F.col("rows_in") - F.col("rows_out"))


def collapse_duplicates(df: DataFrame) -> DataFrame:
    """P-06: one column per repeated label when all copies agree, else raise."""
    names = df.columns
    labelled = df.toDF(*[f"c{i}" for i in range(len(names))])
    first: dict[str, int] = {}
    pairs: list[tuple[str, int, int]] = []
    for i, n in enumerate(names):
        if n in first:
            pairs.append((n, first[n], i))
        else:
            first[n] = i
    if pairs:
        diff = labelled.agg(
            *[F.count_if(~F.col(f"c{a}").eqNullSafe(F.col(f"c{b}"))).alias(f"d{k}") for k, (_, a, b) in enumerate(pairs)]
        ).first()
        bad = [n for k, (n, _, _) in enumerate(pairs) if diff[f"d{k}"]]
        if bad:
            raise DataContractError(f"columns with one label and different values: {bad}")
    return labelled.select(*[F.col(f"c{i}").alias(n) for n, i in first.items()])


def non_null_counts(df: DataFrame) -> dict[str, int]:
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns]).first()
    return row.asDict()


def drop_all_null(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """P-07: drop columns without a single value; rows stay."""
    n = non_null_counts(df)
    gone = [c for c in df.columns if n[c] == 0 and n["_rows"] > 0]
    return df.drop(*gone), gone


def constant_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with at most one distinct non-NULL value, by min and max."""
    wide = df.agg(*[F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "is_constant")


def drop_constant(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """P-08."""
    gone = [r["column_name"] for r in constant_report(df, columns).collect() if r["is_constant"]]
    return df.drop(*gone), gone


def sparse_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "null_fraction")


def drop_sparse(df: DataFrame, columns: Sequence[str], limit: float = 0.20) -> tuple[DataFrame, list[str]]:
    """P-09: drop columns whose NULL share exceeds the limit."""
    gone = [r["column_name"] for r in sparse_report(df, columns).collect() if r["null_fraction"] > limit]
    return df.drop(*gone), gone


def static_predictors(df: DataFrame, sparse_limit: float = 0.20) -> list[str]:
    """P-10: stable numeric spatial columns that are filled well enough."""
    names = []
    for f in df.schema.fields:
        low = f.name.lower()
        if any(t in low for t in STATIC_EXCLUDED) or not isinstance(f.dataType, NumericType):
            continue
        if low in COORDINATES or low.startswith(STATIC_PREFIXES):
            names.append(f.name)
    if not names:
        raise DataContractError("no static spatial predictor in the table")
    share = {r["column_name"]: r["null_fraction"] for r in sparse_report(df, names).collect()}
    kept = [c for c in names if share[c] is not None and share[c] <= sparse_limit]
    if not kept:
        raise DataContractError("all static spatial predictors are too sparse")
    return kept


def hard_excluded(name: str, targets: Sequence[str]) -> bool:
    low = name.lower()
    return (
        low in {t.lower() for t in targets}
        or low in PREDICTOR_BLOCKED_NAMES
        or low.startswith("actual_")
        or any(t in low for t in PREDICTOR_BLOCKED)
    )


def predictors(
    columns: Sequence[str], horizon: int, targets: Sequence[str], roles: Mapping[str, tuple[str, str]] | None = None
) -> list[str]:
    """P-11: columns that may feed a model at one horizon.

    Forecast values of exactly this lead that say nothing about the run itself,
    admitted by weather family or by the dictionary, and past-only columns,
    admitted by prefix or by the dictionary.  ``roles`` is the dictionary: column
    to (feature group, final role).
    """
    chosen = []
    for c in columns:
        low = c.lower()
        if hard_excluded(c, targets):
            continue
        group, role = (roles or {}).get(c, ("", ""))
        ahead = low.endswith(f"_d{horizon}") and not any(t in low for t in PREDICTOR_META)
        known = (group, role) == ("weather_forecast", "forecast_predictor")
        past = low.startswith(PREDICTOR_HISTORY) or (
            group in ("historical_weather", "temporal_control") and role in ("historical_source", "candidate_predictor", "temporal_alignment")
        )
        if past or (ahead and (known or any(t in low for t in PREDICTOR_FAMILIES))):
            chosen.append(c)
    return chosen


def null_outside(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """P-13: values outside their physical range become NULL."""
    return df.withColumns({c: within(F.col(c), lo, hi) for c, (lo, hi) in ranges.items()})


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    return guards.report(df, {c: ~F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()})


def reject_outside(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """P-14: raise when any value leaves its range; NULL passes."""
    bad = [r.asDict() for r in range_violations(df, ranges).filter("n_bad > 0").collect()]
    if bad:
        raise DataContractError(f"values out of range: {bad}")
    return df


def clamp(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """P-15."""
    return df.withColumns({c: clip(F.col(c), lo, hi) for c, (lo, hi) in bounds.items()})


def complete_days(
    df: DataFrame, by: Sequence[str], ts: str, hours: int = 24, day: str = "day"
) -> DataFrame:
    """P-16: rows of days that hold every hour.

    Hours are counted as a 24-bit set in the map-side combine, then the few
    complete days are joined back; no window over the raw rows.
    """
    tagged = df.withColumn(day, F.to_date(ts))
    full = (
        tagged.groupBy(*by, day)
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(ts))).alias("_hours"))
        .filter(F.bit_count("_hours") == hours)
        .select(*by, day)
    )
    return tagged.join(full, [*by, day], "left_semi")


def complete_months(df: DataFrame, date_col: str, today: Column) -> DataFrame:
    """P-16: only calendar months that are over."""
    return df.filter(F.col(date_col) < F.trunc(today, "MM"))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P-17: rows with a value in every required column."""
    return df.dropna(subset=list(columns))


def common_columns(*frames: DataFrame) -> list[DataFrame]:
    """P-18: frames cut to their shared numeric columns, sorted by name."""
    shared = None
    for f in frames:
        names = {c.name for c in f.schema.fields if isinstance(c.dataType, NumericType)}
        shared = names if shared is None else shared & names
    return [f.select(*sorted(shared)) for f in frames]


# Which scenes each instrument keeps.
SCENE_RULES = {
    "optical_local": "cloud_pct < 20",
    "optical_area": "cloud_pct < 80",
    "radar": "mode = 'IW' and resolution_m = 10"
             " and array_contains(polarisations, 'VV') and array_contains(polarisations, 'VH')",
    "thermal": "processing_level = 'L2SP' and cloud_pct <= 60",
}


def filter_scenes(scenes: DataFrame, rule: str) -> DataFrame:
    """P-19."""
    return scenes.filter(SCENE_RULES[rule])


def canonical_lead(df: DataFrame, lead: int = 1) -> DataFrame:
    """P-20: ``x_d1`` also as ``x``; other columns unchanged."""
    suffix = f"_d{lead}"
    extra = {c[: -len(suffix)]: F.col(c) for c in df.columns if c.endswith(suffix)}
    return df.withColumns(extra)
