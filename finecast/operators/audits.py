"""Leakage, availability and training-set audits as report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.functions.columns import close
from finecast.functions.names import COORDINATE_NAMES, has_role
from finecast.operators import guards
from finecast.operators.aggregates import duplicate_rows, profile
from finecast.operators.sets import union_chunks
from finecast.operators.windows import history_columns
from finecast.session import bounded_tasks, materialise

# Dictionary rows by role, decided first match first
# (group, final role, engineering action, availability, leakage risk).
DICTIONARY_RULES = {
    "all_null": ("unavailable", "exclude", "exclude_100pct_unavailable", "unavailable_in_current_dataset", "none"),
    "coordinate": ("spatial_location", "candidate_predictor", "retain_for_spatial_modeling", "static", "low"),
    "identifier": ("identifier", "metadata", "retain_for_joining_only", "static", "none"),
    "temporal": ("temporal_control", "temporal_alignment", "retain_for_temporal_alignment", "known_at_issue_time", "medium"),
    "provenance": ("provenance", "metadata", "retain_for_audit_provenance", "static_or_source_defined", "none"),
    "availability": ("data_availability", "candidate_predictor", "retain_as_availability_feature", "known_at_issue_time", "medium"),
    "actual": ("historical_weather", "historical_source", "use_only_as_past_lag_rolling_feature_or_target", "observed_before_issue_time", "high_if_same_target"),
    "forecast": ("weather_forecast", "forecast_predictor", "retain_with_issue_time_and_lead_alignment", "issued_by_issue_time", "controlled"),
    "reanalysis": ("reanalysis", "candidate_predictor", "retain_with_temporal_availability_control", "published_by_issue_time", "medium"),
    "satellite": ("remote_sensing", "gp_spatial_predictor", "retain_with_acquisition_date_and_availability_control", "acquired_by_issue_time", "medium"),
    "static": ("static_spatial_environment", "gp_spatial_predictor", "retain_as_static_spatial_predictor", "static", "low"),
    "constant": ("constant_physical_or_metadata", "review", "retain_for_multi_block_review_before_removal", "dataset_defined", "low"),
    "numeric": ("other_numeric", "candidate_predictor", "retain_for_scientific_review", "known_at_issue_time", "review"),
    "other": ("other_categorical", "metadata_or_candidate", "retain_for_scientific_review", "dataset_defined", "review"),
}
DICTIONARY_FIELDS = ("feature_group", "final_role", "engineering_action", "availability_rule", "leakage_risk")
# Inventory tokens, first match first (class, role, action).
INVENTORY_RULES = (
    (("synthetic", "interpolation", "fallback"), ("provenance", "metadata", "exclude_initial")),
    (("id", "uuid", "code", "name", "geometry", "wkt", "polygon", "source", "timezone", "retrieval", "timestamp",
      "model"), ("metadata_or_identifier", "metadata", "exclude_initial")),
    (("target", "actual", "rainfall", "precip", "precipitation"), ("weather_or_target_candidate", "predictor_or_target", "review")),
    (("date", "time", "lag", "rolling", "lead", "previous", "acquisition"), ("temporal", "temporal", "review")),
    (("latitude", "longitude", "lat", "lon", "elevation", "slope", "aspect", "distance", "terrain", "landcover", "soil",
      "ndvi", "evi", "savi", "ndmi", "nbr", "vv", "vh", "lst"), ("spatial_or_remote_sensing", "predictor", "keep_review")),
)
NUMERIC_TYPES = r"^(tinyint|smallint|int|bigint|float|double|decimal.*)$"
MATCH_RATE = 0.999
SPLITS = ("train", "validation", "test")
FORBIDDEN_TOKENS = ("actual_", "target", "provenance", "source_file", "retrieved")


def _pick(key: Column, table: Mapping[str, tuple], fields: Sequence[str]) -> list[Column]:
    out = []
    for i, f in enumerate(fields):
        m = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v[i]))])
        out.append(F.element_at(m, key).alias(f))
    return out


def feature_inventory(df: DataFrame, dataset: str, level: str) -> DataFrame:
    """Q-01: profile per column plus a preliminary class from the name, as a table.

    A name falls under a rule by a whole part of it, a number at the end or a
    plural left aside: "humidity" holds no "id", "gp_id" and "gpId" do.
    """
    parts = F.regexp_replace(F.regexp_replace("column_name", "([A-Z])([A-Z][a-z])", "$1_$2"), "([a-z0-9])([A-Z])", "$1_$2")
    rule = None
    for i, (tokens, _) in enumerate(INVENTORY_RULES):
        hit = F.lower(parts).rlike(f"(^|[^a-z0-9])({'|'.join(tokens)})s?[0-9]*($|[^a-z0-9])")
        rule = F.when(hit, F.lit(str(i))) if rule is None else rule.when(hit, F.lit(str(i)))
    rule = rule.when(F.col("dtype").rlike(NUMERIC_TYPES), "num").when(F.col("dtype") == "boolean", "bool").otherwise("text")
    table = {str(i): v for i, (_, v) in enumerate(INVENTORY_RULES)} | {
        "num": ("numeric_environmental_or_derived", "predictor", "keep_review"),
        "bool": ("boolean_indicator", "predictor_or_metadata", "review"),
        "text": ("categorical_or_text", "categorical_or_metadata", "review"),
    }
    p = profile(df)
    return p.select(
        F.lit(dataset).alias("dataset"), F.lit(level).alias("level"), "column_name", "dtype", "row_count",
        F.col("null_count").alias("missing_count"),
        F.round(F.try_divide(F.col("null_count") * 100.0, F.col("row_count")), 4).alias("missing_percent"),
        "all_null", "constant_non_null", *_pick(rule, table, ("classification", "preliminary_role", "preliminary_action")),
    )


def dictionary_rule(name: Column, dtype: Column, all_null: Column, constant: Column) -> Column:
    """Q-03: the first rule a column falls under."""
    return (
        F.when(all_null, "all_null")
        .when(F.lower(name).isin(*COORDINATE_NAMES), "coordinate")
        .when(has_role(name, "identifier"), "identifier")
        .when(has_role(name, "temporal"), "temporal")
        .when(has_role(name, "provenance"), "provenance")
        .when(has_role(name, "availability"), "availability")
        .when(has_role(name, "actual"), "actual")
        .when(has_role(name, "forecast"), "forecast")
        .when(has_role(name, "reanalysis"), "reanalysis")
        .when(has_role(name, "satellite"), "satellite")
        .when(has_role(name, "static"), "static")
        .when(constant, "constant")
        .when(dtype.rlike(NUMERIC_TYPES), "numeric")
        .otherwise("other")
    )


def feature_dictionary(df: DataFrame, dataset: str, level: str, removed: Sequence[str] = ()) -> DataFrame:
    """Q-02: one row per column: profile, role, action, leakage risk; removed columns stay documented."""
    p = profile(df)
    if removed:
        blank = p.limit(1).select(
            F.explode(F.array(*[F.lit(r) for r in removed])).alias("column_name"), F.lit("double").alias("dtype"),
            "row_count", F.col("row_count").alias("null_count"), F.lit(0).cast("long").alias("infinite_count"),
            F.lit(True).alias("all_null"), F.lit(False).alias("constant_non_null"),
            F.lit(None).cast("double").alias("min_value"), F.lit(None).cast("double").alias("max_value"),
        )
        p = p.unionByName(blank)
    rule = dictionary_rule(F.col("column_name"), F.col("dtype"), F.col("all_null"), F.col("constant_non_null"))
    return p.select(
        "column_name", F.lit(dataset).alias("source_dataset"), F.lit(level).alias("level"), "dtype", "row_count",
        F.col("null_count").alias("missing_count"),
        F.try_divide(F.col("null_count") * 100.0, F.col("row_count")).alias("missing_percent"),
        F.col("all_null").alias("all_missing_100pct"), "constant_non_null",
        *_pick(rule, DICTIONARY_RULES, DICTIONARY_FIELDS),
    )


def dictionary_summary(d: DataFrame) -> DataFrame:
    """A-33: counts by group, role, action and dataset in one table."""
    facets = ("feature_group", "final_role", "engineering_action", "source_dataset")
    cells = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in facets])
    return d.select(F.explode(cells).alias("c")).groupBy("c.facet", "c.value").agg(F.count(F.lit(1)).alias("n"))


def engineered_audit(df: DataFrame, date_col: str) -> DataFrame:
    """Q-04: (check, n_bad, status) for an engineered table."""
    p = profile(df).agg(
        F.sum("infinite_count").alias("infinite_cells"), F.count_if("all_null").alias("all_null_columns"),
        F.count_if("constant_non_null").alias("constant_columns"),
        F.count_if(F.lower("column_name").startswith("actual_")).alias("leakage_named_columns"),
    )
    names = ["infinite_cells", "all_null_columns", "constant_columns", "leakage_named_columns"]
    by_profile = p.unpivot([], names, "check_name", "n_bad")
    dup = duplicate_rows(df).select(F.lit("duplicate_rows").alias("check_name"), F.col("duplicate_rows").alias("n_bad"))
    dates = df.agg(F.count_if(F.col(date_col).isNull()).alias("n_bad")).select(F.lit("invalid_dates").alias("check_name"), "n_bad")
    return _with_status(union_chunks(by_profile, dup, dates))


def _with_status(checks: DataFrame) -> DataFrame:
    return checks.withColumn("status", F.when(F.col("n_bad") == 0, "PASS").otherwise("FAIL"))


def verify_history(
    engineered: DataFrame, source: DataFrame, by: Sequence[str], date_col: str, columns: Sequence[str],
    rain: Sequence[str] = (), tol: float = 1e-8,
) -> DataFrame:
    """Q-05: recompute every ``hist__`` column from source and compare by entity and date."""
    wanted = [c for c in engineered.columns if c.startswith("hist__")]
    exprs = history_columns(by, date_col, [c for c in columns if c in source.columns], rain)
    known = [c for c in wanted if c in exprs]
    again = source.select(*by, date_col, *[exprs[c].alias(f"r_{c}") for c in known])
    j = engineered.select(*by, date_col, *known).join(again, [*by, date_col])
    aggs = []
    for c in known:
        a, b = F.col(c), F.col(f"r_{c}")
        aggs += [
            F.count(F.abs(a - b)).alias(f"n|{c}"), F.max(F.abs(a - b)).alias(f"e|{c}"),
            F.count_if(a.isNull() != b.isNull()).alias(f"x|{c}"),
        ]
    row = j.agg(*aggs) if aggs else engineered.limit(1).select(F.lit(1).alias("_"))
    parts = [
        F.struct(
            F.lit(c).alias("feature"), F.col(f"`n|{c}`").alias("comparisons"), F.col(f"`e|{c}`").alias("max_abs_error"),
            F.when(F.col(f"`n|{c}`") == 0, "NO_OVERLAP")
            .when((F.col(f"`e|{c}`") <= tol) & (F.col(f"`x|{c}`") == 0), "PASS")
            .otherwise("MISMATCH").alias("status"),
        )
        for c in known
    ] + [
        F.struct(
            F.lit(c).alias("feature"), F.lit(0).cast("long").alias("comparisons"), F.lit(None).cast("double").alias("max_abs_error"),
            F.lit("SOURCE_COLUMN_MISSING").alias("status"),
        )
        for c in wanted if c not in exprs
    ]
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def classify_actuals(rates: DataFrame) -> DataFrame:
    """Q-06: role of each ``actual_`` column from its match rates (see ``joins.match_rates``)."""
    low = F.lower("column_name")
    return rates.withColumn(
        "provisional_role",
        F.when(low.isin("actual_source", "actual_timezone", "actual_is_reference_only"), "metadata_or_reference")
        .when(low.rlike("latitude|longitude"), "spatial_metadata")
        .when(F.col("target_rate") >= MATCH_RATE, "likely_target_or_target_reference")
        .when(F.col("issue_rate") >= MATCH_RATE, "likely_available_at_run_time")
        .otherwise("REVIEW"),
    )


def chronology_audit(fc: DataFrame, lead: str, target_date: str, issue_date: str) -> DataFrame:
    """Q-07: per lead: rows, bad chronology, wrong lead, range of target minus issue."""
    d = F.datediff(F.col(target_date), F.col(issue_date))
    bad = F.count_if(d.isNull() | (d <= 0))
    wrong = F.count_if(d.isNotNull() & (d != F.col(lead)))
    return fc.groupBy(lead).agg(
        F.count(F.lit(1)).alias("rows"), bad.alias("bad_chronology"), wrong.alias("wrong_lead"),
        F.min(d).alias("min_delta_days"), F.max(d).alias("max_delta_days"),
        F.when((bad == 0) & (wrong == 0), "PASS").otherwise("FAIL").alias("status"),
    )


def flag_audit(df: DataFrame, expected: Mapping[str, bool]) -> DataFrame:
    """Q-08: control flags constant at their expected value; NULL counts as a deviation."""
    return guards.report(df, {c: ~F.col(c).eqNullSafe(F.lit(v)) for c, v in expected.items()})


def training_audit(
    samples: DataFrame, features: Sequence[str], labels: Sequence[str], entity: str, date_col: str, lead: str,
    split: str = "split",
) -> DataFrame:
    """Q-09: one report over a training set.  NULL features are allowed, infinite ones are not."""
    numeric = {f.name for f in samples.schema.fields if f.dataType.typeName() in
               ("double", "float", "integer", "long", "short", "byte", "decimal")}
    low = [f.lower() for f in features]
    static = {
        "forbidden_predictor": sum(any(t in f for t in FORBIDDEN_TOKENS) for f in low),
        "target_in_predictors": sum(f in labels for f in features),
        "non_numeric_predictor": sum(f not in numeric for f in features),
        "missing_label_column": sum(c not in samples.columns for c in labels),
    }
    floats = [f for f in features if f in numeric]
    infinite = [F.count_if(F.isnan(F.col(f).cast("double")) | (F.abs(F.col(f).cast("double")) == float("inf"))) for f in floats]
    empty = [F.when(F.count(f) == 0, 1).otherwise(0) for f in floats]
    total = lambda xs: sum(xs[1:], xs[0]).cast("long") if xs else F.lit(0).cast("long")
    names = [*static, "non_finite_cell", "all_null_predictor", "invalid_date", "missing_entity", "missing_label"]
    agg = samples.agg(
        *[F.lit(v).cast("long").alias(k) for k, v in static.items()],
        total(infinite).alias("non_finite_cell"), total(empty).alias("all_null_predictor"),
        F.count_if(F.col(date_col).isNull()).alias("invalid_date"), F.count_if(F.col(entity).isNull()).alias("missing_entity"),
        total([F.count_if(F.col(c).isNull()) for c in labels if c in samples.columns]).alias("missing_label"),
    ).unpivot([], names, "check_name", "n_bad")
    # One shuffle on the sample key serves duplicates, overlap and order: the
    # later steps work on one row per key, per date and per lead.
    # Splits travel as small numbers, which keeps the aggregates hash-based.
    number = F.lit(len(SPLITS))
    for i, name in enumerate(SPLITS):
        number = F.when(F.col(split) == name, i).otherwise(number)
    per_key = samples.select(lead, date_col, entity, number.alias("s")).groupBy(lead, date_col, entity).agg(
        F.count(F.lit(1)).alias("n"), F.bit_or(F.pow(F.lit(2), F.col("s")).cast("int")).alias("bits")
    )
    per_date = per_key.groupBy(lead, date_col).agg(
        F.count_if(F.col("n") > 1).alias("dup"), F.bit_or("bits").alias("bits")
    ).select(
        "*", *[(F.col("bits").bitwiseAND(F.lit(1 << i)) > 0).alias(f"has_{name}") for i, name in enumerate(SPLITS)]
    )

    def edge(f, s):
        return f(F.when(F.col(f"has_{s}"), F.col(date_col)))

    per_lead = per_date.groupBy(lead).agg(
        F.sum("dup").alias("dup"), F.count_if(F.bit_count("bits") > 1).alias("overlap"),
        edge(F.max, "train").alias("t1"), edge(F.min, "validation").alias("v0"),
        edge(F.max, "validation").alias("v1"), edge(F.min, "test").alias("s0"),
    )
    late = F.count_if((F.col("t1") >= F.col("v0")) | (F.col("v1") >= F.col("s0")))
    keyed = per_lead.agg(
        F.coalesce(F.sum("dup"), F.lit(0)).alias("duplicate_sample"),
        F.coalesce(F.sum("overlap"), F.lit(0)).alias("split_overlap"), late.alias("split_order"),
    ).unpivot([], ["duplicate_sample", "split_overlap", "split_order"], "check_name", "n_bad")
    # Run at once, as one job, so that the tasks of the sample keys can be kept small.
    with bounded_tasks(samples.sparkSession):
        return materialise(_with_status(agg.unionByName(keyed)), "training-audit")


def target_preflight(target: DataFrame, keys: Sequence[str], ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Q-10: key and range contract of a target table."""
    guards.require_columns(target, [*keys, *ranges])
    any_key = F.lit(False)
    for k in keys:
        any_key = any_key | F.col(k).isNull()
    base = guards.report(target, {"null_key": any_key} | {f"range_{c}": ~F.col(c).between(a, b) for c, (a, b) in ranges.items()})
    dup = guards.duplicate_keys(target, keys).agg(F.count(F.lit(1)).alias("n_bad"))
    return base.unionByName(_with_status(dup.select(F.lit("duplicate_key").alias("check_name"), "n_bad")))


def run_gate(checks: DataFrame) -> DataFrame:
    """Q-11: PASS, or REVIEW_REQUIRED with the failing checks (one row per check goes in)."""
    failing = F.sort_array(F.collect_list(F.when(F.col("status") != "PASS", F.col("check_name"))))
    return checks.agg(
        F.count(F.lit(1)).alias("n_checks"), F.count_if(F.col("status") != "PASS").alias("n_failed"),
        F.array_join(failing, "; ").alias("blockers"),
    ).withColumn("status", F.when(F.col("n_failed") == 0, "PASS").otherwise("REVIEW_REQUIRED"))


# Checks in the order in which they decide, with their outcome.
TRAINING_GATE = (
    ("required_source_columns", "DO_NOT_TRAIN_YET"),
    ("forecast_temporal_integrity", "DO_NOT_TRAIN_YET"),
    ("target_leakage_absent", "DO_NOT_TRAIN_YET"),
    ("training_datasets_exist", "DO_NOT_TRAIN_YET"),
    ("wind_source_compatibility", "WIND_REQUIRES_SOURCE_FIX"),
)


def training_gate(checks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Q-12: first failing (or absent) named check decides, per group of ``by``."""
    ok = {n: F.coalesce(F.bool_and(F.when(F.col("check_name") == n, F.col("status") == "PASS")), F.lit(False)) for n, _ in TRAINING_GATE}
    flags = checks.groupBy(*by).agg(*[c.alias(n) for n, c in ok.items()])
    decision, first = None, None
    for n, outcome in TRAINING_GATE:
        bad = ~F.col(n)
        decision = F.when(bad, outcome) if decision is None else decision.when(bad, outcome)
        first = F.when(bad, n) if first is None else first.when(bad, n)
    return flags.select("*", decision.otherwise("READY_FOR_TRAINING").alias("decision"), first.alias("first_failed"))
