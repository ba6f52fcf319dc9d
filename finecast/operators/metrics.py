"""Forecast scores: raw against corrected, by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.functions.columns import safe_ratio
from finecast.operators.quantiles import exact_quantiles

# Rain categories (upper bounds, closed), exceedance thresholds,
# unit factor test, borderline limit.
RAIN_LIMITS = (0.0, 2.5, 10.0, 25.0)
RAIN_LABELS = ("dry", "light", "moderate", "heavy", "extreme")
EXCEEDANCE = (0.0, 2.5, 10.0, 25.0, 50.0)
UNIT_FACTOR, UNIT_TOLERANCE, UNIT_HORIZONS = 3.6, 0.25, 3
BORDERLINE_PCT = 5.0


def distribution(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """A-21: n, mean, median, sample std, min, p90, p95, p99, max, wet share.

    Groups here are few and huge (split, lead), so quantiles use the sliced
    exact method and the rest is one aggregate.
    """
    v = F.col(value)
    base = df.groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
        F.max(v).alias("max"), (F.avg((v > 0).cast("int")) * 100.0).alias("wet_pct"),
    )
    q = exact_quantiles(df, by, value, {"median": 0.5, "p90": 0.90, "p95": 0.95, "p99": 0.99})
    return base.join(q, list(by), "left")


def distribution_shift(stats: DataFrame, by: Sequence[str], split: str, base: str, other: str, fields: Sequence[str]) -> DataFrame:
    """A-22: statistics of one split over another; NULL when the denominator is 0 or NULL."""
    def of(s, f):
        return F.max(F.when(F.col(split) == s, F.col(f)))

    return stats.groupBy(*by).agg(*[safe_ratio(of(other, f), of(base, f)).alias(f"{f}_ratio") for f in fields])


def exceedance(df: DataFrame, by: Sequence[str], value: str, thresholds: Sequence[float] = EXCEEDANCE) -> DataFrame:
    """A-23."""
    def label(t):
        return f"over_{t:g}".replace(".", "_")

    return df.groupBy(*by).agg(
        F.count(value).alias("n"), *[F.count_if(F.col(value) > t).alias(label(t)) for t in thresholds],
        F.max(value).alias("max_value"),
    )


def rain_category(c: Column) -> Column:
    out = F.when(c <= RAIN_LIMITS[0], RAIN_LABELS[0])
    for limit, label in zip(RAIN_LIMITS[1:], RAIN_LABELS[1:]):
        out = out.when(c <= limit, label)
    return out.when(c.isNotNull(), RAIN_LABELS[-1])


def _errors(truth: Column, pred: Column, tag: str) -> list[Column]:
    e = pred - truth
    return [
        F.sqrt(F.avg(e * e)).alias(f"{tag}_rmse"),
        F.avg(F.abs(e)).alias(f"{tag}_mae"),
        F.avg(e).alias(f"{tag}_bias"),
    ]


def improvement_pct(raw: Column, corrected: Column) -> Column:
    """A-27: share of the raw error removed, NULL when raw is 0."""
    return safe_ratio((raw - corrected) * 100.0, raw)


def improvement_label(pct: Column) -> Column:
    return F.when(pct > 0, "IMPROVED").when(pct.isNotNull(), "WORSE").otherwise("UNDEFINED")


def category_errors(pred: DataFrame, by: Sequence[str], truth: str, raw: str, corrected: str) -> DataFrame:
    """A-24: errors per rain category; categories without rows stay with n = 0."""
    full = pred.dropna(subset=[truth, raw, corrected]).withColumn("category", rain_category(F.col(truth)))
    t, r, c = F.col(truth), F.col(raw), F.col(corrected)
    got = full.groupBy(*by, "category").agg(
        F.count(F.lit(1)).alias("n"), F.avg(t).alias("actual_mean"), *_errors(t, r, "raw"), *_errors(t, c, "corrected")
    )
    labels = F.explode(F.array(*[F.lit(x) for x in RAIN_LABELS])).alias("category")
    grid = full.select(*by).distinct().select(*by, labels)
    return (
        grid.join(got, [*by, "category"], "left")
        .na.fill({"n": 0})
        .withColumn("rmse_improvement_pct", improvement_pct(F.col("raw_rmse"), F.col("corrected_rmse")))
    )


def extreme_share(pred: DataFrame, by: Sequence[str], truth: str, raw: str, corrected: str, prob: float = 0.95) -> DataFrame:
    """A-25: part of the squared error that falls on events at or above the group's own P95."""
    full = pred.dropna(subset=[truth, raw, corrected])
    p = exact_quantiles(full, by, truth, {"p95_threshold": prob})
    j = full.join(p, list(by))
    t = F.col(truth)
    hot = t >= F.col("p95_threshold")
    er, ec = F.pow(F.col(raw) - t, 2), F.pow(F.col(corrected) - t, 2)
    g = j.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.any_value("p95_threshold").alias("p95_threshold"),
        F.count_if(hot).alias("extreme_event_count"),
        F.sum(er).alias("raw_total_squared_error"), F.sum(F.when(hot, er)).alias("raw_extreme_squared_error"),
        F.sum(ec).alias("corrected_total_squared_error"), F.sum(F.when(hot, ec)).alias("corrected_extreme_squared_error"),
    )
    return g.withColumns(
        {
            "extreme_event_pct": F.lit(100.0) * F.col("extreme_event_count") / F.col("n"),
            "raw_extreme_error_contribution_pct": safe_ratio(F.col("raw_extreme_squared_error") * 100.0, F.col("raw_total_squared_error")),
            "corrected_extreme_error_contribution_pct": safe_ratio(
                F.col("corrected_extreme_squared_error") * 100.0, F.col("corrected_total_squared_error")
            ),
        }
    )


def regression_metrics(pred: DataFrame, by: Sequence[str], truth: str, estimate: str) -> DataFrame:
    """A-26: RMSE, MAE, bias, R2 = 1 - SSE/SST, MAPE over |y| > 1e-8, wet-day MAE, status.

    One pass; SST is n times the population variance, which Spark computes by
    stable central moments.
    """
    t, p = F.col(truth), F.col(estimate)
    both = t.isNotNull() & p.isNotNull()
    y, e = F.when(both, t), F.when(both, p - t)
    sse, sst = F.sum(e * e), F.var_pop(y) * F.count(y)
    return pred.groupBy(*by).agg(
        F.count(e).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"),
        F.when(sst > 1e-12, F.lit(1.0) - sse / sst).alias("r2"),
        (F.avg(F.when(F.abs(y) > 1e-8, F.abs(e / y))) * 100.0).alias("mape_nonzero"),
        F.avg(F.when(y > 0, F.abs(e))).alias("wet_mae"),
        F.when(F.count(p) == 0, "UNAVAILABLE").when(F.count(e) == 0, "NO_OVERLAP").otherwise("PASS").alias("status"),
    )


def horizon_evaluation(pred: DataFrame, by: Sequence[str], truth: str, raw: str, corrected: str) -> DataFrame:
    """M-11: raw and corrected scores side by side with improvement and label."""
    full = pred.dropna(subset=[truth, raw, corrected])
    t, r, c = F.col(truth), F.col(raw), F.col(corrected)
    g = full.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *_errors(t, r, "raw"), *_errors(t, c, "corrected"))
    pct = improvement_pct(F.col("raw_rmse"), F.col("corrected_rmse"))
    return g.withColumn("rmse_improvement_pct", pct).withColumn("verdict", improvement_label(F.col("rmse_improvement_pct")))


def occurrence_scores(pred: DataFrame, by: Sequence[str], truth: str, prob: str, wet: float = 0.0, cut: float = 0.5) -> DataFrame:
    """A-28: confusion cells, precision, recall, F1, accuracy; zero division gives 0."""
    full = pred.dropna(subset=[truth, prob])
    y, p = F.col(truth) > wet, F.col(prob) >= cut
    g = full.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    def zero(a, b):
        return F.coalesce(safe_ratio(a, b), F.lit(0.0))

    return g.select(
        "*",
        zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        zero(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        zero(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        zero(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"),
    )


def select_method(evaluation: DataFrame, by: Sequence[str], split: str = "split", pct: str = "rmse_improvement_pct") -> DataFrame:
    """A-29: method chosen on validation only, with borderline reasons."""
    val = F.max(F.when(F.col(split) == "validation", F.col(pct)))
    test = F.max(F.when(F.col(split) == "test", F.col(pct)))
    g = evaluation.groupBy(*by).agg(
        val.alias("validation_improvement_pct"), test.alias("test_improvement_pct"),
        F.count_if(F.col(split) == "validation").alias("_n"),
    ).filter("_n > 0").drop("_n")
    v, t = F.col("validation_improvement_pct"), F.col("test_improvement_pct")
    reasons = F.array_compact(
        F.array(
            F.when(F.abs(v) < BORDERLINE_PCT, "validation improvement < 5%"),
            F.when(F.abs(t) < BORDERLINE_PCT, "test improvement < 5%"),
            F.when(F.signum(v) != F.signum(t), "validation/test improvement signs disagree"),
        )
    )
    return g.select(
        "*",
        F.when(v > 0, "SPECIALIZED_CORRECTION").otherwise("RAW_FORECAST").alias("selected_method"),
        F.lit("VALIDATION_ONLY").alias("selection_basis"),
        F.when(F.size(reasons) > 0, "BORDERLINE").otherwise("CLEAR").alias("status"),
        F.array_join(reasons, "; ").alias("reasons"),
    )


def unit_ratio(pred: DataFrame, by: Sequence[str], truth: str, raw: str, factor: float = UNIT_FACTOR) -> DataFrame:
    """A-30: does the mean ratio look like a unit mix-up?  Errors before and after conversion."""
    full = pred.dropna(subset=[truth, raw])
    t, r = F.col(truth), F.col(raw)
    conv = t / factor
    g = full.groupBy(*by).agg(
        F.avg(r).alias("raw_mean"), F.avg(t).alias("actual_mean"),
        F.sqrt(F.avg(F.pow(t - r, 2))).alias("rmse_original"), F.avg(F.abs(t - r)).alias("mae_original"),
        F.sqrt(F.avg(F.pow(conv - r, 2))).alias("rmse_converted"), F.avg(F.abs(conv - r)).alias("mae_converted"),
    )
    ratio = safe_ratio(F.col("actual_mean"), F.col("raw_mean"))
    return g.withColumn("ratio", ratio).withColumn(
        "possible_unit_mismatch", F.coalesce(F.abs(F.col("ratio") - factor) < UNIT_TOLERANCE, F.lit(False))
    )


def unit_decision(ratios: DataFrame) -> DataFrame:
    """A-30: enough horizons with the tell-tale ratio call for reconciliation."""
    n = F.count_if(F.col("possible_unit_mismatch"))
    return ratios.agg(
        n.alias("n_horizons"),
        F.when(n >= UNIT_HORIZONS, "UNIT_RECONCILIATION_REQUIRED").otherwise("RAW_FORECAST_PENDING_VERIFICATION").alias("decision"),
    )


def publish_decision(evaluation: DataFrame, by: str = "variable") -> DataFrame:
    """M-15: RAW_FORECAST, SPECIALIZED_CORRECTION, pending or unavailable per variable.

    The rule is this library's own: a correction is published when it improves
    more than half of the horizons.  Decide on the validation split; the test
    split is for reporting alone.
    ``evaluation(variable, horizon, rmse_improvement_pct, n, unit_mismatch)``.
    """
    g = evaluation.groupBy(by).agg(
        F.sum("n").alias("n"), F.count_if(F.col("rmse_improvement_pct") > 0).alias("improved_horizons"),
        F.count(F.lit(1)).alias("horizons"), F.count_if(F.col("unit_mismatch")).alias("mismatched_horizons"),
    )
    return g.withColumn(
        "decision",
        F.when(F.col("n") == 0, "UNAVAILABLE_PENDING_FORECAST_SOURCE")
        .when(F.col("mismatched_horizons") >= UNIT_HORIZONS, "RAW_FORECAST_PENDING_UNIT_VERIFICATION")
        .when(F.col("improved_horizons") * 2 > F.col("horizons"), "SPECIALIZED_CORRECTION")
        .otherwise("RAW_FORECAST"),
    )
