"""Models: residual correction, direct regression, two-stage rain.

Residuals of all leads at once are learned by extremely randomised trees with
one output per lead (``extra_trees``).  The MLlib forests keep leads in the long
layout, as a feature: one fit per variable; their values are judged by skill.

MLlib grows trees over ``BINS`` bins of a feature, so rows that share all bins
are alike to it.  Rows are therefore binned and gathered on Spark first, all of
them, into weighted points: number of rows and mean label.  Gains of a split
hang on these sums alone, and a fit costs one aggregate over the rows and then
as much as the points, which a few features bound however many rows there are.
Forests draw points, not rows, for each tree; where bins leave room, the rows
of a bin are dealt over several points, up to ``POINTS`` in all.  ``LEAF`` is
kept in rows, by weight.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, QuantileDiscretizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finecast.errors import DataContractError
from finecast.functions.columns import clip, expm1, log1p
from finecast.operators import extra_trees
from finecast.operators.training import blended_rain, forbid_actuals, impute, median_imputer
from finecast.session import materialise

# Forest settings, blend weight, least number of wet rows.
TREES, LEAF, SEED = 100, 5, 42
RAIN_WEIGHT, MIN_WET_ROWS, OCCURRENCE_CUT = 0.7, 10, 0.5
# Bins of a feature (MLlib's own number) and points that a forest may have where bins are few.
BINS, POINTS = 32, 2**19


def _regressor(label: str, trees: int, depth: int, output: str, rows: float) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol=label, weightCol="_n", predictionCol=output, numTrees=trees, maxDepth=depth,
        minWeightFractionPerNode=min(0.49, LEAF / rows), featureSubsetStrategy="sqrt", maxBins=BINS, seed=SEED,
    )


def _bin(feature: str) -> str:
    return f"_bin_{feature}"


def _vector(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[_bin(c) for c in features], outputCol="features", handleInvalid="error")


def _bins(rows: DataFrame, features: Sequence[str]) -> Bucketizer:
    return QuantileDiscretizer(
        inputCols=list(features), outputCols=[_bin(c) for c in features], numBuckets=BINS, handleInvalid="error"
    ).fit(rows)


def _points(rows: DataFrame, bins: Bucketizer, features: Sequence[str], label: str, by: Sequence[str] = (), limit: int = POINTS) -> DataFrame:
    """All of ``rows`` as points: ``features`` of bins, ``by``, number of rows ``_n`` and mean ``label``."""
    pieces = max(1, limit // _combinations(bins))
    keys = [*[_bin(c) for c in features], *by]
    piece = F.pmod(F.xxhash64(*features, label), F.lit(pieces))
    held = bins.transform(rows).groupBy(*keys, piece.alias("_piece")).agg(
        F.count(F.lit(1)).cast("double").alias("_n"), F.avg(label).alias(label)
    )
    spread = held.repartition(rows.sparkSession.sparkContext.defaultParallelism, *keys, "_piece").sortWithinPartitions(*keys, "_piece")
    return _vector(features).transform(materialise(spread, "points"))


def _combinations(bins: Bucketizer) -> int:
    return math.prod(len(s) - 1 for s in bins.getSplitsArray())


def _by_bins(df: DataFrame, bins: Bucketizer, features: Sequence[str], score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``df`` with the columns that ``score`` adds to bins; where bins are few, each combination is scored once."""
    held, names = bins.transform(df), [_bin(c) for c in features]
    if _combinations(bins) > POINTS:
        return score(held).drop("features", *names)
    cells = held.select(*names).distinct().repartition(df.sparkSession.sparkContext.defaultParallelism, *names)
    return held.join(score(cells).drop("features"), names).drop(*names)


@dataclass
class Corrector:
    """Residual or direct model together with its imputation values and feature order."""

    model: PipelineModel
    features: list[str]
    medians: dict[str, float]
    output: str

    def predict(self, df: DataFrame) -> DataFrame:
        bins, *rest = self.model.stages
        return _by_bins(impute(df, self.medians), bins, self.features, PipelineModel(rest).transform)

    def save(self, path: str) -> None:
        """M-14."""
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.active()
        rows = [(i, f, self.medians.get(f), self.output) for i, f in enumerate(self.features)]
        spark.createDataFrame(rows, "position int, feature string, median double, output string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/contract")


def load_corrector(spark, path: str) -> Corrector:
    rows = spark.read.parquet(f"{path}/contract").orderBy("position").collect()
    return Corrector(
        PipelineModel.load(f"{path}/model"), [r["feature"] for r in rows],
        {r["feature"]: r["median"] for r in rows if r["median"] is not None}, rows[0]["output"],
    )


def fit_residual(train: DataFrame, features: Sequence[str], truth: str, raw: str, trees: int = TREES, depth: int = 8) -> Corrector:
    """M-08: forest on truth - raw; the corrected value is raw plus its prediction."""
    forbid_actuals(features)
    usable = train.dropna(subset=[truth, raw]).withColumn("_residual", F.col(truth) - F.col(raw))
    return _fitted(usable, features, "_residual", "predicted_residual", "forest", trees, depth)


def _fitted(usable: DataFrame, features: Sequence[str], label: str, output: str, kind: str, trees: int, depth: int) -> Corrector:
    usable = materialise(usable.select(*features, F.col(label).cast("double").alias("_label")), "model-rows")
    medians = median_imputer(usable, features)
    filled = impute(usable, medians)
    bins = _bins(filled, features)
    if kind == "forest":
        points = _points(filled, bins, features, "_label")
        est = _regressor("_label", trees, depth, output, points.agg(F.sum("_n")).first()[0])
    elif kind == "boosted":
        points = _points(filled, bins, features, "_label", limit=1)
        est = GBTRegressor(featuresCol="features", labelCol="_label", weightCol="_n", predictionCol=output, maxIter=trees, maxDepth=min(depth, 5), maxBins=BINS, seed=SEED)
    else:
        raise ValueError(kind)
    model = PipelineModel([bins, _vector(features), est.fit(points)])
    return Corrector(model, list(features), medians, output)


def apply_residual(corrector: Corrector, df: DataFrame, raw: str, low: float | None = None, high: float | None = None) -> DataFrame:
    out = corrector.predict(df)
    return out.withColumn("corrected", clip(F.col(raw) + F.col(corrector.output), low, high))


@dataclass
class OutputsCorrector:
    """Trees with one output per lead, together with the imputation values."""

    model: extra_trees.ExtraTrees
    medians: dict[str, float]

    def save(self, path: str) -> None:
        """M-14."""
        self.model.save(f"{path}/nodes")
        rows = [(i, f, self.medians.get(f), "predictor") for i, f in enumerate(self.model.features)]
        rows += [(i, o, float(self.model.trees), "output") for i, o in enumerate(self.model.outputs)]
        spark = SparkSession.active()
        spark.createDataFrame(rows, "position int, name string, value double, role string").coalesce(1).write.mode("overwrite").parquet(f"{path}/contract")


def load_outputs_corrector(spark: SparkSession, path: str) -> OutputsCorrector:
    rows = spark.read.parquet(f"{path}/contract").orderBy("position").collect()
    features, outputs = ([r["name"] for r in rows if r["role"] == role] for role in ("predictor", "output"))
    trees = int(next(r["value"] for r in rows if r["role"] == "output"))
    medians = {r["name"]: r["value"] for r in rows if r["role"] == "predictor" and r["value"] is not None}
    return OutputsCorrector(extra_trees.load(spark, f"{path}/nodes", trees, features, outputs), medians)


def fit_residual_outputs(
    train: DataFrame, features: Sequence[str], truths: Sequence[str], raws: Sequence[str], trees: int = TREES, depth: int = 10, seed: int = SEED
) -> OutputsCorrector:
    """M-08 in the wide layout: one model of truth - raw for all leads, on rows that have them all."""
    forbid_actuals(features)
    usable = train.dropna(subset=[*truths, *raws])
    medians = median_imputer(usable, features)
    residuals = {f"_residual_{r}": F.col(t) - F.col(r) for t, r in zip(truths, raws, strict=True)}
    model = extra_trees.fit(impute(usable, medians).withColumns(residuals), features, list(residuals), trees, depth, LEAF, seed=seed)
    return OutputsCorrector(model, medians)


def apply_residual_outputs(corrector: OutputsCorrector, df: DataFrame, raws: Sequence[str], low: float | None = None, high: float | None = None) -> DataFrame:
    """``<raw>_corrected`` for every lead; null where the raw forecast is."""
    names = [f"_predicted_{r}" for r in raws]
    out = corrector.model.predict(df.withColumns({f"_given_{c}": F.col(c) for c in corrector.medians}).na.fill(corrector.medians), names)
    kept = out.withColumns({f"{r}_corrected": clip(F.col(f"_given_{r}" if r in corrector.medians else r) + F.col(n), low, high) for r, n in zip(raws, names, strict=True)})
    return kept.withColumns({c: F.col(f"_given_{c}") for c in corrector.medians}).drop(*names, *[f"_given_{c}" for c in corrector.medians])


def fit_direct(train: DataFrame, features: Sequence[str], truth: str, kind: str = "forest", trees: int = TREES, depth: int = 8) -> Corrector:
    """M-09: forest or boosted trees straight on the target."""
    forbid_actuals(features)
    return _fitted(train.dropna(subset=[truth]), features, truth, "predicted", kind, trees, depth)


@dataclass
class RainModel:
    occurrence: RandomForestClassificationModel
    amount: RandomForestRegressionModel
    features: list[str]
    medians: dict[str, float]
    log_amount: bool
    bins: Bucketizer

    def predict(self, df: DataFrame, raw: str, weight: float = RAIN_WEIGHT) -> DataFrame:
        """Probability, amount and the absolute blended rain, used alike in evaluation and service."""
        def score(cells: DataFrame) -> DataFrame:
            p = self.occurrence.transform(_vector(self.features).transform(cells)).withColumn("rain_probability", vector_to_array("probability")[1])
            a = self.amount.transform(p.drop("rawPrediction", "probability", "prediction"))
            amount = expm1(F.col("_amount")) if self.log_amount else clip(F.col("_amount"), 0.0)
            return a.withColumn("rain_amount", amount).drop("_amount")

        out = _by_bins(impute(df, self.medians), self.bins, self.features, score)
        specialised = F.col("rain_probability") * F.col("rain_amount")
        return out.withColumn("corrected", blended_rain(clip(F.col(raw), 0.0), specialised, weight))


def fit_rain(
    train: DataFrame, features: Sequence[str], truth: str, wet_above: float = 0.0, log_amount: bool = False,
    trees: int = TREES, depth: int = 8,
) -> RainModel:
    """M-10: balanced occurrence classifier, and an amount regressor on wet rows only."""
    forbid_actuals(features)
    y = F.col(truth) > wet_above
    label = (log1p(F.col(truth)) if log_amount else F.col(truth)).cast("double")
    usable = materialise(train.dropna(subset=[truth]).select(*features, y.cast("double").alias("_wet"), label.alias("_y")), "model-rows")
    medians = median_imputer(usable, features)
    n = usable.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_wet") == 1.0).alias("wet")).first()
    if n["wet"] < MIN_WET_ROWS:
        raise DataContractError(f"only {n['wet']} wet training rows")
    wet_w, dry_w = n["n"] / (2.0 * n["wet"]), n["n"] / (2.0 * max(n["n"] - n["wet"], 1))
    filled = impute(usable, medians)
    bins = _bins(filled, features)
    ready = _points(filled, bins, features, "_y", ["_wet"]).withColumn("_w", F.col("_n") * F.when(F.col("_wet") == 1.0, wet_w).otherwise(dry_w))
    occurrence = RandomForestClassifier(
        labelCol="_wet", weightCol="_w", numTrees=trees, maxDepth=depth, minWeightFractionPerNode=min(0.49, LEAF / n["n"]),
        featureSubsetStrategy="sqrt", maxBins=BINS, seed=SEED,
    ).fit(ready)
    amount = _regressor("_y", trees, depth, "_amount", n["wet"]).fit(ready.filter("_wet = 1.0"))
    return RainModel(occurrence, amount, list(features), medians, log_amount, bins)


def apply_current(
    corrector: Corrector, frame: DataFrame, raw: str, keys: Sequence[str], days: int = 7,
    low: float | None = None, high: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """M-12: corrected current forecast and its audit row (expected and actual rows, non-finite cells)."""
    out = materialise(apply_residual(corrector, frame, raw, low, high), "current")
    entities = frame.select(*keys).distinct().agg((F.count(F.lit(1)) * days).alias("expected_rows"))
    audit = out.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("corrected").isNull() | F.isnan("corrected")).alias("non_finite")
    ).withColumn("expected_rows", entities.scalar())
    return out, audit.withColumn(
        "status", F.when((F.col("rows") == F.col("expected_rows")) & (F.col("non_finite") == 0), "PASS").otherwise("FAIL")
    )
