"""Forests are judged by skill and invariants, extremely randomised trees by their values."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from finecast.errors import DataContractError
from finecast.operators import extra_trees, models, training

FEATURES = ["lead", "raw", "season"]


@pytest.fixture(scope="module")
def samples(spark):
    """Truth with a known lead-dependent bias in the raw forecast."""
    return spark.range(1400).selectExpr(
        "id", "cast(1 + id % 7 as double) as lead", "cast(id % 13 as double) as season", "if(id % 17 = 0, null, 20 + id % 13 + (id % 7) * 0.8D) as raw",
        "cast(20 + id % 13 as double) as truth", "if(id % 4 = 0, 0D, (id % 13) * 2D) as rain", "if(id % 4 = 0, 3D, (id % 13) * 2D + 3D) as rain_raw",
        "if(id % 5 < 4, 'train', 'test') as split",
    )


def rmse(df, a, b):
    return df.agg(F.sqrt(F.avg(F.pow(F.col(a) - F.col(b), 2)))).first()[0]


def test_residual_beats_raw_and_respects_bounds(samples):
    m = models.fit_residual(samples.filter("split = 'train'"), FEATURES, "truth", "raw", trees=15, depth=6)
    out = models.apply_residual(m, samples.filter("split = 'test' and raw is not null"), "raw", 21, 30)
    assert rmse(out, "corrected", "truth") < 0.6 * rmse(out, "raw", "truth")
    lo, hi = out.agg(F.min("corrected"), F.max("corrected")).first()
    assert lo >= 21 and hi <= 30


def test_medians_come_from_training_rows(samples):
    train = samples.filter("split = 'train'")
    assert training.median_imputer(train, ["raw"])["raw"] == train.select(F.median("raw")).first()[0]


def test_targets_are_refused_as_predictors(samples):
    with pytest.raises(DataContractError):
        models.fit_direct(samples.withColumn("actual_x", F.lit(1.0)), ["actual_x"], "truth")


def test_rain_is_absolute_and_never_negative(samples):
    m = models.fit_rain(samples.filter("split = 'train'"), ["lead", "season", "rain_raw"], "rain", trees=15, depth=6)
    out = m.predict(samples.filter("split = 'test'"), "rain_raw")
    assert out.agg(F.min("corrected")).first()[0] >= 0
    assert rmse(out, "corrected", "rain") < rmse(out, "rain_raw", "rain")
    want = F.greatest(F.lit(0.0), F.lit(0.7) * F.col("rain_probability") * F.col("rain_amount") + F.lit(0.3) * F.col("rain_raw"))
    assert out.agg(F.max(F.abs(F.col("corrected") - want))).first()[0] < 1e-9


def test_too_few_wet_rows(spark):
    dry = spark.range(50).selectExpr("cast(id as double) as x", "if(id < 5, 1D, 0D) as rain")
    with pytest.raises(DataContractError):
        models.fit_rain(dry, ["x"], "rain")


def test_current_forecast_audit(samples):
    m = models.fit_residual(samples.filter("split = 'train'"), FEATURES, "truth", "raw", trees=5, depth=3)
    cur = samples.sparkSession.range(21).selectExpr("id div 7 as gp", "cast(1 + id % 7 as double) as lead", "cast(id % 13 as double) as season", "cast(20 + id as double) as raw")
    assert models.apply_current(m, cur, "raw", ["gp"])[1].first()["status"] == "PASS"
    assert models.apply_current(m, cur.filter("not (gp = 1 and lead = 3)"), "raw", ["gp"])[1].first()["status"] == "FAIL"


def test_saved_model_with_contract(spark, samples, tmp_path):
    m = models.fit_direct(samples.filter("split = 'train'"), FEATURES, "truth", trees=5, depth=3)
    m.save(str(tmp_path / "m"))
    again = models.load_corrector(spark, str(tmp_path / "m"))
    assert again.features == FEATURES and again.medians == m.medians and again.output == "predicted"
    assert training.feature_contract([1, 2], FEATURES, ["truth"], spark).count() == 8


def grown(x, y, trees, depth, leaf, k, seed):
    """Plain recursion over arrays: {(tree, node): (n, mean, feature, cut)}."""
    d, out = x.shape[1], {}
    digest = lambda *p: hashlib.md5(":".join(map(str, p)).encode()).hexdigest()

    def grow(t, node, rows, level):
        mine = y[rows]
        out[t, node] = [len(rows), mine.mean(axis=0), None, None]
        if level == depth or ((mine**2).sum() - (mine.sum(axis=0) ** 2).sum() / len(rows)) <= (mine**2).sum() * 1e-12:
            return
        drawn = sorted(range(d), key=lambda i: (digest(seed, t, node, i), i))[: min(d, 2 * k)]
        best = None
        for f in [f for f in drawn if x[rows, f].min() < x[rows, f].max()][:k]:
            lo, hi = x[rows, f].min(), x[rows, f].max()
            cut = lo + int(digest(seed, t, node, f, "cut")[:13], 16) / 16**13 * (hi - lo)
            left = x[rows, f] <= cut
            if left.sum() >= leaf and (~left).sum() >= leaf:
                gain = sum((mine[s].sum(axis=0) ** 2).sum() / s.sum() for s in (left, ~left))
                if best is None or gain > best[0]:
                    best = (gain, f, cut, left)
        if best:
            out[t, node][2:] = best[1:3]
            grow(t, 2 * node, rows[best[3]], level + 1)
            grow(t, 2 * node + 1, rows[~best[3]], level + 1)

    for t in range(trees):
        grow(t, 1, np.arange(len(x)), 0)
    return out


def test_extra_trees_equal_a_plain_version(spark, tmp_path):
    """A third of the rows alike, one feature constant, seven outputs."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 6))
    x[:133], x[:, 4] = x[0], 1.0
    y = np.stack([x[:, 0] * (i + 1) + np.sin(3 * x[:, 1]) + 0.1 * rng.normal(size=400) for i in range(7)], axis=1)
    names, labels = [f"x{i}" for i in range(6)], [f"d{i + 1}" for i in range(7)]
    df = spark.createDataFrame(pd.DataFrame(np.hstack([x, y]), columns=names + labels)).repartition(5)
    model = extra_trees.fit(df, names, labels, trees=4, depth=4, leaf=5, seed=3)
    want = grown(x, y, 4, 4, 5, 2, 3)
    got = {(r["t"], r["node"]): r for r in model.nodes.collect()}
    assert got.keys() == want.keys() and max(n for _, n in got) > 15
    for key, (n, mean, f, cut) in want.items():
        r = got[key]
        assert (r["n"], r["f"], r["cut"]) == (n, f, cut)
        assert r["mean"] == pytest.approx(mean, rel=1e-9, abs=1e-9)

    def leaf_of(t, v):
        node = 1
        while want[t, node][2] is not None:
            node = 2 * node + int(v[want[t, node][2]] > want[t, node][3])
        return want[t, node][1]

    model.save(str(tmp_path / "m"))
    again = extra_trees.load(spark, str(tmp_path / "m"), 4, names, labels)
    out = again.predict(df.limit(50), [f"p{i}" for i in range(7)]).toPandas()
    for _, r in out.iterrows():
        assert [r[f"p{i}"] for i in range(7)] == pytest.approx(np.mean([leaf_of(t, r[names].to_numpy()) for t in range(4)], axis=0), rel=1e-9)


def test_seven_outputs_are_corrected_at_once(spark, tmp_path):
    rng = np.random.default_rng(2)
    n = 600
    base = rng.normal(20, 5, n)
    data = {"block": np.arange(n) % 3, "f0": base, "f1": rng.normal(size=n)}
    for h in range(1, 8):
        data[f"raw_d{h}"] = base + h
        data[f"truth_d{h}"] = base + h - 0.3 * base + 0.1 * rng.normal(size=n)
    df = spark.createDataFrame(pd.DataFrame(data)).withColumn("f1", F.when(F.rand(1) > 0.1, F.col("f1")))
    raws, truths = ([f"{w}_d{h}" for h in range(1, 8)] for w in ("raw", "truth"))
    model = models.fit_residual_outputs(df, ["f0", "f1"], truths, raws, trees=10, depth=5)
    out = models.apply_residual_outputs(model, df, raws, low=-50, high=60).toPandas()
    for h in range(1, 8):
        raw, got = ((out[c] - out[f"truth_d{h}"]).pow(2).mean() ** 0.5 for c in (f"raw_d{h}", f"raw_d{h}_corrected"))
        assert got < raw / 3
    model.save(str(tmp_path / "m"))
    again = models.apply_residual_outputs(models.load_outputs_corrector(spark, str(tmp_path / "m")), df, raws, low=-50, high=60).toPandas()
    assert (again["raw_d3_corrected"].round(9) == out["raw_d3_corrected"].round(9)).all() and out["f1"].isna().any()
    with pytest.raises(DataContractError):
        models.fit_residual_outputs(df.withColumn("actual_x", F.lit(1.0)), ["actual_x"], truths, raws)


def test_a_fit_grows_with_bins_not_rows(spark, samples):
    """Forty copies of every row: as many points, their weights add up to all rows, and what is learned stays."""
    train = samples.filter("split = 'train' and raw is not null").withColumn("residual", F.col("truth") - F.col("raw"))
    many = train.crossJoin(spark.range(40).select())
    for rows, n in ((train, train.count()), (many, 40 * train.count())):
        bins = models._bins(rows, FEATURES)
        points = models._points(rows, bins, FEATURES, "residual", limit=1)
        got = points.agg(F.count(F.lit(1)), F.sum("_n"), F.sum(F.col("_n") * F.col("residual"))).first()
        assert got[0] == rows.select(*FEATURES).distinct().count() and got[1] == n
        assert got[2] == pytest.approx(rows.agg(F.sum("residual")).first()[0])
    m = models.fit_residual(many, FEATURES, "truth", "raw", trees=15, depth=6)
    out = models.apply_residual(m, samples.filter("split = 'test' and raw is not null"), "raw")
    assert set(out.columns) == {*samples.columns, "predicted_residual", "corrected"}
    assert rmse(out, "corrected", "truth") < 0.6 * rmse(out, "raw", "truth")


def test_scores_of_bins_equal_scores_of_rows(samples, monkeypatch):
    m = models.fit_direct(samples.filter("split = 'train'"), FEATURES, "truth", trees=5, depth=3)
    test = samples.filter("split = 'test'").select("id", *FEATURES)
    joined = {r["id"]: r["predicted"] for r in m.predict(test).collect()}
    monkeypatch.setattr(models, "POINTS", 0)
    assert {r["id"]: r["predicted"] for r in m.predict(test).collect()} == joined and len(joined) == test.count()
