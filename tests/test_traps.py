"""Each semantic trap on a tiny hand-made frame with a literal result."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from finecast import session
from finecast.errors import DataContractError
from finecast.functions import columns as C
from finecast.functions import weather
from finecast.operators import aggregates, audits, clean, guards, ingest, joins, metrics, ordered, sets, training, windows

D = dt.date


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_nan_and_infinity_are_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert df.agg(F.count(C.finite(F.col("v")))).first()[0] == 1
    out, rep = clean.clean(df)
    assert rep.first().asDict() == {"rows_in": 4, "infinite_cells": 1, "rows_out": 2, "duplicate_rows": 2}
    assert out.count() == 2


def test_text_numbers_do_not_raise(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in df.select(C.num(F.col("v"))).collect()] == [1.5, None, None, None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (120.0,), (-3.0,)], "v double")
    assert [r[0] for r in df.select(C.clip(F.col("v"), 0, 100)).collect()] == [None, 100.0, 0.0]


def test_std_conventions(spark):
    one = spark.createDataFrame([("a", "i1", D(2020, 1, 1), "A", 3.0)], "gp string, image string, d date, orbit string, v double")
    sar = aggregates.sar_profile(one, ["gp"], ["v"], "d", "image", "orbit", {"A": "up"}).first()
    assert sar["v_std"] == 0.0 and sar["v_up_std"] == 0.0 and sar["v_median"] == 3.0
    assert aggregates.optical_profile(one, ["gp"], ["v"], "d", "image").first()["v_std"] is None
    monthly = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "gp string, v double")
    lst = aggregates.lst_profile(monthly, "gp", "v").collect()
    assert len(lst) == 1 and lst[0]["lst_std"] == 1.0


def test_rolling_is_positional_and_past_only(spark):
    days = [D(2020, 1, 1), D(2020, 1, 2), D(2020, 1, 5), D(2020, 1, 9), D(2020, 1, 10)]
    df = spark.createDataFrame([("b", d, float(i + 1)) for i, d in enumerate(days)], "b string, d date, rain double")
    out = windows.history_features(df, ["b"], "d", ["rain"], ["rain"], lags=(1,), windows=(3,)).orderBy("d").collect()
    assert [r["hist__rain__rolling_mean_3d"] for r in out] == [None, None, None, 2.0, 3.0]
    assert [r["hist__rain__wet_days_3d"] for r in out] == [None, None, 2, 3, 3]
    assert [r["hist__rain__lag_1d"] for r in out] == [None, 1.0, 2.0, 3.0, 4.0]


def pandas_history(values, w):
    v = pd.Series(values, dtype="float64")
    past = v.shift(1)
    return {
        "mean": past.rolling(w, min_periods=w).mean(), "std": past.rolling(w, min_periods=w).std(),
        "sum": past.rolling(w, min_periods=w).sum(), "wet": past.gt(0).rolling(w, min_periods=w).sum(), "lag": v.shift(w),
    }


@pytest.mark.parametrize("piece", [None, 20])
def test_history_equals_pandas_on_series_with_nulls(spark, piece):
    values = [None if i % 5 == 2 else float((i * 7) % 11) for i in range(90)]
    df = spark.createDataFrame([("b", i, v) for i, v in enumerate(values)], "b string, pos long, rain double")
    if piece:
        out = windows.history_features_long(df, ["b"], "pos", ["rain"], ["rain"], lags=(3, 7), windows=(3, 7), piece_rows=piece)
    else:
        out = windows.history_features(df, ["b"], "pos", ["rain"], ["rain"], lags=(3, 7), windows=(3, 7))
    got = out.orderBy("pos").toPandas()
    assert len(got) == 90
    for w in (3, 7):
        want = pandas_history(values, w)
        for name, col in (("mean", "rolling_mean"), ("std", "rolling_std"), ("sum", "rolling_sum"), ("wet", "wet_days"), ("lag", "lag")):
            a, b = got[f"hist__rain__{col}_{w}d"].astype(float), want[name].astype(float)
            assert ((a - b).abs().fillna(0) < 1e-9).all() and (a.isna() == b.isna()).all(), (name, w)


def test_position_over_chunks_with_one_hot_series(spark):
    df = spark.range(1000).selectExpr("if(id < 700, 'hot', concat('s', id % 7)) as b", "id * 37 % 1000 as t", "id")
    got = ordered.position(df, ["b"], ["t"], F.floor(F.col("t") / 50))
    want = df.toPandas().sort_values("t")
    want["pos"] = want.groupby("b").cumcount()
    assert dict(got.select("id", "pos").collect()) == dict(zip(want["id"], want["pos"]))


def test_window_closure(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 1), 1.0), ("a", D(2020, 1, 8), 3.0)], "g string, d date, v double")
    own = windows.lookback(df, ["g"], "d", ["v"], [7]).first()
    assert own["v_mean_7d"] == 2.0 and own["v_count_7d"] == 2
    end = windows.lookback(df, ["g"], "d", ["v"], [7], F.lit(D(2020, 1, 8))).first()
    assert end["v_mean_7d"] == 1.0 and end["v_count_7d"] == 1


def test_dedup_directions(spark):
    old = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, v double")
    new = spark.createDataFrame([(2, 21.0), (3, 30.0), (3, 31.0)], "k int, v double")
    assert rows(ingest.append_new(old, new, ["k"], ["v"]), "k") == [(1, 10.0), (2, 20.0), (3, 30.0)]
    assert rows(ingest.upsert_latest(old, new, ["k"], ["v"]), "k") == [(1, 10.0), (2, 21.0), (3, 31.0)]
    with pytest.raises(DataContractError):
        ingest.append_strict(old, new, ["k"])
    same = spark.createDataFrame([(2, 20.0 * (1 + 1e-12)), (4, None)], "k int, v double")
    assert rows(ingest.append_strict(old, same, ["k"]), "k") == [(1, 10.0), (2, 20.0), (4, None)]


def test_target_side_is_dealt_by_number_and_repeats_fail(spark):
    s = spark.createDataFrame([(1, 5), (1, 6), (2, 7), (None, 8)], "k int, x int")
    t = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "k int, y double")
    got = joins.attach_target(s, t, ["k"])
    assert rows(got, "x") == [(1, 5, 1.0), (1, 6, 1.0), (2, 7, None)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "Aggregate" not in plan
    with pytest.raises(Exception, match="duplicate key"):
        joins.attach_target(s, t.union(t.filter("k = 1")), ["k"]).collect()


def test_audit_keys_run_in_small_tasks_and_settings_come_back(spark, monkeypatch):
    parts, seen = "spark.sql.shuffle.partitions", []
    keep = audits.materialise
    monkeypatch.setattr(audits, "materialise", lambda df, label: seen.append(int(spark.conf.get(parts))) or keep(df, label))
    before = int(spark.conf.get(parts))
    s = spark.createDataFrame([(1, D(2020, 1, 1), 1, 0.5, 1.0, "train"), (1, D(2020, 1, 1), 1, 0.5, 1.0, "test"), (2, D(2020, 1, 2), 1, 0.5, 1.0, "test")],
                              "g int, d date, lead int, f double, y double, split string")
    got = {r["check_name"]: r["n_bad"] for r in audits.training_audit(s, ["f"], ["y"], "g", "d", "lead").collect()}
    assert (got["duplicate_sample"], got["split_overlap"], got["split_order"]) == (1, 1, 0)
    assert seen and min(seen) > before and int(spark.conf.get(parts)) == before


def test_strict_append_runs_in_small_tasks_and_settings_come_back(spark, monkeypatch):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")

    def now():
        return tuple(spark.conf.get(n) for n in names)

    before, seen, keep = now(), [], session.materialise
    monkeypatch.setattr(ingest, "materialise", lambda df, label: seen.append(now()) or keep(df, label), raising=False)
    old = spark.createDataFrame([(1, 10.0), (1, 10.0), (None, 5.0)], "k int, v double")
    new = spark.createDataFrame([(1, 10.0), (3, 30.0), (3, 30.0), (None, 5.0)], "k int, v double")
    got = ingest.append_strict(old, new, ["k"])
    assert sorted((r["k"] or 0, r["v"]) for r in got.collect()) == [(0, 5.0), (1, 10.0), (1, 10.0), (3, 30.0)]
    assert len(seen) == 2 and now() == before
    for parts, merged, read in seen:
        assert int(parts) > int(before[0]) and int(merged) == int(read) == 8 << 20
    with pytest.raises(DataContractError):
        ingest.append_strict(old, new.withColumn("v", F.col("v") + 1), ["k"])
    assert now() == before


def test_dedupe_of_key_only_rows(spark):
    assert sets.dedupe(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], []).count() == 1


def test_units_convert_only_when_declared(spark):
    df = spark.createDataFrame([(36.0, "km/h"), (10.0, "m/s"), (36.0, None)], "v double, u string")
    got = [r[0] for r in df.select(weather.convert_declared(F.col("v"), F.col("u"))).collect()]
    assert got[:2] == pytest.approx([10.0, 10.0]) and got[2] is None


def test_r2_is_not_squared_correlation(spark):
    df = spark.createDataFrame([(1.0, 11.0), (2.0, 12.0), (3.0, 13.0)], "y double, p double")
    m = metrics.regression_metrics(df, [], "y", "p").first()
    assert m["r2"] == pytest.approx(1 - 300 / 2) and m["bias"] == 10.0 and m["status"] == "PASS"


def test_metric_status(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", None, 2.0)], "g string, y double, p double")
    got = {r["g"]: r["status"] for r in metrics.regression_metrics(df, ["g"], "y", "p").collect()}
    assert got == {"a": "UNAVAILABLE", "b": "NO_OVERLAP"}


def test_zero_division_rules(spark):
    df = spark.createDataFrame([(0.0, 0.1)], "y double, p double")
    s = metrics.occurrence_scores(df, [], "y", "p").first()
    assert (s["precision"], s["recall"], s["f1"], s["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    assert df.select(metrics.improvement_pct(F.lit(0.0), F.lit(1.0))).first()[0] is None


def test_rain_categories_are_closed_above(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 2.5, 2.6, 10.0, 25.0, 25.1)], "v double")
    assert [r[0] for r in df.select(metrics.rain_category(F.col("v"))).collect()] == ["dry", "dry", "light", "moderate", "moderate", "heavy", "extreme"]


@pytest.mark.parametrize("n,want", [(3, (1, 1, 1)), (4, (2, 1, 1)), (5, (3, 1, 1)), (6, (4, 1, 1)), (7, (4, 1, 2)), (10, (6, 2, 2))])
def test_year_split_sizes(spark, n, want):
    df = spark.createDataFrame([(D(2000 + i, 6, 1),) for i in range(n)], "d date")
    got = {r["split"]: r["count"] for r in training.year_split(df, "d").groupBy("split").count().collect()}
    assert (got["train"], got["validation"], got["test"]) == want


def test_year_split_needs_three_years(spark):
    df = spark.createDataFrame([(D(2000, 1, 1),), (D(2001, 1, 1),)], "d date")
    with pytest.raises(Exception, match="3 calendar years"):
        training.year_split(df, "d").collect()


def test_horizon_dataset_refuses_bad_chronology(spark):
    fc = spark.createDataFrame([("b", D(2020, 1, 3), D(2020, 1, 3), 1, 5.0)], "b string, t date, i date, lead int, x double")
    gps = spark.createDataFrame([("g", "b")], "g string, b string")
    y = spark.createDataFrame([("g", D(2020, 1, 3), 1.0)], "g string, t date, y double")
    with pytest.raises(Exception, match="target - issue"):
        training.horizon_dataset(fc, gps, y, "b", "g", "t", "i", "lead", ["x"], ["y"]).collect()
    with pytest.raises(DataContractError):
        training.horizon_dataset(fc, gps, y, "b", "g", "t", "i", "lead", ["y"], ["y"])


def test_strict_dataset_refuses_missing_predictor(spark):
    fc = spark.createDataFrame([("b", D(2020, 1, 3), D(2020, 1, 2), 1, None)], "b string, t date, i date, lead int, x double")
    y = spark.createDataFrame([("b", D(2020, 1, 3), 1.0)], "b string, t date, y double")
    with pytest.raises(Exception, match="x is missing"):
        training.block_dataset(fc, y, "b", "t", "i", "lead", ["x"], ["y"]).collect()


def test_master_refuses_repeated_key(spark):
    a = spark.createDataFrame([("b", 1, 1.0), ("b", 1, 2.0)], "b string, d int, v double")
    c = spark.createDataFrame([("b", 1, 9.0)], "b string, d int, w double")
    with pytest.raises(Exception, match="duplicate key"):
        joins.daily_master({"a": a, "c": c}, ["b", "d"]).collect()
    with pytest.raises(Exception, match="duplicate key"):
        joins.attach_history(c.withColumnRenamed("d", "t"), a, ["b"], "t", "d").collect()


def test_merge_refuses_foreign_ids(spark):
    master = spark.createDataFrame([("1", "x")], "id string, name string")
    for rows in ([("2", 1.0)], [], [("1", 1.0), ("2", 1.0)], [("1", 1.0), ("1", 2.0)], [("1", 1.0), (None, 2.0)]):
        with pytest.raises(Exception, match="ids differ|blank id"):
            joins.merge_one_to_one(master, {"s": spark.createDataFrame(rows, "id string, v double")}, "id").collect()
    with pytest.raises(DataContractError):
        joins.merge_one_to_one(master.withColumn("s__v", F.lit(1)), {"s": spark.createDataFrame([("1", 1.0)], "id string, v double")}, "id")
    got = joins.merge_one_to_one(master, {"s": spark.createDataFrame([("1", 1.0)], "id string, v double"), "t": spark.createDataFrame([("1", 2.0)], "id string, v double")}, "id").collect()
    assert [tuple(r) for r in got] == [("1", "x", 1.0, 2.0)]


def test_guards(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 6.0)], "k int, v double")
    with pytest.raises(DataContractError):
        guards.require_unique(df, ["k"])
    with pytest.raises(DataContractError):
        clean.reject_outside(df, {"v": (0, 5.5)})
    with pytest.raises(DataContractError):
        guards.require_columns(df, ["nope"])
    with pytest.raises(DataContractError):
        clean.collapse_duplicates(df.selectExpr("k", "v", "v + 1 as w").toDF("k", "v", "v"))


def test_source_nodes_limit(spark):
    df = spark.createDataFrame([("b", n, 1.0) for n in (1, 2, 3)], "b string, node int, v double")
    with pytest.raises(Exception, match="source nodes"):
        aggregates.daily_nodes(df, ["b"], "node", ["v"]).collect()


def test_allocation_weights_conserve_and_refuse_null(spark):
    df = spark.createDataFrame([("f", float(s)) for s in (-9, 0, 3, 9)], "f string, s double")
    w = windows.require_weights(windows.allocation_weights(df, ["f"], "s"), ["f"])
    got = {r["s"]: r["weight"] for r in w.collect()}
    z = sum(math.exp(x) for x in (-5, 0, 3, 5))
    assert got[-9.0] == pytest.approx(math.exp(-5) / z)
    with pytest.raises(Exception, match="score is missing"):
        windows.allocation_weights(spark.createDataFrame([("f", None)], "f string, s double"), ["f"], "s").collect()


def test_gate_order(spark):
    c = spark.createDataFrame([(n, "PASS") for n, _ in audits.TRAINING_GATE], "check_name string, status string")
    assert audits.training_gate(c).first()["decision"] == "READY_FOR_TRAINING"
    c = c.filter("check_name <> 'wind_source_compatibility'")
    assert audits.training_gate(c).first()["decision"] == "WIND_REQUIRES_SOURCE_FIX"
    c = c.filter("check_name <> 'target_leakage_absent'")
    r = audits.training_gate(c).first()
    assert (r["decision"], r["first_failed"]) == ("DO_NOT_TRAIN_YET", "target_leakage_absent")


def test_null_features_pass_the_audit_and_infinite_ones_fail(spark):
    rows_ = [("g", D(2020, 1, i + 1), 1, None if i == 0 else float(i), 1.0, s) for i, s in enumerate(("train", "validation", "test"))]
    df = spark.createDataFrame(rows_, "g string, d date, lead int, x double, y double, split string")
    rep = {r["check_name"]: r["n_bad"] for r in audits.training_audit(df, ["x"], ["y"], "g", "d", "lead").collect()}
    assert set(rep.values()) == {0}
    worse = df.withColumn("x", F.when(F.col("x") == 2, float("inf")).otherwise(F.col("x")))
    rep = {r["check_name"]: r["n_bad"] for r in audits.training_audit(worse, ["x"], ["y"], "g", "d", "lead").collect()}
    assert rep["non_finite_cell"] == 1
    mixed = df.withColumn("split", F.when(F.col("split") == "train", "test").otherwise("train"))
    rep = {r["check_name"]: r["n_bad"] for r in audits.training_audit(mixed, ["x"], ["y"], "g", "d", "lead").collect()}
    assert rep["split_overlap"] == 0


def test_primary_variable_names():
    cols = ["temperature_2m_max", "temperature_2m_mean", "precipitation_sum", "rain_mean", "wind_speed_max", "other"]
    assert windows.primary_variables(cols) == ["rain_mean", "temperature_2m_mean", "wind_speed_max"]
    assert windows.primary_variables(cols, ["rain_mean"])[0] == "precipitation_sum"


def test_predictor_choice():
    cols = ["temp_forecast_d1", "temp_forecast_d2", "forecast_issued_date_d1", "hist__rain__lag_1d", "actual_rain_d1", "date", "rain_d1"]
    assert clean.predictors(cols, 1, ["y"]) == ["temp_forecast_d1", "hist__rain__lag_1d", "rain_d1"]
    about = ["rain_source_d3", "wind_model_d3", "temp_rule_d3", "rainfall_7d", "wet_day_3", "calendar_month", "soil_d3", "gdd", "odd"]
    assert clean.predictors(about, 3, []) == ["rainfall_7d", "wet_day_3", "calendar_month"]
    roles = {"soil_d3": ("weather_forecast", "forecast_predictor"), "gdd": ("historical_weather", "historical_source"), "odd": ("weather_forecast", "metadata"), "wind_model_d3": ("weather_forecast", "forecast_predictor")}
    assert clean.predictors(about, 3, [], roles) == ["rainfall_7d", "wet_day_3", "calendar_month", "soil_d3", "gdd"]


def test_dictionary_limits_primary_variables(spark):
    rows = [("rain_mean", "block_observations_daily", "historical_weather", 1), ("rain_2m_mean", "other", "historical_weather", 2), ("temp_mean", "block_observations_daily", "static", 3),
            ("wind_mean", "block_observations_daily", "historical_weather", 4), ("rain_temp", "block_observations_daily", "historical_weather", 5), ("pressure", "block_observations_daily", "historical_weather", 6)]
    d = spark.createDataFrame(rows, "column_name string, source_dataset string, feature_group string, position int")
    got = {r["family"]: r["column_name"] for r in windows.primary_from_dictionary(d, ["rain_mean", "rain_2m_mean", "temp_mean", "rain_temp", "pressure", "wind_mean"], ["pressure"]).collect()}
    assert got == {"rain": "rain_mean", "temperature": "rain_temp", "wind": "wind_mean"}


def test_conflict_inside_a_delivery_and_null_keys(spark):
    old = spark.createDataFrame([(1, 1.0), (None, 5.0)], "k int, v double")
    twice = spark.createDataFrame([(2, 1.0), (2, 9.0)], "k int, v double")
    with pytest.raises(DataContractError):
        ingest.append_strict(old, twice, ["k"])
    same = spark.createDataFrame([(2, 1.0), (2, 1.0), (None, 5.0)], "k int, v double")
    assert sorted((r["k"] or 0, r["v"]) for r in ingest.append_strict(old, same, ["k"]).collect()) == [(0, 5.0), (1, 1.0), (2, 1.0)]
    half = spark.createDataFrame([(1, None)], "k int, v double")
    assert [r["differing"] for r in ingest.conflicts(old, half, ["k"]).collect()] == [["v"]]


def test_static_predictors(spark):
    df = spark.createDataFrame([(1.0, None, 2.0, "x", 5.0)], "terrain__slope double, soil__sand double, lat double, terrain__name string, actual_temp double")
    assert clean.static_predictors(df) == ["terrain__slope", "lat"]


def test_inventory_matches_whole_parts_of_names(spark):
    from finecast.operators.audits import feature_inventory

    names = ["humidity", "gp_id", "stationIds", "wind_id2", "sentiment", "mean_time", "latent_heat", "lat", "devil", "evi3", "encode", "HTTPCode", "leader", "lead_3"]
    df = spark.createDataFrame([tuple(float(i) for i in range(len(names)))], names)
    got = {r["column_name"]: r["classification"] for r in feature_inventory(df, "d", "l").collect()}
    other, ident = "numeric_environmental_or_derived", "metadata_or_identifier"
    assert got == dict.fromkeys(("humidity", "sentiment", "latent_heat", "devil", "encode", "leader"), other) | dict.fromkeys(("gp_id", "stationIds", "wind_id2", "HTTPCode"), ident) | {
        "mean_time": "temporal", "lead_3": "temporal", "lat": "spatial_or_remote_sensing", "evi3": "spatial_or_remote_sensing",
    }
