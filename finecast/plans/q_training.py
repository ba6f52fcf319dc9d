"""Training frame, split, model and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from finecast.functions.names import ROLE_PATTERNS, has_role
from finecast.operators import audits, extra_trees, joins, metrics, models, training, windows
from finecast.plans.frames import with_
from finecast.plans.q_joins import ACTUALS, RATES, rate_sql, rates
from finecast.plans.q_windows import hist_sql
from finecast.plans.registry import query, r
from finecast.session import fresh_dir, materialise

RAW = "SELECT l_suppkey AS gp_id, CAST(l_shipdate AS DATE) AS date, l_quantity + 270 AS temp_k, l_quantity + 262 - l_linenumber AS dew_k, (l_discount - 0.01::DOUBLE) AS precip_m, l_quantity - 25 AS u, l_tax * 100 AS v FROM lineitem"
SATURATION = "exp(17.625::DOUBLE * {t} / (243.04::DOUBLE + {t}))"


@query(
    "f01_reference_targets",
    with_("", f"""SELECT gp_id, date, CASE WHEN t BETWEEN -60 AND 60 THEN {r('t')} END AS temperature_c, CASE WHEN d BETWEEN -60 AND 60 THEN {r('d')} END AS dewpoint_c,
      {r('least(1e2, greatest(0e0, 100 * ' + SATURATION.format(t='d') + ' / ' + SATURATION.format(t='t') + '))')} AS humidity_pct, CASE WHEN p BETWEEN 0 AND 1000 THEN {r('p')} END AS precipitation_mm, CASE WHEN w BETWEEN 0 AND 100 THEN {r('w')} END AS wind_ms
    FROM (SELECT gp_id, date, m.temp_k - 273.15::DOUBLE AS t, m.dew_k - 273.15::DOUBLE AS d, greatest(0e0, m.precip_m * 1000) AS p, sqrt(m.u * m.u + m.v * m.v) AS w FROM
      (SELECT gp_id, date, unnest([arg_max({{'temp_k': temp_k, 'dew_k': dew_k, 'precip_m': precip_m, 'u': u, 'v': v}}, (temp_k, dew_k, precip_m, u, v))]) AS m FROM raw GROUP BY gp_id, date))""", raw=RAW),
)
def _(f):
    raw = f.table("lineitem").selectExpr(
        "l_suppkey as gp_id", "cast(l_shipdate as date) as date", "l_quantity + 270 as temp_k", "l_quantity + 262 - l_linenumber as dew_k", "l_discount - 0.01D as precip_m", "l_quantity - 25 as u", "l_tax * 100 as v"
    )
    return training.reference_targets(raw, ["gp_id", "date"])


@query(
    "f02_stage_two_frame",
    with_("forecast_wide sites site_targets", f"""SELECT gp_id, block_id, date, {r('temp_f_d1')} AS temp_f_d1, {r('temp_f_d7')} AS temp_f_d7, {r('actual_temperature_2m_mean')} AS actual_temperature_2m_mean, {r('actual_precipitation_sum')} AS actual_precipitation_sum
    FROM sites JOIN forecast_wide USING (block_id) LEFT JOIN site_targets USING (gp_id, date) WHERE temp_f_d1 IS NOT NULL"""),
)
def _(f):
    w = f.forecast_wide.select("block_id", "date", "temp_f_d1", "temp_f_d7")
    return training.stage_two_frame(f.sites.select("gp_id", "block_id"), w, f.site_targets, "block_id", "gp_id", "date", "temp_f_d1")


PREDICTORS, LABELS = ["temp_f", "rain_f", "rh_f", "wind_f"], ["actual_temperature_2m_mean"]


def samples(f):
    target = f.site_targets.withColumnRenamed("date", "target_date")
    return training.horizon_dataset(f.forecast, f.sites, target, "block_id", "gp_id", "target_date", "issue_date", "lead", PREDICTORS, LABELS)


SAMPLES = "SELECT gp_id, block_id, target_date, issue_date, lead, temp_f, rain_f, rh_f, wind_f, actual_temperature_2m_mean FROM sites JOIN forecast USING (block_id) JOIN (SELECT gp_id, date AS target_date, actual_temperature_2m_mean FROM site_targets WHERE actual_temperature_2m_mean IS NOT NULL) USING (gp_id, target_date)"
SAMPLE_DATES = "SELECT target_date, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' WHEN i < floor(n * 0.85::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM (SELECT target_date, row_number() OVER (ORDER BY target_date) - 1 AS i, COUNT(*) OVER () AS n FROM (SELECT DISTINCT target_date FROM samples))"
SUMMARY = f"COUNT(*) AS n, COUNT(DISTINCT gp_id) AS entities, MIN(target_date) AS first_date, MAX(target_date) AS last_date, {r('avg(temp_f)')} AS temp_f, COUNT(rain_f) AS rain_n, {r('avg(actual_temperature_2m_mean)')} AS y"


def summary(df, by):
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("gp_id").alias("entities"), F.min("target_date").alias("first_date"), F.max("target_date").alias("last_date"),
        F.avg("temp_f").alias("temp_f"), F.count("rain_f").alias("rain_n"), F.avg("actual_temperature_2m_mean").alias("y"),
    )


@query("f03_horizon_dataset", with_("sites forecast site_targets", f"SELECT lead, block_id, {SUMMARY} FROM samples GROUP BY lead, block_id", samples=SAMPLES))
def _(f):
    """All entity x date x lead samples, summarised per lead and area."""
    return summary(samples(f), ["lead", "block_id"])


@query(
    "f03b_block_dataset",
    with_("forecast", f"SELECT block_id, target_date, issue_date, lead, {r('rh_f')} AS rh_f, {r('wind_f')} AS wind_f, {r('rain')} AS actual_rain FROM forecast JOIN (SELECT block_id, date AS target_date, rain FROM daily WHERE rain IS NOT NULL) USING (block_id, target_date)"),
)
def _(f):
    t = f.daily.select("block_id", F.col("date").alias("target_date"), F.col("rain").alias("actual_rain"))
    return training.block_dataset(f.forecast, t, "block_id", "target_date", "issue_date", "lead", ["rh_f", "wind_f"], ["actual_rain"])


@query("m01_date_split", with_("sites forecast site_targets", f"SELECT split, lead, {SUMMARY} FROM samples JOIN d USING (target_date) GROUP BY split, lead", samples=SAMPLES, d=SAMPLE_DATES))
def _(f):
    return summary(training.date_split(samples(f), "target_date"), ["split", "lead"])


@query(
    "m01_date_split_per_area",
    with_("daily", """SELECT block_id, date, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' WHEN i < floor(n * 0.85::DOUBLE) THEN 'validation' ELSE 'test' END AS split
      FROM (SELECT block_id, date, row_number() OVER (PARTITION BY block_id ORDER BY date) - 1 AS i, COUNT(*) OVER (PARTITION BY block_id) AS n FROM daily)"""),
)
def _(f):
    return training.date_split(f.daily.select("block_id", "date"), "date", ["block_id"])


@query(
    "m02_row_split",
    with_("daily", """SELECT block_id, date, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' WHEN i < floor(n * 0.85::DOUBLE) THEN 'validation' ELSE 'test' END AS split
      FROM (SELECT block_id, date, row_number() OVER (ORDER BY date, block_id) - 1 AS i, COUNT(*) OVER () AS n FROM daily)"""),
)
def _(f):
    return training.row_split(f.daily.select("block_id", "date"), ["date", "block_id"])


YEARS = """SELECT y, CASE WHEN i < tr THEN 'train' WHEN i < tr + va THEN 'validation' ELSE 'test' END AS split FROM (SELECT y, row_number() OVER (ORDER BY y) - 1 AS i,
      greatest(1, round_even(COUNT(*) OVER () * 0.6, 0)) AS tr, greatest(1, round_even(COUNT(*) OVER () * 0.2, 0)) AS va FROM (SELECT DISTINCT year(date) AS y FROM daily))"""


@query("m03_year_split", with_("daily", f"SELECT block_id, date, split FROM daily JOIN ({YEARS}) ON year(date) = y"))
def _(f):
    return training.year_split(f.daily.select("block_id", "date"), "date")


@query("m04_fixed_years", with_("daily", "SELECT block_id, date, CASE year(date) WHEN 1998 THEN 'train' WHEN 1999 THEN 'validation' ELSE 'test' END AS split FROM daily WHERE year(date) IN (1998, 1999, 2000)"))
def _(f):
    return training.fixed_year_split(f.daily.select("block_id", "date"), "date", {1998: "train", 1999: "validation", 2000: "test"})


@query(
    "m05_median_imputation",
    with_("predictions", f"SELECT block_id, date, horizon, split, coalesce({r('raw')}, (SELECT {r('median(raw)')} FROM predictions WHERE split = 'train')) AS raw, coalesce({r('corrected')}, (SELECT {r('median(corrected)')} FROM predictions WHERE split = 'train')) AS corrected FROM predictions"),
)
def _(f):
    p = f.predictions.select("block_id", "date", "horizon", "split", "raw", "corrected")
    return training.impute_by_train_median(p, ["raw", "corrected"])


@query("m06_predictors_without_actuals", with_("forecast", f"SELECT block_id, target_date, lead, {r('temp_f')} AS temp_f, {r('rain_f')} AS rain_f FROM forecast"))
def _(f):
    fc = f.forecast.withColumn("actual_rain", F.col("rain_f"))
    try:
        training.forbid_actuals(fc.columns)
    except ValueError:
        fc = fc.drop("actual_rain")
    training.forbid_actuals(fc.columns)
    return fc.select("block_id", "target_date", "lead", "temp_f", "rain_f")


@query(
    "m07_residual_targets",
    with_("sites forecast site_targets", f"SELECT gp_id, target_date, lead, {r('actual_temperature_2m_mean - temp_f')} AS residual_temp_f FROM samples", samples=SAMPLES),
)
def _(f):
    return training.residual_targets(samples(f), {"temp_f": "actual_temperature_2m_mean"}).select("gp_id", "target_date", "lead", "residual_temp_f")


@query(
    "m13_raw_baseline",
    with_("sites forecast site_targets", f"""SELECT split, lead, COUNT(e) AS n, {r('sqrt(avg(e * e))')} AS rmse, {r('avg(abs(e))')} AS mae, {r('avg(e)')} AS bias, {r('1 - SUM(e * e) / (var_pop(y) * COUNT(y))')} AS r2,
      {r('avg(CASE WHEN abs(y) > 1e-8 THEN abs(e / y) END) * 100')} AS mape_nonzero, {r('avg(CASE WHEN y > 0 THEN abs(e) END)')} AS wet_mae, 'PASS' AS status FROM (SELECT split, lead, actual_temperature_2m_mean AS y, temp_f - actual_temperature_2m_mean AS e FROM samples JOIN d USING (target_date)) GROUP BY 1, 2""", samples=SAMPLES, d=SAMPLE_DATES),
)
def _(f):
    return metrics.regression_metrics(training.date_split(samples(f), "target_date"), ["split", "lead"], "actual_temperature_2m_mean", "temp_f")


# --- models: checked by skill in the tests, rows only here ------------------------------------------

FEATURES = ["lead", "temp_f", "rh_f", "wind_f"]


def area_samples(f):
    """Area-level temperature samples with a bias that grows with the lead."""
    d = f.daily.select("block_id", F.col("date").alias("target_date"), F.col("temp").alias("truth"))
    j = f.forecast.join(d, ["block_id", "target_date"]).withColumn("temp_f", F.col("temp_f") + F.col("lead") * 0.5)
    # Split, fit and evaluation all read the samples, and predictions are read more than once: both are made once.
    return training.date_split(materialise(j.select("block_id", "target_date", *FEATURES, "truth"), "samples"), "target_date")


def sound(evaluated, slack=1.05):
    """What SQL can know of a model: rows, raw error, and that the corrected values are there and at most ``slack`` times as far off."""
    return evaluated.select(
        "split", "lead", "n", "raw_rmse",
        ((F.col("corrected_rmse") <= F.col("raw_rmse") * slack) & ~F.isnan("corrected_rmse")).alias("sound"),
    )


def judged(predicted, raw, corrected):
    return materialise(predicted.select("split", "lead", "truth", raw, corrected), "predictions")


def raw_error(value: str, truth: str, bias: str) -> str:
    return with_(
        "forecast daily pred_dates",
        f"""SELECT split, lead, COUNT(*) AS n, {r('sqrt(avg(e * e))')} AS raw_rmse, true AS sound FROM (SELECT split, lead, f.{value} + lead * {bias} - d.{truth} AS e
      FROM forecast f JOIN daily d ON f.block_id = d.block_id AND f.target_date = d.date JOIN pred_dates p ON p.date = d.date WHERE split <> 'train') WHERE e IS NOT NULL GROUP BY 1, 2""",
    )


@query("m08_residual_model", raw_error("temp_f", "temp", "5e-1"))
def _(f):
    s = area_samples(f)
    m = models.fit_residual(s.filter("split = 'train'"), FEATURES, "truth", "temp_f", depth=5)
    out = models.apply_residual(m, s.filter("split <> 'train'").dropna(subset=["temp_f"]), "temp_f", -60, 60)
    return sound(metrics.horizon_evaluation(judged(out, "temp_f", "corrected"), ["split", "lead"], "truth", "temp_f", "corrected"))


TREE_FEATURES = ["temp", "rh", "wind", "phase"]


def trees_sql(trees: int, depth: int, leaf: int, tried: int, seed: int) -> str:
    """Every level of every tree: draws, extremes, cuts, gains, and where rows go."""
    digest = lambda *p: f"md5(concat_ws(':', {seed}, t, node, {', '.join(p)}))"
    steps = {}
    for n in range(depth):
        steps[f"drawn{n}"] = f"""SELECT t, node, i, row_number() OVER (PARTITION BY t, node ORDER BY {digest("i")}, i) AS j FROM (SELECT DISTINCT t, node FROM stand{n}), (SELECT unnest(range(0, {len(TREE_FEATURES)})) AS i)"""
        steps[f"ends{n}"] = f"""SELECT t, node, i, j, min(x[i + 1]) AS lo, max(x[i + 1]) AS hi FROM stand{n} JOIN s USING (rid) JOIN drawn{n} USING (t, node) WHERE j <= {2 * tried} GROUP BY ALL"""
        steps[f"cuts{n}"] = f"""SELECT t, node, i, k, lo + ('0x' || substr({digest("i", "'cut'")}, 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE * (hi - lo) AS cut
  FROM (SELECT *, row_number() OVER (PARTITION BY t, node ORDER BY j) AS k FROM ends{n} WHERE lo < hi) WHERE k <= {tried}"""
        steps[f"sides{n}"] = f"""SELECT t, node, i, k, cut, o, sum(y[o]) FILTER (x[i + 1] <= cut) AS sl, sum(y[o]) FILTER (x[i + 1] > cut) AS sr, count(*) FILTER (x[i + 1] <= cut) AS nl, count(*) FILTER (x[i + 1] > cut) AS nr
  FROM stand{n} JOIN s USING (rid) JOIN cuts{n} USING (t, node), (SELECT unnest(range(1, 8)) AS o) GROUP BY ALL"""
        steps[f"best{n}"] = f"""SELECT t, node, arg_max({{'i': i, 'cut': cut}}, (gain, -k)) AS b FROM (SELECT t, node, i, k, cut, sum(sl * sl / nl + sr * sr / nr) AS gain FROM sides{n} WHERE nl >= {leaf} AND nr >= {leaf} GROUP BY ALL) GROUP BY ALL"""
        steps[f"stand{n + 1}"] = f"""SELECT rid, t, node * 2 + CASE WHEN x[b.i + 1] > b.cut THEN 1 ELSE 0 END AS node FROM stand{n} JOIN s USING (rid) JOIN best{n} USING (t, node)"""
    means = ", ".join(f"{r(f'avg(y[{o}])')} AS mean_{o}" for o in (1, 7))
    found = " UNION ALL ".join(
        f"SELECT t::INTEGER AS t, node::INTEGER AS node, count(*) AS n, {means}, any_value({f'b.i::INTEGER' if n < depth else 'NULL::INTEGER'}) AS f, {r(f'any_value(b.cut)') if n < depth else 'NULL::DOUBLE'} AS cut "
        f"FROM stand{n} JOIN s USING (rid) {f'LEFT JOIN best{n} USING (t, node)' if n < depth else ''} GROUP BY t, node" for n in range(depth + 1)
    )
    rows = """SELECT row_number() OVER () AS rid, [temp, rh, wind, (dn % 5)::DOUBLE] AS x, list_transform(range(1, 8), lambda h: -((dn % 5 - 2) * h / 1e1 + wind * h / 2e1))::DOUBLE[] AS y
      FROM daily WHERE temp IS NOT NULL"""
    return with_("daily", found, s=rows, stand0=f"SELECT rid, unnest(range(0, {trees})) AS t, 1 AS node FROM s", **steps)


@query("m08_extra_trees", trees_sql(3, 3, 5, 2, 7))
def _(f):
    """The nodes of three trees over the residuals of all seven leads: counts, cuts and means."""
    late = lambda h: -((F.col("dn") % 5 - 2) * h / 10.0 + F.col("wind") * h / 20.0)
    wide = f.daily.filter("temp is not null").select("temp", "rh", "wind", (F.col("dn") % 5).cast("double").alias("phase"), *[late(h).alias(f"r{h}") for h in range(1, 8)])
    nodes = extra_trees.fit(wide, TREE_FEATURES, [f"r{h}" for h in range(1, 8)], trees=3, depth=3, leaf=5, seed=7).nodes
    return nodes.select("t", "node", "n", *[F.col("mean")[o - 1].alias(f"mean_{o}") for o in (1, 7)], "f", "cut")


@query("m09_direct_model", raw_error("temp_f", "temp", "5e-1"))
def _(f):
    s = area_samples(f)
    m = models.fit_direct(s.filter("split = 'train'"), FEATURES, "truth")
    out = judged(m.predict(s.filter("split <> 'train'")), "temp_f", "predicted")
    return sound(metrics.horizon_evaluation(out, ["split", "lead"], "truth", "temp_f", "predicted"), 3)


@query("m09_boosted_model", raw_error("temp_f", "temp", "5e-1"))
def _(f):
    s = area_samples(f)
    m = models.fit_direct(s.filter("split = 'train'"), FEATURES, "truth", kind="boosted", trees=20, depth=5)
    out = judged(m.predict(s.filter("split <> 'train'")), "temp_f", "predicted")
    return sound(metrics.horizon_evaluation(out, ["split", "lead"], "truth", "temp_f", "predicted"), 3)


@query("m10_two_stage_rain", raw_error("rain_f", "rain", "0e0"))
def _(f):
    j = f.forecast.join(f.daily.select("block_id", F.col("date").alias("target_date"), F.col("rain").alias("truth")), ["block_id", "target_date"])
    s = training.date_split(materialise(j.select("target_date", "lead", "rain_f", "rh_f", "wind_f", "truth"), "samples"), "target_date")
    m = models.fit_rain(s.filter("split = 'train'"), ["lead", "rain_f", "rh_f", "wind_f"], "truth", depth=5)
    out = m.predict(s.filter("split <> 'train'").dropna(subset=["rain_f"]), "rain_f")
    g = metrics.horizon_evaluation(judged(out, "rain_f", "corrected"), ["split", "lead"], "truth", "rain_f", "corrected")
    # The made-up rain errors are proportional and leave little to correct; the blend must stay finite and in bounds.
    return g.select("split", "lead", "n", "raw_rmse", ((F.col("corrected_rmse") < 100) & ~F.isnan("corrected_rmse")).alias("sound"))


@query(
    "m12_apply_to_current",
    with_("current_fc", "SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS non_finite, COUNT(DISTINCT gp_id) * 7 AS expected_rows, CASE WHEN COUNT(*) = COUNT(DISTINCT gp_id) * 7 THEN 'PASS' ELSE 'FAIL' END AS status FROM current_fc"),
)
def _(f):
    """One transform for all entities and days, with the row-count audit."""
    s = area_samples(f)
    m = models.fit_residual(s.filter("split = 'train'"), ["lead", "temp_f", "rh_f", "wind_f"], "truth", "temp_f", depth=5)
    cur = f.current.selectExpr("gp_id", "target_date", "day as lead", "coalesce(temperature, 25D) as temp_f", "humidity as rh_f", "wind as wind_f")
    return models.apply_current(m, cur, "temp_f", ["gp_id"], 7, -60, 60)[1]


@query(
    "m14_model_round_trip",
    with_("forecast daily pred_dates", "SELECT lead, COUNT(*) AS n, 0e0 AS max_change FROM forecast f JOIN daily d ON f.block_id = d.block_id AND f.target_date = d.date JOIN pred_dates p ON p.date = d.date WHERE split = 'test' GROUP BY lead"),
)
def _(f):
    """A saved corrector predicts the same after loading."""
    s = area_samples(f)
    m = models.fit_residual(s.filter("split = 'train'"), FEATURES, "truth", "temp_f", depth=5)
    path = fresh_dir(f.spark, "model")
    m.save(path)
    again = models.load_corrector(f.spark, path)
    test = s.filter("split = 'test'").select("block_id", "target_date", "truth", *FEATURES)
    a = m.predict(test).withColumnRenamed(m.output, "before")
    b = again.predict(test).select("block_id", "target_date", "lead", F.col(again.output).alias("after"))
    return a.join(b, ["block_id", "target_date", "lead"]).groupBy("lead").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("before") - F.col("after"))).alias("max_change"))


# --- audits -----------------------------------------------------------------------------------------

COLUMNS = """SELECT lower(p_brand) || '_' || replace(p_name, ' ', '_') || '_' || f AS column_name, MIN(p_partkey) AS k FROM part, (SELECT unnest(['id', 'target_date', 'source_url', 'valid_fraction', 'actual_rain', 'gfs_d3', 'era5_dew', 's1_vv', 'slope', 'x9']) AS f) GROUP BY 1"""


def sql_text(p):
    return p.replace("'", "''")


def named_columns(f):
    tags = F.explode(F.array(*[F.lit(x) for x in ("id", "target_date", "source_url", "valid_fraction", "actual_rain", "gfs_d3", "era5_dew", "s1_vv", "slope", "x9")]))
    return f.table("part").select("p_brand", "p_name", tags.alias("f")).select(
        F.concat_ws("_", F.lower("p_brand"), F.replace("p_name", F.lit(" "), F.lit("_")), "f").alias("column_name")
    ).distinct()


ROLE_SQL = {k: f"regexp_matches(column_name, '{sql_text(p)}')" for k, p in ROLE_PATTERNS.items()}
ROLE_SQL["actual"] = f"({ROLE_SQL['actual']} AND {ROLE_SQL['weather']})"


@query("q03_name_roles", with_("", "SELECT column_name, " + ", ".join(f"{s} AS is_{k}" for k, s in ROLE_SQL.items()) + " FROM c", c=COLUMNS))
def _(f):
    return named_columns(f).select("column_name", *[has_role(F.col("column_name"), k).alias(f"is_{k}") for k in ROLE_PATTERNS])


ORDER = ("identifier", "temporal", "provenance", "availability", "actual", "forecast", "reanalysis", "satellite", "static")


@query(
    "q02_dictionary_rule_order",
    with_("", "SELECT column_name, CASE " + " ".join(f"WHEN {ROLE_SQL[k]} THEN '{k}'" for k in ORDER) + " ELSE 'numeric' END AS rule FROM c", c=COLUMNS),
)
def _(f):
    no = F.lit(False)
    return named_columns(f).select("column_name", audits.dictionary_rule(F.col("column_name"), F.lit("double"), no, no).alias("rule"))


GP_COLUMNS = {"gp_id": ("bigint", "identifier"), "block_id": ("int", "identifier"), "gp_name": ("string", "other"), "terrain__elevation_mean": ("double", "static"), "terrain__slope_mean": ("double", "static"), "soil__clay": ("double", "static"),
              "soil__sand": ("double", "static"), "landcover__built": ("double", "static"), "landcover__void": ("double", "all_null"), "lat": ("double", "coordinate"), "lon": ("double", "coordinate")}


@query(
    "q02_feature_dictionary",
    with_("gp", " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, 'gp_merged_features' AS source_dataset, 'gp' AS level, '{t}' AS dtype, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS missing_count, {r(f'100e0 * (COUNT(*) - COUNT({c})) / COUNT(*)')} AS missing_percent, COUNT({c}) = 0 AS all_missing_100pct, COUNT(DISTINCT {c}) = 1 AS constant_non_null, "
        + ", ".join(f"'{v}' AS {n}" for n, v in zip(audits.DICTIONARY_FIELDS, audits.DICTIONARY_RULES[k])) + " FROM gp" for c, (t, k) in GP_COLUMNS.items()
    ) + " UNION ALL SELECT 'soil__gone', 'gp_merged_features', 'gp', 'double', COUNT(*), COUNT(*), 100e0, true, false, " + ", ".join(f"'{v}'" for v in audits.DICTIONARY_RULES["all_null"]) + " FROM gp"),
)
def _(f):
    return audits.feature_dictionary(f.gp, "gp_merged_features", "gp", ["soil__gone"])


INVENTORY = {"gp_id": "metadata_or_identifier|metadata|exclude_initial", "gp_name": "metadata_or_identifier|metadata|exclude_initial", "terrain__slope_mean": "spatial_or_remote_sensing|predictor|keep_review", "landcover__void": "spatial_or_remote_sensing|predictor|keep_review", "lat": "spatial_or_remote_sensing|predictor|keep_review"}
INV_TYPE = {"gp_id": "bigint", "gp_name": "string"}


@query(
    "q01_feature_inventory",
    with_("gp", " UNION ALL ".join(
        f"SELECT 'gp' AS dataset, 'gp' AS level, '{c}' AS column_name, '{INV_TYPE.get(c, 'double')}' AS dtype, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS missing_count, {r(f'100e0 * (COUNT(*) - COUNT({c})) / COUNT(*)')} AS missing_percent, COUNT({c}) = 0 AS all_null, COUNT(DISTINCT {c}) = 1 AS constant_non_null, "
        + ", ".join(f"'{v}' AS {n}" for n, v in zip(("classification", "preliminary_role", "preliminary_action"), k.split("|"))) + " FROM gp" for c, k in INVENTORY.items()
    )),
)
def _(f):
    return audits.feature_inventory(f.gp.select(*INVENTORY), "gp", "gp")


CHECK = "SELECT check_name, n_bad, CASE WHEN n_bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("


@query(
    "q04_engineered_audit",
    with_("gp", CHECK + """SELECT 'infinite_cells' AS check_name, CAST(0 AS BIGINT) AS n_bad UNION ALL SELECT 'all_null_columns', CAST(COUNT(landcover__void) = 0 AS BIGINT) FROM gp UNION ALL SELECT 'constant_columns', CAST(COUNT(DISTINCT landcover__built) = 1 AS BIGINT) FROM gp
      UNION ALL SELECT 'leakage_named_columns', 1 UNION ALL SELECT 'duplicate_rows', COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT block_id, soil__clay FROM gp)) FROM gp UNION ALL SELECT 'invalid_dates', COUNT(*) FILTER (soil__clay = 3) FROM gp)"""),
)
def _(f):
    g = f.gp.select(
        "block_id", "landcover__built", "landcover__void", F.col("soil__clay").alias("actual_clay"), F.when(F.col("soil__clay") != 3, F.date_add(F.lit("2020-01-01").cast("date"), F.col("soil__clay").cast("int"))).alias("date")
    )
    return audits.engineered_audit(g, "date")


HIST = [f"hist__temp__lag_{n}d" for n in (1, 3, 7)] + [f"hist__temp__rolling_{op}_{w}d" for w in (3, 7, 14) for op in ("mean", "std")]


@query(
    "q05_verify_history",
    with_("daily", " UNION ALL ".join(
        f"SELECT '{c}' AS feature, COUNT({c}) AS comparisons, {r('0e0')} AS max_abs_error, 'PASS' AS status FROM h" if c != "hist__temp__lag_3d" else
        f"SELECT '{c}' AS feature, COUNT({c}) AS comparisons, {r('1e0')} AS max_abs_error, 'MISMATCH' AS status FROM h" for c in HIST
    ) + " UNION ALL SELECT 'hist__snow__lag_1d', 0, NULL, 'SOURCE_COLUMN_MISSING'", h="SELECT " + ", ".join(hist_sql("temp", False)) + " FROM daily"),
)
def _(f):
    """One column is falsified and one has no source: both must show."""
    e = windows.history_features(f.daily, ["block_id"], "date", ["temp"]).withColumns({"hist__temp__lag_3d": F.col("hist__temp__lag_3d") + 1, "hist__snow__lag_1d": F.lit(0.0)})
    return audits.verify_history(e, f.daily, ["block_id"], "date", ["temp"])


@query(
    "q06_classify_actuals",
    with_("forecast", "SELECT *, CASE WHEN target_rate >= 0.999 THEN 'likely_target_or_target_reference' WHEN issue_rate >= 0.999 THEN 'likely_available_at_run_time' ELSE 'REVIEW' END AS provisional_role FROM (" + " UNION ALL ".join(rate_sql(c) for c in ACTUALS) + ")", x=RATES),
)
def _(f):
    return audits.classify_actuals(rates(f))


BROKEN = "SELECT block_id, target_date, lead, CASE WHEN (dn * 7 + lead) % 97 = 0 THEN target_date WHEN (dn + lead) % 89 = 0 THEN NULL WHEN (dn + lead) % 83 = 0 THEN target_date - 9 ELSE issue_date END AS issue_date FROM forecast"


def broken(f):
    issue = F.expr("case when (dn * 7 + lead) % 97 = 0 then target_date when (dn + lead) % 89 = 0 then null when (dn + lead) % 83 = 0 then date_sub(target_date, 9) else issue_date end")
    return f.forecast.select("block_id", "target_date", "lead", issue.alias("issue_date"))


for _name, _cte in (("q07_chronology_pass", "forecast"), ("q07_chronology_fail", "b")):

    @query(
        _name,
        with_("forecast", f"""SELECT lead, COUNT(*) AS rows, COUNT(*) FILTER (d IS NULL OR d <= 0) AS bad_chronology, COUNT(*) FILTER (d <> lead) AS wrong_lead, CAST(MIN(d) AS INTEGER) AS min_delta_days, CAST(MAX(d) AS INTEGER) AS max_delta_days,
      CASE WHEN COUNT(*) FILTER (d IS NULL OR d <= 0) = 0 AND COUNT(*) FILTER (d <> lead) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT lead, target_date - issue_date AS d FROM {_cte}) GROUP BY lead""", b=BROKEN),
    )
    def _(f, bad=_cte == "b"):
        return audits.chronology_audit(broken(f) if bad else f.forecast, "lead", "target_date", "issue_date")


@query("q08_control_flags", with_("daily", CHECK + "SELECT 'synthetic' AS check_name, COUNT(*) FILTER (dn % 101 = 0) AS n_bad FROM daily UNION ALL SELECT 'reference_only', COUNT(*) FILTER (dn % 103 = 0) FROM daily UNION ALL SELECT 'filled', COUNT(*) FILTER (false) FROM daily)"))
def _(f):
    d = f.daily.selectExpr("dn % 101 = 0 as synthetic", "case when dn % 103 <> 0 then true end as reference_only", "false as filled")
    return audits.flag_audit(d, {"synthetic": False, "reference_only": True, "filled": False})


def audit_sql(bad):
    return (
        CHECK + f"SELECT 'forbidden_predictor' AS check_name, {1 if bad else 0} AS n_bad UNION ALL SELECT 'target_in_predictors', {1 if bad else 0} UNION ALL SELECT 'non_numeric_predictor', 0 UNION ALL SELECT 'missing_label_column', 0 UNION ALL SELECT 'non_finite_cell', 0"
        f" UNION ALL SELECT 'all_null_predictor', 0 UNION ALL SELECT 'invalid_date', 0 UNION ALL SELECT 'missing_entity', 0 UNION ALL SELECT 'missing_label', 0"
        f" UNION ALL SELECT 'duplicate_sample', {'(SELECT COUNT(*) FROM samples WHERE gp_id = 7)' if bad else '0'} UNION ALL SELECT 'split_overlap', {'(SELECT COUNT(DISTINCT (lead, target_date)) FROM samples WHERE gp_id = 7)' if bad else '0'} UNION ALL SELECT 'split_order', {'7' if bad else '0'})"
    )


def audited(f, bad):
    s = training.date_split(samples(f), "target_date")
    if not bad:
        return audits.training_audit(s, PREDICTORS, LABELS, "gp_id", "target_date", "lead")
    wrong = F.when(F.col("split") == "test", "train").otherwise("test")
    s = s.withColumn("split", F.explode(F.when(F.col("gp_id") == 7, F.array("split", wrong)).otherwise(F.array("split"))))
    return audits.training_audit(s, [*PREDICTORS, LABELS[0]], LABELS, "gp_id", "target_date", "lead")


@query("q09_training_audit_pass", with_("sites forecast site_targets", audit_sql(False), samples=SAMPLES))
def _(f):
    return audited(f, False)


@query("q09_training_audit_fail", with_("sites forecast site_targets", audit_sql(True), samples=SAMPLES))
def _(f):
    """One entity's samples are repeated under another split, and a target sits among the predictors."""
    return audited(f, True)


@query(
    "q10_target_preflight",
    with_("radar", CHECK + "SELECT 'null_key' AS check_name, COUNT(*) FILTER (gp_id IS NULL OR date IS NULL) AS n_bad FROM radar UNION ALL SELECT 'range_vv', COUNT(*) FILTER (vv NOT BETWEEN -40 AND 0) FROM radar UNION ALL SELECT 'range_coverage', COUNT(*) FILTER (coverage NOT BETWEEN 0 AND 1.5) FROM radar"
          " UNION ALL SELECT 'duplicate_key', COUNT(*) FROM (SELECT gp_id, date FROM radar GROUP BY 1, 2 HAVING COUNT(*) > 1))"),
)
def _(f):
    return audits.target_preflight(f.radar, ["gp_id", "date"], {"vv": (-40, 0), "coverage": (0, 1.5)})


def gate_checks(f):
    chron = audits.chronology_audit(broken(f), "lead", "target_date", "issue_date").select(F.concat(F.lit("chronology_d"), F.col("lead").cast("string")).alias("check_name"), "status")
    flags = audits.flag_audit(f.daily.selectExpr("dn % 101 = 0 as synthetic"), {"synthetic": False}).select("check_name", "status")
    keys = joins.key_report(f.gp, f.table("customer").selectExpr("c_custkey as gp_id"), "gp_id").select("check_name", "status")
    return chron.unionByName(flags).unionByName(keys)


@query(
    "q11_run_gate",
    with_("forecast", """SELECT COUNT(*) AS n_checks, COUNT(*) FILTER (NOT ok) AS n_failed, string_agg(name, '; ' ORDER BY name) FILTER (NOT ok) AS blockers, CASE WHEN COUNT(*) FILTER (NOT ok) = 0 THEN 'PASS' ELSE 'REVIEW_REQUIRED' END AS status FROM
      (SELECT 'chronology_d' || lead AS name, COUNT(*) FILTER (issue_date IS NULL OR target_date - issue_date <= 0 OR target_date - issue_date <> lead) = 0 AS ok FROM b GROUP BY lead
       UNION ALL SELECT 'synthetic', COUNT(*) FILTER (dn % 101 = 0) = 0 FROM daily UNION ALL SELECT unnest(['blank', 'duplicate', 'missing', 'unexpected']), true)""", b=BROKEN),
)
def _(f):
    return audits.run_gate(gate_checks(f))


GATE = ("required_source_columns", "forecast_temporal_integrity", "target_leakage_absent", "training_datasets_exist", "wind_source_compatibility")


@query(
    "q12_training_gate",
    with_("forecast daily", f"""SELECT *, CASE WHEN NOT (forecast_temporal_integrity AND training_datasets_exist) THEN 'DO_NOT_TRAIN_YET' WHEN NOT wind_source_compatibility THEN 'WIND_REQUIRES_SOURCE_FIX' ELSE 'READY_FOR_TRAINING' END AS decision,
      CASE WHEN NOT forecast_temporal_integrity THEN 'forecast_temporal_integrity' WHEN NOT training_datasets_exist THEN 'training_datasets_exist' WHEN NOT wind_source_compatibility THEN 'wind_source_compatibility' END AS first_failed
    FROM (SELECT lead, true AS required_source_columns, bool_and(target_date - issued = lead) AS forecast_temporal_integrity, true AS target_leakage_absent, COUNT(actual) > 0 AS training_datasets_exist,
      NOT abs(avg(actual) / avg(raw) - 3.6) < 0.25 AS wind_source_compatibility
    FROM (SELECT f.lead, f.target_date, CASE WHEN lead = 7 AND f.dn % 97 = 0 THEN issue_date + 1 ELSE issue_date END AS issued, CASE WHEN lead <= 4 THEN wind * 3.6::DOUBLE ELSE wind END AS actual, wind_f AS raw
      FROM forecast f JOIN daily d ON f.block_id = d.block_id AND f.target_date = d.date) GROUP BY lead)"""),
)
def _(f):
    """One decision per lead, from checks made on the data; all three outcomes occur."""
    from finecast.plans.q_aggs import winds

    fc = f.forecast.withColumn("issue_date", F.expr("case when lead = 7 and dn % 97 = 0 then date_add(issue_date, 1) else issue_date end"))
    time = audits.chronology_audit(fc, "lead", "target_date", "issue_date").groupBy("lead").agg(F.bool_and(F.col("status") == "PASS").alias("ok"))
    w = winds(f).withColumnRenamed("horizon", "lead")
    wind = metrics.unit_ratio(w, ["lead"], "actual", "raw").select("lead", "possible_unit_mismatch").join(w.groupBy("lead").agg(F.count("actual").alias("n")), "lead")
    status = lambda c: F.when(c, "PASS").otherwise("FAIL")
    found = (
        F.lit({"temp_f", "rain_f"} <= set(fc.columns)), F.col("ok"), F.lit(not any(c.startswith("actual_") for c in fc.columns)), F.col("n") > 0, ~F.col("possible_unit_mismatch"),
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), status(c).alias("status")) for n, c in zip(GATE, found)])
    return audits.training_gate(time.join(wind, "lead").select("lead", F.explode(pairs).alias("c")).select("lead", "c.*"), ["lead"])
