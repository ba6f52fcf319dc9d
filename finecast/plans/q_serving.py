"""Serving, risk, scenario and comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from finecast.operators import rules, serving
from finecast.plans.frames import with_
from finecast.plans.registry import query, r

RISK_SQL = """SELECT gp_id, target_date, CAST(rule_no AS INTEGER) AS n, code, severity, CAST(score AS DOUBLE) AS score, CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END AS weight FROM (
      SELECT gp_id, target_date, 0 AS rule_no, 'HEAT_STRESS' AS code, CASE WHEN t >= 40 THEN 'CRITICAL' ELSE 'HIGH' END AS severity, CASE WHEN t >= 40 THEN 0.95 ELSE 0.85 END AS score FROM w WHERE t >= 35
      UNION ALL SELECT gp_id, target_date, 1, 'HEAVY_RAIN', CASE WHEN p >= 64 THEN 'CRITICAL' WHEN p >= 35 THEN 'HIGH' ELSE 'MEDIUM' END, CASE WHEN p >= 64 THEN 0.96 WHEN p >= 35 THEN 0.88 ELSE 0.65 END FROM w WHERE p >= 20
      UNION ALL SELECT gp_id, target_date, 2, 'STRONG_WIND', CASE WHEN v >= 60 THEN 'CRITICAL' WHEN v >= 40 THEN 'HIGH' ELSE 'MEDIUM' END, CASE WHEN v >= 60 THEN 0.97 WHEN v >= 40 THEN 0.87 ELSE 0.65 END FROM w WHERE v >= 25
      UNION ALL SELECT gp_id, target_date, 3, 'HIGH_HUMIDITY', CASE WHEN h >= 90 THEN 'HIGH' ELSE 'MEDIUM' END, CASE WHEN h >= 90 THEN 0.9 ELSE 0.72 END FROM w WHERE h >= 80
      UNION ALL SELECT gp_id, target_date, 4, 'FUNGAL_RISK', 'HIGH', 0.88 FROM w WHERE h >= 85 AND t BETWEEN 18 AND 32 AND p >= 5
      UNION ALL SELECT gp_id, target_date, 5, 'SPRAYING_UNFAVORABLE', 'MEDIUM', 0.78 FROM w WHERE v >= 20 OR p >= 5
      UNION ALL SELECT gp_id, target_date, 6, 'EXCESS_MOISTURE', 'HIGH', 0.86 FROM w WHERE s >= 80 AND p >= 10
      UNION ALL SELECT gp_id, target_date, 7, 'LOW_RAINFALL', 'MEDIUM', 0.6 FROM w WHERE p <= 2
      UNION ALL SELECT gp_id, target_date, 8, 'FROST_RISK', 'HIGH', 0.9 FROM w WHERE t <= 5)"""
RISK_IN = "SELECT gp_id, target_date, temperature AS t, humidity AS h, rainfall AS p, wind * 3.6::DOUBLE AS v, CASE WHEN gp_id % 4 <> 0 THEN CAST(gp_id * 13 % 100 AS DOUBLE) END AS s FROM current_fc"


def risk_input(f):
    return f.current.selectExpr(
        "gp_id", "target_date", "temperature", "humidity", "rainfall", "wind * 3.6D as wind_kmh", "case when gp_id % 4 <> 0 then cast(gp_id * 13 % 100 as double) end as soil_moisture"
    )


KEYS = ["gp_id", "target_date"]


@query("r01_weather_risks", with_("current_fc", "SELECT gp_id, target_date, code, severity, score, CAST(weight AS INTEGER) AS weight FROM (" + RISK_SQL + ")", w=RISK_IN))
def _(f):
    return rules.weather_risks(risk_input(f), KEYS).drop("rule_no")


RANKED = f"SELECT *, CAST(row_number() OVER (PARTITION BY gp_id, target_date ORDER BY weight DESC, score DESC, n) AS INTEGER) AS rank FROM ({RISK_SQL})"


@query("t02_primary_and_next_risks", with_("current_fc", f"SELECT gp_id, target_date, rank, code, severity, score FROM ({RANKED}) WHERE rank <= 4", w=RISK_IN))
def _(f):
    return rules.ranked_risks(risk_input(f), KEYS, 4)


@query(
    "w12_area_rank_by_rain",
    with_("current_fc", f"SELECT block_id, target_date, gp_id, {r('rainfall')} AS rainfall, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY block_id, target_date ORDER BY rainfall DESC NULLS LAST, gp_id) AS rank FROM current_fc) WHERE rank <= 3"),
)
def _(f):
    from finecast.operators.windows import rank_within

    d = f.current.select("block_id", "target_date", "gp_id", "rainfall")
    return rank_within(d, ["block_id", "target_date"], [F.col("rainfall").desc_nulls_last(), F.col("gp_id")], 3)


TEXTS = "SELECT code, 'en' AS language, 'check fields: ' || lower(code) AS text FROM (SELECT unnest(['HEAT_STRESS', 'HEAVY_RAIN', 'STRONG_WIND', 'HIGH_HUMIDITY', 'FUNGAL_RISK', 'EXCESS_MOISTURE', 'FROST_RISK', 'SAFE_WEATHER']) AS code)"


@query(
    "r02_advisories",
    with_("current_fc", """SELECT gp_id, target_date, code, severity, score, rank, CASE WHEN rank = 1 THEN 'PRIMARY' ELSE 'SECONDARY' END AS role, text FROM (SELECT gp_id, target_date, code, severity, score, rank FROM k WHERE rank <= 4
      UNION ALL SELECT gp_id, target_date, 'SAFE_WEATHER', 'LOW', 0, 1 FROM w WHERE (gp_id, target_date) NOT IN (SELECT (gp_id, target_date) FROM k)) LEFT JOIN texts USING (code)""", w=RISK_IN, k=RANKED, texts=TEXTS),
)
def _(f):
    codes = ["HEAT_STRESS", "HEAVY_RAIN", "STRONG_WIND", "HIGH_HUMIDITY", "FUNGAL_RISK", "EXCESS_MOISTURE", "FROST_RISK", "SAFE_WEATHER"]
    rows = [(c, lang, f"check fields: {c.lower()}" if lang == "en" else c) for c in codes for lang in ("en", "hi")]
    texts = f.spark.createDataFrame(rows, "code string, language string, text string")
    return rules.advisories(risk_input(f), KEYS, texts, "en")


@query(
    "r03_watch_ranges",
    with_("current_fc", """SELECT gp_id, watch, MIN(day) FILTER (hit) AS first_day, MAX(day) FILTER (hit) AS last_day, COUNT(*) FILTER (hit) AS matches, COUNT(*) FILTER (has) AS available FROM (
      SELECT gp_id, day, 'rainfall' AS watch, rainfall >= 10 AS hit, rainfall IS NOT NULL AS has FROM current_fc UNION ALL SELECT gp_id, day, 'humidity', humidity >= 80, humidity IS NOT NULL FROM current_fc UNION ALL SELECT gp_id, day, 'wind', wind >= 7, wind IS NOT NULL FROM current_fc
      UNION ALL SELECT gp_id, day, 'temperature', temperature > avg(temperature) OVER (PARTITION BY gp_id) + 3, temperature IS NOT NULL FROM current_fc) GROUP BY 1, 2 HAVING COUNT(*) FILTER (hit) > 0"""),
)
def _(f):
    return rules.watch_ranges(f.current, ["gp_id"], "day", "rainfall", "humidity", "wind", "temperature")


SCEN = """SELECT n_name AS scenario, CAST(n_nationkey * 10 - 120 AS DOUBLE) AS rp, (n_nationkey - 12) / 2e0 AS td, CAST(n_nationkey - 12 AS DOUBLE) AS hd, CAST(n_nationkey * 2 - 24 AS DOUBLE) AS wd, CAST(5 + n_nationkey AS DOUBLE) AS thr, CASE n_nationkey % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS soil FROM nation"""
APPLIED = """SELECT gp_id, target_date, scenario, thr, soil, CASE WHEN rainfall IS NOT NULL THEN greatest(0e0, rainfall * (1 + rp / 100)) END AS rainfall, CASE WHEN temperature IS NOT NULL THEN least(65e0, greatest(-80e0, temperature + td)) END AS temperature,
      least(1e2, greatest(0e0, humidity + hd)) AS humidity, greatest(0e0, wind + wd / 3.6::DOUBLE) AS wind FROM current_fc, sc"""


def applied(f):
    sc = f.table("nation").selectExpr(
        "n_name as scenario", "cast(n_nationkey * 10 - 120 as double) as rainfall_delta_pct", "(n_nationkey - 12) / 2D as temperature_delta_c", "cast(n_nationkey - 12 as double) as humidity_delta_pct",
        "cast(n_nationkey * 2 - 24 as double) as wind_delta_kmh", "cast(5 + n_nationkey as double) as threshold_mm", "case n_nationkey % 3 when 0 then 'low' when 1 then 'medium' else 'high' end as soil",
    )
    base = f.current.select("gp_id", "target_date", "rainfall", "temperature", "humidity", "wind")
    return rules.apply_scenarios(base, sc, "rainfall", "temperature", "humidity", "wind")


@query("r04_scenarios", with_("current_fc", f"SELECT gp_id, target_date, scenario, {r('rainfall')} AS rainfall, {r('temperature')} AS temperature, {r('humidity')} AS humidity, {r('wind')} AS wind FROM a", sc=SCEN, a=APPLIED))
def _(f):
    """One scenario per nation row; every forecast row under each."""
    return applied(f).select("gp_id", "target_date", "scenario", "rainfall", "temperature", "humidity", "wind")


@query(
    "r05_scenario_status",
    with_("current_fc", """SELECT gp_id, scenario, water_status, signal, days_reached FROM (SELECT gp_id, scenario, COUNT(*) FILTER (rainfall >= thr) AS days_reached,
      CASE WHEN avg(rainfall) IS NULL THEN 'UNAVAILABLE' WHEN avg(rainfall) < MAX(thr) AND MAX(soil) = 'low' THEN 'DRYNESS_WATCH' WHEN avg(rainfall) < MAX(thr) THEN 'BELOW_THRESHOLD' WHEN MAX(soil) = 'high' THEN 'WET_CONDITION_REVIEW' ELSE 'THRESHOLD_MET' END AS water_status,
      CASE WHEN avg(rainfall) < MAX(thr) AND MAX(soil) = 'low' THEN 'IRRIGATION_REVIEW' WHEN NOT coalesce(avg(rainfall) < MAX(thr), false) AND MAX(soil) = 'high' THEN 'DRAINAGE_REVIEW' ELSE 'NONE' END AS signal FROM a GROUP BY gp_id, scenario)""", sc=SCEN, a=APPLIED),
)
def _(f):
    a = applied(f).withColumn("st", rules.rainfall_status(F.col("rainfall"), F.col("threshold_mm")))
    g = a.groupBy("gp_id", "scenario").agg(F.avg("rainfall").alias("m"), F.max("threshold_mm").alias("t"), F.max("soil").alias("s"), F.count_if(F.col("st") == "Rainfall threshold reached").alias("days_reached"))
    water, signal = rules.planning_flags(F.col("m"), F.col("t"), F.col("s"))
    return g.select("gp_id", "scenario", water.alias("water_status"), signal.alias("signal"), "days_reached")


TODAY = "DATE '2001-07-25'"


@query(
    "r06_question_facts",
    with_("current_fc", f"""SELECT gp_id, {r('SUM(rainfall)')} AS total_rain_mm, arg_min(target_date, (-rainfall, target_date)) FILTER (rainfall IS NOT NULL) AS peak_date, {r('MAX(rainfall)')} AS peak_rain_mm, {r('MAX(wind)')} AS max_wind,
      {r('(array_agg(rainfall ORDER BY target_date) FILTER (target_date > ' + TODAY + '))[1]')} AS tomorrow_rain_mm FROM current_fc GROUP BY gp_id"""),
)
def _(f):
    return rules.question_facts(f.current, ["gp_id"], "target_date", "rainfall", "wind", F.lit("2001-07-25").cast("date"))


@query(
    "r07_forecast_sanity",
    with_("current_fc", """SELECT gp_id, n_rows, synthetic_rows, actual_input_rows, fallback_rows, CASE WHEN synthetic_rows > 0 OR actual_input_rows > 0 OR n_rows <> 7 THEN 'FAIL' WHEN fallback_rows > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM
      (SELECT gp_id, COUNT(*) AS n_rows, COUNT(*) FILTER (gp_id % 9 = 0) AS synthetic_rows, COUNT(*) FILTER (gp_id % 11 = 0 AND day = 3) AS actual_input_rows, COUNT(*) FILTER (gp_id % 4 = 0) AS fallback_rows FROM current_fc GROUP BY gp_id)"""),
)
def _(f):
    c = f.current.selectExpr("gp_id", "gp_id % 9 = 0 as synthetic", "gp_id % 11 = 0 and day = 3 as actual_used", "gp_id % 4 = 0 as fallback")
    return rules.forecast_sanity(c, ["gp_id"], "synthetic", "actual_used", "fallback")


@query(
    "j20_serving_assembly",
    with_("current_fc", f"""SELECT gp_id, s_name AS gp_name, CASE WHEN gp_id % 3 = 0 THEN {r('s_acctbal + 5')} WHEN gp_id % 5 = 0 THEN NULL ELSE {r('s_acctbal')} END AS elevation, days, {r('rain')} AS rain, CASE WHEN gp_id % 4 <> 0 THEN 'crops,water' ELSE 'water' END AS classes
    FROM (SELECT gp_id, string_agg(day || ':' || CAST(target_date AS VARCHAR), ' ' ORDER BY day, target_date) AS days, SUM(rainfall) AS rain FROM current_fc GROUP BY gp_id) JOIN supplier ON s_suppkey = gp_id"""),
)
def _(f):
    s = f.table("supplier")
    master = s.selectExpr("s_suppkey as gp_id", "s_name as gp_name", "case when s_suppkey % 5 <> 0 then s_acctbal end as elevation")
    over = s.selectExpr("s_suppkey as gp_id", "case when s_suppkey % 3 = 0 then s_acctbal + 5 end as elevation")
    fractions = {c: "cast(null as double)" for c in serving.LANDCOVER_CLASSES} | {"water": "0.25D", "crops": "case when s_suppkey % 4 <> 0 then 0.5D end"}
    lc = s.selectExpr("s_suppkey as gp_id", *[f"{e} as {c}_fraction" for c, e in fractions.items()])
    out = serving.serving_frame(f.current, master, lc, [over], "gp_id", "target_date", "day", ["temperature", "humidity", "rainfall", "wind"], ["elevation"], ["block_id"])
    return out.select(
        "gp_id", "gp_name", "elevation",
        F.array_join(F.transform("forecast", lambda d: F.concat_ws(":", d["day"].cast("string"), d["date"].cast("string"))), " ").alias("days"),
        F.when(F.size(F.filter("forecast", lambda d: d["rainfall"].isNotNull())) > 0, F.aggregate("forecast", F.lit(0.0), lambda a, d: a + F.coalesce(d["rainfall"], F.lit(0.0)))).alias("rain"),
        F.array_join(F.sort_array(F.map_keys("land_use_fractions")), ",").alias("classes"),
    )


POS = "SELECT s_suppkey AS gp_id, 10 + (s_suppkey * 7 % 100) / 1e2 AS lat, 75 + (s_suppkey * 11 % 100) / 1e2 AS lon FROM supplier"
HAV = "sin(radians(b.lat - a.lat) / 2) ** 2 + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lon - a.lon) / 2) ** 2"
BEAR = "degrees(atan2(sin(radians(b.lon - a.lon)) * cos(radians(b.lat)), cos(radians(a.lat)) * sin(radians(b.lat)) - sin(radians(a.lat)) * cos(radians(b.lat)) * cos(radians(b.lon - a.lon))))"


@query(
    "a31_comparison",
    with_("current_fc", f"""SELECT a.gp_id, b.gp_id AS other, {r('max_temp')} AS max_temp, {r('min_temp')} AS min_temp, {r('day_rain')} AS day_rain, {r('total_rain')} AS total_rain, {r('mean_humidity')} AS mean_humidity, {r('wind_kmh')} AS wind_kmh,
      {r(f'12742e0 * atan2(sqrt({HAV}), sqrt(1 - ({HAV})))')} AS distance_km, (['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'])[CAST(floor((({BEAR} + 360) % 360) / 45 + 0.5::DOUBLE) AS INTEGER) % 8 + 1] AS direction
    FROM pos a JOIN pos b ON b.gp_id IN (a.gp_id + 1, a.gp_id + 5) JOIN (SELECT gp_id, MAX(temperature) AS max_temp, MIN(temperature) AS min_temp, MAX(rainfall) FILTER (day = 1) AS day_rain, SUM(rainfall) AS total_rain, avg(humidity) AS mean_humidity, avg(wind) * 3.6::DOUBLE AS wind_kmh FROM current_fc GROUP BY gp_id) s ON s.gp_id = b.gp_id""", pos=POS),
)
def _(f):
    pts = f.table("supplier").selectExpr("s_suppkey as gp_id", "10 + (s_suppkey * 7 % 100) / 100D as lat", "75 + (s_suppkey * 11 % 100) / 100D as lon")
    pairs = pts.select("gp_id", F.explode(F.array(F.col("gp_id") + 1, F.col("gp_id") + 5)).alias("other"))
    return serving.compare(f.current, pts, pairs, "gp_id", "day", "rainfall", "temperature", "humidity", "wind")


@query(
    "a31_wettest_entity",
    with_("current_fc", f"SELECT block_id, target_date, arg_min(gp_id, (-rainfall, gp_id)) AS gp_id, {r('MAX(rainfall)')} AS rainfall FROM current_fc WHERE rainfall IS NOT NULL GROUP BY 1, 2"),
)
def _(f):
    return rules.wettest(f.current, ["block_id", "target_date"], "gp_id", "rainfall")
