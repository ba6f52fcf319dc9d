"""Aggregation, profile and score queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from finecast.operators import aggregates as A
from finecast.operators import audits, metrics
from finecast.plans.frames import with_
from finecast.plans.registry import query, r


def avg_(c, name=None):
    return f"{r(f'avg({c})')} AS {name or c}"


@query(
    "a01_daily_forecast",
    with_("hourly", "SELECT block_id, lead, CAST(time AS DATE) AS date, " + ", ".join(
        [avg_("temperature", "temp_mean"), avg_("humidity", "rh_mean"), f"{r('SUM(precipitation)')} AS precip", avg_("cloud_cover"), avg_("wind_speed"), avg_("wind_direction"), f"{r('MAX(wind_gust)')} AS wind_gust", avg_("vpd")]
    ) + " FROM hourly GROUP BY 1, 2, 3"),
)
def _(f):
    return A.daily_forecast(f.hourly, ["block_id", "lead"])


@query(
    "a03_daily_current",
    with_("hourly", "SELECT block_id, CAST(time AS DATE) AS target_date, " + ", ".join(
        [avg_("temperature", "temp_mean_c"), f"{r('MAX(temperature)')} AS temp_max_c", f"{r('MIN(temperature)')} AS temp_min_c", avg_("humidity", "rh_mean_pct"), f"{r('SUM(precipitation)')} AS precipitation_sum_mm",
         avg_("cloud_cover", "cloud_cover_mean_pct"), avg_("wind_speed", "wind_speed_mean_ms"), f"{r('MAX(wind_gust)')} AS wind_gust_max_ms", avg_("pressure", "surface_pressure_mean_hpa"), avg_("vpd", "vpd_mean_kpa")]
    ) + " FROM hourly GROUP BY 1, 2"),
)
def _(f):
    return A.daily_current(f.hourly, ["block_id"])


@query(
    "a04_gp_daily",
    with_("", "SELECT user_id AS gp_id, CAST(ts AS DATE) AS date, " + ", ".join([avg_("value / 10", "temperature_mean"), avg_("value", "humidity_mean"), f"{r('SUM(value / 100)')} AS precipitation_sum", avg_("value / 7", "wind_speed_mean")]) + " FROM events GROUP BY 1, 2"),
)
def _(f):
    e = f.table("events").selectExpr("user_id as gp_id", "cast(ts as date) as date", "value / 10D as temperature", "value as humidity", "value / 100D as precipitation", "value / 7D as wind_speed")
    return A.gp_daily(e, ["gp_id", "date"])


@query(
    "a05_source_nodes",
    f"SELECT user_id, CAST(ts AS DATE) AS date, COUNT(DISTINCT event_id % 2) AS n_nodes, {r('avg(value)')} AS value FROM events GROUP BY 1, 2",
)
def _(f):
    e = f.table("events").selectExpr("user_id", "cast(ts as date) as date", "event_id % 2 as node", "value")
    return A.daily_nodes(e, ["user_id", "date"], "node", ["value"])


@query("a06_satellite_daily", with_("radar", f"SELECT gp_id, date, {r('avg(vv)')} AS s1_vv, {r('avg(vh)')} AS s1_vh, COUNT(*) AS s1_acquisition_count FROM radar GROUP BY 1, 2"))
def _(f):
    return A.satellite_daily(f.radar, ["gp_id", "date"], ["vv", "vh"], "s1_")


BANDS = ("b4", "b8", "b11")


@query(
    "a07_zonal_stats",
    with_("pixels", "SELECT zone_id, scene_id, " + ", ".join(f"{r(f'{fn}({b})')} AS {b}_{n}" for b in BANDS for n, fn in (("mean", "avg"), ("stdDev", "stddev_pop"), ("min", "MIN"), ("max", "MAX"))) + ", COUNT(*) AS pixel_count FROM pixels GROUP BY 1, 2"),
)
def _(f):
    return A.zonal_stats(f.pixels, ["zone_id", "scene_id"], BANDS)


@query(
    "a08_landcover_fractions",
    f"""SELECT label, {r('avg(a)')} AS a_fraction, {r('avg(b)')} AS b_fraction, {r('avg(CASE WHEN a IS NOT NULL THEN 1 ELSE 0 END)')} AS valid_pixel_fraction FROM
      (SELECT label, vec_id % 10 AS px, avg(CASE WHEN vec_id % 10 <> 3 THEN abs(CAST(embedding[1] AS DOUBLE)) END) AS a, avg(abs(CAST(embedding[2] AS DOUBLE))) AS b FROM embeddings GROUP BY 1, 2) GROUP BY label""",
)
def _(f):
    p = f.table("embeddings").select(
        "label", (F.col("vec_id") % 10).alias("px"), F.when(F.col("vec_id") % 10 != 3, F.abs(F.col("embedding")[0].cast("double"))).alias("a"),
        F.abs(F.col("embedding")[1].cast("double")).alias("b"),
    )
    return A.landcover_fractions(p, "label", ["px"], ["a", "b"])


MONTHS = "SELECT zone_id, CAST(unnest(range(DATE '1995-01-01', DATE '2001-12-01' + 1, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM (SELECT s_suppkey AS zone_id FROM supplier)"


def composite(f):
    zones = f.table("supplier").selectExpr("s_suppkey as zone_id")
    return A.monthly_composite(f.pixels.withColumn("cell", F.col("x") % 5), zones, "zone_id", ["cell"], "date", "dn", F.lit("1995-01-01").cast("date"), F.lit("2001-12-01").cast("date"))


COMPOSITE = "SELECT zone_id, m AS month_start, avg(md) AS dn_median FROM (SELECT zone_id, x % 5 AS cell, CAST(date_trunc('month', date) AS DATE) AS m, median(dn) AS md FROM pixels GROUP BY 1, 2, 3) GROUP BY 1, 2"


@query("a09_monthly_composite", with_("pixels", f"SELECT zone_id, month_start, {r('dn_median')} AS dn_median FROM g LEFT JOIN c USING (zone_id, month_start)", g=MONTHS, c=COMPOSITE))
def _(f):
    return composite(f)


@query(
    "a10_lst_profile",
    with_("pixels", f"SELECT zone_id, {r('avg(dn_median)', 3)} AS lst_mean, {r('median(dn_median)', 3)} AS lst_median, {r('stddev_pop(dn_median)', 3)} AS lst_std, COUNT(*) AS valid_months FROM g JOIN c USING (zone_id, month_start) WHERE dn_median IS NOT NULL GROUP BY zone_id", g=MONTHS, c=COMPOSITE),
    digits=3,
)
def _(f):
    return A.lst_profile(composite(f), "zone_id", "dn_median")


def three(sql):
    return sql.replace(", 4) + 0.0)", ", 3) + 0.0)")


def stats(v, scopes, std):
    out = []
    for tag, c in scopes.items():
        out += [f"{r(f'avg({c})')} AS {v}{tag}_mean", f"{r(f'median({c})')} AS {v}{tag}_median", f"{r(std.format(c=c))} AS {v}{tag}_std", f"{r(f'MIN({c})')} AS {v}{tag}_min", f"{r(f'MAX({c})')} AS {v}{tag}_max", f"COUNT({c}) AS {v}{tag}_count"]
    return ", ".join(out)


PASSES = {"A": "ascending", "R": "descending"}


@query(
    "a11_sar_profile",
    with_("radar", "SELECT gp_id, COUNT(*) AS observation_count, MIN(date) AS first_date, MAX(date) AS last_date, COUNT(DISTINCT image_id) AS distinct_images, " + ", ".join(
        stats(v, {"": v} | {f"_{n}": f"CASE WHEN orbit = '{o}' THEN {v} END" for o, n in PASSES.items()}, "CASE WHEN COUNT({c}) = 1 THEN 0 ELSE stddev_samp({c}) END") for v in ("vv", "vh", "coverage")
    ) + " FROM radar GROUP BY gp_id"),
)
def _(f):
    return A.sar_profile(f.radar, ["gp_id"], ["vv", "vh", "coverage"], "date", "image_id", "orbit", PASSES)


@query(
    "a12_optical_profile",
    with_("pixels", "SELECT zone_id, COUNT(*) AS observation_count, COUNT(DISTINCT scene_id) AS distinct_images, MIN(date) AS first_date, MAX(date) AS last_date, " + ", ".join(
        f"{r(f'avg({v})')} AS {v}_mean, {r(f'stddev_samp({v})')} AS {v}_std, {r(f'MIN({v})')} AS {v}_min, {r(f'MAX({v})')} AS {v}_max, COUNT({v}) AS {v}_count" for v in ("b4", "b8")
    ) + " FROM pixels GROUP BY zone_id"),
)
def _(f):
    return A.optical_profile(f.pixels, ["zone_id"], ["b4", "b8"], "date", "scene_id")


@query(
    "a13_circular_mean",
    with_("hourly", f"SELECT block_id, {r('(degrees(atan2(s, c)) + 360) % 360', 3)} AS aspect_mean_deg, {r('sqrt(s * s + c * c)', 3)} AS aspect_resultant_length FROM (SELECT block_id, avg(sin(radians(wind_direction))) AS s, avg(cos(radians(wind_direction))) AS c FROM hourly GROUP BY 1)"),
    digits=3,
)
def _(f):
    h = f.hourly.select("block_id", F.sin(F.radians("wind_direction")).alias("s"), F.cos(F.radians("wind_direction")).alias("c"))
    return A.aspect_summary(h, ["block_id"], "s", "c")


@query(
    "a14_root_zone_soil",
    with_("gp", "SELECT gp_id, " + ", ".join(f"{r(f'(({a}) * 5 + ({b}) * 10 + ({c}) * 15) / 30e0')} AS soil_{n}_rootzone_0_30cm" for n, a, b, c in (("clay", "soil__clay", "soil__sand", "terrain__slope_mean"), ("sand", "soil__clay + 1", "soil__clay + 2", "terrain__elevation_mean"))) + " FROM gp"),
)
def _(f):
    s = f.gp.select(
        "gp_id", F.col("soil__clay").alias("soil_clay_0-5cm"), F.col("soil__sand").alias("soil_clay_5-15cm"), F.col("terrain__slope_mean").alias("soil_clay_15-30cm"),
        (F.col("soil__clay") + 1).alias("soil_sand_0-5cm"), (F.col("soil__clay") + 2).alias("soil_sand_5-15cm"), F.col("terrain__elevation_mean").alias("soil_sand_15-30cm"),
    )
    return A.root_zone(s, ["gp_id"], ["clay", "sand"])


PROFILED = {"gp_id": "bigint", "block_id": "int", "gp_name": "string", "terrain__elevation_mean": "double", "soil__clay": "double", "soil__sand": "double", "landcover__built": "double", "landcover__void": "double"}


@query(
    "a15_column_profile",
    with_("gp", " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, CAST(0 AS BIGINT) AS infinite_count, COUNT({c}) = 0 AS all_null, COUNT(DISTINCT {c}) = 1 AS constant_non_null,"
        + (f" CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value" if t != "string" else " CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)") + " FROM gp" for c, t in PROFILED.items()
    )),
)
def _(f):
    return A.profile(f.gp.select(*PROFILED))


@query("a15_duplicate_rows", "SELECT COUNT(*) AS row_count, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_suppkey, l_quantity, l_returnflag FROM lineitem)) AS duplicate_rows FROM lineitem")
def _(f):
    return A.duplicate_rows(f.table("lineitem").select("l_suppkey", "l_quantity", "l_returnflag"))


@query(
    "a16_numeric_quality",
    with_("gp", "SELECT * FROM q UNION ALL SELECT '__total__', CAST(SUM(null_count) AS BIGINT), CAST(SUM(infinite_count) AS BIGINT) FROM q",
          q=" UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, CAST(0 AS BIGINT) AS infinite_count FROM gp" for c, t in PROFILED.items() if t != "string")),
)
def _(f):
    return A.numeric_quality(f.gp.select(*PROFILED))


LOW, HIGH = "1995-06-01", "2001-06-30"


@query(
    "a17_date_quality",
    with_("daily radar", f"""SELECT gp_id, COUNT(*) AS row_count, MIN(date) AS first_date, MAX(date) AS last_date, CAST(MAX(date) - MIN(date) + 1 - COUNT(DISTINCT date) AS BIGINT) AS missing_dates,
      COUNT(*) - COUNT(DISTINCT date) AS duplicate_dates, COUNT(*) FILTER (date < DATE '{LOW}' OR date > DATE '{HIGH}') AS out_of_range_dates, {r('100e0 * COUNT(vv) / COUNT(*)')} AS vv_completeness_pct, {r('100e0 * COUNT(vh) / COUNT(*)')} AS vh_completeness_pct FROM radar GROUP BY gp_id"""),
)
def _(f):
    return A.date_quality(f.radar, ["gp_id"], "date", ["vv", "vh"], F.lit(LOW).cast("date"), F.lit(HIGH).cast("date"))


@query(
    "a17_missing_dates",
    with_("daily", "SELECT block_id, d AS date FROM (SELECT block_id, CAST(unnest(range(MIN(date), MAX(date) + 1, INTERVAL 1 DAY)) AS DATE) AS d FROM daily GROUP BY block_id) WHERE (block_id, d) NOT IN (SELECT (block_id, date) FROM daily)"),
)
def _(f):
    return A.missing_dates(f.daily, ["block_id"], "date")


@query(
    "a18_observation_qc",
    with_("radar", """SELECT batch, n_rows, out_of_range, missing_core, duplicate_keys, missing_entities, unexpected_entities,
      CASE WHEN n_rows = 0 THEN 'PASS_EMPTY' WHEN out_of_range + missing_core + duplicate_keys + unexpected_entities > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM
      (SELECT batch, CAST(coalesce(SUM(n), 0) AS BIGINT) AS n_rows, CAST(coalesce(SUM(o), 0) AS BIGINT) AS out_of_range, CAST(coalesce(SUM(m), 0) AS BIGINT) AS missing_core, CAST(coalesce(SUM(d), 0) AS BIGINT) AS duplicate_keys, COUNT(*) FILTER (n IS NULL) AS missing_entities, COUNT(*) FILTER (w IS NULL) AS unexpected_entities
       FROM e FULL JOIN g USING (batch, gp_id) GROUP BY batch)""",
          e="SELECT s_suppkey AS gp_id, CAST(b AS INTEGER) AS batch, 1 AS w FROM supplier, (SELECT unnest(range(1994, 2003)) AS b)",
          k="SELECT CAST(year(date) AS INTEGER) AS batch, gp_id, image_id, COUNT(*) AS n, COUNT(*) FILTER (vv NOT BETWEEN -45 AND 0 OR coverage NOT BETWEEN 0 AND 1) AS o, COUNT(*) FILTER (vv IS NULL OR vh IS NULL) AS m FROM radar GROUP BY 1, 2, 3",
          g="SELECT batch, gp_id, SUM(n) AS n, SUM(o) AS o, SUM(m) AS m, COUNT(*) FILTER (n > 1) AS d FROM k GROUP BY 1, 2"),
)
def _(f):
    obs = f.radar.withColumn("batch", F.year("date"))
    want = f.table("supplier").select(F.col("s_suppkey").alias("gp_id"), F.explode(F.sequence(F.lit(1994), F.lit(2002))).alias("batch"))
    return A.qc(obs, want, "gp_id", ["gp_id", "image_id"], "batch", {"vv": (-45.0, 0.0), "coverage": (0.0, 1.0)}, ["vv", "vh"])


@query(
    "a19_catalogue",
    with_("current_fc", "SELECT block_id, COUNT(DISTINCT gp_id) AS gp_count, array_to_string(list_sort(list(DISTINCT CAST(target_date AS VARCHAR))), ',') AS forecast_dates, true AS available FROM current_fc GROUP BY block_id"),
)
def _(f):
    c = A.catalogue(f.current, ["block_id"], "gp_id", "target_date")
    return c.withColumn("forecast_dates", F.array_join(F.transform("forecast_dates", lambda d: d.cast("string")), ","))


@query(
    "a20_identity_master",
    with_("squares", """SELECT gid, n AS source_feature_count, u AS source_unique_geometry_count, gp_name, valid AS source_geometry_valid, CAST(area AS DOUBLE) AS source_area, CAST(inside AS DOUBLE) AS analysis_area,
      """ + r("100e0 * inside / area") + """ AS analysis_coverage_pct_of_source, status AS geometry_status,
      CASE status WHEN 'EXACT_DUPLICATE' THEN 'DEDUPE_IDENTICAL_GEOMETRY' WHEN 'VALID_SINGLE' THEN 'DISSOLVE_BY_GP_ID' WHEN 'VALID_MULTIPART' THEN 'DISSOLVE_BY_GP_ID' WHEN 'CROSS_BLOCK_SOURCE' THEN 'RETAIN_SOURCE_AND_CLIP_FOR_ANALYSIS'
        WHEN 'PARTIAL_BLOCK_INTERSECTION' THEN 'RETAIN_SOURCE_AND_CLIP_FOR_ANALYSIS' ELSE 'RETAIN_FLAGGED' END AS resolution
    FROM (SELECT *, CASE WHEN names > 1 THEN 'NAME_CONFLICT' WHEN NOT valid THEN 'GEOMETRY_INVALID' WHEN n = 1 THEN 'VALID_SINGLE' WHEN u = 1 THEN 'EXACT_DUPLICATE' WHEN crossing THEN 'CROSS_BLOCK_SOURCE'
      WHEN 100e0 * inside / area < 99.999999 THEN 'PARTIAL_BLOCK_INTERSECTION' ELSE 'VALID_MULTIPART' END AS status FROM
      (SELECT gid, CAST(SUM(n) AS BIGINT) AS n, COUNT(*) AS u, MIN(name_lo) AS gp_name, CASE WHEN MIN(name_lo) <> MAX(name_hi) THEN 2 ELSE 1 END AS names, bool_and(valid) AS valid, bool_or(crossing) AS crossing, SUM(area) AS area, SUM(inside) AS inside FROM
        (SELECT gid, k, COUNT(*) AS n, MIN(name) AS name_lo, MAX(name) AS name_hi, bool_and(valid) AS valid, bool_or(crossing) AS crossing, MAX(area) AS area, MAX(inside) AS inside FROM p GROUP BY gid, k) GROUP BY gid))""",
          p="""SELECT gp_id % 997 % 500 AS gid, k, 'N' || (CASE WHEN gp_id % 23 = 0 THEN gp_id ELSE gp_id % 997 % 500 END) AS name, gp_id % 37 <> 0 AS valid, side * side AS area,
        CASE WHEN gp_id % 3 = 0 THEN side * side ELSE 1 END AS inside, gp_id % 41 = 0 AS crossing FROM squares"""),
)
def _(f):
    p = f.squares.selectExpr(
        "gp_id % 997 % 500 as gid", "cast(k as string) as signature", "concat('N', case when gp_id % 23 = 0 then gp_id else gp_id % 997 % 500 end) as name", "gp_id % 37 <> 0 as valid",
        "cast(side * side as double) as area", "cast(if(gp_id % 3 = 0, side * side, 1) as double) as inside_area", "gp_id % 41 = 0 as cross_block",
    )
    return A.identity_master(p, "gid")


# --- scores ---------------------------------------------------------------------------------------

DIST = f"""COUNT(actual) AS n, {r('avg(actual)')} AS mean, {r('stddev_samp(actual)')} AS std, {r('MIN(actual)')} AS min, {r('MAX(actual)')} AS max, {r('avg(CASE WHEN actual > 0 THEN 1 WHEN actual IS NOT NULL THEN 0 END) * 100')} AS wet_pct,
      {r('median(actual)')} AS median, {r('quantile_cont(actual, 0.9)')} AS p90, {r('quantile_cont(actual, 0.95)')} AS p95, {r('quantile_cont(actual, 0.99)')} AS p99"""


@query("a21_distribution", with_("predictions", f"SELECT split, horizon, {DIST} FROM predictions GROUP BY 1, 2"))
def _(f):
    return metrics.distribution(f.predictions, ["split", "horizon"], "actual")


def ratio_sql(field):
    def part(s):
        return f"MAX(CASE WHEN split = '{s}' THEN {field} END)"

    return f"CASE WHEN {part('train')} <> 0 THEN {r(part('test') + ' / ' + part('train'))} END AS {field}_ratio"


SHIFT = ("mean", "std", "p95", "p99", "max", "wet_pct")


@query(
    "a22_distribution_shift",
    with_("predictions", "SELECT horizon, " + ", ".join(ratio_sql(x) for x in SHIFT) + " FROM s GROUP BY horizon",
          s="SELECT split, horizon, avg(actual) AS mean, stddev_samp(actual) AS std, quantile_cont(actual, 0.95) AS p95, quantile_cont(actual, 0.99) AS p99, MAX(actual) AS max, avg(CASE WHEN actual > 0 THEN 1 WHEN actual IS NOT NULL THEN 0 END) * 100 AS wet_pct FROM predictions GROUP BY 1, 2"),
)
def _(f):
    return metrics.distribution_shift(metrics.distribution(f.predictions, ["split", "horizon"], "actual"), ["horizon"], "split", "train", "test", SHIFT)


@query(
    "a23_exceedance",
    with_("predictions", "SELECT split, horizon, COUNT(actual) AS n, " + ", ".join(f"COUNT(*) FILTER (actual > {t}) AS {n}" for t, n in ((0, "over_0"), (2.5, "over_2_5"), (10, "over_10"), (25, "over_25"), (50, "over_50"))) + f", {r('MAX(actual)')} AS max_value FROM predictions GROUP BY 1, 2"),
)
def _(f):
    return metrics.exceedance(f.predictions, ["split", "horizon"], "actual")


def err(t, p, tag):
    return f"{r(f'sqrt(avg(({p} - {t}) ** 2))')} AS {tag}_rmse, {r(f'avg(abs({p} - {t}))')} AS {tag}_mae, {r(f'avg({p} - {t})')} AS {tag}_bias"


FULL = "SELECT * FROM predictions WHERE actual IS NOT NULL AND raw IS NOT NULL AND corrected IS NOT NULL"
IMPROVE = "CASE WHEN sqrt(avg((raw - actual) ** 2)) <> 0 THEN " + r("(sqrt(avg((raw - actual) ** 2)) - sqrt(avg((corrected - actual) ** 2))) * 100 / sqrt(avg((raw - actual) ** 2))") + " END"
CATEGORY = "CASE WHEN actual <= 0 THEN 'dry' WHEN actual <= 2.5 THEN 'light' WHEN actual <= 10 THEN 'moderate' WHEN actual <= 25 THEN 'heavy' ELSE 'extreme' END"


@query(
    "a24_category_errors",
    with_("predictions", f"SELECT split, category, coalesce(n, 0) AS n, * EXCLUDE (split, category, n) FROM (SELECT DISTINCT split, unnest(['dry', 'light', 'moderate', 'heavy', 'extreme']) AS category FROM p) LEFT JOIN (SELECT split, {CATEGORY} AS category, COUNT(*) AS n, {r('avg(actual)')} AS actual_mean, {err('actual', 'raw', 'raw')}, {err('actual', 'corrected', 'corrected')}, {IMPROVE} AS rmse_improvement_pct FROM p GROUP BY 1, 2) USING (split, category)", p=FULL),
)
def _(f):
    return metrics.category_errors(f.predictions, ["split"], "actual", "raw", "corrected")


@query(
    "a25_extreme_share",
    with_("predictions", three(f"""SELECT *, {r('100e0 * extreme_event_count / n')} AS extreme_event_pct, CASE WHEN raw_t <> 0 THEN {r('100e0 * raw_e / raw_t')} END AS raw_extreme_error_contribution_pct, CASE WHEN cor_t <> 0 THEN {r('100e0 * cor_e / cor_t')} END AS corrected_extreme_error_contribution_pct,
      {r('raw_t')} AS raw_total_squared_error, {r('raw_e')} AS raw_extreme_squared_error, {r('cor_t')} AS corrected_total_squared_error, {r('cor_e')} AS corrected_extreme_squared_error
    FROM (SELECT split, horizon, COUNT(*) AS n, {r('MAX(p95)')} AS p95_threshold, COUNT(*) FILTER (actual >= p95) AS extreme_event_count, SUM((raw - actual) ** 2) AS raw_t, SUM((raw - actual) ** 2) FILTER (actual >= p95) AS raw_e,
      SUM((corrected - actual) ** 2) AS cor_t, SUM((corrected - actual) ** 2) FILTER (actual >= p95) AS cor_e FROM (SELECT *, quantile_cont(actual, 0.95) OVER (PARTITION BY split, horizon) AS p95 FROM p) GROUP BY 1, 2)""").replace("SELECT *, (round((100e0", "SELECT * EXCLUDE (raw_t, raw_e, cor_t, cor_e), (round((100e0"), p=FULL),
    digits=3,
)
def _(f):
    return metrics.extreme_share(f.predictions, ["split", "horizon"], "actual", "raw", "corrected")


BOTH = "CASE WHEN actual IS NOT NULL AND {p} IS NOT NULL THEN {x} END"


@query(
    "a26_regression_metrics",
    with_("predictions", f"""SELECT split, horizon, COUNT(e) AS n, {r('sqrt(avg(e * e))')} AS rmse, {r('avg(abs(e))')} AS mae, {r('avg(e)')} AS bias, {r('1 - SUM(e * e) / (var_pop(y) * COUNT(y))')} AS r2,
      {r('avg(CASE WHEN abs(y) > 1e-8 THEN abs(e / y) END) * 100')} AS mape_nonzero, {r('avg(CASE WHEN y > 0 THEN abs(e) END)')} AS wet_mae, 'PASS' AS status
    FROM (SELECT split, horizon, actual AS y, raw - actual AS e FROM predictions WHERE actual IS NOT NULL AND raw IS NOT NULL) GROUP BY 1, 2"""),
)
def _(f):
    return metrics.regression_metrics(f.predictions, ["split", "horizon"], "actual", "raw")


EVAL = f"SELECT split, horizon, COUNT(*) AS n, {err('actual', 'raw', 'raw')}, {err('actual', 'corrected', 'corrected')}, {IMPROVE} AS rmse_improvement_pct FROM p GROUP BY 1, 2"
VERDICT = "CASE WHEN rmse_improvement_pct > 0 THEN 'IMPROVED' WHEN rmse_improvement_pct IS NOT NULL THEN 'WORSE' ELSE 'UNDEFINED' END"


def evaluation(f):
    return metrics.horizon_evaluation(f.predictions, ["split", "horizon"], "actual", "raw", "corrected")


@query("m11_horizon_evaluation", with_("predictions", f"SELECT *, {VERDICT} AS verdict FROM ({EVAL})", p=FULL))
def _(f):
    return evaluation(f)


@query(
    "a27_improvement",
    with_("predictions", f"SELECT block_id, {IMPROVE} AS improvement_pct, CASE WHEN {IMPROVE} > 0 THEN 'IMPROVED' WHEN {IMPROVE} IS NOT NULL THEN 'WORSE' ELSE 'UNDEFINED' END AS label FROM p GROUP BY block_id", p=FULL),
)
def _(f):
    e = metrics.horizon_evaluation(f.predictions, ["block_id"], "actual", "raw", "corrected")
    return e.select("block_id", F.col("rmse_improvement_pct").alias("improvement_pct"), metrics.improvement_label(F.col("rmse_improvement_pct")).alias("label"))


@query(
    "a28_occurrence_scores",
    with_("predictions", f"""SELECT *, {r('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END')} AS precision, {r('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END')} AS recall, {r('CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END')} AS f1,
      {r('(tp + tn) / (tp + fp + fn + tn)')} AS accuracy FROM (SELECT split, horizon, COUNT(*) FILTER (actual > 0 AND prob >= 0.5) AS tp, COUNT(*) FILTER (actual <= 0 AND prob >= 0.5) AS fp, COUNT(*) FILTER (actual > 0 AND prob < 0.5) AS fn, COUNT(*) FILTER (actual <= 0 AND prob < 0.5) AS tn
      FROM predictions WHERE actual IS NOT NULL AND prob IS NOT NULL GROUP BY 1, 2)"""),
)
def _(f):
    return metrics.occurrence_scores(f.predictions, ["split", "horizon"], "actual", "prob")


PCT = "SELECT horizon, MAX(CASE WHEN split = 'validation' THEN rmse_improvement_pct END) AS v, MAX(CASE WHEN split = 'test' THEN rmse_improvement_pct END) AS t FROM e GROUP BY horizon"
WHY = "concat_ws('; ', CASE WHEN abs(v) < 5 THEN 'validation improvement < 5%' END, CASE WHEN abs(t) < 5 THEN 'test improvement < 5%' END, CASE WHEN sign(v) <> sign(t) THEN 'validation/test improvement signs disagree' END)"


@query(
    "a29_select_method",
    with_("predictions", f"SELECT horizon, v AS validation_improvement_pct, t AS test_improvement_pct, CASE WHEN v > 0 THEN 'SPECIALIZED_CORRECTION' ELSE 'RAW_FORECAST' END AS selected_method, 'VALIDATION_ONLY' AS selection_basis, CASE WHEN {WHY} <> '' THEN 'BORDERLINE' ELSE 'CLEAR' END AS status, {WHY} AS reasons FROM ({PCT})",
          p=FULL, e=EVAL),
)
def _(f):
    return metrics.select_method(evaluation(f), ["horizon"])


UNITS = f"""SELECT horizon, {r('avg(raw)')} AS raw_mean, {r('avg(actual)')} AS actual_mean, {r('sqrt(avg((actual - raw) ** 2))')} AS rmse_original, {r('avg(abs(actual - raw))')} AS mae_original,
      {r('sqrt(avg((actual / 3.6::DOUBLE - raw) ** 2))')} AS rmse_converted, {r('avg(abs(actual / 3.6::DOUBLE - raw))')} AS mae_converted, {r('avg(actual) / avg(raw)')} AS ratio, abs(avg(actual) / avg(raw) - 3.6) < 0.25 AS possible_unit_mismatch FROM u GROUP BY horizon"""
WINDS = "SELECT f.lead AS horizon, CASE WHEN lead <= 4 THEN wind * 3.6::DOUBLE ELSE wind END AS actual, wind_f AS raw FROM forecast f JOIN daily d ON f.block_id = d.block_id AND f.target_date = d.date"


def winds(f):
    j = f.forecast.join(f.daily.select("block_id", F.col("date").alias("target_date"), "wind"), ["block_id", "target_date"])
    return j.select(F.col("lead").alias("horizon"), F.when(F.col("lead") <= 4, F.col("wind") * 3.6).otherwise(F.col("wind")).alias("actual"), F.col("wind_f").alias("raw"))


@query("a30_unit_ratio", with_("forecast", UNITS, u=WINDS))
def _(f):
    return metrics.unit_ratio(winds(f), ["horizon"], "actual", "raw")


@query("a30_unit_decision", with_("forecast", f"SELECT COUNT(*) FILTER (possible_unit_mismatch) AS n_horizons, CASE WHEN COUNT(*) FILTER (possible_unit_mismatch) >= 3 THEN 'UNIT_RECONCILIATION_REQUIRED' ELSE 'RAW_FORECAST_PENDING_VERIFICATION' END AS decision FROM ({UNITS})", u=WINDS))
def _(f):
    return metrics.unit_decision(metrics.unit_ratio(winds(f), ["horizon"], "actual", "raw"))


@query(
    "a32_kernel_density",
    with_("current_fc", f"""SELECT gp_id, CAST(i AS INTEGER) AS i, {r('MAX(x)')} AS x, {r('SUM(exp(-0.5::DOUBLE * ((x - v) / h) ** 2)) / (COUNT(*) * MAX(h) * sqrt(2 * pi()))')} AS density
    FROM (SELECT gp_id, v, h, lo + span * i / 40 AS x, i FROM (SELECT c.gp_id, rainfall AS v, lo, span, greatest(0.8::DOUBLE, span / 5) AS h FROM current_fc c JOIN
      (SELECT gp_id, least(0e0, MIN(rainfall)) AS lo, greatest(1e0, MAX(rainfall) - least(0e0, MIN(rainfall))) AS span FROM current_fc WHERE rainfall IS NOT NULL GROUP BY gp_id) s ON c.gp_id = s.gp_id WHERE rainfall IS NOT NULL), (SELECT unnest(range(0, 41)) AS i)) GROUP BY gp_id, i"""),
)
def _(f):
    return A.kde(f.current, ["gp_id"], "rainfall")


@query(
    "a33_dictionary_summary",
    with_("gp", """SELECT facet, value, COUNT(*) AS n FROM (SELECT unnest(['feature_group', 'final_role', 'engineering_action', 'source_dataset']) AS facet, unnest([g, o, a, 'gp_merged_features']) AS value FROM
      (SELECT UNNEST(['identifier', 'identifier', 'other_categorical', 'static_spatial_environment', 'static_spatial_environment', 'static_spatial_environment', 'static_spatial_environment', 'static_spatial_environment', 'unavailable', 'spatial_location', 'spatial_location']) AS g,
       UNNEST(['metadata', 'metadata', 'metadata_or_candidate', 'gp_spatial_predictor', 'gp_spatial_predictor', 'gp_spatial_predictor', 'gp_spatial_predictor', 'gp_spatial_predictor', 'exclude', 'candidate_predictor', 'candidate_predictor']) AS o,
       UNNEST(['retain_for_joining_only', 'retain_for_joining_only', 'retain_for_scientific_review', 'retain_as_static_spatial_predictor', 'retain_as_static_spatial_predictor', 'retain_as_static_spatial_predictor', 'retain_as_static_spatial_predictor', 'retain_as_static_spatial_predictor', 'exclude_100pct_unavailable', 'retain_for_spatial_modeling', 'retain_for_spatial_modeling']) AS a)) GROUP BY 1, 2"""),
)
def _(f):
    return audits.dictionary_summary(audits.feature_dictionary(f.gp, "gp_merged_features", "gp"))


@query(
    "a34_window_pair",
    with_("radar", "SELECT gp_id, " + ", ".join(
        f"{r(f'avg(CASE WHEN {c} THEN {v} END)')} AS {v}_{n}_mean, COUNT(CASE WHEN {c} THEN {v} END) AS {v}_{n}_count" for v in ("vv", "vh")
        for n, c in (("current", "date >= DATE '2000-01-01' - 30 AND date < DATE '2000-01-01'"), ("previous", "date >= DATE '2000-01-01' - 60 AND date < DATE '2000-01-01' - 30"))
    ) + " FROM radar WHERE orbit = 'A' GROUP BY gp_id"),
)
def _(f):
    return A.window_pair(f.radar.filter("orbit = 'A'"), ["gp_id"], "date", ["vv", "vh"], F.lit("2000-01-01").cast("date"))


DECIDE = "SELECT 'precipitation' AS variable, horizon, n, rmse_improvement_pct, false AS unit_mismatch FROM (SELECT * FROM ev WHERE split = 'validation') UNION ALL SELECT 'wind', horizon, 1, CAST(NULL AS DOUBLE), possible_unit_mismatch FROM uu UNION ALL SELECT 'pressure', horizon, 0, NULL, false FROM uu"


@query(
    "m15_publish_decision",
    with_("predictions", """SELECT *, CASE WHEN n = 0 THEN 'UNAVAILABLE_PENDING_FORECAST_SOURCE' WHEN mismatched_horizons >= 3 THEN 'RAW_FORECAST_PENDING_UNIT_VERIFICATION' WHEN improved_horizons * 2 > horizons THEN 'SPECIALIZED_CORRECTION' ELSE 'RAW_FORECAST' END AS decision
    FROM (SELECT variable, CAST(SUM(n) AS BIGINT) AS n, COUNT(*) FILTER (rmse_improvement_pct > 0) AS improved_horizons, COUNT(*) AS horizons, COUNT(*) FILTER (unit_mismatch) AS mismatched_horizons FROM d GROUP BY variable)""",
          p=FULL, ev=EVAL, u=WINDS, uu=UNITS, d=DECIDE),
)
def _(f):
    rain = evaluation(f).filter("split = 'validation'").selectExpr("'precipitation' as variable", "horizon", "n", "rmse_improvement_pct", "false as unit_mismatch")
    u = metrics.unit_ratio(winds(f), ["horizon"], "actual", "raw")
    wind = u.selectExpr("'wind' as variable", "horizon", "1L as n", "cast(null as double) as rmse_improvement_pct", "possible_unit_mismatch as unit_mismatch")
    none = u.selectExpr("'pressure' as variable", "horizon", "0L as n", "cast(null as double) as rmse_improvement_pct", "false as unit_mismatch")
    return metrics.publish_decision(rain.unionByName(wind).unionByName(none))
