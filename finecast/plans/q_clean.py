"""Cleaning, column selection and scalar function queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from finecast.functions import columns as C
from finecast.functions import geo, names, spectral, weather
from finecast.operators import clean, spatial
from finecast.plans.frames import with_
from finecast.plans.q_windows import CAL
from finecast.plans.registry import query, r

TEXT_DATES = """CASE event_id % 5 WHEN 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 2 THEN 'not a date' WHEN 3 THEN NULL ELSE '2024-02-31' END"""


@query(
    "p01_date_key",
    f"SELECT event_id, target_date, CAST(ts AS DATE) AS date FROM (SELECT event_id, ts, {TEXT_DATES} AS target_date FROM events) WHERE event_id % 5 IN (0, 1)",
)
def _(f):
    e = f.table("events").select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.to_date("ts").cast("string"))
        .when(F.col("event_id") % 5 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_id") % 5 == 2, "not a date")
        .when(F.col("event_id") % 5 == 4, "2024-02-31").alias("target_date"),
    )
    return clean.with_date_key(e)


@query("p02_prefix_columns", with_("daily", f"SELECT block_id, date, {r('temp')} AS era5_temp, {r('rain')} AS era5_rain FROM daily"))
def _(f):
    d = f.daily.select("block_id", "date", "temp", F.col("rain").alias("era5_rain"))
    return clean.prefix_columns(d, "era5_", ["block_id", "date"])


@query(
    "p03_canonical_id",
    """WITH x AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN l_suppkey || '.0' WHEN 1 THEN '  ' || l_suppkey || ' ' WHEN 2 THEN '   ' ELSE CAST(l_suppkey AS VARCHAR) END AS raw FROM lineitem)
    SELECT l_orderkey, l_linenumber, nullif(regexp_replace(trim(raw), '^(\\d+)\\.0$', '\\1'), '') AS gp_id FROM x""",
)
def _(f):
    raw = F.expr("case l_linenumber % 4 when 0 then concat(l_suppkey, '.0') when 1 then concat('  ', l_suppkey, ' ') when 2 then '   ' else cast(l_suppkey as string) end")
    return f.table("lineitem").select("l_orderkey", "l_linenumber", C.canonical_id(raw).alias("gp_id"))


@query(
    "p04_parse_ratios",
    f"SELECT {r('avg(CASE WHEN event_id % 5 IN (0, 1) THEN 1 ELSE 0 END)')} AS issued_text, {r('avg(CASE WHEN ts IS NOT NULL THEN 1 ELSE 0 END)')} AS stamp_text FROM events",
)
def _(f):
    e = f.table("events").select(
        F.when(F.col("event_id") % 5 == 0, F.to_date("ts").cast("string")).when(F.col("event_id") % 5 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("none").alias("issued_text"),
        F.col("ts").cast("string").alias("stamp_text"),
    )
    return clean.parse_ratios(e, ["issued_text", "stamp_text"])


@query("p04_detect_date", "SELECT 'observed_datetime' AS detected, COUNT(*) AS n_rows FROM events")
def _(f):
    e = f.table("events").select("event_id", F.lit("soon").alias("release_date"), F.col("ts").cast("string").alias("observed_datetime"))
    name = clean.detect_date(e)
    return e.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("detected"), "n_rows")


DIRTY = "SELECT l_suppkey, trim(CASE WHEN l_linenumber % 2 = 0 THEN '  ' || l_returnflag ELSE l_returnflag || ' ' END) AS flag, CASE WHEN l_tax = 0 OR l_discount = 0 THEN NULL ELSE l_quantity END AS q FROM lineitem"


def dirty(f):
    return f.table("lineitem").select(
        "l_suppkey", F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("  "), "l_returnflag")).otherwise(F.concat("l_returnflag", F.lit(" "))).alias("flag"),
        F.when(F.col("l_tax") == 0, float("inf")).when(F.col("l_discount") == 0, float("nan")).otherwise(F.col("l_quantity")).alias("q"),
    )


@query("p05_clean", with_("", "SELECT DISTINCT * FROM x", x=DIRTY))
def _(f):
    return clean.clean(dirty(f))[0]


@query(
    "p05_clean_report",
    with_("", "SELECT COUNT(*) AS rows_in, (SELECT COUNT(*) FROM lineitem WHERE l_tax = 0) AS infinite_cells, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM x)) AS rows_out,"
          " COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM x)) AS duplicate_rows FROM x", x=DIRTY),
)
def _(f):
    return clean.clean(dirty(f))[1]


@query("p06_collapse_duplicates", f"SELECT c_custkey, {r('c_acctbal')} AS c_acctbal FROM customer")
def _(f):
    c = f.table("customer")
    twice = c.select("c_custkey", "c_acctbal", F.col("c_acctbal").alias("copy")).toDF("c_custkey", "c_acctbal", "c_acctbal")
    return clean.collapse_duplicates(twice)


@query("p07_drop_all_null", with_("gp", f"SELECT gp_id, {r('soil__clay')} AS soil__clay, {r('soil__sand')} AS soil__sand, 'landcover__void' AS removed FROM gp"))
def _(f):
    out, gone = clean.drop_all_null(f.gp.select("gp_id", "soil__clay", "soil__sand", "landcover__void"))
    return out.withColumn("removed", F.lit(",".join(gone)))


STATIC = ("terrain__elevation_mean", "terrain__slope_mean", "soil__clay", "soil__sand", "landcover__built", "landcover__void")


@query("p08_constant_columns", with_("gp", " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) <= 1 AS is_constant FROM gp" for c in STATIC)))
def _(f):
    return clean.constant_report(f.gp, STATIC)


@query("p08_drop_constant", with_("gp", f"SELECT gp_id, {r('soil__clay')} AS soil__clay FROM gp"))
def _(f):
    return clean.drop_constant(f.gp.select("gp_id", "soil__clay", "landcover__built"), ["soil__clay", "landcover__built"])[0]


@query(
    "p09_null_fractions",
    with_("gp", " UNION ALL ".join(f"SELECT '{c}' AS column_name, {r(f'avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)')} AS null_fraction FROM gp" for c in STATIC)),
)
def _(f):
    return clean.sparse_report(f.gp, STATIC)


@query("p09_drop_sparse", with_("gp", f"SELECT gp_id, {r('terrain__elevation_mean')} AS terrain__elevation_mean FROM gp"))
def _(f):
    return clean.drop_sparse(f.gp.select("gp_id", "terrain__elevation_mean", "soil__sand"), ["terrain__elevation_mean", "soil__sand"])[0]


@query(
    "p10_static_predictors",
    with_("gp", "SELECT gp_id, " + ", ".join(f"{r(c)} AS {c}" for c in ("terrain__elevation_mean", "terrain__slope_mean", "soil__clay", "landcover__built", "lat", "lon")) + " FROM gp"),
)
def _(f):
    return f.gp.select("gp_id", *clean.static_predictors(f.gp))


@query("p11_predictors", with_("forecast_wide", f"SELECT block_id, {r('temp_f_d3')} AS temp_f_d3, {r('rain_f_d3')} AS rain_f_d3 FROM forecast_wide"))
def _(f):
    w = f.forecast_wide.withColumn("actual_rain_d3", F.col("rain_f_d3"))
    return w.select("block_id", *clean.predictors(w.columns, 3, ["actual_precipitation_sum"]))


@query(
    "p12_tolerant_number",
    f"SELECT event_id, CASE event_id % 4 WHEN 0 THEN {r('value')} WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 12.5::DOUBLE END AS value FROM events",
)
def _(f):
    raw = F.when(F.col("event_id") % 4 == 0, F.col("value").cast("string")).when(F.col("event_id") % 4 == 1, "n/a").when(F.col("event_id") % 4 == 2, "Infinity").otherwise(" 12.5 ")
    return f.table("events").select("event_id", C.num(raw).alias("value"))


@query(
    "p13_null_outside",
    with_("daily", f"SELECT block_id, date, CASE WHEN temp BETWEEN 15 AND 35 THEN {r('temp')} END AS temp, CASE WHEN rh BETWEEN 40 AND 90 THEN {r('rh')} END AS rh FROM daily"),
)
def _(f):
    return clean.null_outside(f.daily.select("block_id", "date", "temp", "rh"), {"temp": (15, 35), "rh": (40, 90)})


@query(
    "p14_range_report",
    with_("daily", "SELECT check_name, n_bad, CASE WHEN n_bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT 'temp' AS check_name, COUNT(*) FILTER (temp NOT BETWEEN -60 AND 60) AS n_bad FROM daily"
          " UNION ALL SELECT 'rh', COUNT(*) FILTER (rh NOT BETWEEN 40 AND 90) FROM daily)"),
)
def _(f):
    return clean.range_violations(f.daily, {"temp": (-60, 60), "rh": (40, 90)})


@query(
    "p15_clamp",
    with_("daily", f"SELECT block_id, date, {r('least(60e0, greatest(-60e0, temp * 3 - 60))')} AS temperature, {r('least(1e2, greatest(0e0, rh * 2 - 50))')} AS humidity,"
          f" {r('greatest(0e0, rain - 5)')} AS precipitation, {r('greatest(0e0, wind - 1)')} AS wind FROM (SELECT * FROM daily)"
          ).replace("least(60e0, greatest(-60e0, temp * 3 - 60))", "CASE WHEN temp IS NOT NULL THEN least(60e0, greatest(-60e0, temp * 3 - 60)) END")
          .replace("(greatest(0e0, rain - 5))", "(CASE WHEN rain IS NOT NULL THEN greatest(0e0, rain - 5) END)"),
)
def _(f):
    d = f.daily.selectExpr("block_id", "date", "temp * 3 - 60 as temperature", "rh * 2 - 50 as humidity", "rain - 5 as precipitation", "wind - 1 as wind")
    return clean.clamp(d, clean.CLAMP_STAGE_TWO)


@query(
    "p16_complete_days",
    with_("hourly", f"SELECT block_id, event_id, {r('temperature')} AS temperature, CAST(time AS DATE) AS day FROM hourly JOIN (SELECT block_id, CAST(time AS DATE) AS d FROM hourly GROUP BY 1, 2 HAVING COUNT(DISTINCT hour(time)) = 24) USING (block_id) WHERE CAST(time AS DATE) = d"),
)
def _(f):
    return clean.complete_days(f.hourly.select("block_id", "event_id", "time", "temperature"), ["block_id"], "time").drop("time")


@query("p16_complete_months", with_("daily", "SELECT block_id, date FROM daily WHERE date < DATE '2001-06-01'"))
def _(f):
    return clean.complete_months(f.daily.select("block_id", "date"), "date", F.lit("2001-06-17").cast("date"))


@query("p17_required_values", with_("daily", f"SELECT block_id, date, {r('temp')} AS temp, {r('rain')} AS rain FROM daily WHERE temp IS NOT NULL AND rain IS NOT NULL"))
def _(f):
    return clean.require(f.daily.select("block_id", "date", "temp", "rain"), ["temp", "rain"])


@query("p18_common_columns", f"SELECT {r('a')} AS bal, n FROM (SELECT c_acctbal AS a, c_nationkey AS n FROM customer UNION ALL SELECT s_acctbal, s_nationkey FROM supplier)")
def _(f):
    c = f.table("customer").selectExpr("c_acctbal as bal", "c_name as name", "c_nationkey as n", "c_custkey as only_here")
    s = f.table("supplier").selectExpr("s_nationkey as n", "s_acctbal as bal", "s_name as name")
    a, b = clean.common_columns(c, s)
    return a.unionByName(b)


SCENES = ("SELECT l_orderkey, l_linenumber, l_quantity AS cloud_pct, CASE WHEN l_returnflag = 'A' THEN 'EW' ELSE 'IW' END AS mode, CASE WHEN l_linenumber = 2 THEN 40 ELSE 10 END AS resolution_m,"
          " l_linestatus = 'O' AS has_vh, CASE WHEN l_partkey % 2 = 0 THEN 'L2SP' ELSE 'L1TP' END AS processing_level FROM lineitem")


@query(
    "p19_scene_filter",
    with_("", "SELECT rule, COUNT(*) AS n, CAST(SUM(l_orderkey) AS BIGINT) AS checksum FROM (SELECT *, 'optical_local' AS rule FROM s WHERE cloud_pct < 20 UNION ALL SELECT *, 'optical_area' FROM s WHERE cloud_pct < 80"
          " UNION ALL SELECT *, 'radar' FROM s WHERE mode = 'IW' AND resolution_m = 10 AND has_vh UNION ALL SELECT *, 'thermal' FROM s WHERE processing_level = 'L2SP' AND cloud_pct <= 60) GROUP BY rule", s=SCENES),
)
def _(f):
    s = f.table("lineitem").selectExpr(
        "l_orderkey", "l_quantity as cloud_pct", "if(l_returnflag = 'A', 'EW', 'IW') as mode", "if(l_linenumber = 2, 40, 10) as resolution_m",
        "if(l_linestatus = 'O', array('VV', 'VH'), array('VV')) as polarisations", "if(l_partkey % 2 = 0, 'L2SP', 'L1TP') as processing_level",
    )
    kept = [clean.filter_scenes(s, n).select(F.lit(n).alias("rule"), "l_orderkey") for n in clean.SCENE_RULES]
    return reduce(lambda a, b: a.unionByName(b), kept).groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("checksum"))


@query("p20_canonical_lead", with_("forecast_wide", f"SELECT block_id, date, {r('temp_f_d1')} AS temp_f_d1, {r('temp_f_d2')} AS temp_f_d2, {r('temp_f_d1')} AS temp_f FROM forecast_wide"))
def _(f):
    return clean.canonical_lead(f.forecast_wide.select("block_id", "date", "temp_f_d1", "temp_f_d2"))


# --- X: scalar functions ----------------------------------------------------------------------------

SAT = "exp(17.625::DOUBLE * {t} / (243.04::DOUBLE + {t}))"


@query(
    "x01_relative_humidity",
    with_("daily", f"SELECT block_id, date, {r('CASE WHEN temp IS NOT NULL THEN least(1e2, greatest(0e0, 100 * ' + SAT.format(t='(temp - wind)') + ' / ' + SAT.format(t='temp') + ')) END')} AS rh FROM daily"),
)
def _(f):
    return f.daily.select("block_id", "date", weather.relative_humidity(F.col("temp"), F.col("temp") - F.col("wind")).alias("rh"))


@query("x02_vapour_pressure_deficit", with_("daily", f"SELECT block_id, date, {r('0.6108::DOUBLE * exp(17.27::DOUBLE * temp / (temp + 237.3::DOUBLE)) * (1 - rh / 100)')} AS vpd FROM daily"))
def _(f):
    return f.daily.select("block_id", "date", weather.vapour_pressure_deficit(F.col("temp"), F.col("rh")).alias("vpd"))


@query("x03_wind_speed", with_("daily", f"SELECT block_id, date, {r('sqrt((wind - 6) * (wind - 6) + (temp - 25) * (temp - 25))')} AS speed FROM daily"))
def _(f):
    return f.daily.select("block_id", "date", weather.wind_speed(F.col("wind") - 6, F.col("temp") - 25).alias("speed"))


@query(
    "x04_unit_conversions",
    with_("daily", f"SELECT block_id, date, {r('temp + 300 - 273.15::DOUBLE')} AS celsius, CASE WHEN rain IS NOT NULL THEN {r('greatest(0e0, (rain - 1) * 1000)')} END AS mm,"
          f" {r('rh * 500 * 0.00341802::DOUBLE + 149 - 273.15::DOUBLE')} AS lst, {r('rh / 10')} AS soil, {r('wind * 3.6::DOUBLE')} AS kmh, CASE block_id % 3 WHEN 0 THEN {r('wind')} WHEN 1 THEN {r('wind / 3.6::DOUBLE')} END AS declared FROM daily"),
)
def _(f):
    unit = F.when(F.col("block_id") % 3 == 0, "m/s").when(F.col("block_id") % 3 == 1, "KM/H")
    return f.daily.select(
        "block_id", "date", weather.kelvin_to_celsius(F.col("temp") + 300).alias("celsius"), weather.metres_to_mm(F.col("rain") - 1).alias("mm"),
        weather.lst_dn_to_celsius(F.col("rh") * 500).alias("lst"), weather.scaled(F.col("rh"), 10).alias("soil"),
        weather.ms_to_kmh(F.col("wind")).alias("kmh"), weather.convert_declared(F.col("wind"), unit).alias("declared"),
    )


def nd(a, b):
    return f"CASE WHEN {a} + {b} <> 0 THEN ({a} - {b}) / ({a} + {b}) END"


@query(
    "x05_spectral_indices",
    with_("pixels", f"SELECT zone_id, x, y, scene_id, date, {r(nd('b8', 'b4'))} AS ndvi, {r(nd('b8', 'b11'))} AS ndmi, {r(nd('b8', 'b12'))} AS nbr,"
          f" {r('CASE WHEN b8 + b4 + 0.5::DOUBLE <> 0 THEN (b8 - b4) * 1.5::DOUBLE / (b8 + b4 + 0.5::DOUBLE) END')} AS savi,"
          f" {r('CASE WHEN b8 + b4 * 6 - b2 * 7.5::DOUBLE + 1 <> 0 THEN (b8 - b4) * 2.5::DOUBLE / (b8 + b4 * 6 - b2 * 7.5::DOUBLE + 1) END')} AS evi FROM p",
          p="SELECT zone_id, x, y, scene_id, date, b11, b12, b2, round(b4) AS b4, round(b8) AS b8 FROM pixels"),
)
def _(f):
    p = f.pixels.withColumns({"b4": F.round("b4"), "b8": F.round("b8")})
    b2, b4, b8, b11, b12 = (F.col(c) for c in ("b2", "b4", "b8", "b11", "b12"))
    return p.select(
        "zone_id", "x", "y", "scene_id", "date", spectral.ndvi(b8, b4).alias("ndvi"), spectral.ndmi(b8, b11).alias("ndmi"), spectral.nbr(b8, b12).alias("nbr"),
        spectral.savi(b8, b4).alias("savi"), spectral.evi(b8, b4, b2).alias("evi"),
    )


@query(
    "x06_quality_masks",
    with_("pixels", "SELECT zone_id, COUNT(*) FILTER ((qa & 3072) = 0) AS clear_optical, COUNT(*) FILTER ((qa & 63) = 0) AS clear_thermal, COUNT(*) FILTER ((qa & 62) = 0) AS clear_thermal_area,"
          " COUNT(*) FILTER (scl NOT IN (3, 8, 9, 10, 11)) AS clear_class FROM pixels GROUP BY zone_id"),
)
def _(f):
    qa, scl = F.col("qa"), F.col("scl")
    return f.pixels.groupBy("zone_id").agg(
        F.count_if(spectral.clear_bits(qa)).alias("clear_optical"), F.count_if(spectral.clear_bits(qa, spectral.THERMAL_QA_BITS)).alias("clear_thermal"),
        F.count_if(spectral.clear_bits(qa, spectral.THERMAL_QA_BITS_AREA)).alias("clear_thermal_area"), F.count_if(spectral.clear_class(scl)).alias("clear_class"),
    )


@query(
    "x07_radar_pair",
    with_("radar", f"SELECT gp_id, COUNT(d) AS n_joint, {r('avg(d)')} AS diff_mean, {r('avg(CASE WHEN d IS NOT NULL THEN 1 ELSE 0 END)')} AS valid_fraction FROM (SELECT gp_id, vv - vh AS d FROM radar) GROUP BY gp_id"),
)
def _(f):
    vv, vh, diff, joint = spectral.radar_pair(F.col("vv"), F.col("vh"))
    return f.radar.select("gp_id", diff.alias("d"), joint.alias("j")).groupBy("gp_id").agg(
        F.count("d").alias("n_joint"), F.avg("d").alias("diff_mean"), F.avg(F.col("j").cast("int")).alias("valid_fraction")
    )


NEIGH = "CROSS JOIN (SELECT i, j FROM (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j))"


@query(
    "x08_terrain",
    with_("", f"""SELECT zone_id, x, y, {r('z')} AS z, {r('degrees(atan(sqrt(gx * gx + gy * gy)))')} AS slope_deg, {r('CASE WHEN gx = 0 AND gy = 0 THEN 0 ELSE sin(atan2(-gx, -gy)) END')} AS aspect_sin, {r('CASE WHEN gx = 0 AND gy = 0 THEN 1 ELSE cos(atan2(-gx, -gy)) END')} AS aspect_cos,
      {r('tri')} AS tri, {r('z - m')} AS tpi, CASE WHEN n5 = 5 THEN {r('lap')} END AS laplacian_curvature
    FROM (SELECT *, CASE WHEN n9 = 9 THEN e / 8 END AS gx, CASE WHEN n9 = 9 THEN n / 8 END AS gy FROM a) WHERE z IS NOT NULL""",
          g="SELECT l_suppkey % 20 AS zone_id, CAST(l_orderkey % 12 AS INTEGER) AS x, CAST(l_partkey % 12 AS INTEGER) AS y, CAST(MAX(l_quantity) AS DOUBLE) AS z FROM lineitem GROUP BY 1, 2, 3",
          s=f"SELECT zone_id, x - i AS x, y - j AS y, z, i, j FROM g {NEIGH}",
          a="""SELECT zone_id, x, y, MAX(z) FILTER (i = 0 AND j = 0) AS z, COUNT(*) AS n9, COUNT(*) FILTER (abs(i) + abs(j) <= 1) AS n5,
      SUM(i * (CASE WHEN j = 0 THEN 2 ELSE 1 END) * z) AS e, SUM(j * (CASE WHEN i = 0 THEN 2 ELSE 1 END) * z) AS n,
      SUM(CASE WHEN i = 0 AND j = 0 THEN -4 * z WHEN abs(i) + abs(j) = 1 THEN z END) AS lap, avg(z) FILTER (abs(i) + abs(j) <= 1) AS m, stddev_pop(z) FILTER (abs(i) + abs(j) <= 1) AS tri FROM s GROUP BY 1, 2, 3"""),
)
def _(f):
    g = f.table("lineitem").groupBy(
        (F.col("l_suppkey") % 20).alias("zone_id"), (F.col("l_orderkey") % 12).cast("int").alias("x"), (F.col("l_partkey") % 12).cast("int").alias("y")
    ).agg(F.max("l_quantity").alias("z"))
    return spatial.terrain(g, ["zone_id"])


@query("x09_cyclic_calendar", with_("daily", "SELECT block_id, date, " + CAL.format(d="date") + " FROM daily"))
def _(f):
    return f.daily.select("block_id", "date", *weather.calendar_cycle(F.col("date")))


@query(
    "x10_issue_and_lead",
    f"SELECT event_id, CAST(ts AS DATE) - CAST(1 + event_id % 7 AS INTEGER) AS issued, CAST(1 + event_id % 7 AS INTEGER) AS lead, {r('(epoch_us(date_trunc(chr(100) || chr(97) || chr(121), ts) + INTERVAL 3 DAY) - epoch_us(ts) - 19800000000) / 3600000000e0')} AS lead_hours FROM events".replace("chr(100) || chr(97) || chr(121)", "'day'"),
)
def _(f):
    d, n = F.to_date("ts"), (1 + F.col("event_id") % 7).cast("int")
    issued = weather.issue_date(d, n)
    target = F.timestamp_add("DAY", F.lit(3), F.date_trunc("day", F.col("ts").cast("timestamp")))
    return f.table("events").select(
        "event_id", issued.alias("issued"), weather.lead_days(d, issued).alias("lead"), weather.lead_hours(target, F.col("ts").cast("timestamp")).alias("lead_hours")
    )


CLS = [f"c{i}" for i in range(9)]
LABELS = ("water", "trees", "grass", "flooded_vegetation", "crops", "shrub", "built", "bare", "snow_ice")


@query(
    "x11_landcover_entropy",
    with_("", f"SELECT vec_id, {r('list_sum(list_transform(list_filter(q, lambda x: x > 0), lambda x: -x * ln(x)))')} AS entropy, ([" + ", ".join(f"'{x}'" for x in LABELS)
          + f"])[list_position(p, list_max(p))] AS dominant, {r('list_max(p)')} AS dominant_probability, {r('list_sum(p)')} AS probability_sum FROM (SELECT vec_id, p, list_transform(c, lambda x: x / list_sum(c)) AS q FROM"
          " (SELECT vec_id, p, list_transform(p, lambda x: least(1e0, greatest(0e0, x))) AS c FROM e))",
          e="SELECT vec_id, list_transform(embedding[1:9], lambda x: abs(CAST(x AS DOUBLE)) * 3) AS p FROM embeddings"),
)
def _(f):
    p = f.table("embeddings").select("vec_id", *[(F.abs(F.col("embedding")[i].cast("double")) * 3).alias(c) for i, c in enumerate(CLS)])
    cols = [F.col(c) for c in CLS]
    name, best = C.dominant(cols, LABELS)
    return p.select("vec_id", C.entropy(cols).alias("entropy"), name.alias("dominant"), best.alias("dominant_probability"), reduce(lambda a, b: a + b, cols).alias("probability_sum"))


GEO = "(SELECT gp_id, lat AS la, lon AS lo, lat + (gp_id % 9 - 4) / 1e1 AS lb, lon + (gp_id % 5 - 2) / 1e1 AS lq FROM gp)"
HAV = "sin(radians(lb - la) / 2) ** 2 + cos(radians(la)) * cos(radians(lb)) * sin(radians(lq - lo) / 2) ** 2"
BEAR = "degrees(atan2(sin(radians(lq - lo)) * cos(radians(lb)), cos(radians(la)) * sin(radians(lb)) - sin(radians(la)) * cos(radians(lb)) * cos(radians(lq - lo))))"


@query(
    "x12_distance_and_bearing",
    with_("gp", f"SELECT gp_id, {r(f'12742e0 * atan2(sqrt({HAV}), sqrt(1 - ({HAV})))')} AS km, (['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'])[CAST(floor((({BEAR} + 360) % 360) / 45 + 0.5::DOUBLE) AS INTEGER) % 8 + 1] AS direction FROM {GEO}"),
)
def _(f):
    a = [F.col("lat"), F.col("lon"), F.col("lat") + (F.col("gp_id") % 9 - 4) / 10.0, F.col("lon") + (F.col("gp_id") % 5 - 2) / 10.0]
    return f.gp.select("gp_id", geo.haversine_km(*a).alias("km"), geo.compass_point(geo.bearing_degrees(*a)).alias("direction"))


@query("x13_utm_zone", with_("gp", "SELECT gp_id, CAST(floor((lon + 180) / 6) + 1 AS INTEGER) AS zone, CAST((CASE WHEN lat - 20 >= 0 THEN 32600 ELSE 32700 END) + floor((lon + 180) / 6) + 1 AS INTEGER) AS epsg FROM gp"))
def _(f):
    return f.gp.select("gp_id", geo.utm_zone(F.col("lon")).alias("zone"), geo.utm_epsg(F.col("lat") - 20, F.col("lon")).alias("epsg"))


@query(
    "x14_polygon_measures",
    with_("squares", f"SELECT gp_id, {r('side * side')} AS area, {r('x0 + side / 2e0')} AS cx, {r('y0 + side / 2e0')} AS cy, {r('x0')} AS min_x, {r('y0')} AS min_y, {r('x0 + side')} AS max_x, {r('y0 + side')} AS max_y, CAST(4 AS INTEGER) AS n_edges FROM squares"),
)
def _(f):
    ring = F.col("ring")
    (cx, cy), b = geo.centroid(ring), geo.bounds(ring)
    return f.squares.select(
        "gp_id", geo.ring_area(ring).alias("area"), cx.alias("cx"), cy.alias("cy"), *[c.alias(n) for c, n in zip(b, ("min_x", "min_y", "max_x", "max_y"))],
        F.size(geo.edge_keys(ring)).alias("n_edges"),
    )


@query("x15_geometry_signature", with_("squares", "SELECT k, COUNT(*) AS n, CAST(1 AS BIGINT) AS signatures FROM squares GROUP BY k"))
def _(f):
    """Copies drawn from another start vertex and the other way round share one signature."""
    ring = F.col("ring")
    turned = F.concat(F.slice(ring, 3, 3), F.slice(ring, 2, 2))
    drawn = F.when(F.col("gp_id") % 2 == 0, ring).otherwise(F.reverse(turned))
    s = f.squares.select("k", geo.signature(drawn).alias("s"))
    return s.groupBy("k", "s").agg(F.count(F.lit(1)).alias("n1")).groupBy("k").agg(F.sum("n1").alias("n"), F.count(F.lit(1)).alias("signatures"))


@query("x16_log_and_clip", with_("daily", f"SELECT block_id, date, {r('ln(1 + rain)')} AS l, {r('rain')} AS back FROM daily"))
def _(f):
    return f.daily.select("block_id", "date", C.log1p(F.col("rain")).alias("l"), C.expm1(C.log1p(F.col("rain"))).alias("back"))


@query(
    "x17_name_keys",
    "SELECT c_custkey, regexp_replace(lower(trim(x)), '[^a-z0-9]+', '', 'g') AS match_key, regexp_replace(upper(trim(x)), '[_-]', ' ', 'g') AS admin_name, regexp_replace(lower(trim(x)), '[ -]', '_', 'g') AS snake_name"
    " FROM (SELECT c_custkey, ' ' || c_name || ' - ' || c_mktsegment || '_x' AS x FROM customer)",
)
def _(f):
    x = F.concat(F.lit(" "), "c_name", F.lit(" - "), "c_mktsegment", F.lit("_x"))
    return f.table("customer").select("c_custkey", names.match_key(x).alias("match_key"), names.admin_name(x).alias("admin_name"), names.snake_name(x).alias("snake_name"))


@query("x19_safe_ratio", f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax <> 0 THEN {r('l_discount / l_tax')} END AS ratio FROM lineitem")
def _(f):
    return f.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", C.safe_ratio(F.col("l_discount"), F.col("l_tax")).alias("ratio"))
