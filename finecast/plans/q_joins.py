"""Merge, as-of, run selection, spatial and neighbour queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from finecast.operators import joins, spatial
from finecast.plans.frames import with_
from finecast.plans.registry import query, r

AREA_DAY = ["block_id", "date"]


def actual(f):
    return f.daily.select("block_id", "date", "temp", "rain")


def reanalysis(f):
    return f.table("lineitem").groupBy((F.col("l_partkey") % 25).cast("int").alias("block_id"), F.to_date("l_shipdate").alias("date")).agg(
        F.min("l_quantity").alias("rh")
    )


def optical(f):
    return f.table("lineitem").groupBy((F.col("l_suppkey") % 25).cast("int").alias("block_id"), F.to_date("l_shipdate").alias("date")).agg(
        F.max("l_quantity").alias("ndvi")
    )


SOURCES = dict(
    actual="SELECT block_id, date, temp, rain FROM daily",
    era5="SELECT CAST(l_partkey % 25 AS INTEGER) AS block_id, CAST(l_shipdate AS DATE) AS date, MIN(l_quantity) AS rh FROM lineitem GROUP BY 1, 2",
    s2="SELECT CAST(l_suppkey % 25 AS INTEGER) AS block_id, CAST(l_shipdate AS DATE) AS date, MAX(l_quantity) AS ndvi FROM lineitem GROUP BY 1, 2",
)


@query(
    "j01_daily_master",
    with_("daily", f"SELECT block_id, date, {r('temp')} AS actual_temp, {r('rain')} AS actual_rain, {r('rh')} AS era5_rh, {r('ndvi')} AS s2_ndvi FROM actual FULL JOIN era5 USING (block_id, date) FULL JOIN s2 USING (block_id, date)", **SOURCES),
)
def _(f):
    return joins.daily_master({"actual": actual(f), "era5": reanalysis(f), "s2": optical(f)}, AREA_DAY)


@query(
    "j02_training_base",
    with_("forecast", f"""SELECT block_id, w.target_date AS date, lead, {r('temp_f')} AS temp_f, {r('temp')} AS actual_temp, {r('rain')} AS actual_rain, {r('rh')} AS era5_rh, {r('ndvi')} AS s2_ndvi,
      true AS actual_is_reference_only, false AS synthetic_data_present, false AS interpolation_present
    FROM (SELECT block_id, target_date, target_date AS date, lead, temp_f FROM forecast) w LEFT JOIN actual USING (block_id, date) LEFT JOIN era5 USING (block_id, date) LEFT JOIN s2 USING (block_id, date)""", **SOURCES),
)
def _(f):
    fc = f.forecast.select("block_id", F.col("target_date").alias("date"), "lead", "temp_f")
    return joins.training_base(fc, {"actual": actual(f), "era5": reanalysis(f), "s2": optical(f)}, AREA_DAY)


@query(
    "j03_merge_one_to_one",
    with_("gp", f"SELECT gp_id, gp_name, {r('terrain__elevation_mean')} AS terrain__elevation_mean, {r('terrain__slope_mean')} AS terrain__slope_mean, {r('soil__clay')} AS soil__clay FROM gp"),
)
def _(f):
    g = f.gp
    terrain = g.select("gp_id", F.col("terrain__elevation_mean").alias("elevation_mean"), F.col("terrain__slope_mean").alias("slope_mean"))
    soil = g.select("gp_id", F.col("soil__clay").alias("clay"))
    return joins.merge_one_to_one(g.select("gp_id", "gp_name"), {"terrain": terrain, "soil": soil}, "gp_id")


@query("j04_assemble_leads", with_("forecast_wide", "SELECT block_id, date, " + ", ".join(f"{r(f'{v}_d{d}')} AS {v}_d{d}" for v in ("temp_f", "rain_f") for d in range(1, 8)) + " FROM forecast_wide"))
def _(f):
    return f.forecast_wide


@query("a02_unpivot_leads", with_("forecast", f"SELECT block_id, target_date AS date, lead, {r('temp_f')} AS temp_f, {r('rain_f')} AS rain_f FROM forecast WHERE temp_f IS NOT NULL OR rain_f IS NOT NULL"))
def _(f):
    """Wide and back: the round trip equals the long rows."""
    return joins.unpivot_leads(f.forecast_wide, ["block_id", "date"], ["temp_f", "rain_f"])


@query(
    "j05_expand_entities",
    with_("daily gp", "SELECT gp_id, COUNT(*) AS n_days, MIN(date) AS first_date, MAX(date) AS last_date FROM gp JOIN daily USING (block_id) GROUP BY gp_id"),
)
def _(f):
    """The whole entity x date grid, summarised per entity."""
    grid = joins.expand(f.gp.select("gp_id", "block_id"), f.daily, ["block_id"], "date")
    return grid.groupBy("gp_id").agg(F.count(F.lit(1)).alias("n_days"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query(
    "j06_attach_forecast_and_target",
    with_("forecast_wide sites site_targets", f"""SELECT gp_id, block_id, date, {r('temp_f_d1')} AS temp_f_d1, {r('rain_f_d1')} AS rain_f_d1, {r('actual_temperature_2m_mean')} AS actual_temperature_2m_mean
    FROM sites JOIN forecast_wide USING (block_id) LEFT JOIN site_targets USING (gp_id, date)"""),
)
def _(f):
    w = f.forecast_wide.select("block_id", "date", "temp_f_d1", "rain_f_d1")
    grid = joins.expand(f.sites.select("gp_id", "block_id"), w, ["block_id"], "date")
    t = f.site_targets.select("gp_id", "date", "actual_temperature_2m_mean")
    return joins.attach(grid, w, t, ["block_id", "date"], ["gp_id", "date"])


@query(
    "j07_attach_genuine_target",
    with_("sites daily site_targets", f"SELECT gp_id, date, {r('wind')} AS wind, {r('actual_precipitation_sum')} AS actual_precipitation_sum FROM (SELECT gp_id, date, wind FROM sites JOIN daily USING (block_id)) JOIN t USING (gp_id, date)",
          t="SELECT gp_id, date, actual_precipitation_sum FROM site_targets WHERE actual_precipitation_sum IS NOT NULL"),
)
def _(f):
    s = f.sites.join(f.daily, "block_id").select("gp_id", "date", "wind")
    t = f.site_targets.select("gp_id", "date", "actual_precipitation_sum").dropna()
    return joins.attach_target(s, t, ["gp_id", "date"])


SQ = f"SELECT gp_id, zone, {r('COUNT(*)')} AS overlap_area, {r('100e0 * COUNT(*) / MAX(side * side)')} AS overlap_pct FROM (SELECT *, CAST((cx // 4) * 100 + cy // 3 AS BIGINT) AS zone FROM square_cells) GROUP BY gp_id, zone"


@query("j08_polygon_membership", with_("square_cells", SQ))
def _(f):
    """Squares against 4 x 3 zones that tile the board."""
    sq = f.squares
    zx, zy = F.floor(F.col("k") % 20 / 4), F.floor(F.floor(F.col("k") / 20) / 3)
    corners = (
        sq.select(zx.alias("zx"), zy.alias("zy"))
        .distinct()
        .select(F.explode(F.array(F.col("zx"), F.col("zx") + 1)).alias("zx"), "zy")
        .select("zx", F.explode(F.array(F.col("zy"), F.col("zy") + 1)).alias("zy"))
        .distinct()
    )
    from finecast.functions.geo import make_ring

    x, y = F.col("zx") * 4, F.col("zy") * 3
    zones = corners.select((F.col("zx") * 100 + F.col("zy")).alias("zone"), make_ring([(x, y), (x + 4, y), (x + 4, y + 3), (x, y + 3)]).alias("ring"))
    return spatial.membership(sq.select("gp_id", "ring"), zones, "gp_id", "zone")


POINTS = "SELECT c_custkey AS gp_id, (c_custkey * 37 % 9973) / 1e1 AS x, (c_custkey * 91 % 8999) / 1e1 AS y FROM customer"
NODES = "SELECT s_suppkey AS node, (s_suppkey * 53 % 1009) / 1e0 AS x, (s_suppkey * 29 % 907) / 1e0 AS y FROM supplier"


@query(
    "j09_nearest_node",
    with_("", f"SELECT gp_id, arg_min(node, (d, node)) AS node, {r('MIN(d)')} AS distance FROM (SELECT gp_id, node, sqrt((p.x - n.x) ** 2 + (p.y - n.y) ** 2) AS d FROM p, n) GROUP BY gp_id", p=POINTS, n=NODES),
)
def _(f):
    p = f.table("customer").selectExpr("c_custkey as gp_id", "(c_custkey * 37 % 9973) / 10D as x", "(c_custkey * 91 % 8999) / 10D as y")
    n = f.table("supplier").selectExpr("s_suppkey as node", "(s_suppkey * 53 % 1009) / 1D as x", "(s_suppkey * 29 % 907) / 1D as y")
    return spatial.nearest_cell(p, n, "gp_id", "node")


@query(
    "j10_neighbours",
    with_("squares", f"""SELECT gp_id, other, shared_edges, {r('d')} AS distance, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY gp_id ORDER BY shared_edges DESC, d, other) AS rank FROM
      (SELECT a.gp_id, b.gp_id AS other, COUNT(e.ea) AS shared_edges, any_value(sqrt((a.x0 + a.side / 2e0 - b.x0 - b.side / 2e0) ** 2 + (a.y0 + a.side / 2e0 - b.y0 - b.side / 2e0) ** 2)) AS d
       FROM squares a JOIN squares b ON a.block_id = b.block_id AND a.gp_id <> b.gp_id
       LEFT JOIN (SELECT e1.gp_id AS ea, e2.gp_id AS eb FROM edges e1 JOIN edges e2 USING (block_id, p, q)) e ON e.ea = a.gp_id AND e.eb = b.gp_id GROUP BY 1, 2)) WHERE rank <= 4""",
          edges="""SELECT gp_id, block_id, least(p, q) AS p, greatest(p, q) AS q FROM (SELECT gp_id, block_id, (x0, y0) AS p, (x0 + side, y0) AS q FROM squares UNION ALL SELECT gp_id, block_id, (x0 + side, y0), (x0 + side, y0 + side) FROM squares
        UNION ALL SELECT gp_id, block_id, (x0 + side, y0 + side), (x0, y0 + side) FROM squares UNION ALL SELECT gp_id, block_id, (x0, y0 + side), (x0, y0) FROM squares)"""),
)
def _(f):
    return spatial.neighbours(f.squares, "gp_id", ["block_id"]).drop("block_id")


RELATION = "CASE WHEN n = na AND n = nb THEN 'IDENTICAL' WHEN n = nb THEN 'A_CONTAINS_B' WHEN n = na THEN 'B_CONTAINS_A' ELSE 'OVERLAPPING' END"


OUTLINES = "SELECT gid, k, side, cx, cy, MIN(gp_id) AS f, COUNT(*) AS c FROM (SELECT *, k % 40 AS gid FROM square_cells) GROUP BY ALL"


@query(
    "j11_same_id_pairs",
    with_("square_cells", f"""SELECT gid, a, b, {RELATION} AS relation, {r('n')} AS overlap_area, {r('100e0 * n / least(na, nb)')} AS overlap_pct_of_smaller, n_pairs FROM
      (SELECT gid, p.f AS a, q.f AS b, COUNT(*) AS n, MAX(p.side * p.side) AS na, MAX(q.side * q.side) AS nb, MAX(p.c * q.c) AS n_pairs FROM u p JOIN u q USING (gid, cx, cy) WHERE p.f < q.f GROUP BY 1, 2, 3
       UNION ALL SELECT gid, f, f, COUNT(*), MAX(side * side), MAX(side * side), MAX(c * (c - 1) // 2) FROM u WHERE c > 1 GROUP BY 1, 2, 3)""", u=OUTLINES),
)
def _(f):
    """Outlines filed under one id; copies appear once with their number of pairs."""
    parts = f.squares.select((F.col("k") % 40).alias("gid"), "gp_id", "ring")
    return spatial.same_id_pairs(parts, ["gid"], "gp_id")


@query(
    "j11_same_id_summary",
    with_("square_cells", """SELECT gid, n_parts, coalesce(i, 0) AS identical, coalesce(ac, 0) AS a_contains_b, coalesce(bc, 0) AS b_contains_a, coalesce(o, 0) AS overlapping, n_parts * (n_parts - 1) // 2 - coalesce(met, 0) AS disjoint
      FROM (SELECT k % 40 AS gid, COUNT(DISTINCT gp_id) AS n_parts FROM square_cells GROUP BY 1) LEFT JOIN (SELECT gid, COUNT(*) AS met, COUNT(*) FILTER (rel = 'IDENTICAL') AS i, COUNT(*) FILTER (rel = 'A_CONTAINS_B') AS ac,
       COUNT(*) FILTER (rel = 'B_CONTAINS_A') AS bc, COUNT(*) FILTER (rel = 'OVERLAPPING') AS o FROM (SELECT gid, """ + RELATION + """ AS rel FROM
      (SELECT p.k % 40 AS gid, p.gp_id AS a, q.gp_id AS b, COUNT(*) AS n, MAX(p.side * p.side) AS na, MAX(q.side * q.side) AS nb
       FROM square_cells p JOIN square_cells q ON p.k % 40 = q.k % 40 AND p.cx = q.cx AND p.cy = q.cy AND p.gp_id < q.gp_id GROUP BY 1, 2, 3)) GROUP BY gid) USING (gid)"""),
)
def _(f):
    parts = f.squares.select((F.col("k") % 40).alias("gid"), "gp_id", "ring")
    return spatial.same_id_summary(parts, ["gid"], "gp_id")


@query(
    "j12_cross_overlaps",
    with_("square_cells", f"""SELECT a, b, {RELATION} AS relation, {r('n')} AS overlap_area, ca * cb AS n_pairs FROM
      (SELECT p.k, q.k, MIN(p.f) AS a, MIN(q.f) AS b, COUNT(*) AS n, MAX(p.side * p.side) AS na, MAX(q.side * q.side) AS nb, MAX(p.c) AS ca, MAX(q.c) AS cb FROM u p JOIN u q ON p.cx = q.cx AND p.cy = q.cy AND p.f < q.f GROUP BY 1, 2)
      UNION ALL SELECT f, f, 'IDENTICAL', {r('MAX(side * side)')}, MAX(c * (c - 1) // 2) FROM u WHERE c > 1 GROUP BY f""",
          u="SELECT k, side, cx, cy, MIN(gp_id) AS f, COUNT(*) AS c FROM square_cells GROUP BY ALL"),
)
def _(f):
    return spatial.cross_overlaps(f.squares, "gp_id")


@query(
    "j13_key_report",
    """SELECT check_name, n_bad, CASE WHEN n_bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
      SELECT 'blank' AS check_name, COUNT(*) FILTER (i IS NULL) AS n_bad FROM x UNION ALL SELECT 'duplicate', COUNT(*) FROM (SELECT i FROM x WHERE i IS NOT NULL GROUP BY i HAVING COUNT(*) > 1)
      UNION ALL SELECT 'missing', COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT i FROM x WHERE i IS NOT NULL) UNION ALL SELECT 'unexpected', COUNT(DISTINCT i) FROM x WHERE i NOT IN (SELECT c_custkey FROM customer))""".replace("FROM x", "FROM (SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey * 3 END AS i FROM orders) x"),
)
def _(f):
    x = f.table("orders").selectExpr("case when o_orderkey % 50 <> 0 then o_custkey * 3 end as gp_id")
    return joins.key_report(x, f.table("customer").selectExpr("c_custkey as gp_id"), "gp_id")


@query(
    "j14_history_by_issue_date",
    with_("forecast", f"SELECT f.block_id, target_date, issue_date, lead, {r('temp_f')} AS temp_f, {r('h.lag')} AS hist__temp__lag_1d FROM forecast f LEFT JOIN h ON f.block_id = h.block_id AND f.issue_date = h.date",
          h="SELECT block_id, date, lag(temp, 1) OVER (PARTITION BY block_id ORDER BY date) AS lag FROM daily"),
)
def _(f):
    """History joined at the issue date: nothing after the issue can enter."""
    from finecast.operators.windows import history_features

    h = history_features(f.daily, ["block_id"], "date", ["temp"]).select("block_id", "date", "hist__temp__lag_1d")
    fc = f.forecast.select("block_id", "target_date", "issue_date", "lead", "temp_f")
    return joins.attach_history(fc, h, ["block_id"], "issue_date", "date")


RUNS = """SELECT event_id, user_id % 3 AS area, ts + INTERVAL 0 DAY AS run_created, ts + to_days(CAST(1 + event_id % 3 AS INTEGER)) AS valid_time, value FROM events"""


@query(
    "j15_select_run",
    with_("", f"""SELECT t.area, t.valid_date, valid_date - 2 AS issue_date, event_id, run_created, valid_time, {r('value')} AS value
    FROM (SELECT DISTINCT user_id % 3 AS area, CAST(ts AS DATE) AS valid_date FROM events) t JOIN runs USING (area)
    WHERE run_created >= valid_date - 2 AND run_created < CAST(valid_date - 2 AS TIMESTAMP) + INTERVAL 6 HOUR AND valid_time >= valid_date AND valid_time < CAST(valid_date AS TIMESTAMP) + INTERVAL 24 HOUR""", runs=RUNS),
)
def _(f):
    e = f.table("events").withColumn("area", F.col("user_id") % 3)
    runs = e.select(
        "event_id", "area", F.col("ts").cast("timestamp").alias("run_created"),
        F.timestamp_add("DAY", (1 + F.col("event_id") % 3).cast("int"), F.col("ts").cast("timestamp")).alias("valid_time"), "value",
    )
    targets = e.select("area", F.to_date("ts").alias("valid_date")).distinct()
    return joins.select_run(targets, runs, 2, by=["area"])


@query(
    "j16_availability_tag",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN o_orderdate IS NULL OR l_linenumber = 7 THEN 'UNKNOWN' WHEN l_shipdate < o_orderdate THEN 'DATE_BEFORE_ISSUANCE' ELSE 'DATE_NOT_BEFORE_ISSUANCE' END AS availability FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey",
)
def _(f):
    j = f.table("lineitem").join(f.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    obs = F.when(F.col("l_linenumber") != 7, F.col("l_shipdate"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", joins.availability_tag(F.col("o_orderdate"), obs).alias("availability"))


def issues(f):
    return f.table("orders").selectExpr("o_orderkey", "o_custkey % 100 as gp_id", "cast(o_orderdate as timestamp) as issued")


ISSUES = "SELECT o_orderkey, o_custkey % 100 AS gp_id, o_orderdate AS issued FROM orders"
SCENE = "SELECT l_suppkey % 100 AS gp_id, l_shipdate AS seen, MAX(l_extendedprice) AS v FROM lineitem GROUP BY 1, 2"


def scenes(f):
    return f.table("lineitem").groupBy((F.col("l_suppkey") % 100).alias("gp_id"), F.col("l_shipdate").cast("timestamp").alias("seen")).agg(F.max("l_extendedprice").alias("v"))


for _name, _strict, _op in (("j17_asof_strict", True, ">"), ("j17_asof_inclusive", False, ">=")):

    @query(_name, with_("", f"SELECT o_orderkey, i.gp_id, i.issued, s.seen, {r('s.v')} AS v FROM i ASOF LEFT JOIN s ON i.gp_id = s.gp_id AND i.issued {_op} s.seen", i=ISSUES, s=SCENE))
    def _(f, strict=_strict):
        return joins.asof_join(issues(f), scenes(f), ["gp_id"], "issued", "seen", ["v"], strict=strict)


def tagged_forecast(f):
    """Two ``actual_`` columns: one taken from the target date, one from the issue date."""
    d = f.daily.select("block_id", "date", "wind")
    t = d.select("block_id", F.col("date").alias("target_date"), F.col("wind").alias("actual_wind"))
    i = d.select("block_id", F.col("date").alias("issue_date"), F.col("wind").alias("actual_wind_known"))
    fc = f.forecast.select("block_id", "target_date", "issue_date", "lead")
    return fc.join(t, ["block_id", "target_date"], "left").join(i, ["block_id", "issue_date"], "left").withColumn("actual_mixed", F.when(F.col("lead") > 3, F.col("actual_wind")).otherwise(F.col("actual_wind_known")))


RATES = """SELECT block_id, target_date, lead, t.wind AS actual_wind, i.wind AS actual_wind_known, CASE WHEN lead > 3 THEN t.wind ELSE i.wind END AS actual_mixed, t.wind AS tw, i.wind AS iw
      FROM forecast f LEFT JOIN (SELECT block_id, date AS target_date, wind FROM daily) t USING (block_id, target_date) LEFT JOIN (SELECT block_id AS ib, date AS id, wind FROM daily) i ON ib = block_id AND id = issue_date"""


def rate_sql(c):
    def rate(o):
        return f"avg(CASE WHEN {c} IS NOT NULL AND {o} IS NOT NULL THEN CASE WHEN abs({c} - {o}) <= 1e-8 + 1e-8 * abs({o}) THEN 1 ELSE 0 END END)"

    return f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NOT NULL AND tw IS NOT NULL) AS target_n, {r(rate('tw'))} AS target_rate, COUNT(*) FILTER ({c} IS NOT NULL AND iw IS NOT NULL) AS issue_n, {r(rate('iw'))} AS issue_rate FROM x"


ACTUALS = ("actual_wind", "actual_wind_known", "actual_mixed")


def rates(f):
    return joins.match_rates(tagged_forecast(f), f.daily, ["block_id"], {c: "wind" for c in ACTUALS}, "target_date", "issue_date", "date")


@query("j18_match_rates", with_("forecast", " UNION ALL ".join(rate_sql(c) for c in ACTUALS), x=RATES))
def _(f):
    return rates(f)


@query(
    "j19_scenario_difference",
    with_("current_fc", f"SELECT gp_id, target_date, {r('rainfall * 1.2::DOUBLE - rainfall')} AS rainfall_delta, CASE WHEN gp_id % 2 = 0 THEN {r('2e0')} + 0 * temperature END AS temperature_delta FROM current_fc"),
)
def _(f):
    base = f.current.select("gp_id", "target_date", "rainfall", "temperature")
    s = base.select("gp_id", "target_date", (F.col("rainfall") * 1.2).alias("rainfall"), F.when(F.col("gp_id") % 2 == 0, F.col("temperature") + 2).alias("temperature"))
    return joins.scenario_difference(base, s, ["gp_id", "target_date"], ["rainfall", "temperature"])


@query(
    "j21_registry_with_outputs",
    """SELECT n_name AS block, n_nationkey AS code, n AS gp_count, n_nationkey IS NOT NULL AS official, n IS NOT NULL AS available
    FROM nation FULL JOIN (SELECT CASE WHEN b = 'OLD_7' THEN 'NATION_7' ELSE b END AS block, n FROM
      (SELECT CASE WHEN s_nationkey = 7 THEN 'OLD_7' WHEN s_nationkey = 3 THEN 'ELSEWHERE' ELSE 'NATION_' || s_nationkey END AS b, COUNT(*) AS n FROM supplier GROUP BY 1)) ON n_name = block""".replace("n_name AS block, n_nat", "coalesce(n_name, block) AS block, n_nat"),
)
def _(f):
    reg = f.table("nation").selectExpr("n_name as block", "n_nationkey as code")
    out = f.table("supplier").groupBy(
        F.expr("case when s_nationkey = 7 then 'OLD_7' when s_nationkey = 3 then 'ELSEWHERE' else concat('NATION_', s_nationkey) end").alias("block")
    ).agg(F.count(F.lit(1)).alias("gp_count"))
    return joins.registry_with_outputs(reg, out, ["block"], "block", {"OLD_7": "NATION_7"})
