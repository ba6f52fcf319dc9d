"""History, look-back, score, order and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from finecast.functions.names import parse_history
from finecast.operators import joins, sets, windows
from finecast.operators.ordered import position
from finecast.plans.frames import with_
from finecast.plans.registry import query, r


def hist_sql(col: str, rain: bool, by: str = "block_id", order: str = "date") -> list[str]:
    """SELECT items of all history features of one column."""
    o = f"PARTITION BY {by} ORDER BY {order}"
    out = [f"lag({col}, {n}) OVER ({o}) AS hist__{col}__lag_{n}d" for n in (1, 3, 7)]
    for w in (3, 7, 14):
        f = f"OVER ({o} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        full = f"COUNT({col}) {f} = {w}"
        for op, fn in (("mean", "avg"), ("std", "stddev_samp")) + ((("sum", "sum"),) if rain else ()):
            out.append(f"{r(f'CASE WHEN {full} THEN {fn}({col}) {f} END')} AS hist__{col}__rolling_{op}_{w}d")
        if rain:
            wet = f"SUM(CASE WHEN {col} > 0 THEN 1 ELSE 0 END) {f}"
            out.append(
                f"CAST(CASE WHEN row_number() OVER ({o}) >= {w} THEN coalesce({wet}, 0) END AS BIGINT) AS hist__{col}__wet_days_{w}d"
            )
    return out


HIST_TEMP, HIST_RAIN = ", ".join(hist_sql("temp", False)), ", ".join(hist_sql("rain", True))
CAL = ", ".join(
    f"{r(f'{fn}({angle})')} AS time__{name}_{fn}"
    for name, angle in (("day_of_year", "2 * pi() * dayofyear({d}) / 365.25::DOUBLE"), ("month", "2 * pi() * month({d}) / 12::DOUBLE"))
    for fn in ("sin", "cos")
)


@query("w01_lags", with_("daily", "SELECT block_id, date, " + ", ".join(hist_sql("temp", False)[:3]) + " FROM daily"))
def _(f):
    h = windows.history_features(f.daily, ["block_id"], "date", ["temp"])
    return h.select("block_id", "date", *[c for c in h.columns if "__lag_" in c])


@query("w02_rolling_past_only", with_("daily", f"SELECT block_id, date, {HIST_TEMP} FROM daily"))
def _(f):
    h = windows.history_features(f.daily, ["block_id"], "date", ["temp"])
    return h.select("block_id", "date", *[c for c in h.columns if c.startswith("hist__")])


@query("w03_rain_sums_wet_days", with_("daily", f"SELECT block_id, date, {HIST_RAIN} FROM daily"))
def _(f):
    h = windows.history_features(f.daily, ["block_id"], "date", ["rain"], ["rain"])
    return h.select("block_id", "date", *[c for c in h.columns if c.startswith("hist__")])


@query(
    "w03_long_series_in_pieces",
    with_(
        "radar",
        "SELECT gp_id, l_orderkey, l_linenumber, l_partkey, date, " + ", ".join(
            hist_sql("vv", True, "gp_id", "date, l_orderkey, l_linenumber, l_partkey, coverage, orbit")
        ) + " FROM radar",
    ),
)
def _(f):
    """Series with many rows per day: positions by month, windows in pieces of 500 rows."""
    order = ["date", "l_orderkey", "l_linenumber", "l_partkey", "coverage", "orbit"]
    placed = position(f.radar, ["gp_id"], order, F.trunc("date", "MM"))
    h = windows.history_features_long(placed, ["gp_id"], "pos", ["vv"], ["vv"], piece_rows=500)
    return h.select("gp_id", "l_orderkey", "l_linenumber", "l_partkey", "date", *[c for c in h.columns if c.startswith("hist__")])


def flagship(f):
    """The forecast of every lead with past-only history and calendar features per area and target date."""
    h = windows.history_features(f.daily, ["block_id"], "date", ["temp", "rain"], ["rain"])
    hist = h.select("block_id", "date", *[c for c in h.columns if c.startswith("hist__")])
    fc = f.forecast.select("block_id", "target_date", "lead", "issue_date", "temp_f", "rain_f")
    out = joins.attach_history(fc, hist, ["block_id"], "target_date", "date")
    from finecast.functions.weather import calendar_cycle

    return out.select("*", *calendar_cycle(F.col("target_date")))


@query(
    "flagship_history_on_forecast",
    with_(
        "forecast",
        f"SELECT f.block_id, f.target_date, f.lead, f.issue_date, {r('temp_f')} AS temp_f, {r('rain_f')} AS rain_f, h.* EXCLUDE (block_id, date), "
        + CAL.format(d="f.target_date")
        + " FROM forecast f LEFT JOIN h ON f.block_id = h.block_id AND f.target_date = h.date",
        h=f"SELECT block_id, date, {HIST_TEMP}, {HIST_RAIN} FROM daily",
    ),
)
def _(f):
    return flagship(f)


# --- W-04 .. W-13 -----------------------------------------------------------------------------

NAMES = "actual_temperature_2m_mean actual_temperature_2m_max actual_rain_sum actual_precipitation_mean wind_speed_10m_max wind_speed_10m_mean surface_pressure_mean relative_humidity_2m_mean relative_humidity_2m_min dewpoint_2m_std".split()


@query(
    "w04_primary_variables",
    """WITH names AS (SELECT *, CASE WHEN contains(n, 'mean') THEN 50 ELSE 0 END + CASE WHEN contains(n, '2m') THEN 20 ELSE 0 END
      - CASE WHEN contains(n, 'std') THEN 20 ELSE 0 END - CASE WHEN contains(n, 'max') THEN 10 ELSE 0 END - CASE WHEN contains(n, 'min') THEN 10 ELSE 0 END AS s
      FROM (SELECT lower(p_name) || '_' || f || '_' || lower(p_type) AS n, MIN(p_partkey) AS position FROM part,
        (SELECT unnest(['rain', 'temp_mean', 'humidity_2m', 'wind_max', 'pressure', 'dewpoint_min']) AS f) GROUP BY ALL))
    SELECT arg_min(family, list_position(['rain', 'temperature', 'humidity', 'wind', 'pressure', 'dewpoint'], family)) AS family, column_name FROM (SELECT family, arg_min(n, (-s, position, n)) AS column_name FROM names JOIN
      (SELECT unnest(['rain', 'temperature', 'humidity', 'wind', 'pressure', 'dewpoint']) AS family,
              unnest(['rain|precip', 'temp', 'humidity', 'wind', 'pressure', 'dewpoint|dew_point']) AS pat)
      ON regexp_matches(n, pat) GROUP BY family) GROUP BY column_name""",
)
def _(f):
    """Best-named column per weather family over a table of column names."""
    fams = F.explode(F.array(*[F.lit(x) for x in ("rain", "temp_mean", "humidity_2m", "wind_max", "pressure", "dewpoint_min")]))
    names = f.table("part").select("p_partkey", "p_name", "p_type", fams.alias("f")).groupBy(
        F.concat_ws("_", F.lower("p_name"), "f", F.lower("p_type")).alias("column_name")
    ).agg(F.min("p_partkey").alias("position"))
    return windows.primary_report(names)


LOOK = ("vv", "vh")
END = "2000-01-01"


@query(
    "w05_lookback_own_anchor",
    with_(
        "radar",
        "SELECT gp_id, " + ", ".join(
            f"{r(f'avg(CASE WHEN date BETWEEN m - {d} AND m THEN {v} END)')} AS {v}_mean_{d}d, COUNT(CASE WHEN date BETWEEN m - {d} AND m THEN {v} END) AS {v}_count_{d}d"
            for v in LOOK for d in (7, 30, 90, 365)
        ) + " FROM (SELECT *, MAX(date) OVER (PARTITION BY gp_id) AS m FROM radar) GROUP BY gp_id",
    ),
)
def _(f):
    return windows.lookback(f.radar, ["gp_id"], "date", LOOK, (7, 30, 90, 365))


@query(
    "w05_lookback_global_end",
    with_(
        "radar",
        "SELECT gp_id, " + ", ".join(
            f"{r(f'avg(CASE WHEN {c} THEN {v} END)')} AS {v}_mean_{d}d, COUNT(CASE WHEN {c} THEN {v} END) AS {v}_count_{d}d"
            for v in LOOK for d in (7, 30, 60) for c in [f"date >= DATE '{END}' - {d} AND date < DATE '{END}'"]
        ) + " FROM radar GROUP BY gp_id",
    ),
)
def _(f):
    return windows.lookback(f.radar, ["gp_id"], "date", LOOK, (7, 30, 60), F.lit(END).cast("date"))


@query(
    "w06_change_30d",
    with_(
        "radar",
        "SELECT gp_id, " + ", ".join(
            r(f"avg(CASE WHEN date >= DATE '{END}' - 30 AND date < DATE '{END}' THEN {v} END) - avg(CASE WHEN date >= DATE '{END}' - 60 AND date < DATE '{END}' - 30 THEN {v} END)")
            + f" AS {v}_change_30d" for v in LOOK
        ) + " FROM radar GROUP BY gp_id",
    ),
)
def _(f):
    return windows.change(f.radar, ["gp_id"], "date", LOOK, F.lit(END).cast("date"))


@query(
    "w07_staleness",
    with_(
        "radar",
        "SELECT gp_id, MAX(CASE WHEN coalesce(vv, vh) IS NOT NULL THEN date END) AS latest_valid_date,"
        " CAST(DATE '2002-01-01' - MAX(CASE WHEN coalesce(vv, vh) IS NOT NULL THEN date END) AS INTEGER) AS days_since_valid FROM radar GROUP BY gp_id",
    ),
)
def _(f):
    return windows.staleness(f.radar, ["gp_id"], "date", LOOK, F.lit("2002-01-01").cast("date"))


SCORES = "SELECT c.gp_id, d.block_id, d.date, (c.gp_id % 23 - 11) * (1 + d.dn % 3) / 2e0 AS score FROM sites c JOIN daily d USING (block_id)"


def scored(f):
    return f.sites.join(f.daily, "block_id").selectExpr("gp_id", "block_id", "date", "(gp_id % 23 - 11) * (1 + dn % 3) / 2D as score")


@query(
    "w08_allocation_weights",
    with_(
        "sites daily",
        f"SELECT gp_id, block_id, date, {r('exp(greatest(-5e0, least(5e0, score))) / SUM(exp(greatest(-5e0, least(5e0, score)))) OVER (PARTITION BY block_id, date)', 6)} AS weight FROM scored",
        scored=SCORES,
    ),
    digits=6,
)
def _(f):
    return windows.allocation_weights(scored(f), ["block_id", "date"], "score").drop("score")


@query(
    "w08_weight_audit",
    with_(
        "sites daily",
        f"SELECT block_id, date, COUNT(*) AS n, {r('1e0')} AS weight_sum, true AS conserved, true AS all_positive FROM scored GROUP BY block_id, date",
        scored=SCORES,
    ),
)
def _(f):
    return windows.weight_report(windows.allocation_weights(scored(f), ["block_id", "date"], "score"), ["block_id", "date"])


STATIC = ("terrain__elevation_mean", "terrain__slope_mean", "soil__clay", "landcover__built", "landcover__void")


@query(
    "w09_block_median_anomaly",
    with_(
        "gp",
        "SELECT g.gp_id, g.block_id, " + ", ".join(
            f"CASE WHEN n_{c} >= 2 AND lo_{c} <> hi_{c} THEN {r(f'{c} - m_{c}')} END AS spatial__{c}__block_median_anomaly" for c in STATIC
        ) + " FROM gp g JOIN b USING (block_id)",
        b="SELECT block_id, " + ", ".join(f"median({c}) AS m_{c}, COUNT({c}) AS n_{c}, MIN({c}) AS lo_{c}, MAX({c}) AS hi_{c}" for c in STATIC) + " FROM gp GROUP BY block_id",
    ),
)
def _(f):
    return windows.block_anomaly(f.gp.select("gp_id", "block_id", *STATIC), ["block_id"], STATIC).drop(*STATIC)


EMB = [f"e{i}" for i in range(8)]


@query(
    "w10_spatial_score",
    with_(
        "",
        f"""SELECT vec_id, label, {r('d')} AS spatial_distance_from_mean,
      {r('(d - avg(d) OVER w) / CASE WHEN stddev_pop(d) OVER w > 1e-12 THEN stddev_pop(d) OVER w ELSE 1 END')} AS spatial_anomaly_score
    FROM dist WINDOW w AS (PARTITION BY label)""",
        x="SELECT vec_id, label, " + ", ".join(
            f"CASE WHEN vec_id % 6 <> {i % 6} THEN CAST(embedding[{i + 1}] AS DOUBLE) END AS e{i}" for i in range(8)
        ) + " FROM embeddings",
        fill="SELECT vec_id, label, " + ", ".join(f"coalesce({e}, median({e}) OVER (PARTITION BY label)) AS {e}" for e in EMB) + " FROM x",
        z="SELECT vec_id, label, " + ", ".join(
            f"({e} - avg({e}) OVER w) / CASE WHEN stddev_pop({e}) OVER w > 1e-12 THEN stddev_pop({e}) OVER w ELSE 1 END AS {e}" for e in EMB
        ) + " FROM fill WINDOW w AS (PARTITION BY label)",
        dist="SELECT vec_id, label, sqrt((" + " + ".join(f"{e} * {e}" for e in EMB) + ") / 8) AS d FROM z",
    ),
)
def _(f):
    """Eight vector elements stand for standardised spatial features; some are blanked and imputed."""
    x = f.table("embeddings").select(
        "vec_id", "label", *[F.when(F.col("vec_id") % 6 != i % 6, F.col("embedding")[i].cast("double")).alias(f"e{i}") for i in range(8)]
    )
    return windows.spatial_score(x, ["label"], EMB).drop(*EMB)


@query(
    "w11_horizon_position",
    with_("current_fc", "SELECT gp_id, target_date, CAST(row_number() OVER (PARTITION BY gp_id ORDER BY target_date) AS INTEGER) AS forecast_horizon_day FROM current_fc"),
)
def _(f):
    return windows.horizon_position(f.current.select("gp_id", "target_date"), ["gp_id"], "target_date")


@query(
    "w13_above_own_mean",
    with_("current_fc", f"SELECT gp_id, target_date, {r('own_mean')} AS own_mean, temperature > own_mean + 3 AS above FROM (SELECT *, avg(temperature) OVER (PARTITION BY gp_id) AS own_mean FROM current_fc)"),
)
def _(f):
    return windows.above_own_mean(f.current, ["gp_id"], "temperature", 3.0).select("gp_id", "target_date", "own_mean", "above")


# --- T, U, X-18 -------------------------------------------------------------------------------


@query("t01_output_order", with_("current_fc", f"SELECT target_date, gp_id, day, {r('temperature')} AS temperature FROM current_fc ORDER BY target_date, gp_id, day"))
def _(f):
    return windows.ordered(f.current.select("target_date", "gp_id", "day", "temperature"), ["target_date", "gp_id", "day"])


@query(
    "t03_peak_rain_day",
    with_("current_fc", f"SELECT gp_id, arg_min(target_date, (-rainfall, target_date)) AS peak_date, {r('MAX(rainfall)')} AS peak_value FROM current_fc WHERE rainfall IS NOT NULL GROUP BY gp_id"),
)
def _(f):
    return windows.peak_day(f.current, ["gp_id"], "rainfall", "target_date")


@query(
    "t04_latest_observation",
    with_("radar", f"SELECT gp_id, t.date, t.image_id, t.orbit FROM (SELECT gp_id, MAX((date, image_id, orbit)) AS m, unnest([arg_max({{'date': date, 'image_id': image_id, 'orbit': orbit}}, (date, image_id, orbit))]) AS t FROM radar GROUP BY gp_id)"),
)
def _(f):
    return windows.latest(f.radar, ["gp_id"], "date", ["image_id", "orbit"])


@query("t05_first_violations", with_("radar", "SELECT gp_id, image_id, COUNT(*) AS n_rows FROM radar GROUP BY gp_id, image_id HAVING COUNT(*) > 1 ORDER BY gp_id, image_id, n_rows LIMIT 10"))
def _(f):
    """The report lists ten examples by design."""
    from finecast.operators import guards

    return guards.examples(guards.duplicate_keys(f.radar, ["gp_id", "image_id"]))


@query(
    "u01_union_chunks",
    "SELECT c_custkey AS id, c_nationkey AS nation, c_acctbal AS balance, NULL AS name FROM customer UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, s_name FROM supplier",
)
def _(f):
    a = f.table("customer").selectExpr("c_custkey as id", "c_nationkey as nation", "c_acctbal as balance")
    b = f.table("supplier").selectExpr("s_name as name", "s_acctbal as balance", "s_nationkey as nation", "s_suppkey as id")
    return sets.union_chunks(a, b)


@query("u02_distinct_keys", with_("daily", "SELECT DISTINCT date FROM daily"))
def _(f):
    return sets.distinct_keys(f.daily, ["date"])


@query(
    "u03_key_difference",
    "SELECT id, CASE WHEN a AND b THEN 'BOTH' WHEN a THEN 'LEFT_ONLY' ELSE 'RIGHT_ONLY' END AS side FROM (SELECT id, bool_or(s = 1) AS a, bool_or(s = 2) AS b FROM"
    " (SELECT c_custkey AS id, 1 AS s FROM customer UNION ALL SELECT o_custkey * 2, 2 FROM orders) GROUP BY id)",
)
def _(f):
    return sets.key_difference(
        f.table("customer").selectExpr("c_custkey as id"), f.table("orders").selectExpr("o_custkey * 2 as id"), ["id"]
    )


@query(
    "u04_keep_last",
    with_("radar", "SELECT gp_id, orbit, arg_max(image_id, (date, image_id)) AS image_id, MAX(date) AS date FROM radar GROUP BY gp_id, orbit"),
)
def _(f):
    return sets.dedupe(f.radar.select("gp_id", "orbit", "date", "image_id"), ["gp_id", "orbit"], ["date"], keep="last")


@query(
    "u04_keep_first",
    with_("radar", "SELECT gp_id, orbit, arg_min(image_id, (date, image_id)) AS image_id, MIN(date) AS date FROM radar GROUP BY gp_id, orbit"),
)
def _(f):
    return sets.dedupe(f.radar.select("gp_id", "orbit", "date", "image_id"), ["gp_id", "orbit"], ["date"], keep="first")


@query(
    "x18_history_names",
    """WITH n AS (SELECT 'hist__' || replace(p_name, ' ', '_') || '__' || op || '_' || p_size || 'd' AS name FROM part,
      (SELECT unnest(['lag', 'rolling_mean', 'rolling_std', 'rolling_sum', 'wet_days', 'trend']) AS op))
    SELECT name, nullif(regexp_extract(name, p, 1), '') AS source, nullif(regexp_extract(name, p, 2), '') AS operation,
      CAST(nullif(regexp_extract(name, p, 3), '') AS INTEGER) AS days
    FROM n, (SELECT '^hist__(.+?)__(lag|rolling_mean|rolling_std|rolling_sum|wet_days)_(\\d+)d$' AS p)""".replace("\\\\", "\\"),
)
def _(f):
    ops = F.explode(F.array(*[F.lit(x) for x in ("lag", "rolling_mean", "rolling_std", "rolling_sum", "wet_days", "trend")])).alias("op")
    n = f.table("part").select("p_name", "p_size", ops).select(
        F.concat(F.lit("hist__"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("__"), "op", F.lit("_"), F.col("p_size").cast("string"), F.lit("d")).alias("name")
    )
    return n.select("name", *[c.alias(k) for k, c in parse_history(F.col("name")).items()])
