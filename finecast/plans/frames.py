"""Domain frames derived from the given tables, once for Spark and once as SQL.

All derived numbers are integers over a power of ten, so both engines hold
the same doubles before any aggregate.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finecast.functions.geo import make_ring
from finecast.operators.training import date_split

DAY_ZERO = "1995-01-01"

# Areas and outlines follow keys that grow with the tables; area 0 and outline 0 hold a third of all rows.
CUSTOMER_AREA = "cast(case when c_custkey % 3 = 0 then 0 else c_custkey div 60 end as int)"
SUPPLIER_AREA = "cast(case when s_suppkey % 3 = 0 then 0 else s_suppkey div 4 end as int)"
OUTLINE = "case when c_custkey % 3 = 0 then 0 else c_custkey div 2 end"
CUSTOMER_AREA_SQL, SUPPLIER_AREA_SQL, OUTLINE_SQL = (e.replace("div", "//") for e in (CUSTOMER_AREA, SUPPLIER_AREA, OUTLINE))


class Frames:
    """Lazy domain frames over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def daily(self) -> DataFrame:
        """(block_id, date): one row per area and day that has data; gaps are natural."""
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        c = self.table("customer").select("c_custkey", F.expr(CUSTOMER_AREA).alias("block_id"))
        g = (
            o.join(c, o.o_custkey == c.c_custkey)
            .groupBy("block_id", F.to_date("o_orderdate").alias("date"))
            .agg(
                F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"),
                F.min("o_orderkey").alias("k"),
                F.count(F.lit(1)).alias("n_obs"),
            )
            .withColumn("dn", F.datediff("date", F.lit(DAY_ZERO).cast("date")))
        )
        return g.selectExpr(
            "block_id", "date", "dn", "n_obs",
            "case when (block_id * 31 + dn) % 7 <> 0 then (1000 + cents % 3000) / 100D end as temp",
            "case when (block_id * 17 + dn) % 11 = 0 then null when k % 3 = 0 then 0D"
            " else ((cents div 7) % 4000) / 100D end as rain",
            "(3000 + (cents div 11) % 7000) / 100D as rh",
            "((cents div 13) % 1200) / 100D as wind",
        )

    @cached_property
    def forecast(self) -> DataFrame:
        """(block_id, target_date, lead): seven leads per area and day."""
        return self.daily.withColumn("lead", F.explode(F.sequence(F.lit(1), F.lit(7)))).selectExpr(
            "block_id", "date as target_date", "lead", "date_sub(date, lead) as issue_date", "dn",
            "temp + (lead * (dn % 5 - 2)) / 10D as temp_f",
            "rain * (8 + (dn + lead) % 5) / 10D as rain_f",
            "least(100D, rh + ((dn + lead) % 9 - 4)) as rh_f",
            "wind * (9 + (dn + lead) % 3) / 10D as wind_f",
        )

    @cached_property
    def forecast_wide(self) -> DataFrame:
        from finecast.operators.joins import assemble_leads

        wide = assemble_leads(self.forecast, ["block_id", "target_date"], "lead", ["temp_f", "rain_f"])
        return wide.withColumnRenamed("target_date", "date")

    @cached_property
    def gp(self) -> DataFrame:
        """Local areas with static features; one column constant, one empty."""
        return self.table("customer").selectExpr(
            "c_custkey as gp_id", f"{CUSTOMER_AREA} as block_id", "c_name as gp_name",
            "case when c_custkey % 7 <> 0 then c_acctbal end as terrain__elevation_mean",
            "cast(c_custkey % 17 as double) as terrain__slope_mean",
            "cast(c_custkey % 5 as double) as soil__clay",
            "case when c_custkey % 3 = 0 then cast(c_custkey % 11 as double) end as soil__sand",
            "cast(1 as double) as landcover__built", "cast(null as double) as landcover__void",
            "(800 + c_custkey * 7 % 2500) / 100D as lat", "(7000 + c_custkey * 13 % 1800) / 100D as lon",
        )

    @cached_property
    def sites(self) -> DataFrame:
        return self.table("supplier").selectExpr("s_suppkey as gp_id", f"{SUPPLIER_AREA} as block_id", "s_name as gp_name")

    @cached_property
    def site_targets(self) -> DataFrame:
        """Genuine local targets: (gp_id, date)."""
        return self.sites.select("gp_id", "block_id").join(self.daily, "block_id").selectExpr(
            "gp_id", "date", "temp + (gp_id % 5) / 10D as actual_temperature_2m_mean",
            "rain * (9 + gp_id % 3) / 10D as actual_precipitation_sum",
        )

    @cached_property
    def hourly(self) -> DataFrame:
        return self.table("events").selectExpr(
            "cast(user_id % 3 as int) as block_id", "cast(ts as timestamp) as time", "event_id",
            "value / 10D as temperature", "value as humidity",
            "case when event_id % 5 <> 0 then value / 100D end as precipitation",
            "cast(event_id % 101 as double) as cloud_cover", "value / 7D as wind_speed",
            "cast(event_id % 360 as double) as wind_direction", "value / 3D as wind_gust",
            "900 + value as pressure", "value / 1000D as vpd", "cast(1 + event_id % 7 as int) as lead",
        )

    @cached_property
    def radar(self) -> DataFrame:
        """Radar scenes; the key (gp_id, image_id) repeats now and then."""
        return self.table("lineitem").selectExpr(
            "l_suppkey as gp_id", "concat(l_orderkey, '-', l_linenumber) as image_id", "cast(l_shipdate as date) as date",
            "case when l_partkey % 9 <> 0 then -l_quantity end as vv", "case when l_partkey % 8 <> 0 then -l_extendedprice / 1000D end as vh",
            "l_returnflag as orbit", "l_discount * 10 as coverage", "l_orderkey", "l_partkey", "l_linenumber",
        )

    @cached_property
    def pixels(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_suppkey as zone_id", "cast(l_orderkey % 50 as int) as x", "cast(l_partkey % 50 as int) as y",
            "cast(l_shipdate as date) as date", "l_linenumber as scene_id",
            "l_quantity as b2", "l_tax * 100 as b4", "l_discount * 100 as b8", "cast(l_partkey % 40 as double) as b11",
            "cast(l_orderkey % 30 as double) as b12", "cast(l_orderkey % 4096 as int) as qa", "cast(l_partkey % 12 as int) as scl",
            "l_extendedprice as dn",
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """(block, date, horizon) with truth, raw and corrected rain and a split by distinct date."""
        p = self.daily.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(7)))).selectExpr(
            "block_id", "date", "dn", "horizon", "rain as actual", "rain * (8 + (dn + horizon) % 5) / 10D as raw",
            "((dn * 13 + horizon * 5) % 101) / 100D as prob",
        ).selectExpr(
            "block_id", "date", "horizon", "actual", "raw",
            "case when raw is not null then greatest(0D, raw + ((dn * 7 + horizon * 3) % 11 - 5) / 4D) end as corrected", "prob",
        )
        return date_split(p, "date")

    @cached_property
    def current(self) -> DataFrame:
        """GP forecast: the newest seven days of each area for every site."""
        from finecast.operators.windows import rank_within

        d = self.daily
        last = rank_within(d, ["block_id"], [F.col("date").desc()], 7, "back")
        return self.sites.join(last, "block_id").selectExpr(
            "gp_id", "block_id", "date as target_date", "cast(8 - back as int) as day",
            "temp + (gp_id % 7) as temperature", "least(100D, rh + gp_id % 20) as humidity",
            "rain * (5 + gp_id % 11) / 5D as rainfall", "wind * (8 + gp_id % 4) / 10D as wind",
        )

    @cached_property
    def squares(self) -> DataFrame:
        """Unit-step squares on a 20-wide board: side 1, or 2 for every fifth, so some overlap.

        Two customers share each outline, and a third of all share outline 0.
        """
        k = F.expr(OUTLINE)
        side = F.when(k % 5 == 0, 2).otherwise(1)
        x, y = (k % 20).cast("double"), F.floor(k / 20).cast("double")
        ring = make_ring([(x, y), (x + side, y), (x + side, y + side), (x, y + side)])
        return self.table("customer").select(
            F.col("c_custkey").alias("gp_id"), F.expr(CUSTOMER_AREA).alias("block_id"), k.alias("k"), side.alias("side"), ring.alias("ring")
        )


CTE = {
    "day_raw": (
        (),
        f"""SELECT {CUSTOMER_AREA_SQL} AS block_id, CAST(o_orderdate AS DATE) AS date,
      CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, MIN(o_orderkey) AS k, COUNT(*) AS n_obs,
      CAST(CAST(o_orderdate AS DATE) - DATE '{DAY_ZERO}' AS INTEGER) AS dn
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    ),
    "daily": (
        ("day_raw",),
        """SELECT block_id, date, dn, n_obs,
      CASE WHEN (block_id * 31 + dn) % 7 <> 0 THEN (1000 + cents % 3000) / 1e2 END AS temp,
      CASE WHEN (block_id * 17 + dn) % 11 = 0 THEN NULL WHEN k % 3 = 0 THEN 0e0 ELSE ((cents // 7) % 4000) / 1e2 END AS rain,
      (3000 + (cents // 11) % 7000) / 1e2 AS rh, ((cents // 13) % 1200) / 1e2 AS wind FROM day_raw""",
    ),
    "forecast": (
        ("daily",),
        """SELECT block_id, date AS target_date, lead, date - lead AS issue_date, dn,
      temp + (lead * (dn % 5 - 2)) / 1e1 AS temp_f, rain * (8 + (dn + lead) % 5) / 1e1 AS rain_f,
      least(1e2, rh + ((dn + lead) % 9 - 4)) AS rh_f, wind * (9 + (dn + lead) % 3) / 1e1 AS wind_f
    FROM daily, (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS lead)""",
    ),
    "forecast_wide": (
        ("forecast",),
        "SELECT block_id, target_date AS date, "
        + ", ".join(f"MAX(CASE WHEN lead = {d} THEN {v} END) AS {v}_d{d}" for v in ("temp_f", "rain_f") for d in range(1, 8))
        + " FROM forecast GROUP BY block_id, target_date",
    ),
    "gp": (
        (),
        f"""SELECT c_custkey AS gp_id, {CUSTOMER_AREA_SQL} AS block_id, c_name AS gp_name,
      CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS terrain__elevation_mean,
      CAST(c_custkey % 17 AS DOUBLE) AS terrain__slope_mean, CAST(c_custkey % 5 AS DOUBLE) AS soil__clay,
      CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 11 AS DOUBLE) END AS soil__sand,
      1e0 AS landcover__built, CAST(NULL AS DOUBLE) AS landcover__void,
      (800 + c_custkey * 7 % 2500) / 1e2 AS lat, (7000 + c_custkey * 13 % 1800) / 1e2 AS lon FROM customer""",
    ),
    "sites": ((), f"SELECT s_suppkey AS gp_id, {SUPPLIER_AREA_SQL} AS block_id, s_name AS gp_name FROM supplier"),
    "site_targets": (
        ("sites", "daily"),
        """SELECT gp_id, date, temp + (gp_id % 5) / 1e1 AS actual_temperature_2m_mean,
      rain * (9 + gp_id % 3) / 1e1 AS actual_precipitation_sum FROM sites JOIN daily USING (block_id)""",
    ),
    "hourly": (
        (),
        """SELECT CAST(user_id % 3 AS INTEGER) AS block_id, ts AS time, event_id, value / 1e1 AS temperature, value AS humidity,
      CASE WHEN event_id % 5 <> 0 THEN value / 1e2 END AS precipitation, CAST(event_id % 101 AS DOUBLE) AS cloud_cover,
      value / 7e0 AS wind_speed, CAST(event_id % 360 AS DOUBLE) AS wind_direction, value / 3e0 AS wind_gust,
      900 + value AS pressure, value / 1e3 AS vpd, CAST(1 + event_id % 7 AS INTEGER) AS lead FROM events""",
    ),
    "radar": (
        (),
        """SELECT l_suppkey AS gp_id, l_orderkey || '-' || l_linenumber AS image_id, CAST(l_shipdate AS DATE) AS date,
      CASE WHEN l_partkey % 9 <> 0 THEN -l_quantity END AS vv, CASE WHEN l_partkey % 8 <> 0 THEN -l_extendedprice / 1e3 END AS vh,
      l_returnflag AS orbit, l_discount * 10 AS coverage, l_orderkey, l_partkey, l_linenumber FROM lineitem""",
    ),
    "pixels": (
        (),
        """SELECT l_suppkey AS zone_id, CAST(l_orderkey % 50 AS INTEGER) AS x, CAST(l_partkey % 50 AS INTEGER) AS y,
      CAST(l_shipdate AS DATE) AS date, l_linenumber AS scene_id, l_quantity AS b2, l_tax * 100 AS b4, l_discount * 100 AS b8,
      CAST(l_partkey % 40 AS DOUBLE) AS b11, CAST(l_orderkey % 30 AS DOUBLE) AS b12, CAST(l_orderkey % 4096 AS INTEGER) AS qa,
      CAST(l_partkey % 12 AS INTEGER) AS scl, l_extendedprice AS dn FROM lineitem""",
    ),
    "pred_raw": (
        ("forecast", "daily"),
        """SELECT f.block_id, f.target_date AS date, lead AS horizon, rain AS actual, rain_f AS raw,
      CASE WHEN rain_f IS NOT NULL THEN greatest(0e0, rain_f + ((f.dn * 7 + lead * 3) % 11 - 5) / 4e0) END AS corrected,
      ((f.dn * 13 + lead * 5) % 101) / 1e2 AS prob
    FROM forecast f JOIN daily d ON f.block_id = d.block_id AND f.target_date = d.date""",
    ),
    "pred_dates": (
        ("pred_raw",),
        """SELECT date, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' WHEN i < floor(n * 0.85::DOUBLE) THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, COUNT(*) OVER () AS n FROM (SELECT DISTINCT date FROM pred_raw))""",
    ),
    "predictions": (("pred_raw", "pred_dates"), "SELECT * FROM pred_raw JOIN pred_dates USING (date)"),
    "current_fc": (
        ("sites", "daily"),
        """SELECT gp_id, block_id, date AS target_date, CAST(8 - back AS INTEGER) AS day, temp + (gp_id % 7) AS temperature,
      least(1e2, rh + gp_id % 20) AS humidity, rain * (5 + gp_id % 11) / 5e0 AS rainfall, wind * (8 + gp_id % 4) / 1e1 AS wind
    FROM sites JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY block_id ORDER BY date DESC) AS back FROM daily) WHERE back <= 7)
    USING (block_id)""",
    ),
    "squares": (
        (),
        f"""SELECT gp_id, block_id, k, side, k % 20 AS x0, k // 20 AS y0 FROM (SELECT c_custkey AS gp_id, {CUSTOMER_AREA_SQL} AS block_id,
      {OUTLINE_SQL} AS k, CASE WHEN ({OUTLINE_SQL}) % 5 = 0 THEN 2 ELSE 1 END AS side FROM customer)""",
    ),
    "square_cells": (
        ("squares",),
        """SELECT gp_id, block_id, k, side, cx, cy FROM (SELECT *, unnest(range(x0, x0 + side)) AS cx FROM squares) s,
      LATERAL (SELECT unnest(range(s.y0, s.y0 + s.side)) AS cy)""",
    ),
}


def with_(names: str, body: str, **extra: str) -> str:
    """``WITH`` clause for the named frames (and what they need), then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n not in order:
            for d in CTE[n][0]:
                visit(d)
            order.append(n)

    for n in names.split():
        visit(n)
    parts = [f"{n} AS (\n    {CTE[n][1]})" for n in order] + [f"{n} AS (\n    {t})" for n, t in extra.items()]
    return ("WITH " + ",\n  ".join(parts) + "\n" if parts else "") + body
