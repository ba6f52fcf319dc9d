"""Sources, sinks and incremental archive queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from finecast.functions import geo
from finecast.operators import ingest, serving
from finecast.plans.frames import with_
from finecast.plans.registry import query, r
from finecast.session import bounded_tasks, fresh_dir, materialise
from finecast.sources import geojson, hourly, tables
from finecast.sources.keyed import KeyedArchive

A, B = "1995-01-01", "2001-12-31"


def day(text: str):
    return F.lit(text).cast("date")


@query("s01_read_table", f"SELECT c_custkey, c_nationkey, {r('c_acctbal')} AS c_acctbal FROM customer")
def _(f):
    return tables.read_table(f.spark, f"{f.dir}/customer.parquet", "c_custkey bigint, c_nationkey int, c_acctbal double")


@query("s01_read_csv", "SELECT n_nationkey, n_name, n_regionkey FROM nation JOIN customer ON n_nationkey = c_nationkey")
def _(f):
    """Customer nations written as CSV and scanned with a declared schema."""
    path = fresh_dir(f.spark, "csv")
    n = f.table("customer").select("c_nationkey").join(f.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    n.select("n_nationkey", "n_name", "n_regionkey").write.option("header", True).csv(path)
    return tables.read_table(f.spark, path, "n_nationkey int, n_name string, n_regionkey int", fmt="csv")


def payloads(f):
    """Events packed the way an hourly interface delivers them: parallel arrays per user and day.

    A payload holds at most 100 entries, however busy the user is.
    """
    row = F.struct(F.col("ts").cast("string").alias("t"), "event_id", "value")
    part = F.floor(F.col("event_id") / 100).alias("part")
    packed = f.table("events").groupBy("user_id", F.to_date("ts").alias("day"), part).agg(F.sort_array(F.collect_list(row)).alias("a"))
    return packed.select(
        "user_id", "day",
        F.struct(
            F.col("a.t").alias("time"), F.transform("a.event_id", lambda x: x.cast("double")).alias("code"), F.col("a.value").alias("value"),
        ).alias("hourly"),
    )


@query("s02_hourly_strict", f"SELECT user_id, CAST(ts AS DATE) AS day, ts AS time, CAST(event_id AS DOUBLE) AS code, {r('value')} AS value FROM events")
def _(f):
    return hourly.explode_hourly(payloads(f), ["user_id", "day"], ["code", "value"])


@query("s02_hourly_lenient", f"SELECT user_id, CAST(ts AS DATE) AS day, ts AS time, {r('value')} AS value, CAST(NULL AS DOUBLE) AS snow FROM events")
def _(f):
    return hourly.explode_hourly(payloads(f), ["user_id", "day"], ["value", "snow"], strict=False)


@query("s03_read_geojson", with_("squares", f"SELECT CAST(gp_id AS VARCHAR) AS gp_id, CAST(5 AS INTEGER) AS vertices, {r('side * side')} AS area FROM squares"))
def _(f):
    """Feature collection documents of at most 500 features per area, read as many documents."""
    path = fresh_dir(f.spark, "collections")
    feature = geojson.feature_json(["gp_id"])
    part = F.floor(F.col("gp_id") / 500).alias("part")
    sq = f.squares.select("block_id", part, F.col("gp_id").cast("string").alias("gp_id"), F.array("ring").alias("rings"))
    docs = sq.groupBy("block_id", "part").agg(F.collect_list(feature).alias("fs")).select(
        F.concat(
            F.lit('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"EPSG:4326"}},"features":['),
            F.array_join("fs", ","), F.lit("]}"),
        ).alias("value")
    )
    docs.repartition(25).write.option("maxRecordsPerFile", 1).text(path)
    got = geojson.read_geojson(f.spark, path, {"gp_id": "string"}, "gp_id")
    return got.select("gp_id", F.size("ring").alias("vertices"), geo.ring_area(F.col("ring")).alias("area"))


@query("s04_write_geojson", with_("squares", f"SELECT gp_id, block_id, {r('4 * side')} AS perimeter FROM squares"))
def _(f):
    path = fresh_dir(f.spark, "features")
    geojson.write_geojson(f.squares.select("gp_id", "block_id", F.array("ring").alias("rings")), path, ["gp_id", "block_id"])
    back = geojson.read_features(f.spark, path, {"gp_id": "bigint", "block_id": "int"})
    edges = geo.ring_edges(F.col("rings")[0])
    length = F.aggregate(edges, F.lit(0.0), lambda s, e: s + F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]))
    return back.select("gp_id", "block_id", length.alias("perimeter"))


@query(
    "s06_resolve_location",
    """WITH reg AS (SELECT r_name AS state, n_name AS block FROM nation JOIN region ON n_regionkey = r_regionkey
      UNION ALL SELECT r_name, CASE WHEN n_nationkey % 6 = 0 THEN replace(n_name, '_', ' - ') ELSE n_name END FROM nation JOIN region ON n_regionkey = r_regionkey),
    req AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lower(r_name) WHEN 1 THEN '  ' || r_name ELSE r_name END AS state,
      CASE c_custkey % 4 WHEN 0 THEN replace(n_name, '_', '-') WHEN 1 THEN lower(n_name) || ' ' WHEN 2 THEN n_name ELSE n_name || 'x' END AS block
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    off AS (SELECT regexp_replace(lower(trim(state)), '[^a-z0-9]+', '', 'g') AS ks, regexp_replace(lower(trim(block)), '[^a-z0-9]+', '', 'g') AS kb,
      COUNT(*) AS n, MIN(state) AS s, MIN(block) AS b FROM (SELECT DISTINCT * FROM reg) GROUP BY 1, 2)
    SELECT c_custkey, state, block, coalesce(n, 0) AS n_matches, CASE WHEN n = 1 THEN s END AS official_state, CASE WHEN n = 1 THEN b END AS official_block,
      CASE WHEN n = 1 THEN 'RESOLVED' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'MISSING' END AS status
    FROM req LEFT JOIN off ON ks = regexp_replace(lower(trim(state)), '[^a-z0-9]+', '', 'g') AND kb = regexp_replace(lower(trim(block)), '[^a-z0-9]+', '', 'g')""",
)
def _(f):
    nr = f.table("nation").join(f.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    reg = nr.selectExpr("r_name as state", "n_name as block").unionByName(
        nr.selectExpr("r_name as state", "if(n_nationkey % 6 = 0, replace(n_name, '_', ' - '), n_name) as block")
    )
    req = f.table("customer").join(nr, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey",
        "case c_custkey % 3 when 0 then lower(r_name) when 1 then concat('  ', r_name) else r_name end as state",
        "case c_custkey % 4 when 0 then replace(n_name, '_', '-') when 1 then concat(lower(n_name), ' ') when 2 then n_name else concat(n_name, 'x') end as block",
    )
    return tables.resolve_location(req, reg, ["state", "block"])


@query("s07_partitioned_sink", with_("daily", f"SELECT block_id, date, {r('temp')} AS temp, {r('rain')} AS rain FROM daily"))
def _(f):
    path = fresh_dir(f.spark, "partitioned")
    d = f.daily.select("block_id", "date", "temp", "rain")
    tables.write_partitioned(d, path, ["block_id"])
    return f.spark.read.schema(d.schema).parquet(path).select("block_id", "date", "temp", "rain")


@query("s08_staged_publish", with_("daily", f"SELECT block_id, date, CASE WHEN block_id % 2 = 0 THEN {r('temp + 100')} ELSE {r('temp')} END AS temp FROM daily"))
def _(f):
    """Publish all areas, then replace only the even ones: the others must survive."""
    path = fresh_dir(f.spark, "published")
    d = f.daily.select("date", "temp", "block_id")
    tables.publish(d, path, ["block_id"])
    tables.publish(d.filter("block_id % 2 = 0").withColumn("temp", F.col("temp") + 100), path, ["block_id"])
    return tables.published(f.spark, path, d.schema).select("block_id", "date", "temp")


@query(
    "s09_manifest",
    with_("radar", """SELECT CAST(SUM(n) AS BIGINT) AS row_count, CAST(10 AS INTEGER) AS column_count, COUNT(*) AS distinct_keys, COUNT(*) FILTER (n > 1) AS repeated_keys,
      MIN(lo) AS first_date, MAX(hi) AS last_date, '{"imputed": false, "synthetic": false}' AS policy
    FROM (SELECT gp_id, image_id, COUNT(*) AS n, MIN(date) AS lo, MAX(date) AS hi FROM radar GROUP BY ALL)"""),
)
def _(f):
    return tables.manifest(f.radar, ["gp_id", "image_id"], "date", {"synthetic": False, "imputed": False})


@query(
    "s10_output_contract",
    "SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (r_name <> 'ASIA') AS foreign_rows, 'lead' AS missing_columns, 'FAIL' AS status"
    " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def _(f):
    c = f.table("customer").join(f.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.join(f.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).withColumnRenamed("r_name", "state")
    return tables.check_contract(c, ["c_custkey", "state", "lead"], {"state": "Asia "})


@query(
    "s11_publishable_forecast",
    with_("current_fc sites", """SELECT (SELECT COUNT(DISTINCT gp_id) FROM current_fc) AS n_ids,
      (SELECT COUNT(DISTINCT gp_id) FROM current_fc WHERE gp_id % 10 = 3) AS unknown_ids, (SELECT MAX(target_date) FROM current_fc) AS last_target,
      false AS publishable, 'unknown ids' || CASE WHEN (SELECT MAX(target_date) FROM current_fc) < DATE '2001-08-02' THEN '; forecast is out of date' ELSE '' END AS reasons"""),
)
def _(f):
    n = f.current.agg(F.count_distinct("gp_id").cast("long").alias("gp_count"))
    m = n.selectExpr("gp_count", "false as synthetic_target", "false as interpolated_target", "false as block_actual_copied_to_gp")
    return serving.validate_forecast(f.current, f.sites.selectExpr("if(gp_id % 10 = 3, -1 - gp_id, gp_id) as gp_id"), m, "gp_id", "target_date", day("2001-08-02"))


# --- incremental archives -----------------------------------------------------------------------


@query(
    "i01_next_window",
    with_("daily", f"""SELECT block_id, MAX(date) AS last_date, MAX(date) + 1 AS window_start, DATE '2001-07-31' AS window_end,
      CASE WHEN MAX(date) > DATE '2001-07-31' THEN 'FUTURE_DATA' WHEN MAX(date) + 1 > DATE '2001-07-31' THEN 'UP_TO_DATE' ELSE 'FETCH' END AS status
    FROM daily GROUP BY block_id"""),
)
def _(f):
    return ingest.next_window(f.daily, "date", day(A), day("2001-07-31"), ["block_id"])


EXISTING = "SELECT gp_id, image_id, date, vv, l_partkey AS v FROM radar WHERE l_linenumber <= 4"
ARRIVING = "SELECT gp_id, image_id, date, vv, l_partkey + CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE 1000000 END AS v FROM radar WHERE l_linenumber >= 3"


def batches(f):
    """Stored scenes and an overlapping delivery, half of whose repeats changed."""
    a = f.radar.filter("l_linenumber <= 4").selectExpr("gp_id", "image_id", "date", "vv", "l_partkey as v")
    b = f.radar.filter("l_linenumber >= 3").selectExpr(
        "gp_id", "image_id", "date", "vv", "l_partkey + case when l_orderkey % 2 = 0 then 0 else 1000000 end as v"
    )
    return a, b


@query(
    "i02_append_new",
    with_("radar", f"""SELECT gp_id, image_id, date, {r('vv')} AS vv, v FROM a UNION ALL
      SELECT gp_id, image_id, u.date, {r('u.vv')}, u.v FROM (SELECT gp_id, image_id, unnest([arg_min({{'date': date, 'vv': vv, 'v': v}}, (date, v))]) AS u FROM b
        WHERE (gp_id, image_id) NOT IN (SELECT (gp_id, image_id) FROM a) GROUP BY gp_id, image_id)""", a=EXISTING, b=ARRIVING),
)
def _(f):
    return ingest.append_new(*batches(f), ["gp_id", "image_id"], ["date", "v"])


UPSERT = with_("radar", f"""SELECT gp_id, image_id, u.date, {r('u.vv')} AS vv, u.v FROM
      (SELECT gp_id, image_id, unnest([arg_max({{'date': date, 'vv': vv, 'v': v}}, (b, date, v))]) AS u
       FROM (SELECT *, 0 AS b FROM a UNION ALL SELECT *, 1 FROM b) GROUP BY gp_id, image_id)""", a=EXISTING, b=ARRIVING)


@query("i03_upsert_latest", UPSERT)
def _(f):
    return ingest.upsert_latest(*batches(f), ["gp_id", "image_id"], ["date", "v"])


@query("i03_keyed_archive", UPSERT)
def _(f):
    """The same upsert through the keyed archive; the delivery comes twice and counts once."""
    stored, delivery = batches(f)
    archive = KeyedArchive(f.spark, fresh_dir(f.spark, "keyed"), stored.schema, ["gp_id", "image_id"], ["date", "v"], buckets=16)
    for no, batch in enumerate((stored, delivery, delivery)):
        archive.append(batch, "deliveries", min(no, 1))
    return archive.read()


@query(
    "i04_conflicts",
    with_("radar", """SELECT gp_id, image_id, differing FROM (SELECT gp_id, image_id, array_to_string(list_filter([
        CASE WHEN COUNT(DISTINCT date) > 1 OR COUNT(date) BETWEEN 1 AND COUNT(*) - 1 THEN 'date' END, CASE WHEN COUNT(DISTINCT vv) > 1 OR COUNT(vv) BETWEEN 1 AND COUNT(*) - 1 THEN 'vv' END,
        CASE WHEN COUNT(DISTINCT v) > 1 OR COUNT(v) BETWEEN 1 AND COUNT(*) - 1 THEN 'v' END], lambda x: x IS NOT NULL), ',') AS differing
      FROM (SELECT *, 0 AS o FROM a UNION ALL BY NAME SELECT *, 1 AS o FROM b) GROUP BY gp_id, image_id HAVING MAX(o) = 1) WHERE differing <> ''""", a=EXISTING, b=ARRIVING),
)
def _(f):
    c = ingest.conflicts(*batches(f), ["gp_id", "image_id"])
    return c.withColumn("differing", F.array_join("differing", ","))


@query(
    "i04_append_strict",
    with_("radar", f"SELECT DISTINCT gp_id, image_id, l_orderkey, l_linenumber FROM radar"),
)
def _(f):
    """A delivery that repeats stored scenes unchanged is absorbed without a conflict.

    The scenes are written once, as check and merge both read them.
    """
    k = f.radar.select("gp_id", "image_id", "l_orderkey", "l_linenumber").distinct()
    with bounded_tasks(f.spark, scans=True):
        k = materialise(k, "scenes")
    return ingest.append_strict(k.filter("l_linenumber <= 4"), k.filter("l_linenumber >= 3"), ["gp_id", "image_id"])


@query(
    "i05_missing_keys",
    with_("daily gp", f"SELECT block_id, date FROM (SELECT block_id, CAST(unnest(range(DATE '{A}', DATE '{B}' + 1, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT DISTINCT block_id FROM gp))"
          " WHERE (block_id, date) NOT IN (SELECT (block_id, date) FROM daily)"),
)
def _(f):
    blocks = f.gp.select("block_id").distinct()
    return ingest.missing_keys(blocks, day(A), day(B), f.daily, ["block_id"], "date")


SPANS = "SELECT block_id, MIN(date) AS start_date, MAX(date) AS end_date FROM daily GROUP BY block_id"


def spans(f):
    return f.daily.groupBy("block_id").agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))


@query(
    "i06_date_buckets",
    with_("daily", """SELECT block_id, b AS bucket_start, least(b + 29, end_date) AS bucket_end, least(b + 29, end_date) + 1 AS bucket_stop FROM
      (SELECT block_id, end_date, CAST(unnest(range(start_date, end_date + 1, INTERVAL 30 DAY)) AS DATE) AS b FROM spans)""", spans=SPANS),
)
def _(f):
    return ingest.date_buckets(spans(f), 30).drop("start_date", "end_date")


@query(
    "i06_month_buckets",
    with_("daily", """SELECT block_id, m AS month_start, greatest(m, start_date) AS bucket_start, least(last_day(m), end_date) AS bucket_end FROM
      (SELECT *, CAST(unnest(range(CAST(date_trunc('month', start_date) AS DATE), end_date + 1, INTERVAL 1 MONTH)) AS DATE) AS m FROM spans)""", spans=SPANS),
)
def _(f):
    return ingest.month_buckets(spans(f)).drop("start_date", "end_date")


@query(
    "i06_listed_buckets",
    with_("daily", f"SELECT block_id, CAST(floor((date - DATE '{A}') / 10) AS INTEGER) AS bucket_no, MIN(date) AS bucket_start, MAX(date) AS bucket_end, COUNT(*) AS n_dates FROM daily GROUP BY 1, 2"),
)
def _(f):
    return ingest.listed_buckets(f.daily, "date", 10, day(A), ["block_id"])


CYCLES = "SELECT user_id, event_id, date_trunc('hour', ts) AS retrieved_at FROM events"


@query("i07_latest_cycle", with_("", "SELECT user_id, event_id, retrieved_at FROM c WHERE retrieved_at = (SELECT MAX(retrieved_at) FROM c)", c=CYCLES))
def _(f):
    c = f.table("events").select("user_id", "event_id", F.date_trunc("hour", "ts").alias("retrieved_at"))
    return ingest.latest_cycle(c, "retrieved_at")


@query(
    "i07_latest_cycle_per_area",
    with_("", "SELECT user_id, event_id, retrieved_at FROM c JOIN (SELECT user_id, MAX(retrieved_at) AS retrieved_at FROM c GROUP BY user_id) USING (user_id, retrieved_at)", c=CYCLES),
)
def _(f):
    c = f.table("events").select("user_id", "event_id", F.date_trunc("hour", "ts").alias("retrieved_at"))
    return ingest.latest_cycle(c, "retrieved_at", ["user_id"])


@query("i08_latest_dates", with_("daily", f"SELECT block_id, date, {r('rh')} AS rh FROM daily JOIN (SELECT * FROM (SELECT block_id, date, row_number() OVER (PARTITION BY block_id ORDER BY date DESC) AS n FROM (SELECT DISTINCT block_id, date FROM daily)) WHERE n <= 7) USING (block_id, date)"))
def _(f):
    return ingest.latest_dates(f.daily.select("block_id", "date", "rh"), "date", 7, ["block_id"])


@query("i09_trim_before", with_("daily", f"SELECT block_id, date, {r('rh')} AS rh FROM daily WHERE date >= DATE '1998-06-15'"))
def _(f):
    return ingest.trim_before(f.daily.select("block_id", "date", "rh"), "date", day("1998-06-15"))


@query(
    "i10_entity_windows",
    with_("", f"""SELECT gp_id, m AS last_date, coalesce(m + 1, DATE '{A}') AS window_start, DATE '2001-07-01' AS window_end,
      CASE WHEN m IS NULL THEN 'FULL_HISTORY' WHEN m + 1 > DATE '2001-07-01' THEN 'UP_TO_DATE' ELSE 'INCREMENTAL' END AS mode
    FROM (SELECT c_custkey AS gp_id, CAST(MAX(o_orderdate) AS DATE) AS m FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON o_custkey = c_custkey GROUP BY c_custkey)"""),
)
def _(f):
    gps = f.table("customer").selectExpr("c_custkey as gp_id")
    stored = f.table("orders").filter("o_orderstatus <> 'P'").selectExpr("o_custkey as gp_id", "cast(o_orderdate as date) as date")
    return ingest.entity_windows(gps, stored, ["gp_id"], "date", day(A), day("2001-07-01"))


@query(
    "i11_store_preflight",
    with_("radar", """SELECT check_name, n_bad, CASE WHEN n_bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
      SELECT 'invalid_date' AS check_name, COUNT(*) FILTER (date IS NULL) AS n_bad FROM radar UNION ALL SELECT 'blank_id', COUNT(*) FILTER (gp_id IS NULL) FROM radar
      UNION ALL SELECT 'unknown_id', COUNT(DISTINCT gp_id) FROM radar WHERE gp_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 4 <> 1)
      UNION ALL SELECT 'duplicate_key', COUNT(*) FROM (SELECT gp_id, image_id FROM radar GROUP BY ALL HAVING COUNT(*) > 1))"""),
)
def _(f):
    master = f.table("supplier").selectExpr("if(s_suppkey % 4 = 1, -1 - s_suppkey, s_suppkey) as gp_id")
    return ingest.check_store(f.radar, ["gp_id", "image_id"], "date", master, "gp_id")
