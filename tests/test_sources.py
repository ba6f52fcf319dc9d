"""Sources, sinks and contracts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from finecast.errors import DataContractError
from finecast.sources import geojson, hourly, keyed, tables
from finecast.sources.keyed import KeyedArchive
from finecast.sources.ledger import ConcurrentWrite

SQUARE = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]


def write(path, obj):
    with open(path, "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj))
    return str(path)


def collection(*features, crs="EPSG:4326"):
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": crs}}, "features": list(features)}


def feature(i, ring=SQUARE):
    return {"type": "Feature", "properties": {"gp_id": i}, "geometry": {"type": "Polygon", "coordinates": [ring]}}


def test_geojson_contract(spark, tmp_path):
    ok = write(tmp_path / "ok.json", collection(feature("1"), feature("2")))
    assert geojson.read_geojson(spark, ok, {"gp_id": "string"}, "gp_id").count() == 2
    bad = {
        "crs": collection(feature("1"), crs="EPSG:32643"), "empty": collection(), "repeated": collection(feature("1"), feature("1")),
        "blank": collection(feature(" ")), "open": collection(feature("1", SQUARE[:-1])),
    }
    for name, doc in bad.items():
        with pytest.raises(DataContractError):
            geojson.read_geojson(spark, write(tmp_path / f"{name}.json", doc), {"gp_id": "string"}, "gp_id")


def test_geojson_parts_and_holes(spark, tmp_path):
    hole = [[0.2, 0.2], [0.4, 0.2], [0.4, 0.4], [0.2, 0.2]]
    far = [[5.0, 0.0], [6.0, 0.0], [6.0, 1.0], [5.0, 0.0]]
    multi = {"type": "Feature", "properties": {"gp_id": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[SQUARE, hole], [far]]}}
    rows = geojson.read_geojson(spark, write(tmp_path / "m.json", collection(feature("1"), multi)), {"gp_id": "string"}, "gp_id")
    got = {r["gp_id"]: ([len(p) for p in r["parts"]], len(r["rings"]), len(r["ring"])) for r in rows.collect()}
    assert got == {"1": ([1], 1, 5), "m": ([2, 1], 2, 5)}
    line = {"type": "Feature", "properties": {"gp_id": "l"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}}
    broken = {"type": "Feature", "properties": {"gp_id": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [[SQUARE], [far[:-1]]]}}
    for i, bad in enumerate((line, broken)):
        with pytest.raises(DataContractError):
            geojson.read_geojson(spark, write(tmp_path / f"bad{i}.json", collection(bad)), {"gp_id": "string"}, "gp_id")


def test_one_large_collection_is_read_by_many_tasks(spark, tmp_path):
    def moved(i):
        return feature(str(i), [[x + i, y] for x, y in SQUARE])

    path = write(tmp_path / "large.json", json.dumps(collection(*map(moved, range(6000))), indent=1))
    size = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(size, "128k")
    try:
        rows = geojson._cut_features(spark, path, "gp_id: string")
        assert rows.rdd.getNumPartitions() > 4 and rows.count() == 6000
        got = geojson.read_geojson(spark, path, {"gp_id": "string"}, "gp_id").agg(F.countDistinct("gp_id"), F.sum(F.col("ring")[0]["x"]), F.min(F.size("ring"))).first()
    finally:
        spark.conf.unset(size)
    assert tuple(got) == (6000, 6000 * 5999 / 2, 5)


def test_collections_that_cannot_be_cut_are_read_whole(spark, tmp_path):
    last = [dict(reversed(feature(i).items())) for i in ("1", "2")]
    texts = [feature(i) | {"properties": {"gp_id": i, "kind": "Feature"}} for i in ("1", "2")]
    for n, features in enumerate((last, texts, [feature("1"), last[1]])):
        path = write(tmp_path / f"odd{n}.json", collection(*features))
        assert geojson._cut_features(spark, path, "gp_id: string") is None
        assert sorted(r["gp_id"] for r in geojson.read_geojson(spark, path, {"gp_id": "string"}, "gp_id").collect()) == ["1", "2"]
    late = write(tmp_path / "late.json", {"type": "FeatureCollection", "features": [feature("1")], "crs": {"type": "name", "properties": {"name": "EPSG:32643"}}})
    with pytest.raises(DataContractError, match="geographic"):
        geojson.read_geojson(spark, late, {"gp_id": "string"}, "gp_id")


def test_collection_round_trip(spark, tmp_path):
    rows = geojson.read_geojson(spark, write(tmp_path / "a.json", collection(feature("1"), feature("2"))), {"gp_id": "string"}, "gp_id")
    out = str(tmp_path / "doc")
    geojson.write_collection(rows, out, ["gp_id"])
    assert geojson.read_geojson(spark, out, {"gp_id": "string"}, "gp_id").count() == 2
    with pytest.raises(DataContractError):
        geojson.write_collection(rows, out, ["gp_id"], max_features=1)


def test_csv_with_repeated_header(spark, tmp_path):
    with pytest.raises(DataContractError):
        tables.read_table(spark, write(tmp_path / "x.csv", "a,b,a\n1,2,3\n"), fmt="csv")


def payload(**arrays):
    return json.dumps({"gp_id": "g", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], **arrays}})


def test_hourly_strict_and_lenient(spark, tmp_path):
    p = write(tmp_path / "p.json", payload(t=[1.0, 2.0], rain=[0.5]))
    df = hourly.read_payloads(spark, p, ["t", "rain"], "gp_id string")
    with pytest.raises(Exception, match="length differs"):
        hourly.explode_hourly(df, ["gp_id"], ["t", "rain"]).collect()
    with pytest.raises(DataContractError):
        hourly.explode_hourly(df, ["gp_id"], ["t", "snow"])
    with pytest.raises(Exception, match="length differs"):
        hourly.explode_hourly(df, ["gp_id"], ["t", "rain", "snow"], strict=False).collect()
    q = write(tmp_path / "q.json", payload(t=[1.0, 2.0]))
    df = hourly.read_payloads(spark, q, ["t", "rain"], "gp_id string")
    got = hourly.explode_hourly(df, ["gp_id"], ["t", "rain", "snow"], strict=False).orderBy("time").collect()
    assert [(r["time"].hour, r["t"], r["rain"], r["snow"]) for r in got] == [(0, 1.0, None, None), (1, 2.0, None, None)]
    with pytest.raises(Exception, match="absent"):
        hourly.explode_hourly(df, ["gp_id"], ["t", "rain"]).collect()
    bad = write(tmp_path / "b.json", payload(t=[1.0, 2.0]).replace("2024-01-01T01:00", "yesterday"))
    with pytest.raises(Exception, match="not a time"):
        hourly.explode_hourly(hourly.read_payloads(spark, bad, ["t"], "gp_id string"), ["gp_id"], ["t"], strict=False).collect()


def test_failed_publish_leaves_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    shown = lambda: sorted((r["k"], r["v"]) for r in tables.published(spark, path).collect())
    with pytest.raises(DataContractError, match="nothing"):
        shown()
    tables.publish(spark.createDataFrame([(1, "a")], "v int, k string"), path, ["k"])
    broken = spark.createDataFrame([(2, "a")], "v int, k string").withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("stop"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        tables.publish(broken, path, ["k"])
    assert shown() == [("a", 1)]
    tables.publish(spark.createDataFrame([(5, "b")], "v int, k string"), path, ["k"])
    assert shown() == [("a", 1), ("b", 5)]
    tables.publish(spark.createDataFrame([(6, "b"), (7, None)], "v int, k string"), path, ["k"])
    assert sorted(map(str, ((r["k"], r["v"]) for r in tables.published(spark, path).collect()))) == ["('a', 1)", "('b', 6)", "(None, 7)"]


def test_a_reader_between_the_steps_sees_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "whole")
    shown = lambda: sorted(r["id"] for r in tables.published(spark, path).collect())
    tables.publish(spark.range(3), path)
    before = tables.published(spark, path)
    seen = []
    commit = tables.Ledger.commit
    monkeypatch.setattr(tables.Ledger, "commit", lambda self, *a: (seen.append(shown()), commit(self, *a), seen.append(shown())))
    tables.publish(spark.range(5, 7), path)
    assert seen == [[0, 1, 2], [5, 6]]
    # Who resolved the pointer before still reads what it pointed to.
    assert before.count() == 3
    monkeypatch.undo()
    for n in range(6):
        tables.publish(spark.range(n), path)
    assert shown() == [0, 1, 2, 3, 4] and len([n for n in os.listdir(path) if n.startswith("data-")]) == 3


def test_of_two_writers_at_once_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "both")
    tables.publish(spark.range(1), path)
    head, first = tables.Ledger.head, []

    def late(self):
        state = head(self)
        if not first:
            # Another writer comes and goes after this one has looked.
            first.append(1)
            tables.publish(spark.range(10, 12), path)
        return state

    monkeypatch.setattr(tables.Ledger, "head", late)
    with pytest.raises(ConcurrentWrite):
        tables.publish(spark.range(20, 23), path)
    monkeypatch.undo()
    assert sorted(r["id"] for r in tables.published(spark, path).collect()) == [10, 11]
    assert not [n for n in os.listdir(f"{path}/_ledger") if n.startswith(".") and not n.endswith(".crc")]


def test_publish_of_many_keys_writes_few_files_and_replaces_by_key(spark, tmp_path):
    path, want = str(tmp_path / "many"), {}
    for n in range(12):
        keys = range(0, 300, n + 1)
        df = spark.range(300).filter(F.col("id") % (n + 1) == 0).select((F.col("id") + 1000 * n).alias("v"), F.format_string("%03d", "id").alias("k"))
        tables.publish(df.unionByName(df.limit(1).select(F.lit(-n).cast("long").alias("v"), F.lit(None).cast("string").alias("k"))), path, ["k"])
        want |= {f"{i:03d}": i + 1000 * n for i in keys} | {None: -n}
        if n in (0, 1, 8, 11):
            assert {r["k"]: r["v"] for r in tables.published(spark, path, "v long, k string").collect()} == want
            assert tables.published(spark, path).count() == len(want)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) < 300
    tables.publish(spark.createDataFrame([(1, "a")], "v long, k string"), path)
    tables.publish(spark.createDataFrame([(2, "a"), (3, "b")], "v long, k string"), path, ["k"])
    assert sorted((r["k"], r["v"]) for r in tables.published(spark, path).collect()) == [("a", 2), ("b", 3)]


KEYED = "k long, g string, ts int, v double"


def test_keyed_archive_touches_only_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "a")
    make = lambda: KeyedArchive(spark, path, spark.createDataFrame([], KEYED).schema, ["k", "g"], ["ts"], buckets=8)
    archive, want = make(), {}
    assert archive.read().count() == 0
    for no in range(2 * keyed.FANOUT + 3):
        # A third of every delivery is one key, repeated with rising ts; a null key is a key.
        rows = [(None if no == 3 else 7, "hot", t, float(no * 100 + t)) for t in range(5)] + [(no * 3 + i, "x", 0, float(no)) for i in range(10)]
        archive.append(spark.createDataFrame(rows, KEYED), "src", no)
        for k, g, _, v in rows:
            want[k, g] = v
    got = {(r["k"], r["g"]): r["v"] for r in make().read().collect()}
    assert got == want
    state = archive.ledger.head()[1]
    assert sorted(s["level"] for s in state["segments"]) == [0, 0, 0, 1, 1]
    one = spark.createDataFrame([(7, "hot", 9, -1.0)], KEYED)
    archive.append(one, "src", 99)
    assert len(archive.ledger.head()[1]["segments"][-1]["buckets"]) == 1
    asked = archive.read(one.select("k", "g"))
    assert [r["v"] for r in asked.collect()] == [-1.0]
    assert all("_bucket=" in f for f in asked.inputFiles()) and len({f.split("_bucket=")[1].split("/")[0] for f in asked.inputFiles()}) == 1
    # A batch that comes again, with other rows even, is known.
    archive.append(spark.createDataFrame([(7, "hot", 99, 5.0)], KEYED), "src", 99)
    assert [r["v"] for r in archive.read(one).collect()] == [-1.0]
    archive.append(one.filter("k < 0"), "src", 100)
    assert archive.ledger.head()[1]["applied"] == {"src": 100}


def test_two_writers_of_an_archive_lose_nothing(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], KEYED).schema
    a, b = (KeyedArchive(spark, str(tmp_path / "a"), schema, ["k", "g"], ["ts"]) for _ in range(2))
    write = KeyedArchive._write

    def slow(self, rows):
        out = write(self, rows)
        if self is a:
            b.append(spark.createDataFrame([(2, "b", 0, 2.0)], KEYED))
        return out

    monkeypatch.setattr(KeyedArchive, "_write", slow)
    a.append(spark.createDataFrame([(1, "a", 0, 1.0)], KEYED))
    assert sorted(r["k"] for r in a.read().collect()) == [1, 2]


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "p")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        tables.write_partitioned(spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, id % 50, 99) as k", "id", "uuid() as u"), path, ["k"])
    finally:
        spark.conf.unset(size)
    assert len([f for f in os.listdir(f"{path}/k=99") if f.endswith(".parquet")]) > 1


def test_manifest_and_contract(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "Goa"), ("a", 1, "Goa"), ("b", 2, "GOA ")], "k string, d int, state string")
    m = tables.manifest(df, ["k"], "d", {"synthetic": False}).first()
    assert (m["row_count"], m["distinct_keys"], m["repeated_keys"], m["first_date"], m["last_date"]) == (3, 2, 1, 1, 2)
    tables.write_manifest(tables.manifest(df, ["k"]), str(tmp_path / "m"))
    assert tables.check_contract(df, ["k"], {"state": "goa"}).first()["status"] == "PASS"
    assert tables.check_contract(df.limit(0), ["k"]).first()["status"] == "FAIL"
