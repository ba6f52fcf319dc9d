"""GeoJSON feature collections in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finecast.errors import DataContractError

# Accepted spellings of the geographic reference system.
GEOGRAPHIC_CRS = ("EPSG:4326", "urn:ogc:def:crs:OGC:1.3:CRS84", "urn:ogc:def:crs:EPSG::4326")


def read_geojson(spark: SparkSession, path: str, properties: Mapping[str, str], id_col: str) -> DataFrame:
    """S-03: polygon features as rows: properties, ``parts``, and of the first part ``rings`` and ``ring`` (its outer one).

    A Polygon has one part, a MultiPolygon as many as it states; a part is its
    outer ring and its holes.  Many collections may lie under ``path``; one of
    any size is read by many tasks (``_cut_features``) as long as its features
    state their type first, as writers do.  Refused: another reference system,
    a collection without features, other geometries, an unclosed or too short
    ring, blank or repeated ids.
    """
    props = ", ".join(f"{k}: {t}" for k, t in properties.items())
    rows = _cut_features(spark, path, props)
    return _checked(rows if rows is not None else _whole_features(spark, path, props), properties, id_col)


#: The mark that every feature has once, and what stands before it.
MARK, OPENING = '"Feature"', '{"type":"Feature"'


def _cut_features(spark: SparkSession, path: str, props: str) -> DataFrame | None:
    """Features (f) of collections cut at the mark, in byte ranges; None where a cut piece is not one feature.

    A piece runs from one mark to the next, so with its opening put back it
    starts with the rest of one feature; what follows that is not looked at.  The
    piece before a collection's first mark is its head.  Whatever does not come
    out as one head and whole features per file (a type that is not stated
    first, the mark inside a text) is left to :func:`_whole_features`.
    """
    schema = f"properties struct<{props}>, geometry struct<type: string, coordinates: string>, _broken string"
    pieces = spark.read.option("lineSep", MARK).text(path).select("value", F.col("_metadata.file_path").alias("file"))
    read = pieces.withColumn("head", F.contains("value", F.lit('"FeatureCollection"'))).withColumn(
        "f", F.from_json(F.concat(F.lit(OPENING), "value"), schema, {"columnNameOfCorruptRecord": "_broken"})
    )
    whole = F.col("f._broken").isNull() & F.col("f.properties").isNotNull() & F.col("f.geometry").isNotNull()
    crs = F.regexp_extract("value", r'"crs"\s*:\s*\{[^{}]*\{[^{}]*"name"\s*:\s*"([^"]*)"', 1)
    files = read.groupBy("file").agg(
        F.count_if("head").alias("heads"), F.count_if(~F.col("head") & F.coalesce(whole, F.lit(False))).alias("whole"), F.count(F.lit(1)).alias("n"),
        F.count_if((crs != "") & ~crs.isin(*GEOGRAPHIC_CRS)).alias("crs"),
    )
    c = files.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("heads") != 1) | (F.col("whole") + 1 != F.col("n")) | (F.col("whole") < 1)).alias("other"), F.sum("crs").alias("crs")).first()
    if not c["n"] or c["other"]:
        return None
    if c["crs"]:
        raise DataContractError("coordinates are not geographic (EPSG:4326)")
    return read.filter("not head").select(F.struct("f.properties", "f.geometry").alias("f"))


def _whole_features(spark: SparkSession, path: str, props: str) -> DataFrame:
    """Features (f) of collections that are read one document a task."""
    schema = (
        "type string, crs struct<properties: struct<name: string>>, features array<struct<"
        f"properties: struct<{props}>, geometry: struct<type: string, coordinates: string>>>"
    )
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    crs = F.col("crs.properties.name")
    bad = docs.agg(
        F.count_if(crs.isNotNull() & ~crs.isin(*GEOGRAPHIC_CRS)).alias("crs"),
        F.count_if(F.coalesce(F.size("features"), F.lit(0)) < 1).alias("empty"), F.count(F.lit(1)).alias("n"),
    ).first()
    if bad["n"] == 0 or bad["empty"]:
        raise DataContractError("feature collection without features")
    if bad["crs"]:
        raise DataContractError("coordinates are not geographic (EPSG:4326)")
    return docs.select(F.explode("features").alias("f"))


def _checked(rows: DataFrame, properties: Mapping[str, str], id_col: str) -> DataFrame:
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    polygon = "array<array<array<double>>>"
    drawn = F.when(kind == "Polygon", F.array(F.from_json(text, polygon))).when(kind == "MultiPolygon", F.from_json(text, f"array<{polygon}>"))
    parts = F.transform(drawn, lambda p: F.transform(p, lambda r: F.transform(r, lambda v: F.struct(v[0].alias("x"), v[1].alias("y")))))
    out = rows.select(*[F.col(f"f.properties.{k}").alias(k) for k in properties], parts.alias("parts"), kind.alias("geometry_type"))
    out = out.withColumn("rings", F.get("parts", F.lit(0))).withColumn("ring", F.get("rings", F.lit(0)))
    closed = lambda r: (F.size(r) >= 4) & (r[0] == F.element_at(r, -1))
    shape = (F.size("parts") > 0) & F.forall("parts", lambda p: (F.size(p) > 0) & F.forall(p, closed))
    per_id = out.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(shape, F.lit(False))).alias("bad")
    )
    c = per_id.agg(
        F.count_if(F.col(id_col).isNull() | (F.trim(F.col(id_col).cast("string")) == "")).alias("blank"),
        F.count_if(F.col("n") > 1).alias("repeated"), F.sum("bad").alias("shape"),
    ).first()
    if c["blank"] or c["repeated"] or c["shape"]:
        raise DataContractError(f"features break the contract: {c.asDict()}")
    return out


def write_geojson(df: DataFrame, path: str, attributes: Sequence[str], rings: str = "rings") -> None:
    """S-04: one feature per line (a GeoJSON text sequence), written in parallel.

    A single enclosing document would force all features through one task;
    line-wise features are read by the same tools and by :func:`read_features`.
    """
    df.select(feature_json(attributes, rings).alias("value")).write.mode("overwrite").text(path)


def feature_json(attributes: Sequence[str], rings: str = "rings"):
    coordinates = F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"), F.struct(*attributes).alias("properties"),
            F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"),
        ),
        {"ignoreNullFields": "false"},
    )


def read_features(spark: SparkSession, path: str, properties: Mapping[str, str]) -> DataFrame:
    """Features written by :func:`write_geojson`."""
    props = ", ".join(f"{k}: {t}" for k, t in properties.items())
    schema = f"type string, properties struct<{props}>, geometry struct<type: string, coordinates: array<array<array<double>>>>"
    rows = spark.read.schema(schema).json(path)
    rings = F.transform(
        "geometry.coordinates", lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    )
    return rows.select("properties.*", rings.alias("rings"))


def write_collection(features: DataFrame, path: str, attributes: Sequence[str], max_features: int = 50_000, rings: str = "rings") -> None:
    """One FeatureCollection document per area; refused above ``max_features`` per document.

    Use per area (block), whose feature count is small by nature and checked here.
    """
    n = features.limit(max_features + 1).count()
    if n > max_features:
        raise DataContractError(f"more than {max_features} features in one document; use write_geojson")
    doc = features.agg(F.collect_list(feature_json(attributes, rings)).alias("f")).select(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join("f", ","), F.lit("]}")).alias("value")
    )
    doc.coalesce(1).write.mode("overwrite").text(path)
