"""Polygon and neighbour jobs on cell grids.

Cells are equi-join keys that only pre-select pairs; areas are exact, from the
edges of the pair (``grid``).  Shapes may be rings, polygons with holes, or
several parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finecast.functions import geo
from finecast.operators import grid as cells
from finecast.operators.nearest import nearest
from finecast.session import materialise


#: Areas that differ by less than this share count as equal, and smaller ones as none.
TOLERANCE = 1e-9


def membership(polys: DataFrame, zones: DataFrame, poly_key: str, zone_key: str, ring: str = "ring") -> DataFrame:
    """J-08: zones each polygon meets, with exact area and share of the polygon.

    Rows of one polygon key are its parts, rows of one zone key the zone's.
    """
    def parts(df: DataFrame, key: str, name: str) -> DataFrame:
        named = df.select(F.struct(F.col(key).alias("k"), F.xxhash64(ring).alias("h")).alias(name), F.col(ring).alias("_ring"))
        return cells.shapes(named.dropDuplicates([name]), [name], "_ring")

    p, z = parts(polys, poly_key, "_p"), parts(zones, zone_key, "_z")
    total = p.groupBy(F.col("_p.k").alias(poly_key)).agg(F.sum("area").alias("_total"))
    hit = cells.shared_areas(p, z, "_p", "_z", [], False, TOLERANCE)
    areas = hit.groupBy(F.col("_p.k").alias(poly_key), F.col("_z.k").alias(zone_key)).agg(F.sum("shared").alias("overlap_area"))
    return areas.join(total, poly_key).select(
        poly_key, zone_key, "overlap_area", (F.lit(100.0) * F.col("overlap_area") / F.col("_total")).alias("overlap_pct"),
    )


def distinct_outlines(polys: DataFrame, key: str, by: Sequence[str] = (), ring: str = "ring") -> DataFrame:
    """One row per outline (within ``by``): smallest id, number of ids drawn with it.

    Copies of one outline are merged before any overlap join, so a shape
    repeated by a third of all rows stays one row.
    """
    return (
        polys.withColumn("signature", geo.shape_signature(F.col(ring), geo.nesting(polys, ring)))
        .groupBy(*by, "signature")
        .agg(
            F.min(key).alias("first_id"),
            F.count(F.lit(1)).alias("n_copies"),
            F.any_value(ring).alias(ring),
        )
    )


def _relation(shared: Column, a: Column, b: Column) -> Column:
    near = lambda v: F.abs(shared - v) <= v * TOLERANCE
    return (
        F.when(near(a) & near(b), "IDENTICAL")
        .when(near(b), "A_CONTAINS_B")
        .when(near(a), "B_CONTAINS_A")
        .otherwise("OVERLAPPING")
    )


def _overlaps(polys: DataFrame, key: str, by: Sequence[str], ring: str) -> DataFrame:
    """Pairs of distinct outlines a < b (within ``by``) that share an area.

    ``a`` and ``b`` are the smallest ids drawn with each outline and
    ``n_pairs`` the id pairs behind the row; copies of one outline are one
    IDENTICAL row with a = b.
    """
    by = list(by)
    outlines = materialise(distinct_outlines(polys, key, by, ring), "outlines")
    shapes = cells.shapes(outlines, [*by, "first_id"], ring)
    other = lambda n: shapes.withColumnRenamed("first_id", n)
    pairs = cells.shared_areas(other("a"), other("b"), "a", "b", by, True, TOLERANCE)
    copies = lambda n: outlines.select(*by, F.col("first_id").alias(n), F.col("n_copies").alias(f"c{n}"))
    between = pairs.join(copies("a"), [*by, "a"]).join(copies("b"), [*by, "b"]).select(
        *by, "a", "b", "shared", "area_a", "area_b", (F.col("ca") * F.col("cb")).alias("n_pairs")
    )
    among = shapes.join(outlines.filter("n_copies > 1").select(*by, "first_id", "n_copies"), [*by, "first_id"]).select(
        *by, F.col("first_id").alias("a"), F.col("first_id").alias("b"), F.col("area").alias("shared"),
        F.col("area").alias("area_a"), F.col("area").alias("area_b"),
        (F.col("n_copies") * (F.col("n_copies") - 1) / 2).cast("long").alias("n_pairs"),
    )
    return between.unionByName(among).select(
        *by,
        "a",
        "b",
        _relation(F.col("shared"), F.col("area_a"), F.col("area_b")).alias("relation"),
        F.col("shared").alias("overlap_area"),
        (F.lit(100.0) * F.col("shared") / F.least("area_a", "area_b")).alias("overlap_pct_of_smaller"),
        "n_pairs",
    )


def same_id_pairs(parts: DataFrame, by: Sequence[str], part: str, ring: str = "ring") -> DataFrame:
    """J-11: relation of the parts filed under one id, for all parts that meet."""
    return _overlaps(parts, part, by, ring)


def same_id_summary(parts: DataFrame, by: Sequence[str], part: str, ring: str = "ring") -> DataFrame:
    """J-11 per id: pairs of each relation; DISJOINT is counted, not enumerated."""
    met = same_id_pairs(parts, by, part, ring)
    kinds = ("IDENTICAL", "A_CONTAINS_B", "B_CONTAINS_A", "OVERLAPPING")
    counted = met.groupBy(*by).agg(
        *[F.coalesce(F.sum(F.when(F.col("relation") == k, F.col("n_pairs"))), F.lit(0)).alias(k.lower()) for k in kinds]
    )
    n = parts.groupBy(*by).agg(F.count(F.lit(1)).alias("n_parts"))
    filled = n.join(counted, list(by), "left").na.fill(0)
    pairs = (F.col("n_parts") * (F.col("n_parts") - 1) / 2).cast("long")
    met_pairs = sum((F.col(k.lower()) for k in kinds), F.lit(0))
    return filled.withColumn("disjoint", pairs - met_pairs)


def cross_overlaps(polys: DataFrame, key: str, ring: str = "ring") -> DataFrame:
    """J-12: positive-area overlaps between distinct outlines, each pair once."""
    return _overlaps(polys, key, [], ring).drop("overlap_pct_of_smaller")


def touching(polys: DataFrame, key: str, by: Sequence[str], ring: str = "ring", digits: int = 5) -> DataFrame:
    """Pairs (both directions) that share at least one outline edge, with the edge count."""
    edges = polys.select(*by, key, F.explode(F.array_distinct(geo.edge_keys(F.col(ring), digits))).alias("_edge"))
    other = edges.withColumnRenamed(key, "other")
    return (
        edges.join(other, [*by, "_edge"])
        .filter(F.col(key) != F.col("other"))
        .groupBy(*by, key, "other")
        .agg(F.count(F.lit(1)).alias("shared_edges"))
    )


def nearest_cell(points: DataFrame, grid: DataFrame, key: str, node: str, by: Sequence[str] = (), metric: str = "planar") -> DataFrame:
    """J-09: closest grid node of each point."""
    return nearest(points, grid, key, node, 1, by, metric=metric).select(*by, key, F.col("other").alias(node), "distance")


def neighbours(
    polys: DataFrame, key: str, by: Sequence[str], limit: int = 4, ring: str = "ring"
) -> DataFrame:
    """J-10: touching areas first (shared edges, then distance, then id), then the nearest others.

    Outlines are compared once per distinct drawing, and each drawing offers
    its ``limit + 1`` smallest ids, so copies do not multiply.  For the second
    part the ``limit`` nearest are enough: with ``t`` touching areas at most
    ``t`` of them can be taken already.
    """
    by = list(by)
    x, y = geo.centroid(F.col(ring))
    # Written once: outlines, offers and points all start from it.
    tagged = materialise(
        polys.select(*by, key, ring, geo.signature(F.col(ring)).alias("_sig"), x.alias("x"), y.alias("y")), "outlines"
    )
    order = Window.partitionBy(*by, "_sig").orderBy(key)
    reps = (
        tagged.withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") <= limit + 1)
        .select(*by, F.col("_sig").alias("_osig"), F.col(key).alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    )
    shapes = tagged.groupBy(*by, "_sig").agg(F.any_value(ring).alias(ring), F.min("x").alias("x"), F.min("y").alias("y"))
    between = touching(shapes, "_sig", by, ring).withColumnRenamed("other", "_osig")
    own = shapes.select(
        *by, "_sig", F.col("_sig").alias("_osig"),
        F.size(F.array_distinct(geo.edge_keys(F.col(ring)))).cast("long").alias("shared_edges"),
    )
    best = Window.partitionBy(*by, "_sig").orderBy(F.col("shared_edges").desc(), "distance", "other")
    offers = (
        between.unionByName(own)
        .join(shapes.drop(ring), [*by, "_sig"])
        .join(reps, [*by, "_osig"])
        .withColumn("distance", F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy")))
        .withColumn("_rn", F.row_number().over(best))
        .filter(F.col("_rn") <= limit + 1)
        .select(*by, "_sig", "other", "shared_edges", "distance")
    )
    touch = tagged.select(*by, key, "_sig").join(offers, [*by, "_sig"]).filter(F.col(key) != F.col("other")).drop("_sig")
    pts = tagged.select(*by, key, "x", "y")
    near = nearest(pts, pts, key, key, limit, by, same_table=True).select(
        *by, key, "other", F.lit(0).cast("long").alias("shared_edges"), "distance"
    )
    merged = touch.unionByName(near).groupBy(*by, key, "other").agg(
        F.max("shared_edges").alias("shared_edges"), F.min("distance").alias("distance")
    )
    final = Window.partitionBy(*by, key).orderBy(F.col("shared_edges").desc(), "distance", "other")
    return merged.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= limit)


def terrain(grid: DataFrame, by: Sequence[str], z: str = "z", cell: float = 1.0, radius: int = 1) -> DataFrame:
    """X-08: slope, aspect, local std (TRI), z minus local mean (TPI), Laplacian.

    Every cell sends its height to the cells it influences; one grouped
    aggregate per cell follows.  Neighbourhood: circle of ``radius`` cells;
    gradients use the 3 x 3 weights of Horn and stay NULL at the rim.
    """
    near = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if i * i + j * j <= radius * radius]
    offsets = sorted(set(near) | {(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)})
    table = F.array(
        *[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"), F.lit((i, j) in near).alias("in_circle")) for i, j in offsets]
    )
    sent = grid.select(*by, "x", "y", F.col(z).alias("_z"), F.explode(table).alias("o")).select(
        *by, (F.col("x") - F.col("o.dx")).alias("x"), (F.col("y") - F.col("o.dy")).alias("y"), "_z", "o.dx", "o.dy", "o.in_circle"
    )
    dx, dy, v = F.col("dx"), F.col("dy"), F.col("_z")
    in3 = (F.abs(dx) <= 1) & (F.abs(dy) <= 1)
    centre = (dx == 0) & (dy == 0)
    east = F.when(in3 & (dx != 0), dx * F.when(dy == 0, 2).otherwise(1) * v)
    north = F.when(in3 & (dy != 0), dy * F.when(dx == 0, 2).otherwise(1) * v)
    cross = F.when(centre, v * -4).when((F.abs(dx) + F.abs(dy)) == 1, v)
    got = sent.groupBy(*by, "x", "y").agg(
        F.max(F.when(centre, v)).alias("z"),
        F.count(F.when(in3, v)).alias("_n9"),
        F.count(F.when((F.abs(dx) + F.abs(dy)) <= 1, v)).alias("_n5"),
        F.sum(east).alias("_e"),
        F.sum(north).alias("_n"),
        F.sum(cross).alias("_lap"),
        F.avg(F.when(F.col("in_circle"), v)).alias("_mean"),
        F.stddev_pop(F.when(F.col("in_circle"), v)).alias("tri"),
    )
    gx = F.when(F.col("_n9") == 9, F.col("_e") / (8.0 * cell))
    gy = F.when(F.col("_n9") == 9, F.col("_n") / (8.0 * cell))
    # Downslope direction; flat ground counts as 0 degrees.
    aspect = F.when((gx == 0) & (gy == 0), F.lit(0.0)).otherwise(F.atan2(-gx, -gy))
    return got.filter("z is not null").select(
        *by,
        "x",
        "y",
        "z",
        F.degrees(F.atan(F.hypot(gx, gy))).alias("slope_deg"),
        F.sin(aspect).alias("aspect_sin"),
        F.cos(aspect).alias("aspect_cos"),
        "tri",
        (F.col("z") - F.col("_mean")).alias("tpi"),
        F.when(F.col("_n5") == 5, F.col("_lap")).alias("laplacian_curvature"),
    )
