"""Points, rings and projections as Column expressions.

A ring is ``array<struct<x double, y double>>`` whose last vertex repeats the
first.  Longitude is x and latitude is y where degrees are meant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

# Mean Earth radius, compass names in clockwise order.
EARTH_KM = 6371.0
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
KM_PER_DEGREE = 111.32


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2.0)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))


def bearing_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    east = F.sin(d) * F.cos(b)
    north = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def compass_point(degrees: Column) -> Column:
    """Eight-way name; halves round up."""
    sector = F.pmod(F.floor(degrees / 45.0 + 0.5), F.lit(8)).cast("int")
    return F.element_at(F.array(*[F.lit(n) for n in COMPASS]), sector + 1)


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180.0) / 6.0) + 1).cast("int")


def utm_epsg(lat: Column, lon: Column) -> Column:
    return F.when(lat >= 0, F.lit(32600)).otherwise(F.lit(32700)) + utm_zone(lon)


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def make_ring(points: list[tuple[Column, Column]]) -> Column:
    """Ring from vertices; the first is repeated at the end."""
    closed = [*points, points[0]]
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in closed])


def ring_edges(ring: Column) -> Column:
    """array<struct<a, b>> of consecutive vertices."""
    head = F.slice(ring, 1, F.size(ring) - 1)
    tail = F.slice(ring, 2, F.size(ring) - 1)
    return F.zip_with(head, tail, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _cross(e: Column) -> Column:
    return e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]


def signed_area(ring: Column) -> Column:
    return F.aggregate(ring_edges(ring), F.lit(0.0), lambda s, e: s + _cross(e)) / 2.0


def ring_area(ring: Column) -> Column:
    """Planar area in squared ring units."""
    return F.abs(signed_area(ring))


def ring_area_km2(ring: Column) -> Column:
    """Area in km2 of a ring in degrees, with the ellipsoid's degree lengths at its mean latitude."""
    lon, lat = degree_km(vertices_mean(ring, "y"))
    return ring_area(ring) * lon * lat


def degree_km(lat: Column) -> tuple[Column, Column]:
    """Length in km of one degree of longitude and of latitude (WGS 84 series)."""
    p = F.radians(lat)
    lon = (F.cos(p) * 111412.84 - F.cos(p * 3) * 93.5 + F.cos(p * 5) * 0.118) / 1000.0
    return lon, (F.lit(111132.92) - F.cos(p * 2) * 559.82 + F.cos(p * 4) * 1.175 - F.cos(p * 6) * 0.0023) / 1000.0


def nesting(df: DataFrame, name: str) -> int:
    """1 for a ring, 2 for a polygon (outer ring, then holes), 3 for a multipolygon."""
    depth, kind = 0, df.schema[name].dataType
    while isinstance(kind, ArrayType):
        depth, kind = depth + 1, kind.elementType
    return depth


def oriented_rings(shape: Column, depth: int) -> Column:
    """All rings of a shape, outer ones counter-clockwise and holes clockwise, so that signed sums hold for the shape."""
    def turned(ring: Column, hole) -> Column:
        wrong = (signed_area(ring) > 0) if hole is True else (signed_area(ring) < 0) if hole is False else ((signed_area(ring) > 0) == hole)
        return F.when(wrong, F.reverse(ring)).otherwise(ring)

    if depth == 1:
        return F.array(turned(shape, False))
    if depth == 2:
        return F.transform(shape, lambda r, i: turned(r, i > 0))
    return F.flatten(F.transform(shape, lambda p: F.transform(p, lambda r, i: turned(r, i > 0))))


def total(rings: Column, of) -> Column:
    """Sum of ``of(ring)``."""
    return F.aggregate(rings, F.lit(0.0), lambda s, r: s + of(r))


def sweep_edges(rings: Column) -> Column:
    """array<struct<x0, y0, x1, y1, s>>: edges from left to right; s is +1 where the shape lies below, -1 above.

    Upright edges bound no area below them and are left out.
    """
    def edge(e: Column) -> Column:
        a, b = e["a"], e["b"]
        right = a["x"] < b["x"]
        lo, hi = F.when(right, a).otherwise(b), F.when(right, b).otherwise(a)
        return F.struct(
            lo["x"].alias("x0"), lo["y"].alias("y0"), hi["x"].alias("x1"), hi["y"].alias("y1"),
            F.when(right, -1.0).otherwise(1.0).alias("s"),
        )

    flat = F.flatten(F.transform(rings, ring_edges))
    return F.transform(F.filter(flat, lambda e: e["a"]["x"] != e["b"]["x"]), edge)


def edges_area(edges: Column) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda t, e: t + e["s"] * (e["x1"] - e["x0"]) * (e["y0"] + e["y1"]) / 2.0)


def height_at(edge: Column, x: Column, ground: Column) -> Column:
    """Height above ``ground`` of one of ``sweep_edges`` at ``x``."""
    return (edge["y0"] - ground) + (x - edge["x0"]) * (edge["y1"] - edge["y0"]) / (edge["x1"] - edge["x0"])


def area_below_both(width: Column, el: Column, fl: Column, eh: Column, fh: Column) -> Column:
    """Area below the lower of two lines over ``width``, from their heights at its left and right end.

    A shape is the signed sum of the strips below its edges, so the area that
    two shapes share is the signed sum of this over all pairs of their edges
    and the x each pair has in common.  Holds for concave shapes, holes and
    several parts; the ground that heights count from cancels and may lie
    anywhere, but close to the shapes fewer digits are lost.
    """
    dl, dh = el - fl, eh - fh
    ends = F.least(el, fl) + F.least(eh, fh)
    # Where the lines cross, the lower one changes.
    part = dl / (dl - dh)
    middle = el + (eh - el) * part
    crossed = part * (F.least(el, fl) + middle) + (F.lit(1.0) - part) * (middle + F.least(eh, fh))
    return width / 2.0 * F.when(dl * dh < 0, crossed).otherwise(ends)


def vertices_mean(ring: Column, axis: str) -> Column:
    n = F.size(ring) - 1
    return F.aggregate(F.slice(ring, 1, n), F.lit(0.0), lambda s, p: s + p[axis]) / n


def centroid(ring: Column) -> tuple[Column, Column]:
    """Area centroid (x, y)."""
    return shape_centroid(F.array(ring))


def shape_centroid(rings: Column) -> tuple[Column, Column]:
    """Area centroid (x, y) of oriented rings."""
    six_area = total(rings, signed_area) * 6.0

    def moment(axis: str) -> Column:
        return total(rings, lambda r: F.aggregate(
            ring_edges(r), F.lit(0.0), lambda s, e: s + (e["a"][axis] + e["b"][axis]) * _cross(e)
        ))

    return F.try_divide(moment("x"), six_area), F.try_divide(moment("y"), six_area)


def bounds(ring: Column) -> tuple[Column, Column, Column, Column]:
    """min x, min y, max x, max y."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def edge_keys(ring: Column, digits: int = 5) -> Column:
    """Direction-free text key per edge, vertices rounded to ``digits`` places."""
    def name(p: Column) -> Column:
        return F.format_string(f"%.{digits}f,%.{digits}f", p["x"], p["y"])

    def pairs(names: Column) -> Column:
        n = F.size(names) - 1
        return F.zip_with(
            F.slice(names, 1, n), F.slice(names, 2, n),
            lambda a, b: F.concat_ws("|", F.least(a, b), F.greatest(a, b)),
        )

    return bind(F.transform(ring, name), pairs)


def contains_point(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd test; points exactly on an edge may fall on either side."""
    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        straddles = (a["y"] > y) != (b["y"] > y)
        at = a["x"] + F.try_divide((y - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"])
        return F.when(straddles & (x < at), 1).otherwise(0)

    hits = F.aggregate(ring_edges(ring), F.lit(0), lambda s, e: s + crosses(e))
    return hits % 2 == 1


def signature(ring: Column) -> Column:
    """SHA-256 of a ring in canonical form.

    Canonical: counter-clockwise, started at the smallest vertex, coordinates
    printed with seven decimals.  Equal outlines give equal text wherever the
    drawing started and whichever way it ran.
    """
    open_ring = F.slice(ring, 1, F.size(ring) - 1)
    ccw = F.when(signed_area(ring) < 0, F.reverse(open_ring)).otherwise(open_ring)

    def digest(r: Column) -> Column:
        start = F.array_position(r, F.array_min(r)).cast("int")
        turned = F.concat(F.slice(r, start, F.size(r)), F.slice(r, 1, start - 1))
        text = F.transform(turned, lambda p: F.format_string("%.7f %.7f", p["x"], p["y"]))
        return F.sha2(F.array_join(text, ","), 256)

    return bind(ccw, digest)


def shape_signature(shape: Column, depth: int) -> Column:
    """Signature of a ring, a polygon with its holes, or several parts, whatever their order."""
    if depth == 1:
        return signature(shape)
    if depth == 2:
        holes = F.array_sort(F.transform(F.slice(shape, 2, F.greatest(F.size(shape) - 1, F.lit(0))), signature))
        return F.when(F.size(shape) == 1, signature(shape[0])).otherwise(F.sha2(F.concat_ws("|", signature(shape[0]), holes), 256))
    parts = F.array_sort(F.transform(shape, lambda p: shape_signature(p, 2)))
    return F.when(F.size(shape) == 1, parts[0]).otherwise(F.sha2(F.concat_ws("||", parts), 256))
