"""Areas that shapes share: a grid of many cell sizes picks the pairs, slabs of x hold the edges that meet.

No size has to be given.  Shapes of any mix of sizes and with any number of
vertices go through the same steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.functions import geo
from finecast.session import materialise

BOX = ("bx0", "by0", "bx1", "by1")
#: Cells of one level are so many times as wide as those of the level below.
GROWTH = 4.0
#: Slabs of a shape are at least as wide as so many of its edges would be, if all were alike.
SLAB_EDGES = 4


def shapes(polys: DataFrame, keys: Sequence[str], ring: str) -> DataFrame:
    """(keys, edges, area, bounding box, level, slab) of every shape, written once.

    ``level`` is the lowest whose cells hold the bounding box; a shape without
    area has no edges and meets nothing.  ``slab`` is the power of two that its
    edges are cut by: no narrower than the mean edge, so edges span three slabs
    on average at most, and slabs are not many more than edges.
    """
    e = F.col("edges")
    ys = F.concat(F.transform(e, lambda x: x["y0"]), F.transform(e, lambda x: x["y1"]))
    cut = polys.select(*keys, geo.sweep_edges(geo.oriented_rings(F.col(ring), geo.nesting(polys, ring))).alias("edges")).select(
        *keys, "edges", geo.edges_area(e).alias("area"), F.array_min(F.transform(e, lambda x: x["x0"])).alias("bx0"),
        F.array_min(ys).alias("by0"), F.array_max(F.transform(e, lambda x: x["x1"])).alias("bx1"), F.array_max(ys).alias("by1"),
        F.aggregate(e, F.lit(0.0), lambda t, x: t + x["x1"] - x["x0"]).alias("_run"),
    )
    wide = F.greatest(F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0"))
    n = F.size("edges")
    slab = F.greatest((F.col("bx1") - F.col("bx0")) * SLAB_EDGES / n, F.col("_run") / n)
    leveled = cut.filter(n > 0).withColumn("level", F.ceil(F.log(wide) / F.log(F.lit(GROWTH))).cast("int"))
    return materialise(leveled.withColumn("slab", F.ceil(F.log2(slab)).cast("int")).drop("_run"), "shapes")


def _cells(rows: DataFrame, level: Column) -> DataFrame:
    """``rows`` once per cell of ``level`` that the bounding box touches, as (cx, cy)."""
    wide = F.pow(F.lit(GROWTH), level)
    reach = lambda lo, hi: F.sequence(F.floor(F.col(lo) / wide), F.floor(F.col(hi) / wide))
    return rows.withColumn("cx", F.explode(reach("bx0", "bx1"))).withColumn("cy", F.explode(reach("by0", "by1")))


def filed(side: DataFrame, other: DataFrame, keep: Sequence[str], own_roles: Sequence[int], above_role: int) -> DataFrame:
    """(keep, box, at, cx, cy, role): the cells under which shapes of ``side`` look for shapes of ``other``.

    Every shape is filed at its own level, in four cells at most, and at those
    higher levels that a shape of ``other`` lives on.  A pair meets at the
    higher of its two levels, where one of the two is at home: roles keep
    small shapes from meeting each other in the wide cells above them.
    """
    used = other.agg(F.collect_set("level")).scalar()
    rows = side.select(*keep, *BOX, "level", used.alias("_used"))
    home = rows.select(*keep, *BOX, F.col("level").alias("at"), F.explode(F.array(*[F.lit(r) for r in own_roles])).alias("role"))
    above = rows.select(*keep, *BOX, F.explode(F.filter("_used", lambda u: u > F.col("level"))).alias("at"), F.lit(above_role).alias("role"))
    return _cells(home.unionByName(above), F.col("at"))


def meetings(left: DataFrame, right: DataFrame, a: str, b: str, by: Sequence[str], once: bool) -> DataFrame:
    """(by, a, b, areas, slabs, box of the intersection): pairs whose bounding boxes overlap; with ``once`` only a < b.

    A pair shares up to four cells and is kept in one of them, the one of the
    lower left corner of the boxes' intersection.
    """
    fl = filed(left, right, [*by, a, "area", "slab"], (0,), 1)
    fr = filed(right, left, [*by, b, "area", "slab"], (0, 1), 0)
    fr = fr.select(*by, "at", "cx", "cy", "role", b, *[F.col(c).alias(f"r{c}") for c in (*BOX, "area", "slab")])
    x, y, wide = F.greatest("bx0", "rbx0"), F.greatest("by0", "rby0"), F.pow(F.lit(GROWTH), F.col("at"))
    x1, y1 = F.least("bx1", "rbx1"), F.least("by1", "rby1")
    pairs = fl.join(fr, [*by, "at", "cx", "cy", "role"]).filter(
        (x1 > x) & (y1 > y) & (F.floor(x / wide) == F.col("cx")) & (F.floor(y / wide) == F.col("cy"))
    )
    return (pairs.filter(F.col(a) < F.col(b)) if once else pairs).select(
        *by, a, b, F.col("area").alias("area_a"), F.col("rarea").alias("area_b"), F.col("slab").alias("_ka"), F.col("rslab").alias("_kb"),
        x.alias("_x0"), x1.alias("_x1"), y.alias("_y0"),
    )


def slabs(side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, i, edges): the edges of a shape that reach into its i-th slab of x."""
    each = side.select(*keys, "slab", F.explode("edges").alias("e"))
    width = F.pow(F.lit(2.0), F.col("slab"))
    cut = each.select(*keys, F.explode(F.sequence(F.floor(F.col("e.x0") / width), F.floor(F.col("e.x1") / width))).alias("i"), "e")
    return cut.groupBy(*keys, "i").agg(F.collect_list("e").alias("edges"))


def shared_areas(left: DataFrame, right: DataFrame, a: str, b: str, by: Sequence[str], once: bool, tolerance: float) -> DataFrame:
    """(by, a, b, shared, area_a, area_b): pairs of ``shapes`` with an area in common; with ``once`` only a < b.

    A pair is one row per slab of the finer of its two shapes, within the x
    that both have; slabs are powers of two, so each lies in one slab of the
    coarser shape.  Two equality joins bring the edges of either, and edges meet
    edges of the same slab only: the work follows the edges that overlap in x,
    not the product of all edges.  Nothing of a shape outside the intersection
    is shipped.  Areas below ``tolerance`` of the smaller shape count as none.
    """
    pairs = meetings(left, right, a, b, by, once)
    fine = F.pow(F.lit(2.0), F.least("_ka", "_kb"))
    runs = pairs.withColumn("_i", F.explode(F.sequence(F.floor(F.col("_x0") / fine), F.floor(F.col("_x1") / fine))))
    lo = F.col("_i") * fine
    runs = runs.select(
        *by, a, b, "area_a", "area_b", "_y0", lo.alias("_lo"), (lo + fine).alias("_hi"),
        F.floor(lo / F.pow(F.lit(2.0), F.col("_ka"))).alias("_ia"), F.floor(lo / F.pow(F.lit(2.0), F.col("_kb"))).alias("_ib"),
    )
    # Few narrow rows may stand for many edges: spread them before the edges come in.
    runs = runs.repartition(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by, a, b, "_lo")
    side = lambda d, k, n: slabs(d, [*by, k]).withColumnsRenamed({"i": f"_i{n}", "edges": f"_e{n}"})
    met = runs.join(side(left, a, "a"), [*by, a, "_ia"]).join(side(right, b, "b"), [*by, b, "_ib"])
    keep = [*by, a, b, "area_a", "area_b"]
    each = met.withColumn("e", F.explode("_ea")).select(*keep, "_y0", "_lo", "_hi", "e", F.explode("_eb").alias("f"))
    common = each.select(*keep, "_y0", "e", "f", F.greatest("e.x0", "f.x0", "_lo").alias("lo"), F.least("e.x1", "f.x1", "_hi").alias("hi")).filter("hi > lo")
    heights = [geo.height_at(F.col(g), F.col(x), F.col("_y0")).alias(f"{g}{x}") for x in ("lo", "hi") for g in ("e", "f")]
    strips = common.select(*keep, ((F.col("hi") - F.col("lo")) * F.col("e.s") * F.col("f.s")).alias("w"), *heights)
    below = geo.area_below_both(F.col("w"), F.col("elo"), F.col("flo"), F.col("ehi"), F.col("fhi"))
    found = strips.groupBy(*keep).agg(F.sum(below).alias("shared"))
    return found.filter(F.col("shared") > F.least("area_a", "area_b") * tolerance).select(*by, a, b, "shared", "area_a", "area_b")
