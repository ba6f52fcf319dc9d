"""Nearest targets, exact at any density: a tree of adaptive cells, searched from the top by best bound."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finecast.functions import geo
from finecast.session import materialise

#: Targets that a cell may hold before it is split, four ways along each axis.
CELL_TARGETS = 16
#: Levels that one round of counting looks at, and levels in all (a double's digits).
BAND, LEVELS = 6, 26
#: Bounds are widened by this share, so that rounding never drops a tie.
SLACK = 1e-9


def _axes(metric: str) -> list[Column]:
    """Coordinates in which straight distances order like ``metric``.

    Great circles order like the chords below them, so places on the globe
    are searched as points on the unit sphere.
    """
    x, y = F.col("x"), F.col("y")
    if metric == "planar":
        return [x, y]
    lon, lat = F.radians(x), F.radians(y)
    return [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]


def _distance(metric: str) -> Column:
    if metric == "planar":
        return F.hypot(F.col("x") - F.col("tx"), F.col("y") - F.col("ty"))
    return geo.haversine_km(F.col("y"), F.col("x"), F.col("ty"), F.col("tx"))


class Tree:
    """Cells of ``targets`` (by, p: array of coordinates), each split while it holds more than ``most``.

    A cell splits four ways along each axis of its group's extent.  Rounds of
    counting look at ``BAND`` levels at a time and only at targets in cells that
    are still full; a cell is known by its level and its whole-number place.
    Every cell knows the tight box of what it holds.
    """

    def __init__(self, targets: DataFrame, by: Sequence[str], dims: int, most: int):
        self.by, self.dims, self.key = list(by), dims, [*by, "level", "cell"]
        axes = range(dims)
        ends = [f(F.col("p")[i]).alias(f"{n}{i}") for i in axes for n, f in (("lo", F.min), ("hi", F.max))]
        extent = targets.groupBy(*by).agg(*ends).select(
            *by, F.array(*[f"lo{i}" for i in axes]).alias("_lo"),
            F.greatest(*[F.col(f"hi{i}") - F.col(f"lo{i}") for i in axes], F.lit(0.0)).alias("_wide"),
        )
        if by:
            scaled = targets.join(extent, list(by))
        else:
            scaled = targets.select("*", extent.select("_lo").scalar().alias("_lo"), extent.select("_wide").scalar().alias("_wide"))
        # Place in the finest grid; the upper rim belongs to the last cell.
        finest = float(4**LEVELS)
        share = F.when(F.col("_wide") > 0, F.lit(1.0) / F.col("_wide")).otherwise(0.0)
        place = F.transform("p", lambda v, i: F.least(F.floor((v - F.get(F.col("_lo"), i)) * share * finest), F.lit(4**LEVELS - 1)))
        loose = materialise(scaled.select(*targets.columns, place.alias("_place")), "tree-targets")
        nodes, homes, level = [], [], 0
        box = [f"{n}{i}" for i in axes for n in ("lo", "hi")]
        while True:
            upto = min(level + BAND, LEVELS)
            cells = loose.withColumn("level", F.explode(F.sequence(F.lit(level + 1), F.lit(upto)))).withColumn(
                "cell", F.transform("_place", lambda v: F.floor(v / F.pow(F.lit(4.0), F.lit(LEVELS) - F.col("level"))))
            )
            counted = cells.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n"), *ends).withColumn("parent", F.transform("cell", lambda v: F.shiftright(v, 2)))
            # A cell below a cell that is not full is not there.
            above = counted.filter((F.col("n") > most) & (F.col("level") < upto)).select(*by, (F.col("level") + 1).alias("level"), F.col("cell").alias("parent"))
            held = counted.filter(F.col("level") == level + 1).unionByName(counted.join(above, [*by, "level", "parent"], "left_semi").select(*counted.columns))
            full = (F.col("n") > most) & (F.col("level") < LEVELS)
            made = materialise(held.withColumn("leaf", ~full), "tree-cells")
            nodes.append(made)
            homes.append(cells.join(made.filter("leaf").select(*self.key), self.key).select(*targets.columns, "level", "cell"))
            rest = made.filter((F.col("level") == upto) & ~F.col("leaf")).select(*self.key)
            if rest.isEmpty():
                break
            loose, level = cells.filter(F.col("level") == upto).join(rest, self.key).select(*loose.columns), upto
        #: (by, targets' columns, level, cell): every target under the leaf that holds it.
        self.homes = reduce(DataFrame.unionByName, homes)
        # A cell with one full cell in it and nothing else has that cell's count and box: such chains are one
        # cell, known by its lowest member and found under the parent of its highest.
        chains = reduce(DataFrame.unionByName, nodes).groupBy(*by, "n", *box).agg(
            F.min_by(F.struct((F.col("level") - 1).alias("level"), F.col("parent").alias("cell")), "level").alias("up"),
            F.max_by(F.struct("level", "cell", "leaf"), "level").alias("own"),
        )
        shape = F.struct("own.level", "own.cell", "own.leaf", "n", F.array(*[f"lo{i}" for i in axes]).alias("lo"), F.array(*[f"hi{i}" for i in axes]).alias("hi"))
        kids = chains.select(*by, F.col("up.level").alias("_l"), F.col("up.cell").alias("_c"), shape.alias("k"))
        self.kids = materialise(kids.groupBy(*by, "_l", "_c").agg(F.collect_list("k").alias("kids")), "tree")
        self.branching = sorted(r[0] for r in self.kids.select("_l").distinct().collect())

    def leaves(self) -> DataFrame:
        """(by, level, cell, n) of every leaf."""
        return self.kids.select(*self.by, F.explode("kids").alias("k")).filter("k.leaf").select(*self.by, "k.level", "k.cell", "k.n")

    def reach(self, spots: DataFrame, need: int) -> DataFrame:
        """(spots' columns, level, cell): the leaves that can hold one of the ``need`` nearest targets of each spot (by, p).

        Level by level, over the levels that branch at all, a spot opens the
        cells of that level and keeps those whose nearest place is within its
        bound.  The bound comes from boxes and counts alone: a tight box has a
        target on each of its faces, so the ``need``-th smallest distance to the
        farthest place on a box's best face bounds the answer, and so does the
        far corner of boxes that hold enough together.  Far from all targets as
        well as inside a cluster that leaves a few cells per spot.  Small levels
        are broadcast by their measured size, so rows then stay where they are.
        """
        cols, endless = spots.columns, F.lit(float("inf"))
        root = F.struct(
            F.lit(0.0).alias("near"), endless.alias("face"), endless.alias("far"), F.lit(0).cast("long").alias("n"),
            F.lit(0).alias("level"), F.array(*[F.lit(0).cast("long")] * self.dims).alias("cell"),
        )

        # A root without targets below it has no kids and no way on.
        # Kids beyond the bound along one axis are dropped before their own bounds are taken.
        beside = lambda q: [g <= F.col("_side") for i in range(self.dims) for g in (q["lo"][i] - F.col("p")[i], F.col("p")[i] - q["hi"][i])]
        close = F.filter("kids", lambda q: reduce(lambda a, b: a & b, beside(q)))
        opened = F.when(F.col("kids").isNotNull(), self._bounds(close, need)).when(F.col("k.level") > 0, F.array("k"))
        faces = F.get(F.sort_array(F.transform("ks", lambda q: q["face"])), F.lit(need - 1))
        first = F.array_min(F.transform("ks", lambda q: q["face"]))
        enough = F.aggregate(
            F.sort_array(F.transform("ks", lambda q: F.struct(q["far"].alias("far"), q["n"].alias("n")))),
            F.struct(F.lit(0).cast("long").alias("n"), endless.alias("r")),
            lambda s, q: F.struct((s["n"] + q["n"]).alias("n"), F.when((s["n"] < need) & (s["n"] + q["n"] >= need), q["far"]).otherwise(s["r"]).alias("r")),
        )["r"]
        # One face is never beyond the far corner of its box, so for one target the first face is all it takes.
        bound = F.least("_r", *[c * (1 + SLACK) for c in ([first] if need == 1 else [F.coalesce(faces, endless), enough])]).alias("_r")
        within = F.explode(F.filter("ks", lambda q: q["near"] <= F.col("_r"))).alias("k")
        open_ = spots.select(*cols, endless.alias("_r"), root.alias("k"))
        for level in self.branching:
            kids = self.kids.filter(F.col("_l") == level).drop("_l")
            seen = open_.withColumn("_c", F.when(F.col("k.level") == level, F.col("k.cell"))).join(kids, [*self.by, "_c"], "left")
            seen = seen.withColumn("_side", F.sqrt("_r") * (1 + SLACK)).select(*cols, "_r", F.explode(opened).alias("k")).filter("k.near <= _r")
            each = seen.groupBy(*cols).agg(F.min("_r").alias("_r"), F.collect_list("k").alias("ks"))
            open_ = each.select(*cols, bound, "ks").select(*cols, "_r", within)
        return open_.filter("k.level > 0").select(*cols, "k.level", "k.cell")

    def _bounds(self, kids: Column, need: int) -> Column:
        """``kids`` with their squared distances from ``p``: nearest place, farthest place of the best face, farthest corner.

        Each step is an array of its own, so that no distance along an axis is
        taken twice.  For one target the far corner is not looked at.
        """
        axes = range(self.dims)
        plus = lambda cols: reduce(lambda a, b: a + b, cols)
        ends = F.transform(kids, lambda q: F.struct(
            q.alias("q"), *[(F.col("p")[i] - q[e][i]).alias(f"{e}{i}") for i in axes for e in ("lo", "hi")]
        ))
        sides = F.transform(ends, lambda s: F.struct(
            s["q"].alias("q"), *[F.greatest(-s[f"lo{i}"], s[f"hi{i}"], F.lit(0.0)).alias(f"gap{i}") for i in axes],
            *[f(F.abs(s[f"lo{i}"]), F.abs(s[f"hi{i}"])).alias(f"{n}{i}") for i in axes for n, f in (("close", F.least), ("far", F.greatest))],
        ))
        square = lambda s, n, i: s[f"{n}{i}"] * s[f"{n}{i}"]
        faces = lambda s: [plus([square(s, "close", i), *[square(s, "far", j) for j in axes if j != i]]) for i in axes]
        return F.transform(sides, lambda s: F.struct(
            plus([square(s, "gap", i) for i in axes]).alias("near"), (F.least(*faces(s)) if self.dims > 1 else faces(s)[0]).alias("face"),
            (F.lit(float("inf")) if need == 1 else plus([square(s, "far", i) for i in axes])).alias("far"),
            s["q"]["n"].alias("n"), s["q"]["level"].alias("level"), s["q"]["cell"].alias("cell"),
        ))


def nearest(
    points: DataFrame, targets: DataFrame, key: str, target_key: str, k: int, by: Sequence[str] = (), same_table: bool = False, metric: str = "planar"
) -> DataFrame:
    """(by, key, other, tx, ty, distance, rank): the ``k`` nearest targets of each point, ties by id.

    Both tables carry ``x`` and ``y``; with ``metric="globe"`` these are
    longitude and latitude in degrees and distances are great circles in km.
    Targets sharing one spot are reduced to their ``k + 1`` smallest ids first
    (no other can be among the nearest), and points sharing one spot are
    searched once.  Rows without coordinates find nothing and are not found.
    """
    by, need = list(by), k + same_table
    here = ~(F.isnan(F.coalesce("x", F.lit(float("nan")))) | F.isnan(F.coalesce("y", F.lit(float("nan")))))
    spot = Window.partitionBy(*by, "x", "y").orderBy(target_key)
    slim = targets.filter(here).withColumn("_rn", F.row_number().over(spot)).filter(F.col("_rn") <= k + 1)
    p = F.array(*[c.cast("double") for c in _axes(metric)]).alias("p")
    tree = Tree(slim.select(*by, F.col(target_key).alias("_t"), F.col("x").alias("tx"), F.col("y").alias("ty"), p), by, len(_axes(metric)), max(CELL_TARGETS, 2 * need))
    # Few bytes and much work: spots are dealt to as many tasks as are set for shuffles, by ``p``, so that
    # this is no repeat of the deal before it, whose tasks are merged by bytes.
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spots = points.filter(here).select(*by, "x", "y").distinct().select(*by, "x", "y", p).repartition(tasks, "p")
    pairs = tree.reach(spots, need).join(tree.homes.drop("p"), tree.key).select(*by, "x", "y", "_t", "tx", "ty", _distance(metric).alias("distance"))
    best = Window.partitionBy(*by, "x", "y").orderBy("distance", "_t")
    found = pairs.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= need)
    asked = points.filter(here).select(*by, F.col(key).alias("_p"), "x", "y")
    rows = asked.join(found, [*by, "x", "y"])
    if same_table:
        rows = rows.filter(F.col("_t") != F.col("_p"))
    own = Window.partitionBy(*by, "_p").orderBy("distance", "_t")
    return rows.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k).select(
        *by, F.col("_p").alias(key), F.col("_t").alias("other"), "tx", "ty", "distance", "rank"
    )
