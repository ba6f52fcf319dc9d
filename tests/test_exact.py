"""Distributed algorithms against brute force, with hot groups."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from finecast.functions import geo
from finecast.operators import joins, spatial
from finecast.operators.quantiles import exact_quantiles
from finecast.session import materialise


def skewed(spark, n=3000):
    """A third of all rows in one group, half of them one value."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{i % 7}"
        rows.append((g, 1.0 if i % 6 == 0 else rng.gauss(0, 100) ** 3))
    return pd.DataFrame(rows, columns=["g", "v"])


@pytest.mark.parametrize("group_values", [100_000, 50])
def test_quantiles_match_numpy(spark, group_values):
    pdf = skewed(spark)
    probs = {"p0": 0.0, "p10": 0.1, "med": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    got = exact_quantiles(spark.createDataFrame(pdf), ["g"], "v", probs, group_values=group_values, slices=16).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        for n, p in probs.items():
            assert got.loc[g, n] == pytest.approx(np.quantile(part["v"], p), rel=1e-12), (g, n)


def test_quantiles_of_the_whole_table(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "v double")
    for limit in (100, 3):
        assert exact_quantiles(df, [], "v", {"q": 0.25}, group_values=limit, slices=4).collect() == [(2.5,)]


def cluster(n, seed):
    """Dense cluster, exact copies of one spot, and a sparse rest."""
    rng = np.random.default_rng(seed)
    x, y = rng.uniform(0, 1000, n), rng.uniform(0, 1000, n)
    third = n // 3
    x[:third] = 500 + rng.normal(0, 0.01, third)
    y[:third] = 500 + rng.normal(0, 0.01, third)
    x[third : third + 20], y[third : third + 20] = 7.0, 7.0
    return pd.DataFrame({"id": np.arange(n), "x": x, "y": y})


def brute(p, t, k, same):
    out = set()
    for i, px, py in p.itertuples(index=False):
        d = np.hypot(px - t["x"].to_numpy(), py - t["y"].to_numpy())
        order = sorted((dd, j) for dd, j in zip(d, t["id"]) if not (same and j == i))[:k]
        out |= {(i, j, r + 1) for r, (_, j) in enumerate(order)}
    return out


@pytest.mark.parametrize("same,k", [(True, 4), (False, 1)])
def test_nearest_is_exact_for_any_density(spark, same, k):
    p = cluster(240, 1)
    t = p if same else cluster(90, 2)
    got = spatial.nearest(spark.createDataFrame(p), spark.createDataFrame(t), "id", "id", k, same_table=same)
    assert {(r["id"], r["other"], r["rank"]) for r in got.collect()} == brute(p, t, k, same)


def test_nearest_with_fewer_targets_than_asked(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 0.0), (3, 0.0, 900.0)], "id long, x double, y double")
    got = {(r["id"], r["other"]) for r in spatial.nearest(df, df, "id", "id", 5, same_table=True).collect()}
    assert got == {(1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)}


def test_spots_are_dealt_by_number_not_by_bytes(spark):
    """A spot has few bytes and costs much: tasks merged by bytes would leave all spots to one."""
    df = spark.createDataFrame(cluster(50, 3))
    plan = spatial.nearest(df, df, "id", "id", 1, same_table=True)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


@pytest.mark.parametrize("strict", [True, False])
def test_asof_matches_pandas(spark, strict):
    rng = np.random.default_rng(3)
    left = pd.DataFrame({"g": np.where(np.arange(400) % 3 == 0, 0, np.arange(400) % 9), "t": pd.to_datetime("2020-01-01") + pd.to_timedelta(rng.integers(0, 500, 400), "D"), "i": range(400)})
    right = pd.DataFrame({"g": np.where(np.arange(300) % 3 == 0, 0, np.arange(300) % 9), "s": pd.to_datetime("2020-01-01") + pd.to_timedelta(rng.integers(0, 500, 300), "D"), "v": rng.normal(size=300)})
    right = right.drop_duplicates(["g", "s"])
    want = pd.merge_asof(left.sort_values("t"), right.sort_values("s"), left_on="t", right_on="s", by="g", allow_exact_matches=not strict).sort_values("i")
    got = joins.asof_join(spark.createDataFrame(left), spark.createDataFrame(right), ["g"], "t", "s", ["v"], strict=strict).orderBy("i").toPandas()
    assert len(got) == 400
    assert ((got["v"] - want["v"].to_numpy()).abs().fillna(0) == 0).all() and (got["v"].isna().to_numpy() == want["v"].isna().to_numpy()).all()


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


RING = "array<struct<x: double, y: double>>"


def shapes(spark):
    sq = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    data = [
        (1, ring(sq(0, 0, 4))), (2, ring(list(reversed(sq(0, 0, 4))))), (3, ring(sq(1, 1, 2))), (4, ring(sq(3, 3, 3))),
        (5, ring([(10, 0), (14, 0), (14, 2), (12, 2), (12, 4), (10, 4)])), (6, ring(sq(4, 0, 2))),
    ]
    return spark.createDataFrame(data, f"id int, ring {RING}")


def test_ring_measures(spark):
    r = shapes(spark).filter("id = 5").select(geo.ring_area(F.col("ring")), geo.utm_zone(F.lit(73.9)), *geo.centroid(F.col("ring"))).first()
    assert r[0] == 12.0 and r[1] == 43
    assert (r[2], r[3]) == (pytest.approx(140 / 12), pytest.approx(20 / 12))


def test_signature_ignores_start_and_direction(spark):
    s = {r["id"]: r["s"] for r in shapes(spark).select("id", geo.signature(F.col("ring")).alias("s")).collect()}
    assert s[1] == s[2] and len(set(s.values())) == 5


def test_cross_overlaps(spark):
    got = {(r["a"], r["b"]): (r["relation"], r["overlap_area"], r["n_pairs"]) for r in spatial.cross_overlaps(shapes(spark), "id").collect()}
    assert got == {(1, 1): ("IDENTICAL", 16.0, 1), (1, 3): ("A_CONTAINS_B", 4.0, 2), (1, 4): ("OVERLAPPING", 1.0, 2)}


def test_membership_of_concave_shape(spark):
    zones = spark.createDataFrame([("w", ring([(10, 0), (12, 0), (12, 4), (10, 4)])), ("e", ring([(12, 0), (16, 0), (16, 4), (12, 4)]))], f"z string, ring {RING}")
    got = {r["z"]: (r["overlap_area"], r["overlap_pct"]) for r in spatial.membership(shapes(spark).filter("id = 5"), zones, "id", "z").collect()}
    assert got["w"][0] == 8.0 and got["e"][0] == 4.0 and got["w"][1] == pytest.approx(200 / 3)


def test_neighbours_put_touching_first_and_copies_do_not_multiply(spark):
    sq = lambda x, y: ring([(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)])
    data = [("b", i, sq(0, 0)) for i in range(50)] + [("b", 100, sq(1, 0)), ("b", 101, sq(5, 0))]
    df = spark.createDataFrame(data, f"b string, id int, ring {RING}")
    got = spatial.neighbours(df, "id", ["b"]).orderBy("id", "rank").toPandas()
    assert len(got) == 52 * 4
    assert got[got["id"] == 0]["other"].tolist() == [1, 2, 3, 4]
    assert got[got["id"] == 49]["other"].tolist() == [0, 1, 2, 3]
    assert got[got["id"] == 100]["other"].tolist() == [0, 1, 2, 3]
    assert got[got["id"] == 101]["other"].tolist() == [100, 0, 1, 2]


def test_terrain_of_a_plane(spark):
    grid = spark.createDataFrame([("z", x, y, 2.0 * x) for x in range(5) for y in range(5)], "zone string, x int, y int, z double")
    r = spatial.terrain(grid, ["zone"]).filter("x = 2 and y = 2").first()
    assert r["slope_deg"] == pytest.approx(math.degrees(math.atan(2))) and r["laplacian_curvature"] == 0.0 and r["tpi"] == 0.0
    assert (r["aspect_sin"], r["aspect_cos"]) == (pytest.approx(-1.0), pytest.approx(0.0, abs=1e-12))
    assert spatial.terrain(grid, ["zone"]).filter("x = 0 and y = 0").first()["slope_deg"] is None


def test_position_by_ranges_when_one_date_holds_most_rows(spark):
    from finecast.operators.ordered import position
    from finecast.operators.training import row_split

    df = spark.range(900).selectExpr("if(id % 3 = 0, 5, id % 40) as d", "id * 31 % 900 as k")
    want = df.toPandas().sort_values(["d", "k"]).reset_index(drop=True)
    got = position(df, [], ["d", "k"]).orderBy("pos").toPandas()
    assert got["pos"].tolist() == list(range(900)) and (got[["d", "k"]].to_numpy() == want[["d", "k"]].to_numpy()).all()
    sizes = {r["split"]: r["count"] for r in row_split(df, ["d", "k"]).groupBy("split").count().collect()}
    assert sizes == {"train": 630, "validation": 135, "test": 135}


def polygon(*rings):
    return [ring(r) for r in rings]


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def test_overlaps_are_exact_off_the_grid(spark):
    """Tiny, shifted, concave, holed and multipart shapes; areas in closed form."""
    shape = f"array<array<{RING}>>"
    parts = [
        (1, [polygon(box(0.1, 0.1, 3, 3))]),
        (2, [polygon(box(0.35, 0.35, 0.3, 0.3))]),  # no cell centre inside
        (3, [polygon(box(-1, -1, 6, 6), box(0.2, 0.2, 2, 2))]),  # a frame around a hole
        (4, [polygon(box(2.9, 0, 1, 1)), polygon(box(-0.5, 2.5, 1, 1))]),  # two parts
        (5, [polygon([(0.1, 0.1), (3.1, 0.1), (0.1, 3.1)])]),
        (6, [polygon(box(100, 100, 1e-3, 1e-3))]),
    ]
    df = spark.createDataFrame(parts, f"id int, ring {shape}")
    got = {(r["a"], r["b"]): (r["relation"], round(r["overlap_area"], 9)) for r in spatial.cross_overlaps(df, "id").collect()}
    assert got == {
        (1, 2): ("A_CONTAINS_B", 0.09), (1, 3): ("OVERLAPPING", 5.0), (1, 4): ("OVERLAPPING", 0.42), (1, 5): ("A_CONTAINS_B", 4.5),
        (2, 5): ("B_CONTAINS_A", 0.09), (3, 4): ("A_CONTAINS_B", 2.0), (3, 5): ("OVERLAPPING", 1.22), (4, 5): ("OVERLAPPING", 0.18),
    }


def test_membership_keeps_tiny_polygons(spark):
    zones = spark.createDataFrame([("z", ring(box(0, 0, 10, 10)))], f"z string, ring {RING}")
    small = spark.createDataFrame([(1, ring(box(0.1, 0.1, 0.3, 0.3))), (2, ring(box(9.75, 3, 0.5, 0.5))), (3, ring(box(10, 0, 1, 1)))], f"id int, ring {RING}")
    got = {r["id"]: (r["overlap_area"], r["overlap_pct"]) for r in spatial.membership(small, zones, "id", "z").collect()}
    assert set(got) == {1, 2}
    assert got[1] == (pytest.approx(0.09), pytest.approx(100)) and got[2] == (pytest.approx(0.125), pytest.approx(50))


def test_one_country_among_villages_is_filed_in_few_cells(spark):
    """One shape ten thousand times as wide as most, a third of the small ones in one spot: few cells each, all pairs."""
    from finecast.operators import grid

    rng = np.random.default_rng(11)
    boxes = [(0, -3.0, -7.0, 1000.0, 1000.0)]
    for i in range(1, 400):
        x, y = rng.uniform(500, 501, 2) if i % 3 == 0 else rng.uniform(0, 990, 2)
        w, h = 10.0 ** rng.uniform(-1, 1.3, 2) if i % 7 else (60.0, 0.01)
        boxes.append((i, float(x), float(y), float(w), float(h)))
    df = spark.createDataFrame([(i, ring(box(x, y, w, h))) for i, x, y, w, h in boxes], f"id int, ring {RING}")
    want = {}
    for a in boxes:
        for b in boxes[a[0] + 1 :]:
            w, h = (min(a[k] + a[k + 2], b[k] + b[k + 2]) - max(a[k], b[k]) for k in (1, 2))
            if w > 0 and h > 0:
                want[a[0], b[0]] = pytest.approx(w * h, rel=1e-8)
    got = {(r["a"], r["b"]): r["overlap_area"] for r in spatial.cross_overlaps(df, "id").collect()}
    assert got == want and len(want) > 1500
    made = grid.shapes(df, ["id"], "ring")
    per_shape = grid.filed(made, made, ["id"], (0, 1), 0).groupBy("id").count().agg(F.max("count"), F.avg("count")).first()
    assert per_shape[0] <= 16 and per_shape[1] < 10


def wheel(n, radius):
    """Ring around (70, 20) with n vertices and radius(i) as SQL over i."""
    at = f"2 * pi() * i / {n}"
    point = f"named_struct('x', 70 + ({radius}) * cos({at}), 'y', 20 + ({radius}) * sin({at}))"
    return f"transform(concat(sequence(0, {n - 1}), array(0)), i -> {point})"


def test_outlines_of_twenty_thousand_vertices(spark):
    """Jagged outlines around one centre; per sector the shared part is a triangle or two, in closed form."""
    import time

    n, r1, r2 = 20_000, "1 + 0.01D * (i * 7919 % 97) / 97", "1.002D + 0.01D * (i * 104729 % 89) / 89"
    df = spark.range(2).selectExpr("id", f"if(id = 0, {wheel(n, r1)}, {wheel(n, r2)}) as ring")
    df = materialise(df, "wheels")
    i = np.arange(n + 1) % n
    a, b = 1 + 0.01 * (i * 7919 % 97) / 97, 1.002 + 0.01 * (i * 104729 % 89) / 89
    s = np.sin(2 * np.pi / n)
    whole = np.minimum(a[:-1], b[:-1]) * np.minimum(a[1:], b[1:])
    # Where the outlines cross inside a sector, at share t of a's edge: two triangles.
    u, v = 1 / a[:-1] - 1 / b[:-1], 1 / a[1:] - 1 / b[1:]
    k = np.flatnonzero(u * v < 0)
    angle = np.arange(n)[k] * 2 * np.pi / n
    for j, t0 in zip(k, angle, strict=True):
        p = [(c[j + d] * np.cos(t0 + d * 2 * np.pi / n), c[j + d] * np.sin(t0 + d * 2 * np.pi / n)) for c in (a, b) for d in (0, 1)]
        (x1, y1), (x2, y2), (x3, y3), (x4, y4) = p
        t = ((x1 - x3) * (y3 - y4) - (y1 - y3) * (x3 - x4)) / ((x1 - x2) * (y3 - y4) - (y1 - y2) * (x3 - x4))
        x, y = x1 + t * (x2 - x1), y1 + t * (y2 - y1)
        first, last = (p[0], p[3]) if a[j] < b[j] else (p[2], p[1])
        whole[j] = (abs(first[0] * y - first[1] * x) + abs(x * last[1] - y * last[0])) / s
    start = time.time()
    rows = spatial.cross_overlaps(df, "id").collect()
    assert time.time() - start < 40
    assert [(r["a"], r["b"], r["relation"]) for r in rows] == [(0, 1, "OVERLAPPING")]
    assert rows[0]["overlap_area"] == pytest.approx(whole.sum() * s / 2, rel=1e-9)


def test_vertices_crowded_in_one_corner(spark):
    """A coast of 4,000 short edges in a thousandth of the width, two long sides: against squares of many sizes."""
    n = 4000
    coast = f"transform(sequence(0, {n}), i -> named_struct('x', 10 - 0.01 * i / {n}, 'y', 5 + 0.001 * (i % 2)))"
    df = spark.range(1).selectExpr("1 as id", f"concat(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 10D, 'y', 0D)), {coast}, array(named_struct('x', 0D, 'y', 0D))) as ring")
    squares = spark.createDataFrame([(9.995, ring(box(9.995, 4, 20, 20))), (9.0, ring(box(9, 1, 0.5, 0.5))), (9.992, ring(box(9.992, 4.5, 0.002, 0.25)))], f"z double, ring {RING}")
    got = {r["z"]: r["overlap_area"] for r in spatial.membership(df, squares, "id", "z").collect()}
    # Mean height of the coast is 5.0005.
    assert got[9.995] == pytest.approx(0.005 * 1.0005, rel=1e-6) and got[9.0] == pytest.approx(0.25) and got[9.992] == pytest.approx(0.0005)


def test_holes_count_in_signature_and_centroid(spark):
    shape = f"array<{RING}>"
    df = spark.createDataFrame([(1, polygon(box(0, 0, 4, 4))), (2, polygon(box(0, 0, 4, 4), box(0, 0, 2, 4))), (3, polygon(list(reversed(box(0, 0, 4, 4))), list(reversed(box(0, 0, 2, 4)))))], f"id int, rings {shape}")
    rings = geo.oriented_rings(F.col("rings"), geo.nesting(df, "rings"))
    got = {r["id"]: r for r in df.select("id", geo.shape_signature(F.col("rings"), 2).alias("s"), geo.total(rings, geo.signed_area).alias("a"), geo.shape_centroid(rings)[0].alias("x")).collect()}
    assert got[2]["s"] == got[3]["s"] != got[1]["s"]
    assert [(got[i]["a"], got[i]["x"]) for i in (1, 2, 3)] == [(16.0, 2.0), (8.0, 3.0), (8.0, 3.0)]


def test_nearest_keeps_points_far_from_all_targets(spark):
    t = spark.createDataFrame([(i, float(i % 40) / 40, float(i // 40) / 40) for i in range(400)], "id long, x double, y double")
    p = spark.createDataFrame([(1000, 100.0, 100.0), (1001, -5e6, 3.0), (1002, 0.5, 0.1)], "id long, x double, y double")
    got = {(r["id"], r["other"], r["rank"]) for r in spatial.nearest(p, t, "id", "id", 3).collect()}
    assert got == brute(p.toPandas(), t.toPandas(), 3, False)


def crowded(n, seed):
    """A third in a spot of a millionth of the extent, a third on one line, points far outside."""
    rng = np.random.default_rng(seed)
    x, y = rng.uniform(0, 1000, n), rng.uniform(0, 1000, n)
    x[: n // 3], y[: n // 3] = 500 + rng.uniform(0, 1e-3, n // 3), 500 + rng.uniform(0, 1e-3, n // 3)
    y[n // 3 : 2 * n // 3] = 250.0
    x[-8:], y[-8:] = [-1e7, 1e7, 500, 500, -1e7, 2000, 999, 0], [500, 500, -1e7, 1e7, 1e7, -3000, 0, 1e5]
    return pd.DataFrame({"id": np.arange(n), "x": x, "y": y})


@pytest.mark.parametrize(("k", "same"), [(1, False), (5, True)])
def test_candidates_stay_few_in_clusters_and_far_away(spark, k, same):
    from finecast.operators import nearest as tree

    t, p = crowded(3000, 1), crowded(900, 2)
    p = t if same else p
    got = {(r["id"], r["other"], r["rank"]) for r in spatial.nearest(spark.createDataFrame(p), spark.createDataFrame(t), "id", "id", k, same_table=same).collect()}
    assert got == brute(p, t, k, same)
    place = F.array("x", "y").alias("p")
    made = tree.Tree(spark.createDataFrame(t).select("id", place), [], 2, 16)
    assert made.homes.count() == 3000 and made.leaves().agg(F.sum("n"), F.max("n")).first() == (3000, 16)
    leaves = made.reach(spark.createDataFrame(p).select("id", place), k + same).join(made.leaves(), ["level", "cell"])
    held = leaves.groupBy("id").agg(F.sum("n").alias("n")).agg(F.count("n"), F.max("n"), F.avg("n")).first()
    assert held[0] == len(p) and held[1] <= 300 and held[2] < 80


def test_nearest_on_the_globe(spark):
    rng = np.random.default_rng(5)
    t = pd.DataFrame({"id": np.arange(400), "x": rng.uniform(-180, 180, 400), "y": np.degrees(np.arcsin(rng.uniform(-1, 1, 400)))})
    t.loc[:9, "y"], t.loc[10:13, "x"] = rng.uniform(88, 90, 10), [179.99, -179.99, 179.5, -179.5]
    p = pd.DataFrame({"id": np.arange(60), "x": np.r_[rng.uniform(-180, 180, 56), [180, -180, 0, 77]], "y": np.r_[rng.uniform(-90, 90, 56), [0, 0, 90, -90]]})
    want = set()
    for i, lon, lat in p.itertuples(index=False):
        a, b = np.radians(lat), np.radians(t["y"])
        h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(t["x"] - lon) / 2) ** 2
        order = sorted(zip(2 * 6371 * np.arcsin(np.sqrt(h)), t["id"], strict=True))[:3]
        want |= {(i, j, r + 1, round(float(d), 6)) for r, (d, j) in enumerate(order)}
    got = spatial.nearest(spark.createDataFrame(p), spark.createDataFrame(t), "id", "id", 3, metric="globe").collect()
    assert {(r["id"], r["other"], r["rank"], round(r["distance"], 6)) for r in got} == want


def test_nearest_of_odd_rows(spark):
    t = spark.createDataFrame([("a", 1, None, 2.0), ("a", 2, float("nan"), 1.0), ("a", 3, 0.0, 0.0), ("a", 4, -0.0, 0.0), ("b", 5, 1.0, 1.0)], "g string, id int, x double, y double")
    p = spark.createDataFrame([("a", 1, 5.0, 5.0), ("a", 2, None, 1.0), ("c", 3, 1.0, 1.0), ("b", 4, 1.0, 1.0)], "g string, id int, x double, y double")
    got = {(r["g"], r["id"], r["other"], r["rank"]) for r in spatial.nearest(p, t, "id", "id", 2, ["g"]).collect()}
    assert got == {("a", 1, 3, 1), ("a", 1, 4, 2), ("b", 4, 5, 1)}
    assert spatial.nearest(p.filter("1 = 0"), t, "id", "id", 2, ["g"]).count() == 0
    assert spatial.nearest(p, t.filter("1 = 0"), "id", "id", 2).count() == 0


def test_latest_dates_per_area(spark):
    from finecast.operators import ingest

    rows = [("a", f"2024-01-{d:02d}", i) for d in range(1, 12) for i in range(2)] + [("b", f"2023-01-{d:02d}", 0) for d in range(1, 12)] + [(None, "2020-05-05", 1), ("c", None, 1)]
    df = spark.createDataFrame(rows, "area string, date string, v int")
    got = ingest.latest_dates(df, "date", 7, ["area"]).groupBy("area").agg(F.count("*").alias("n"), F.min("date").alias("lo")).collect()
    assert {r["area"]: (r["n"], r["lo"]) for r in got} == {"a": (14, "2024-01-05"), "b": (7, "2023-01-05"), None: (1, "2020-05-05")}


def test_own_mean_does_not_hang_on_the_order_of_rows(spark):
    import itertools

    from finecast.operators import windows

    orders = list(itertools.permutations([0.1, 0.2, 0.3, 0.7, None]))
    rows = [(g, v) for g, p in enumerate(orders) for v in p] + [(-1, 1e300), (-1, 3e300), (-2, 1e-15), (-2, 3e-15), (-3, None), (-4, float("inf")), (-4, 1.0)]
    out = windows.above_own_mean(spark.createDataFrame(rows, "g int, v double").coalesce(1), ["g"], "v", 0.0)
    means = {r["g"]: r["own_mean"] for r in out.collect()}
    assert {means[g] for g in range(len(orders))} == {1.3 / 4}
    assert [means[-n] for n in (1, 2, 3, 4)] == [2e300, 2e-15, None, float("inf")]


def test_a_hot_area_is_expanded_by_many_tasks(spark, monkeypatch):
    """Two thirds of the entities are in one area; no task gets more than its share of them."""
    monkeypatch.setattr(joins, "AREA_PART", 50)
    entities = spark.range(3000).coalesce(1).selectExpr("id as e", "if(id % 3 = 0, id, -1) as area")
    dates = spark.range(4).selectExpr("-1L as area", "date_add(date'2024-01-01', cast(id as int)) as date").unionByName(spark.range(0, 900, 9).selectExpr("id as area", "date'2024-02-02' as date"))
    grid = joins.expand(entities, dates, ["area"], "date")
    assert grid.columns == ["area", "e", "date"]
    rows = [r[0] for r in grid.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).select("n").collect()]
    assert sum(rows) == 8100 and max(rows) < 4000
    assert grid.distinct().count() == 8100
