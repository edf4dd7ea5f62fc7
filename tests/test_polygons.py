"""Clipping, crossings and repairs against numbers known by other means, and hexagonal cells against distances."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from gridweave.operators import cells, polygons

RING = "array<struct<x:double,y:double>>"


def ring(*points):
    return [(float(x), float(y)) for x, y in points]


def test_clip_areas(spark):
    turned = ring((0, 2), (2, 0), (4, 2), (2, 4))  # a square on its corner, area 8
    l_shape = ring((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4))  # area 12
    window = ring((1, 1), (3, 1), (3, 3), (1, 3))
    rows = [(1, turned, window, 4.0), (2, turned, list(reversed(window)), 4.0), (3, l_shape, window, 3.0), (4, l_shape, turned, 6.0), (5, turned, ring((9, 9), (10, 9), (10, 10)), 0.0), (6, [], window, 0.0), (7, turned, turned, 8.0)]
    df = spark.createDataFrame(rows, f"id int, a {RING}, b {RING}, want double")
    for r in df.select("id", "want", polygons.area(polygons.clip(F.col("a"), F.col("b"))).alias("got")).collect():
        assert abs(r["got"] - r["want"]) < 1e-9, r


def test_clip_against_counted_points(spark):
    rng, rows = random.Random(4), []
    for i in range(20):
        tri = [(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(3)]
        x, y = rng.uniform(0, 5), rng.uniform(0, 5)
        rows.append((i, ring(*tri), ring((x, y), (x + 4, y), (x + 4, y + 4), (x, y + 4))))
    got = {r["id"]: r["area"] for r in spark.createDataFrame(rows, f"id int, a {RING}, b {RING}").select("id", polygons.area(polygons.clip(F.col("a"), F.col("b"))).alias("area")).collect()}
    side = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    for i, tri, box in rows:
        n, hit = 150, 0
        for u in range(n):
            for v in range(n):
                p = (box[0][0] + 4 * (u + 0.5) / n, box[0][1] + 4 * (v + 0.5) / n)
                s = [side(tri[k], tri[(k + 1) % 3], p) for k in range(3)]
                hit += min(s) >= 0 or max(s) <= 0
        assert abs(got[i] - 16 * hit / n**2) < 0.15


def test_rings(spark):
    rows = [(1, ring((0, 0), (2, 2), (2, 0), (0, 2))), (2, ring((0, 0), (2, 0), (2, 2), (0, 2))), (3, ring((0, 0), (1, 1))), (4, []), (5, None)]
    df = spark.createDataFrame(rows, f"id int, r {RING}")
    got = {r["id"]: (r["s"], r["a"]) for r in df.select("id", polygons.is_simple(F.col("r")).alias("s"), polygons.area(polygons.around(F.col("r"))).alias("a")).collect()}
    assert got[1] == (False, 4.0) and got[2] == (True, 4.0) and got[3][0] is False and got[4][0] is False


def test_overlaps_once_each(spark):
    rng = random.Random(6)

    def box(i):
        x, y = rng.uniform(0, 30), rng.uniform(0, 30)
        return i, ring((x, y), (x + 6, y), (x + 6, y + 5), (x, y + 5))

    a, b = [box(i) for i in range(40)], [box(100 + i) for i in range(40)]
    want = {}
    for i, p in a:
        for j, q in b:
            dx = min(p[1][0], q[1][0]) - max(p[0][0], q[0][0])
            dy = min(p[2][1], q[2][1]) - max(p[0][1], q[0][1])
            if dx > 0 and dy > 0:
                want[i, j] = dx * dy
    make = lambda rows: spark.createDataFrame(rows, f"id int, ring {RING}")
    rows = polygons.overlaps(make(a), make(b), "id", "ring", 4.0).collect()
    assert len(rows) == len(want) and all(abs(r["area"] - want[r["a"], r["b"]]) < 1e-9 for r in rows)
    assert polygons.overlaps(make(a).limit(0), make(b), "id", "ring", 4.0).count() == 0


def test_best_overlap_with_many_copies(spark, monkeypatch):
    """2000 by 2000 rings of four shapes: pairs are made of shapes, and each ring has the best by brute force over the least ids."""
    kinds = [(0.0, 4.0), (1.0, 4.0), (2.0, 9.0), (40.0, 4.0)]
    ids = lambda r: [(i, ring((x, 0), (x + w, 0), (x + w, 2), (x, 2))) for i in range(r, 4000, 2) for x, w in (kinds[i // 2 % 4],)]
    rows = ids(0), ids(1)
    left, right = (spark.createDataFrame([*r, (9000 + k, None), (9002 + k, [])], f"id int, ring {RING}") for k, r in enumerate(rows))
    paired, real = [], polygons.overlaps
    monkeypatch.setattr(polygons, "overlaps", lambda a, b, *rest: paired.extend((a.count(), b.count())) or real(a, b, *rest))
    got = {r["a"]: (r["b"], r["area"]) for r in polygons.best_overlap(left, right, "id", "ring", 4.0, 0.5).collect()}
    assert max(paired) <= 6
    want = {}
    for i, p in rows[0]:
        met = [(min(p[1][0], q[1][0]) - max(p[0][0], q[0][0]), -j, min(p[1][0] - p[0][0], q[1][0] - q[0][0])) for j, q in rows[1][:4]]
        d, j, _ = max(m for m in met if m[0] > 0 and m[0] >= 0.5 * m[2])
        want[i] = (-j, 2 * d)
    assert got == want


def test_projection(spark):
    """The middle meridian's northing is the length of the meridian, and scale is near 0.9996."""
    df = spark.createDataFrame([(33.0, 0.0), (33.0, 1.0), (33.0, -1.0), (33.5, 0.0)], "lon double, lat double")
    e, n = polygons.transverse_mercator(F.col("lon"), F.col("lat"), F.lit(33))
    got = [(r[0], r[1]) for r in df.select(e, n).collect()]
    assert abs(got[0][0] - 500_000) < 1e-6 and abs(got[0][1]) < 1e-6
    assert abs(got[1][1] - 0.9996 * 110_574.3886) < 0.01 and abs(got[2][1] - 10_000_000 + 0.9996 * 110_574.3886) < 0.01
    assert abs(got[3][0] - 500_000 - 0.9996 * 0.5 * math.pi / 180 * 6_378_137 * (1 + (0.5 * math.pi / 180) ** 2 / 6)) < 0.5


def test_cells_hold_their_points(spark):
    """A point's cell has the nearest centre of all cells around it; parents, disks and ids fit together."""
    rng = random.Random(7)
    pts = spark.createDataFrame([(i, rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(300)] + [(999, None, 0.5)], "id int, lon double, lat double")
    c = cells.encode(F.col("lon"), F.col("lat"), 4, 0.0)
    lon, lat = cells.centre(F.col("near"), 0.0)
    d = F.hypot(F.col("lon") - lon, F.col("lat") - lat)
    best = pts.withColumn("cell", c).withColumn("near", F.explode(cells.disk(F.col("cell"), 2))).groupBy("id", "cell").agg(F.min_by("near", d).alias("best"), F.count(F.lit(1)).alias("n"))
    rows = best.where("id < 999").collect()
    assert len(rows) == 300 and all(r["cell"] == r["best"] and r["n"] == 19 for r in rows)
    own = pts.where("id < 999").select(c.alias("cell"))
    lon, lat = cells.centre(F.col("cell"), 0.0)
    assert own.where(cells.encode(lon, lat, 4, 0.0) != F.col("cell")).count() == 0
    assert pts.where("id = 999").select(c.alias("cell")).first()["cell"] is None
    r = cells.boundary(F.col("cell"), 0.0)
    assert own.where((F.size(r) != 7) | (r[0]["lon"] != r[6]["lon"])).count() == 0


def test_ring_sums(spark):
    pts = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.5, 0.5), (3, 0.0, 0.0)], "id int, lon double, lat double").withColumn("cell", cells.encode(F.col("lon"), F.col("lat"), 4, 0.0))
    things = pts.where("id = 1").withColumn("v", F.lit(5)).unionAll(pts.where("id = 3").withColumn("v", F.lit(7)))
    got = {r["id"]: (r["total"], r["n"]) for r in cells.ring_sum(pts, things, "v", 1).collect()}
    assert got == {1: (12, 2), 3: (12, 2), 2: (None, 0)}
