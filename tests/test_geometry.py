"""Rings, quotes, groups and tiles on planted cases."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from gridweave.functions import METRES, keep_likely, mercator_tile, quadkey
from gridweave.operators import curation, geometry, neighbours
from gridweave.plans import sampling

RING = "array<struct<x:double,y:double>>"
SQUARE = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
NOTCHED = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (5.0, 2.0), (0.0, 10.0), (0.0, 0.0)]


def test_ring_measures(spark):
    r = F.col("ring")
    row = spark.createDataFrame([(SQUARE,)], f"ring {RING}").select(geometry.area(r), geometry.perimeter(r), geometry.contains(r, F.lit(5.0), F.lit(5.0)), geometry.contains(r, F.lit(15.0), F.lit(5.0)), geometry.orientation(r)).first()
    assert tuple(row) == (100.0, 40.0, True, False, 0.0)


def test_a_notch_is_outside(spark):
    r = F.col("ring")
    assert tuple(spark.createDataFrame([(NOTCHED,)], f"ring {RING}").select(geometry.contains(r, F.lit(5.0), F.lit(8.0)), geometry.contains(r, F.lit(1.0), F.lit(7.0))).first()) == (False, True)


def test_least_area_wins_and_outside_is_null(spark):
    big = [(x * 3 - 5, y * 3 - 5) for x, y in SQUARE]
    areas = spark.createDataFrame([(2, SQUARE), (1, SQUARE), (3, big)], f"area_id int, ring {RING}")
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 15.0, 15.0), (3, 90.0, 90.0), (4, None, 1.0)], "id int, x double, y double")
    assert dict(map(tuple, geometry.smallest_container(points, areas, "id", "area_id", 4.0).collect())) == {1: 1, 2: 3, 3: None, 4: None}


def test_nearest_segment_within_a_radius(spark):
    lines = spark.createDataFrame([(110.0, -500.0, 110.0, 500.0), (7.0, 50.0, 7.0, 50.0)], "x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(1, 105.0, 3.0), (2, 7.0, 20.0), (3, 900.0, 0.0)], "id int, x double, y double")
    assert dict(map(tuple, geometry.nearest_segment(points, lines, "id", 40.0).collect())) == {1: 5.0, 2: 30.0, 3: None}


def test_nearest_segment_against_all_pairs(spark, monkeypatch):
    """Long, short, upright, level and steep lines, dense and alone, with copies; rows without a place stay null."""
    rng = random.Random(12)
    lines = [(x, y, x + rng.uniform(-9, 9), y + rng.uniform(-6, 6)) for x, y in ((rng.uniform(-50, 50), rng.uniform(-50, 50)) for _ in range(300))]
    lines += [(0.0, y * 1.0, 0.0, y + 5.0) for y in range(20)] + [(x * 1.0, 7.0, x + 3.0, 7.0) for x in range(20)] + [(8.0, -40.0, 8.0 + 1e-13, 40.0), (-60.0, -60.0, 60.0, 60.5), (70.0, 70.0, 70.0, 70.0)]
    lines += [(rng.uniform(20, 20.2), rng.uniform(20, 20.2), 20.1, 20.1) for _ in range(300)] + lines[:1] * 500
    points = [(rng.uniform(-90, 90), rng.uniform(-90, 90)) for _ in range(300)] + [(20 + rng.uniform(0, 0.3), 20 + rng.uniform(0, 0.3)) for _ in range(500)] + [(8.5, 0.0), (70.0, 90.0), (None, 1.0), (float("nan"), 1.0), (float("inf"), 0.0)]

    def dist(x, y, a, b, c, e):
        n = (c - a) ** 2 + (e - b) ** 2
        t = min(max(((x - a) * (c - a) + (y - b) * (e - b)) / n, 0), 1) if n else 0
        return math.hypot(x - a - t * (c - a), y - b - t * (e - b))

    want = {}
    for i, (x, y) in enumerate(points):
        d = min(dist(x, y, *s) for s in lines) if x is not None and abs(x) < 1e9 else 99
        want[i] = d if d <= 20 else None
    dealt, real = [], geometry._along
    monkeypatch.setattr(geometry, "_along", lambda df, side: dealt.append(side) or real(df, side))
    p, s = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, x double, y double"), spark.createDataFrame([*lines, (None, 1.0, 2.0, 3.0), (float("nan"), 1.0, 2.0, 3.0)], "x1 double, y1 double, x2 double, y2 double")
    got = dict(map(tuple, geometry.nearest_segment(p, s, "id", 20.0).collect()))
    assert got.keys() == want.keys() and all(got[i] is None if d is None else abs(got[i] - d) < 1e-9 for i, d in want.items())
    assert min(dealt) < 20 and None in list(want.values())[:800]
    assert {r[1] for r in geometry.nearest_segment(p, s.limit(0), "id", 20.0).collect()} == {None}


def test_zonal_median_takes_the_least_value_at_half(spark):
    pixels = spark.createDataFrame([(0, 0, 9), (0, 1, 6), (0, 2, 0), (1, 0, None)], "row int, col int, v int")
    boxes = spark.createDataFrame([(1, 0.75, 0.0, 2.5, 1.0), (2, 0.0, 0.0, 1.0, 2.0), (3, 50.0, 50.0, 51.0, 51.0)], "id int, x0 double, y0 double, x1 double, y1 double")
    assert sorted(map(tuple, geometry.zonal_median(boxes, pixels, "id", "v").collect())) == [(1, 6, 3), (2, 9, 1)]


def test_quotes(spark):
    rows = [
        ("the “new” meter – works", 'so the "new"  meter - works well', None, True),
        ("one long elec-\ntric line", "one long electric line", None, True),
        ("ends here and goes", "it ends here", "and goes on", True),
        ("goes on", "it ends here", "and goes on", False),
        ("40 kWh", "it used 41 kWh", None, False),
        ("  ", "any", None, False),
    ]
    df = spark.createDataFrame(rows, "q string, p string, n string, want boolean")
    assert [r.got for r in df.select(curation.quote_holds(F.col("q"), F.col("p"), F.col("n")).alias("got")).collect()] == [r[3] for r in rows]


def test_words_cut_at_line_and_page_ends(spark):
    rows = [("a", "cafétable", "une café-\ntable", None, True), ("b", "A4B7", "an A4-  \n \n  B7", None, True), ("c", "the electricity bill", "pays the electri-", "city bill now", True), ("d", "the electri city", "the electri-", "city", False), ("e", "well-known", "a well-known x", None, True), ("f", "bill now", "pays the electri-", "city bill now", False)]
    df = spark.createDataFrame(rows, "k string, q string, p string, n string, want boolean")
    assert {r.k: r.got for r in df.select("k", curation.quote_holds(F.col("q"), F.col("p"), F.col("n")).alias("got")).collect()} == {r[0]: r[4] for r in rows}


def test_groups_follow_chains_and_cycles(spark):
    nodes = spark.range(0, 40).withColumnRenamed("id", "k")
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(30, 1), (35, 38), (38, 35), (39, 39)], "u long, v long")
    found = dict(map(tuple, curation.linked_groups(nodes, edges, "k").collect()))
    assert found == {k: 1 if 1 <= k <= 30 else 35 if k in (35, 38) else k for k in range(40)}


def test_groups_follow_a_long_chain_of_mixed_ids(spark):
    ids = random.Random(5).sample(range(1000, 9000), 600)
    edges = spark.createDataFrame([*zip(ids, ids[1:]), (ids[0], 7), (7, 8)], "u long, v long")
    nodes = spark.createDataFrame([(i,) for i in [*ids, 8]], "k long")
    found = dict(map(tuple, curation.linked_groups(nodes, edges, "k").collect()))
    assert found == {**dict.fromkeys(ids, min(ids)), 8: 8}  # 7 is no node, so it links nothing


def test_near_groups_against_all_pairs(spark):
    rng = random.Random(8)
    places = [(rng.uniform(-0.05, 0.05), rng.uniform(-0.04, 0.04)) for _ in range(500)]
    places += [(0.2 + rng.gauss(0, 0.002), rng.gauss(0, 0.002)) for _ in range(150)] + [places[0], places[3]] * 10 + [(None, 0.1), (float("nan"), 0.0), (float("inf"), 0.0), (float("nan"), 0.0)]
    ids = rng.sample(range(10_000), len(places))
    for radius in (150.0, 400.0, 900.0):
        group = dict(zip(ids, ids))

        def root(i):
            while group[i] != i:
                i = group[i]
            return i

        for i, (a, b) in zip(ids, places):
            for j, (c, d) in zip(ids, places):
                if i < j and None not in (a, c) and math.hypot((a - c) * METRES * math.cos(math.radians(-2.0)), (b - d) * METRES) <= radius:
                    u, v = sorted((root(i), root(j)))
                    group[v] = u
        df = spark.createDataFrame([(i, *p) for i, p in zip(ids, places)], "k long, lon double, lat double")
        assert dict(map(tuple, curation.near_groups(df, "k", radius, -2.0).collect())) == {i: root(i) for i in ids}


def test_groups_of_nothing(spark):
    assert curation.linked_groups(spark.range(0).withColumnRenamed("id", "k"), spark.createDataFrame([], "u long, v long"), "k").count() == 0
    assert curation.near_groups(spark.createDataFrame([], "k long, lon double, lat double"), "k", 5.0, 0.0).count() == 0


def test_tiles_and_likely_classes(spark):
    one = spark.range(1)
    x, y = mercator_tile(F.lit(30.0036621), F.lit(-1.6587038), 14)
    assert tuple(one.select(x, y, quadkey(F.lit(3), F.lit(5), 3)).first()) == (9557, 8267, "213")
    probs = F.create_map(F.lit("res"), F.lit(0.62), F.lit("comm"), F.lit(0.18), F.lit("shop"), F.lit(0.05), F.lit("pu"), F.lit(0.15))
    kept, alone = one.select(keep_likely(probs, 0.16, F.lit("res")), keep_likely(probs, 0.9, F.lit("comm"))).first()
    assert {k: round(v, 6) for k, v in kept.items()} == {"res": 0.775, "comm": 0.225} and alone == {"comm": 1.0}


def test_disk_means_beyond_all_cells_are_null(spark):
    cells = spark.createDataFrame([(0, 0, 6, 2), (0, 2, 9, 1)], "row int, col int, s int, n int")
    wanted = spark.createDataFrame([(0, 1, 1), (9, 9, 1)], "row int, col int, k int")
    assert sorted(map(tuple, neighbours.disk_means(cells, wanted, "k").collect())) == [(0, 1, 5.0, 3), (9, 9, None, None)]


def test_bilinear_grid_is_all_of_part(spark):
    plan = sampling.bilinear_lapse(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" in plan and "< 36" not in plan


def test_mutual_nearest_against_all_pairs(spark, monkeypatch):
    """Clumps, voids, copies at one place, ties after rounding and rows without a place; no step makes more pairs than a few a row."""
    rng = random.Random(9)
    spot = lambda n, x, y, s: [(x + rng.gauss(0, s), y + rng.gauss(0, s)) for _ in range(n)]
    a = spot(150, 0, 0, 0.0005) + spot(150, 0, 0, 0.05) + spot(5, 3, 3, 0.01) + [(0.3, 0.3)] * 4 + [(None, 0.0), (float("nan"), 0.0)]
    b = spot(600, 0, 0, 0.0005) + spot(600, 0, 0, 0.05) + [(0.301, 0.3), (0.3 - 0.001 + 1e-12, 0.3), (0.3, 0.301)] + [(0.4, 0.4)] * 900 + [(None, 0.0), (float("inf"), 0.0)]
    make = lambda rows, k: spark.createDataFrame([(i, *p) for i, p in zip(rng.sample(range(9000), len(rows)), rows)], f"{k} long, lon double, lat double")
    left, right = make(a, "f"), make(b, "b")
    per_lon, best = METRES * math.cos(math.radians(-2.0)), {}
    finite = lambda df: [r for r in map(tuple, df.collect()) if r[1] is not None and abs(r[1]) < 1e6]
    rows = finite(left), finite(right)
    for f, *p in rows[0]:
        for k, *q in rows[1]:
            d = math.hypot((p[0] - q[0]) * per_lon, (p[1] - q[1]) * METRES)
            if d <= 20_000:
                d = round(d, 4)
                best["f", f] = min(best.get(("f", f), (d, k)), (d, k))
                best["b", k] = min(best.get(("b", k), (d, f)), (d, f))
    want = {(f, k, d) for (side, f), (d, k) in best.items() if side == "f" and best["b", k][1] == f}
    made, real = [], neighbours.within
    monkeypatch.setattr(neighbours, "within", lambda *args: made.append(real(*args)) or made[-1])
    assert set(map(tuple, neighbours.mutual_nearest(left, right, "f", "b", 20_000.0, -2.0, 4).collect())) == want
    assert len(want) > 50 and len(made) > 2 and made[0].count() < 32 * (len(a) + len(b))
    assert neighbours.mutual_nearest(left, right.limit(0), "f", "b", 20_000.0, -2.0, 4).count() == 0
