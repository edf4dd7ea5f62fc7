"""Rings of any corners: closure, crossings, clipping, overlaps; and a projection. Rings are arrays of struct<x, y>."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import let

RING = "array<struct<x:double,y:double>>"


def is_closed(ring: Column) -> Column:
    return F.coalesce(F.try_element_at(ring, F.lit(1)) == F.try_element_at(ring, F.lit(-1)), F.lit(False))


def closed(ring: Column) -> Column:
    return let(ring, lambda r: F.when(is_closed(r), r).otherwise(F.concat(r, F.slice(r, 1, 1))))


def _edges(ring: Column) -> Column:
    """The edges (a, b) of a ring, closed first."""

    def of(r: Column) -> Column:
        n = F.greatest(F.size(r), F.lit(1))
        return F.zip_with(F.slice(r, 1, n - 1), F.slice(r, 2, n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    return let(closed(ring), of)


def signed_area(ring: Column) -> Column:
    """Half the sum of cross products: positive if the corners run against the clock. Open rings are closed."""
    return F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def _side(a: Column, b: Column, p: Column) -> Column:
    return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])


def is_simple(ring: Column) -> Column:
    """Whether no two edges cross at a point inside both, and there are three different corners at least."""
    cross = lambda e, f: (_side(e["a"], e["b"], f["a"]) * _side(e["a"], e["b"], f["b"]) < 0) & (_side(f["a"], f["b"], e["a"]) * _side(f["a"], f["b"], e["b"]) < 0)
    crossed = let(_edges(ring), lambda edges: F.exists(edges, lambda e: F.exists(edges, lambda f: cross(e, f))))
    return (F.size(F.array_distinct(ring)) >= 3) & ~crossed


def around(ring: Column) -> Column:
    """The distinct corners in their order around their middle, closed: a star-shaped ring through all of them."""

    def turn(pts: Column) -> Column:
        mid = F.aggregate(pts, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), lambda s, p: F.struct((s["x"] + p["x"]).alias("x"), (s["y"] + p["y"]).alias("y")))
        n = F.size(pts)
        turned = let(mid, lambda m: F.transform(pts, lambda p: F.struct(F.atan2(p["y"] - m["y"] / n, p["x"] - m["x"] / n).alias("t"), p["x"].alias("x"), p["y"].alias("y"))))
        return closed(F.transform(F.array_sort(turned), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))))

    return let(F.array_distinct(ring), turn)


def clip(ring: Column, window: Column) -> Column:
    """The part of a ring inside a convex window, as an open ring, by cutting it along each edge of the window.

    The window's corners may run either way. A ring that isn't convex may come back with doubled edges along the cut,
    which add nothing to its area. Empty if nothing is left.
    """
    edges = _edges(F.when(signed_area(window) < 0, F.reverse(window)).otherwise(window))
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

    def cut(poly: Column, e: Column) -> Column:
        m = F.size(poly)
        sides = F.transform(poly, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), _side(e["a"], e["b"], p).alias("s")))
        none = F.array().cast(RING)

        def step(p: Column, q: Column) -> Column:
            u = p["s"] / F.nullif(p["s"] - q["s"], F.lit(0.0))
            meet = F.array(point(p["x"] + u * (q["x"] - p["x"]), p["y"] + u * (q["y"] - p["y"])))
            return F.concat(F.when(p["s"] >= 0, F.array(point(p["x"], p["y"]))).otherwise(none), F.when(p["s"] * q["s"] < 0, meet).otherwise(none))

        return F.flatten(let(sides, lambda ps: F.zip_with(ps, F.when(m > 0, F.concat(F.slice(ps, F.lit(2), m), F.slice(ps, 1, 1))).otherwise(ps), step)))

    opened = F.when(is_closed(ring), F.slice(ring, F.lit(1), F.greatest(F.size(ring), F.lit(1)) - 1)).otherwise(ring)
    return F.aggregate(edges, opened.cast(RING), cut)


def overlaps(left: DataFrame, right: DataFrame, id_col: str, ring: str, side: float) -> DataFrame:
    """(a, b, area, area_a, area_b) of convex rings that overlap, each pair once.

    Rings are dealt to the cells of their boxes, and a pair is taken in the cell that holds the lower corner of the boxes'
    overlap alone; so no pair is shuffled to be made distinct.
    """

    def dealt(df: DataFrame, p: str) -> DataFrame:
        xs, ys = F.transform(ring, lambda c: c["x"]), F.transform(ring, lambda c: c["y"])
        own = df.select(F.col(id_col).alias(p), F.col(ring).alias(f"ring_{p}"), F.array_min(xs).alias(f"x0{p}"), F.array_max(xs).alias(f"x1{p}"), F.array_min(ys).alias(f"y0{p}"), F.array_max(ys).alias(f"y1{p}"))
        run = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / side), F.floor(F.col(b) / side)))
        return own.withColumn("cx", run(f"x0{p}", f"x1{p}")).withColumn("cy", run(f"y0{p}", f"y1{p}"))

    pairs = dealt(left, "a").join(dealt(right, "b"), ["cx", "cy"])
    corner = (F.col("cx") == F.floor(F.greatest("x0a", "x0b") / side)) & (F.col("cy") == F.floor(F.greatest("y0a", "y0b") / side))
    touching = (F.col("x0a") < F.col("x1b")) & (F.col("x0b") < F.col("x1a")) & (F.col("y0a") < F.col("y1b")) & (F.col("y0b") < F.col("y1a"))
    met = pairs.where(corner & touching).select("a", "b", area(clip(F.col("ring_a"), F.col("ring_b"))).alias("area"), area(F.col("ring_a")).alias("area_a"), area(F.col("ring_b")).alias("area_b"))
    return met.where("area > 0")


def best_overlap(left: DataFrame, right: DataFrame, id_col: str, ring: str, side: float, share: float) -> DataFrame:
    """(a, b, area): for each left ring the right one it overlaps most, if by `share` of the smaller one; the lesser b on ties.

    Equal rings are one shape, named by its least id, and only shapes are paired: of equal right rings the least id wins
    anyway, and equal left rings share one answer. So copies cost a row each and not a pair each.
    """

    def shapes(df: DataFrame) -> DataFrame:
        return df.groupBy(ring).agg(F.min(id_col).alias(id_col))

    met = overlaps(shapes(left), shapes(right), id_col, ring, side).where(F.col("area") >= share * F.least("area_a", "area_b"))
    best = met.groupBy("a").agg(F.max_by(F.struct("b", "area"), F.struct("area", -F.col("b"))).alias("m"))
    named = shapes(left).join(best, F.col(id_col) == F.col("a")).select(ring, "m.b", "m.area")
    return left.select(F.col(id_col).alias("a"), ring).join(named, ring).select("a", "b", "area")


#: Half axis and flattening of the WGS84 ellipsoid.
AXIS, FLAT = 6_378_137.0, 1 / 298.257223563


def transverse_mercator(lon: Column, lat: Column, middle: Column) -> tuple[Column, Column]:
    """(easting, northing) in metres on the transverse Mercator around a meridian, scale 0.9996, false easting 500 km,
    and 10,000 km added south of the equator; Krüger's series to the third order (millimetres within a zone)."""
    n = FLAT / (2 - FLAT)
    a = AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - middle)
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x = xi + sum((c * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta) for j, c in enumerate(alpha)), F.lit(0.0))
    y = eta + sum((c * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta) for j, c in enumerate(alpha)), F.lit(0.0))
    return 500_000 + 0.9996 * a * y, 0.9996 * a * x + F.when(lat < 0, 10_000_000.0).otherwise(0.0)
