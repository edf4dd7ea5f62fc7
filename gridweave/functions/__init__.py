"""Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRES = 111_320.0  # of a degree


def let(x: Column, f) -> Column:
    """f of x, with x computed once however often f uses it."""
    return F.transform(F.array(x), f)[0]


def metres(lon1: Column, lat1: Column, lon2: Column, lat2: Column, lat0: float) -> Column:
    """Planar distance on a local metric around latitude lat0."""
    import math

    return F.hypot((lon1 - lon2) * (METRES * math.cos(math.radians(lat0))), (lat1 - lat2) * METRES)


def first_match(rules: list[tuple[Column, str]], default: Column | None = None) -> Column:
    """Ordered rules as one CASE: the value of the first that holds."""
    out = default if default is not None else F.lit(None).cast("string")
    for test, value in reversed(rules):
        out = F.when(test, F.lit(value)).otherwise(out)
    return out


def half_open(x: Column, edges: list[float], labels: list[str]) -> Column:
    """The label of the bin [edge, next edge) that holds x; null outside."""
    return first_match([((x >= a) & (x < b), name) for a, b, name in zip(edges[:-1], edges[1:], labels, strict=True)])


def kwh_from_spend(spend: Column, blocks: list[tuple[float, float]], vat: float) -> Column:
    """Inverts a block tariff: blocks of (size, price before tax), the last one without an end."""
    net, paid, out = spend / vat, 0.0, F.lit(0.0)
    for size, price in blocks:
        cap = size * price
        out = out + F.least(F.greatest(net - paid, F.lit(0.0)), F.lit(cap)) / price
        paid += cap
    return out


def mercator_tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Column and row of the Web Mercator tile that holds a point."""
    import math

    n, phi = float(2**zoom), F.radians(lat)
    x = F.floor((lon + 180.0) / 360.0 * n)
    return x, F.floor((1.0 - F.ln(F.tan(phi) + 1.0 / F.cos(phi)) / math.pi) / 2.0 * n)


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    """One digit a level: 1 for the right half and 2 for the lower half."""
    digits = [(F.shiftright(x, k).bitwiseAND(F.lit(1)) + 2 * F.shiftright(y, k).bitwiseAND(F.lit(1))).cast("string") for k in reversed(range(zoom))]
    return F.concat(*digits)


def keep_likely(probs: Column, least: float, top: Column) -> Column:
    """A map of the classes with at least that probability, scaled to sum to one; the top class alone if none has it."""
    kept = F.map_filter(probs, lambda _, p: p >= least)
    total = F.aggregate(F.map_values(kept), F.lit(0.0), lambda s, p: s + p)
    return F.when(F.size(kept) > 0, F.transform_values(kept, lambda _, p: p / total)).otherwise(F.create_map(top, F.lit(1.0)))
