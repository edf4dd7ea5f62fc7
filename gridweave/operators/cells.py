"""Hexagonal cells in plain expressions: encode, parent, disk, centre, boundary; and joins over them.

The plane is an equal-distance projection around a latitude. A cell of level r has a circumradius of SIZE / 2^r metres
and axial coordinates (q, s); its id packs level and coordinates into a long, so cells are equi-join keys.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import METRES

SIZE = 65_536.0  # metres of the circumradius at level 0
SHIFT, HALF = 27, 1 << 26  # bits of a coordinate, and its middle


def plane(lon: Column, lat: Column, lat0: float) -> tuple[Column, Column]:
    return lon * (METRES * math.cos(math.radians(lat0))), lat * METRES


def pack(level: int | Column, q: Column, s: Column) -> Column:
    high = F.lit(level) if isinstance(level, int) else level
    return (high.cast("long") * (1 << SHIFT) + (q + HALF)) * (1 << SHIFT) + (s + HALF)


def unpack(cell: Column) -> tuple[Column, Column, Column]:
    """(level, q, s) of a cell."""
    low, rest = cell.bitwiseAND(F.lit((1 << SHIFT) - 1)), F.shiftright(cell, SHIFT)
    return F.shiftright(rest, SHIFT).cast("int"), rest.bitwiseAND(F.lit((1 << SHIFT) - 1)) - HALF, low - HALF


def _rounded(q: Column, s: Column) -> tuple[Column, Column]:
    """The hexagon that holds fractional axial coordinates: round all three, and mend the one that is furthest off."""
    t = -q - s
    rq, rs, rt = (F.floor(x + 0.5) for x in (q, s, t))
    dq, ds, dt = F.abs(rq - q), F.abs(rs - s), F.abs(rt - t)
    worst_q, worst_s = (dq > ds) & (dq > dt), ds > dt
    return F.when(worst_q, -rs - rt).otherwise(rq), F.when(~worst_q & worst_s, -rq - rt).otherwise(rs)


def encode(lon: Column, lat: Column, level: int, lat0: float) -> Column:
    """The cell of a point; null for null coordinates."""
    x, y = plane(lon, lat, lat0)
    size = SIZE / 2**level
    q, s = _rounded((math.sqrt(3) / 3 * x - y / 3) / size, (y * 2 / 3) / size)
    return pack(level, q, s)


def centre(cell: Column, lat0: float) -> tuple[Column, Column]:
    """(lon, lat) of a cell's middle."""
    level, q, s = unpack(cell)
    size = F.lit(SIZE) / F.pow(F.lit(2.0), level)
    return size * math.sqrt(3) * (q + s / 2) / (METRES * math.cos(math.radians(lat0))), size * 1.5 * s / METRES


def parent(cell: Column, level: int, lat0: float) -> Column:
    """The cell of a lower level that holds the cell's middle."""
    lon, lat = centre(cell, lat0)
    return encode(lon, lat, level, lat0)


def boundary(cell: Column, lat0: float) -> Column:
    """The closed ring of a cell's six corners, as structs (lon, lat)."""
    lon, lat = centre(cell, lat0)
    size = F.lit(SIZE) / F.pow(F.lit(2.0), unpack(cell)[0])
    corners = [(math.cos(math.radians(60 * k - 30)), math.sin(math.radians(60 * k - 30))) for k in (0, 1, 2, 3, 4, 5, 0)]
    return F.array(*(F.struct((lon + size * c / (METRES * math.cos(math.radians(lat0)))).alias("lon"), (lat + size * d / METRES).alias("lat")) for c, d in corners))


def disk(cell: Column, k: int) -> Column:
    """All cells within k steps, 1 + 3k(k+1) of them: offsets are plain additions to the packed id."""
    steps = [(q, s) for q in range(-k, k + 1) for s in range(max(-k, -q - k), min(k, -q + k) + 1)]
    return F.array(*(cell + (q * (1 << SHIFT) + s) for q, s in steps))


def ring_sum(points: DataFrame, things: DataFrame, value: str, k: int, cell: str = "cell") -> DataFrame:
    """For each point's cell what things within k cells add up to; things are summed by cell before they are dealt."""
    sums = things.groupBy(F.col(cell).alias("_c")).agg(F.sum(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    own = points.select(cell).distinct().withColumn("_c", F.explode(disk(F.col(cell), k)))
    found = own.join(sums, "_c").groupBy(cell).agg(F.sum("_v").alias("total"), F.sum("_n").alias("n"))
    return points.join(found, cell, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def empty_cells(cells: DataFrame, k: int, inside: Column, cell: str = "cell") -> DataFrame:
    """Cells within k steps of some cell that aren't there themselves and that `inside` (of the column `cell`) accepts."""
    near = cells.select(F.explode(disk(F.col(cell), k)).alias(cell)).distinct()
    return near.join(cells.select(cell).distinct(), cell, "left_anti").where(inside)
