"""Contract queries of hexagonal cells, spherical and projected geometry."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import METRES, first_match
from ..operators import cells, polygons
from .core import BLD, FAC, LAT0, buildings, facilities

R = 5
_Q = cells.SIZE / 2**R


def _homes(spark, sf_dir, level=R):
    return buildings(spark, sf_dir).select("bldg_id", "area", "lon", "lat", cells.encode(F.col("lon"), F.col("lat"), level, LAT0).alias("cell"))


def hex_encode(spark, sf_dir):
    return _homes(spark, sf_dir).select("bldg_id", "cell")


def hex_parent_rollup(spark, sf_dir):
    """Buildings by parent cell: counted by cell first, and a parent is computed once for each cell."""
    own = _homes(spark, sf_dir).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return own.groupBy(cells.parent(F.col("cell"), R - 2, LAT0).alias("parent")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("children"))


def hex_disk_sum(spark, sf_dir):
    """Areas within two cells of each facility's cell."""
    fac = facilities(spark, sf_dir).select("facility_id", cells.encode(F.col("lon"), F.col("lat"), R, LAT0).alias("cell"))
    return cells.ring_sum(fac, _homes(spark, sf_dir), "area", 2).select("facility_id", "total", "n")


def hex_neighbour_fetch(spark, sf_dir):
    """Buildings in the cells around the facilities' cells, each once."""
    fac = facilities(spark, sf_dir).select(F.explode(cells.disk(cells.encode(F.col("lon"), F.col("lat"), R, LAT0), 1)).alias("cell")).distinct()
    return _homes(spark, sf_dir).join(fac, "cell", "left_semi").select("bldg_id")


def hex_centre(spark, sf_dir):
    out = _homes(spark, sf_dir).select("cell").distinct()
    lon, lat = cells.centre(F.col("cell"), LAT0)
    ring = cells.boundary(F.col("cell"), LAT0)
    return out.select("cell", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"), F.round(ring[1]["lon"], 8).alias("corner_lon"), F.round(ring[1]["lat"], 8).alias("corner_lat"), F.size(ring).alias("corners"))


def hex_empty_cover(spark, sf_dir):
    """Cells around the settled ones without a building, inside the country's box by their middle."""
    lon, lat = cells.centre(F.col("cell"), LAT0)
    return cells.empty_cells(_homes(spark, sf_dir), 1, lon.between(28.8, 30.9) & lat.between(-2.85, -1.04))


def bearing_names(spark, sf_dir):
    """The direction from each district's facility number one, in eight names."""
    one = facilities(spark, sf_dir).where("grp = 1").agg(F.min_by(F.struct("lon", "lat"), "facility_id").alias("f"))
    b = buildings(spark, sf_dir).select("bldg_id", "lon", "lat").join(F.broadcast(one))  # one row
    east, north = (F.col("lon") - F.col("f.lon")) * math.cos(math.radians(LAT0)), F.col("lat") - F.col("f.lat")
    turn = F.pmod(F.degrees(F.atan2(east, north)) + 360.0, F.lit(360.0))
    names = F.array(*map(F.lit, ("N", "NE", "E", "SE", "S", "SW", "W", "NW")))
    return b.select("bldg_id", F.element_at(names, (F.pmod(F.floor((turn + 22.5) / 45), F.lit(8)) + 1).cast("int")).alias("bearing"))


def utm_coordinates(spark, sf_dir):
    """Easting and northing on the transverse Mercator of each point's own zone."""
    zone = F.floor((F.col("lon") + 180) / 6).cast("int") + 1
    e, n = polygons.transverse_mercator(F.col("lon"), F.col("lat"), zone * 6 - 183)
    return buildings(spark, sf_dir).select("bldg_id", zone.alias("zone"), F.round(e, 3).alias("easting"), F.round(n, 3).alias("northing"))


def row_cell_area(spark, sf_dir):
    """Square kilometres of a degree cell by its row of latitude on a sphere, and buildings for each."""
    b = buildings(spark, sf_dir).groupBy(F.floor((F.col("lat") + 2.85) * 10).cast("int").alias("row")).agg(F.count(F.lit(1)).alias("n"))
    low = F.radians(F.col("row") / 10 - 2.85)
    high = F.radians((F.col("row") + 1) / 10 - 2.85)
    km2 = 6371.0072 * 6371.0072 * math.radians(0.1) * (F.sin(high) - F.sin(low))
    return b.select("row", "n", F.round(km2, 6).alias("km2"), F.round(F.col("n") / km2, 8).alias("density"))


def quadkey_decode(spark, sf_dir):
    """Tiles from quadkeys again, and the tile's centre."""
    from ..functions import mercator_tile, quadkey

    zoom = 12
    x, y = mercator_tile(F.col("lon"), F.col("lat"), zoom)
    out = buildings(spark, sf_dir).select(quadkey(x.cast("int"), y.cast("int"), zoom).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    digits = F.transform(F.split("key", ""), lambda d: d.cast("int"))
    back = lambda bit: F.aggregate(F.filter(digits, lambda d: d.isNotNull()), F.lit(0), lambda s, d: s * 2 + F.shiftright(d, bit).bitwiseAND(F.lit(1)))
    n = 2.0**zoom
    tx, ty = back(0), back(1)
    lat = F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * (ty + 0.5) / n))))
    return out.select("key", "n", tx.alias("x"), ty.alias("y"), F.round((tx + 0.5) / n * 360 - 180, 8).alias("lon"), F.round(lat, 8).alias("lat"))


def time_interpolated(spark, sf_dir):
    """Values of years between anchors, piecewise linear and flat outside."""
    k = F.col("bldg_id")
    b = buildings(spark, sf_dir).select("bldg_id", (k % 50).alias("v2014"), (k % 70).alias("v2018"), (k % 90).alias("v2023"), (2012 + k % 14).alias("year"))
    y = F.col("year")
    line = lambda a, b: F.col(f"v{a}") + (F.col(f"v{b}") - F.col(f"v{a}")) * (y - a) / (b - a)
    value = F.when(y <= 2014, F.col("v2014").cast("double")).when(y <= 2018, line(2014, 2018)).when(y <= 2023, line(2018, 2023)).otherwise(F.col("v2023").cast("double"))
    return b.select("bldg_id", "year", value.alias("value"))


def name_subtypes(spark, sf_dir):
    """The subtype and the role of a named thing: ordered patterns, prefixes removed from names, and a key of what is left."""
    from ..sources import read

    name = F.lower("p_name")
    subtype = first_match([(name.rlike("^(blush|thistle)"), "clinic"), (name.contains("blue"), "post"), (name.rlike(r"\bred\b|rose"), "hospital")], F.lit("other"))
    role = first_match([(name.rlike("unit|green"), "unit"), (name.rlike("black$"), "clinic")], F.lit("hospital"))
    key = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"\(.*?\)|[^a-z ]", " "), r"blue|green", " "), " +", " "))
    return read(spark, sf_dir, "part").select("p_partkey", subtype.alias("subtype"), role.alias("role"), key.alias("name_key"))


def polygon_overlap_half(spark, sf_dir):
    """Footprints that overlap by half of the smaller one or more; the best of each building. Convex shapes, clipped.

    The footprints are plain boxes, so that SQL can tell the overlaps; the tests clip turned and uneven ones.
    """
    b = buildings(spark, sf_dir).select("bldg_id", (F.col("bldg_id") * 7 % 90).alias("x"), (F.col("bldg_id") * 13 % 70).alias("y"), (4 + F.col("bldg_id") % 7).alias("w"), (4 + F.col("bldg_id") % 5).alias("h"))
    box = F.array(*(F.struct((F.col("x") + dx).cast("double").alias("x"), (F.col("y") + dy).cast("double").alias("y")) for dx, dy in ((0, 0), (F.col("w"), 0), (F.col("w"), F.col("h")), (0, F.col("h")))))
    df = b.select("bldg_id", box.alias("ring"))
    best = polygons.best_overlap(df.where("bldg_id % 2 = 0"), df.where("bldg_id % 2 = 1"), "bldg_id", "ring", 16.0, 0.5)
    return best.select("a", "b", F.round("area", 6).alias("area"))


def validity_flags(spark, sf_dir):
    """Rings that cross themselves or aren't closed, and their repair: closed, and the corners turned around their middle."""
    k = F.col("bldg_id")
    x, y = (k * 7 % 400).cast("double"), (k * 13 % 300).cast("double")
    p = [F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in ((0, 0), (4, 0), (4, 3), (0, 3))]
    ring = F.when(k % 5 == 0, F.array(p[0], p[2], p[1], p[3], p[0])).when(k % 7 == 0, F.array(*p)).otherwise(F.array(*p, p[0]))
    df = buildings(spark, sf_dir).select("bldg_id", ring.alias("ring"))
    out = df.withColumn("was_invalid", ~polygons.is_simple(F.col("ring"))).withColumn("open", ~polygons.is_closed(F.col("ring")))
    fixed = F.when(F.col("was_invalid"), polygons.around(F.col("ring"))).otherwise(polygons.closed(F.col("ring")))
    return out.select("bldg_id", "was_invalid", "open", polygons.area(fixed).alias("area"))


_S3 = math.sqrt(3)
_SX, _SY = METRES * math.cos(math.radians(LAT0)), METRES


def _enc(lon: str, lat: str, size: float) -> str:
    """CTE columns (fq, fs) of fractional axial coordinates."""
    return f"({_S3 / 3!r}::DOUBLE * ({lon} * {_SX!r}::DOUBLE) - ({lat} * {_SY!r}::DOUBLE) / 3) / {size!r}::DOUBLE AS fq, (({lat} * {_SY!r}::DOUBLE) * 2 / 3) / {size!r}::DOUBLE AS fs"


def _round(source: str) -> str:
    return f"""(SELECT * EXCLUDE (fq, fs, rq, rs, rt, dq, ds, dt), (CASE WHEN dq > ds AND dq > dt THEN -rs - rt ELSE rq END)::BIGINT AS q, (CASE WHEN NOT (dq > ds AND dq > dt) AND ds > dt THEN -rq - rt ELSE rs END)::BIGINT AS s
FROM (SELECT *, abs(rq - fq) AS dq, abs(rs - fs) AS ds, abs(rt - (-fq - fs)) AS dt FROM (SELECT *, floor(fq + 0.5) AS rq, floor(fs + 0.5) AS rs, floor(-fq - fs + 0.5) AS rt FROM {source})))"""


def _pack(level: int) -> str:
    return f"(({level}::BIGINT * {1 << cells.SHIFT} + (q + {cells.HALF})) * {1 << cells.SHIFT} + (s + {cells.HALF}))"


_HOME = f"h AS (SELECT *, {_pack(R)} AS cell FROM {_round(f'(SELECT bldg_id, area, {_enc(chr(108) + chr(111) + chr(110), chr(108) + chr(97) + chr(116), _Q)} FROM bld)')})"
_FACS = f"f AS (SELECT *, {_pack(R)} AS cell FROM {_round(f'(SELECT facility_id, {_enc(chr(108) + chr(111) + chr(110), chr(108) + chr(97) + chr(116), _Q)} FROM fac)')})"
_MID = f"{_Q!r}::DOUBLE * {_S3!r}::DOUBLE * (q + s / 2) / {_SX!r}::DOUBLE"
_MIDY = f"{_Q!r}::DOUBLE * 1.5::DOUBLE * s / {_SY!r}::DOUBLE"


def _disk(k: int) -> str:
    return f"(SELECT dq, ds FROM range({-k}, {k + 1}) a(dq), range({-k}, {k + 1}) b(ds) WHERE abs(dq + ds) <= {k})"


def _utm() -> str:
    n = polygons.FLAT / (2 - polygons.FLAT)
    a = polygons.AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    x = " + ".join(["xi", *(f"{c!r}::DOUBLE * sin({2 * (j + 1)} * xi) * cosh({2 * (j + 1)} * eta)" for j, c in enumerate(alpha))])
    y = " + ".join(["eta", *(f"{c!r}::DOUBLE * cos({2 * (j + 1)} * xi) * sinh({2 * (j + 1)} * eta)" for j, c in enumerate(alpha))])
    return f"""WITH {BLD}, z AS (SELECT bldg_id, lat, floor((lon + 180) / 6)::INT + 1 AS zone, radians(lat) AS phi, radians(lon - ((floor((lon + 180) / 6)::INT + 1) * 6 - 183)) AS lam FROM bld),
t AS (SELECT *, sinh(atanh(sin(phi)) - {e!r}::DOUBLE * atanh({e!r}::DOUBLE * sin(phi))) AS t FROM z), k AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t)
SELECT bldg_id, zone, round(500000 + {0.9996 * a!r}::DOUBLE * ({y}), 3) AS easting, round({0.9996 * a!r}::DOUBLE * ({x}) + CASE WHEN lat < 0 THEN 10000000 ELSE 0 END, 3) AS northing FROM k"""


_C1, _D1 = math.cos(math.radians(30)), math.sin(math.radians(30))
ORACLE = {
    "hex_encode": f"WITH {BLD}, {_HOME} SELECT bldg_id, cell FROM h",
    "hex_parent_rollup": f"""WITH {BLD}, {_HOME}, c AS (SELECT q, s, count(*) AS n FROM h GROUP BY ALL), p AS (SELECT n, {_MID} AS lon, {_MIDY} AS lat FROM c)
SELECT {_pack(R - 2)} AS parent, sum(n)::BIGINT AS n, count(*) AS children FROM {_round(f'(SELECT n, {_enc("lon", "lat", cells.SIZE / 2 ** (R - 2))} FROM p)')} GROUP BY 1""",
    "hex_disk_sum": f"""WITH {BLD}, {FAC}, {_HOME}, {_FACS}, c AS (SELECT q, s, sum(area) AS a, count(*) AS n FROM h GROUP BY ALL)
SELECT facility_id, sum(a)::BIGINT AS total, coalesce(sum(n), 0)::BIGINT AS n FROM f CROSS JOIN {_disk(2)} d LEFT JOIN c ON c.q = f.q + dq AND c.s = f.s + ds GROUP BY 1""",
    "hex_neighbour_fetch": f"WITH {BLD}, {FAC}, {_HOME}, {_FACS}, n AS (SELECT DISTINCT q + dq AS q, s + ds AS s FROM f, {_disk(1)} d) SELECT bldg_id FROM h JOIN n USING (q, s)",
    "hex_centre": f"WITH {BLD}, {_HOME}, c AS (SELECT DISTINCT cell, {_MID} AS lon, {_MIDY} AS lat FROM h) SELECT cell, round(lon, 8) AS lon, round(lat, 8) AS lat, round(lon + {_Q * _C1 / _SX!r}::DOUBLE, 8) AS corner_lon, round(lat + {_Q * _D1 / _SY!r}::DOUBLE, 8) AS corner_lat, 7 AS corners FROM c",
    "hex_empty_cover": f"WITH {BLD}, {_HOME}, n AS (SELECT DISTINCT q + dq AS q, s + ds AS s FROM h, {_disk(1)} d), e AS (SELECT q, s FROM n ANTI JOIN h USING (q, s)) SELECT {_pack(R)} AS cell FROM e WHERE {_MID} BETWEEN 28.8 AND 30.9 AND {_MIDY} BETWEEN -2.85 AND -1.04",
    "bearing_names": f"""WITH {BLD}, {FAC}, o AS (SELECT lon, lat FROM fac WHERE grp = 1 ORDER BY facility_id LIMIT 1), t AS (SELECT bldg_id, (degrees(atan2((b.lon - o.lon) * {math.cos(math.radians(LAT0))!r}::DOUBLE, b.lat - o.lat)) + 360) % 360 AS t FROM bld b, o)
SELECT bldg_id, ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][(floor((t + 22.5) / 45) % 8)::INT + 1] AS bearing FROM t""",
    "utm_coordinates": _utm(),
    "row_cell_area": f"""WITH {BLD}, r AS (SELECT floor((lat + 2.85::DOUBLE) * 10)::INT AS row, count(*) AS n FROM bld GROUP BY 1),
k AS (SELECT *, 6371.0072::DOUBLE * 6371.0072::DOUBLE * {math.radians(0.1)!r}::DOUBLE * (sin(radians((row + 1) / 10 - 2.85::DOUBLE)) - sin(radians(row / 10 - 2.85::DOUBLE))) AS km2 FROM r) SELECT row, n, round(km2, 6) AS km2, round(n / km2, 8) AS density FROM k""",
    "quadkey_decode": f"""WITH {BLD}, t AS (SELECT floor((lon + 180) / 360 * 4096)::INT AS x, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 4096)::INT AS y FROM bld), c AS (SELECT x, y, count(*) AS n FROM t GROUP BY ALL)
SELECT array_to_string(list_transform(range(11, -1, -1), lambda k: (((x >> k::INT) & 1) + 2 * ((y >> k::INT) & 1))::VARCHAR), '') AS key, n, x, y, round((x + 0.5) / 4096 * 360 - 180, 8)::DOUBLE AS lon, round(degrees(atan((exp(pi() * (1 - 2 * (y + 0.5::DOUBLE) / 4096)) - exp(-pi() * (1 - 2 * (y + 0.5::DOUBLE) / 4096))) / 2)), 8) AS lat FROM c""",
    "time_interpolated": f"""WITH {BLD}, v AS (SELECT bldg_id, bldg_id % 50 AS a, bldg_id % 70 AS b, bldg_id % 90 AS c, 2012 + bldg_id % 14 AS year FROM bld)
SELECT bldg_id, year, CASE WHEN year <= 2014 THEN a::DOUBLE WHEN year <= 2018 THEN a + ((b - a) * (year - 2014))::DOUBLE / 4 WHEN year <= 2023 THEN b + ((c - b) * (year - 2018))::DOUBLE / 5 ELSE c::DOUBLE END AS value FROM v""",
    "name_subtypes": r"""WITH n AS (SELECT p_partkey, lower(p_name) AS n FROM part) SELECT p_partkey, CASE WHEN regexp_matches(n, '^(blush|thistle)') THEN 'clinic' WHEN contains(n, 'blue') THEN 'post' WHEN regexp_matches(n, '\bred\b|rose') THEN 'hospital' ELSE 'other' END AS subtype,
CASE WHEN regexp_matches(n, 'unit|green') THEN 'unit' WHEN regexp_matches(n, 'black$') THEN 'clinic' ELSE 'hospital' END AS role, trim(regexp_replace(regexp_replace(regexp_replace(n, '\(.*?\)|[^a-z ]', ' ', 'g'), 'blue|green', ' ', 'g'), ' +', ' ', 'g')) AS name_key FROM n""",
    "polygon_overlap_half": f"""WITH {BLD}, b AS (SELECT bldg_id AS i, bldg_id * 7 % 90 AS x, bldg_id * 13 % 70 AS y, 4 + bldg_id % 7 AS w, 4 + bldg_id % 5 AS h FROM bld),
p AS (SELECT a.i AS a, b.i AS b, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x) AS dx, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y) AS dy, least(a.w * a.h, b.w * b.h) AS small FROM b a JOIN b ON a.i % 2 = 0 AND b.i % 2 = 1)
SELECT a, b, round((dx * dy)::DOUBLE, 6) AS area FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY dx * dy DESC, b) AS r FROM p WHERE dx > 0 AND dy > 0 AND 2 * dx * dy >= small) WHERE r = 1""",
    "validity_flags": f"WITH {BLD} SELECT bldg_id, bldg_id % 5 = 0 AS was_invalid, bldg_id % 5 <> 0 AND bldg_id % 7 = 0 AS open, 12.0::DOUBLE AS area FROM bld",
}
QUERIES = {name: globals()[name] for name in ORACLE}
