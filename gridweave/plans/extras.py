"""Contract queries of tiles, dissolves, release joins, survey totals, simulated loads and report limits."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import first_match, kwh_from_spend
from ..operators import neighbours, shaping
from ..sources import read
from .core import BLD, DIST, FAC, LAT0, TARIFF, buildings, facilities


def dissolved_outline(spark, sf_dir):
    """The outline of districts' grid squares: edges that two squares share cancel, and what stays is counted."""
    b = buildings(spark, sf_dir).select("province", F.floor((F.col("lon") - 28.8) * 8).alias("x"), F.floor((F.col("lat") + 2.85) * 8).alias("y")).distinct()
    sides = F.array(*(F.struct((2 * F.col("x") + dx).alias("u"), (2 * F.col("y") + dy).alias("v")) for dx, dy in ((1, 0), (1, 2), (0, 1), (2, 1))))
    edges = b.select("province", F.explode(sides).alias("e")).groupBy("province", "e").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
    return edges.groupBy("province").agg(F.count(F.lit(1)).alias("edges")).join(b.groupBy("province").agg(F.count(F.lit(1)).alias("squares")), "province")


def multi_tile_sample(spark, sf_dir):
    """The first tile, in a fixed order, with a pixel under each point: overlapping tiles, one equi-join."""
    p = read(spark, sf_dir, "part").select((F.col("p_partkey") % 3).alias("tile"), F.expr("p_partkey div 3 div 20").alias("row"), (F.expr("p_partkey div 3") % 20).alias("col"), F.when(F.col("p_size") > 10, F.col("p_size")).alias("v"))
    pts = buildings(spark, sf_dir).select("bldg_id", F.floor((F.col("lat") + 2.85) * 8).alias("row"), F.floor((F.col("lon") - 28.8) * 8).alias("col"))
    best = pts.join(p.where("v IS NOT NULL"), ["row", "col"]).groupBy("bldg_id").agg(F.min(F.struct("tile", "v")).alias("m"))
    return pts.select("bldg_id").join(best, "bldg_id", "left").select("bldg_id", F.col("m.tile").alias("tile"), F.col("m.v").alias("value"))


def legend_decode(spark, sf_dir):
    """Codes of a raster as classes by a legend; unknown codes are null."""
    legend = spark.createDataFrame([(0, "built"), (1, "crop"), (2, "forest"), (3, "water")], "code long, land string")
    p = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 6).cast("long").alias("code"))
    return p.join(F.broadcast(legend), "code", "left").groupBy("land").agg(F.count(F.lit(1)).alias("n"))


def tile_names(spark, sf_dir):
    """Names of the degree tiles that points fall in, and the box snapped outwards to tenths."""
    b = buildings(spark, sf_dir)
    y, x = F.floor("lat").cast("int"), F.floor("lon").cast("int")
    name = F.format_string("%s%02d_%s%03d", F.when(y < 0, "S").otherwise("N"), F.abs(y), F.when(x < 0, "W").otherwise("E"), F.abs(x))
    return b.groupBy(name.alias("tile")).agg(F.count(F.lit(1)).alias("n"), F.floor(F.min("lon") * 10).alias("x0"), F.ceil(F.max("lon") * 10).alias("x1"))


def release_join(spark, sf_dir):
    """Twelve relations by one key: sums first, so each side is a row a building, then left joins."""
    c = buildings(spark, sf_dir).select("bldg_id", "district", "area", "floors")
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("bldg_id"), F.col("o_orderkey").alias("k"), "o_orderstatus", (F.col("o_totalprice") * 100).cast("long").alias("v"), F.year("o_orderdate").alias("y"))
    sides = [o.groupBy("bldg_id").agg(F.count(F.lit(1)).alias("n0"))]
    sides += [o.where(F.col("o_orderstatus") == s).groupBy("bldg_id").agg(F.max("k").alias(f"n{i + 1}")) for i, s in enumerate("FOP")]
    sides += [o.where(F.col("y") % 7 == i).groupBy("bldg_id").agg(F.count(F.lit(1)).alias(f"n{i + 4}")) for i in range(7)]
    for s in sides:
        c = c.join(s, "bldg_id", "left")
    return c.select("bldg_id", "district", *(F.coalesce(f"n{i}", F.lit(0)).alias(f"n{i}") for i in range(11)), (F.col("area") * F.col("floors")).cast("long").alias("gross"))


def country_candidates(spark, sf_dir):
    """Candidates inside the country's outline: one small ring against all rows."""
    ring = spark.createDataFrame([(28.9, -2.8, 30.8, -1.1)], "x0 double, y0 double, x1 double, y1 double")
    b = buildings(spark, sf_dir).join(F.broadcast(ring), F.col("lon").between(F.col("x0"), F.col("x1")) & F.col("lat").between(F.col("y0"), F.col("y1")))  # one row
    return b.select("bldg_id")


def largest_contained(spark, sf_dir):
    """Of the footprints in each polygon the largest, the lesser id on ties."""
    b = buildings(spark, sf_dir).select("bldg_id", "area", (F.floor((F.col("lon") - 28.8) * 5) * 100 + F.floor((F.col("lat") + 2.85) * 5)).alias("polygon"))
    return b.groupBy("polygon").agg(F.max(F.struct("area", (-F.col("bldg_id")).alias("m"))).alias("r")).select("polygon", (-F.col("r.m")).alias("bldg_id"), F.col("r.area").alias("area"))


def nearest_with_attributes(spark, sf_dir):
    """The nearest facility of a building with its class and distance, within 8 km."""
    pairs = neighbours.within(facilities(spark, sf_dir), buildings(spark, sf_dir).select("bldg_id", "lon", "lat"), 8000.0, LAT0)
    best = pairs.groupBy(F.col("r_bldg_id").alias("bldg_id")).agg(F.min(F.struct("dist", "facility_id", "grp")).alias("m"))
    return best.select("bldg_id", "m.facility_id", "m.grp", F.round("m.dist", 3).alias("dist"))


def closest_tag_wins(spark, sf_dir):
    """Of the tags matched to a building the closest, then by id and tag."""
    pairs = neighbours.within(facilities(spark, sf_dir).withColumn("tag", F.concat(F.lit("t"), F.col("facility_id") % 4)), buildings(spark, sf_dir).select("bldg_id", "lon", "lat"), 12_000.0, LAT0)
    best = pairs.groupBy(F.col("r_bldg_id").alias("bldg_id")).agg(F.min(F.struct(F.floor(F.col("dist") / 500).alias("d"), "facility_id", "tag")).alias("m"))
    return best.select("bldg_id", "m.tag", F.col("m.d").alias("step"))


def values_rule_join(spark, sf_dir):
    """Rules of a small table joined by their key: group, reach and weight."""
    rules = spark.createDataFrame([("BUILDING", 3, 5), ("MACHINERY", 2, 7), ("HOUSEHOLD", 1, 11)], "cls string, least int, weight long")
    b = buildings(spark, sf_dir).join(F.broadcast(rules), "cls").where(F.col("floors") >= F.col("least"))
    return b.groupBy("district", "cls").agg(F.sum("weight").alias("weight"))


def enterprise_stats(spark, sf_dir):
    """Columns of answers as rows, then shares and means by trade; groups under ten rows are kept back."""
    k = F.col("s_suppkey")
    s = read(spark, sf_dir, "customer").select((F.col("c_custkey") % 5).alias("trade"), *(((F.col("c_custkey") * m) % 9).alias(f"a{m}") for m in (2, 3, 5)))
    long = s.select("trade", F.stack(F.lit(3), F.lit("lamps"), F.col("a2"), F.lit("motors"), F.col("a3"), F.lit("fridges"), F.col("a5")).alias("appliance", "n"))
    by = long.groupBy("trade", "appliance").agg(F.count(F.lit(1)).alias("rows"), F.avg((F.col("n") > 0).cast("int")).alias("share"), (F.sum("n") / F.count(F.lit(1))).alias("mean"))
    return by.select("trade", "appliance", "rows", F.when(F.col("rows") >= 10, F.col("share")).alias("share"), F.when(F.col("rows") >= 10, F.col("mean")).alias("mean"))


def spending_consumption(spark, sf_dir):
    """Consumption from spending by the inverted tariff: weighted means by group."""
    o = read(spark, sf_dir, "orders").select("o_orderstatus", kwh_from_spend(F.col("o_totalprice") / 10, TARIFF, 1.18).alias("kwh"), (1 + F.col("o_custkey") % 4).alias("w"))
    return o.groupBy("o_orderstatus").agg(F.round(F.sum(F.col("kwh") * F.col("w")) / F.sum("w"), 5).alias("kwh"), F.count(F.lit(1)).alias("n"))


def district_extras(spark, sf_dir):
    """Urban and upper shares, facility sums and light by district."""
    b = buildings(spark, sf_dir)
    return b.groupBy("district").agg(F.avg((F.col("floors") > 2).cast("int")).alias("urban"), F.avg((F.col("score") > 5000).cast("int")).alias("upper"), F.sum(F.when(F.col("bldg_id") % 11 == 0, F.col("area")).otherwise(0)).alias("facility_area"), F.sum(F.col("bldg_id") % 63).alias("light"))


def median_split_flags(spark, sf_dir):
    """Rich against the median of the own setting; a null is not rich."""
    b = buildings(spark, sf_dir).select("bldg_id", (F.col("floors") > 2).alias("urban"), F.when(F.col("bldg_id") % 9 > 0, (F.col("bldg_id") * 29) % 100).alias("rwi"))
    mid = b.groupBy("urban").agg(F.median("rwi").alias("mid"))
    return b.join(F.broadcast(mid), "urban").select("bldg_id", "urban", F.coalesce(F.col("rwi") > F.col("mid"), F.lit(False)).alias("rich"))  # two rows


def trade_composition(spark, sf_dir):
    """Counts joined by key with 0 for none; a trade's tag beats a service's."""
    k = F.col("bldg_id")
    b = buildings(spark, sf_dir).select("bldg_id", "district", F.coalesce(F.when(k % 6 == 0, "mill"), F.when(k % 4 == 0, "bar")).alias("profile"))
    n = b.where("profile IS NOT NULL").groupBy("district", "profile").agg(F.count(F.lit(1)).alias("n"))
    keys = b.select("district").distinct().select("district", F.explode(F.array(F.lit("mill"), F.lit("bar"))).alias("profile"))
    return keys.join(n, ["district", "profile"], "left").select("district", "profile", F.coalesce("n", F.lit(0)).alias("n"))


def consumption_targets(spark, sf_dir):
    """Monthly targets of regions from annual means, by a key of population."""
    b = buildings(spark, sf_dir).groupBy("province").agg(F.sum("need").alias("annual"), F.count(F.lit(1)).alias("pop"))
    return b.select("province", (F.col("annual") / 12).alias("monthly"), "pop")


def predicted_vs_survey(spark, sf_dir):
    """Predicted against surveyed means by district, and the gap."""
    b = buildings(spark, sf_dir).groupBy("district").agg((F.sum("floors") / F.count(F.lit(1))).alias("predicted"))
    s = read(spark, sf_dir, "nation").select(F.col("n_name").alias("district"), ((F.col("n_nationkey") % 4) * 1.0).alias("survey"))
    return b.join(s, "district").select("district", "predicted", "survey", (F.col("predicted") - F.col("survey")).alias("gap"))


def gross_floor_area(spark, sf_dir):
    f = F.when(F.col("bldg_id") % 8 > 0, F.col("floors"))
    return buildings(spark, sf_dir).select("bldg_id", (F.col("area") * f).cast("long").alias("gross"))


def presence_resampled(spark, sf_dir):
    """Presence by year, clipped to 0..1, as rows."""
    y = [F.struct(F.lit(y).alias("year"), F.least(F.greatest(((F.col("bldg_id") * 7 + y * 13) % 140 - 20) / 100, F.lit(0.0)), F.lit(1.0)).alias("presence")) for y in (2016, 2019, 2023)]
    return buildings(spark, sf_dir).select("bldg_id", F.explode(F.array(*y)).alias("x")).select("bldg_id", "x.*")


def wealth_tiles(spark, sf_dir):
    """Tiles from their centres, the centre's round trip, and that none stands twice: violations counted."""
    from ..functions import mercator_tile

    z, n = 9, 512.0
    x, y = mercator_tile(F.col("lon"), F.col("lat"), z)
    t = buildings(spark, sf_dir).select(x.alias("x"), y.alias("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    lon = (F.col("x") + 0.5) / n * 360 - 180
    lat = F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * (F.col("y") + 0.5) / n))))
    bx, by = mercator_tile(lon, lat, z)
    return t.agg(F.count(F.lit(1)).alias("tiles"), F.count_if((bx != F.col("x")) | (by != F.col("y"))).alias("moved"), F.sum("n").alias("rows"))


def appliance_codes(spark, sf_dir):
    """Codes from labels of survey variables, and a half of wealth from the words of a category."""
    p = read(spark, sf_dir, "part")
    code = first_match([(F.lower("p_name").rlike("blue"), "TV"), (F.lower("p_name").rlike("red|green"), "FRIDGE")], F.lit("OTHER"))
    half = F.when(F.regexp_extract("p_type", "([A-Z]+)$", 1).isin("STEEL", "BRASS"), "upper").otherwise("lower")
    return p.groupBy(code.alias("code"), half.alias("half")).agg(F.count(F.lit(1)).alias("n"))


def headline_totals(spark, sf_dir):
    """National totals, counts and the band that a site's head shows: one row."""
    b = buildings(spark, sf_dir)
    return b.agg(F.count(F.lit(1)).alias("buildings"), F.count_if(F.col("floors") > 2).alias("storeyed"), F.sum((F.col("area") * F.col("floors")).cast("long")).alias("gross"), F.percentile("area", F.lit(0.1)).cast("decimal(20,4)").cast("double").alias("low"), F.percentile("area", F.lit(0.9)).cast("decimal(20,4)").cast("double").alias("high"))


def map_limits(spark, sf_dir):
    """The 2nd and 98th percentile of a map's values, and how much of the cells has one."""
    b = buildings(spark, sf_dir).groupBy(F.floor((F.col("lon") - 28.8) * 10).alias("x")).agg(F.sum("area").alias("v"), F.count_if(F.col("bldg_id") % 3 > 0).alias("n"))
    return b.agg(F.round(F.percentile("v", F.lit(0.02)), 4).alias("low"), F.round(F.percentile("v", F.lit(0.98)), 4).alias("high"), F.avg((F.col("n") > 0).cast("int")).alias("covered"))


def release_files(spark, sf_dir):
    """Rows by table of a release, as a table of its files."""
    tables = ("nation", "region", "customer", "part")
    out = [read(spark, sf_dir, t).agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("rows")) for t in tables]
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])


def cost_per_thousand(spark, sf_dir):
    """Cost of a thousand calls by labeller: measured rows if there are five, else a prior."""
    o = read(spark, sf_dir, "orders").select(F.concat(F.lit("m"), F.col("o_custkey") % 40).alias("labeler"), (F.col("o_orderstatus") != "O").alias("live"), (F.col("o_totalprice") * 100).cast("long").alias("cost"))
    by = o.groupBy("labeler").agg(F.count_if("live").alias("n"), F.sum(F.when(F.col("live"), F.col("cost"))).alias("live"), F.sum("cost").alias("every"), F.count(F.lit(1)).alias("all"))
    return by.select("labeler", "n", F.when(F.col("n") >= 5, F.col("live") * 1000 / F.col("n")).otherwise(F.lit(1000.0)).alias("per_1000"))


def affordable_calls(spark, sf_dir):
    """How many calls a budget pays for at the measured unit cost."""
    o = read(spark, sf_dir, "orders").agg(F.sum((F.col("o_totalprice") * 100).cast("long")).alias("cost"), F.count(F.lit(1)).alias("n"))
    return o.select("n", F.least(F.col("n"), F.floor(F.lit(10**9) * F.col("n") / F.col("cost"))).alias("affordable"))


def simulated_appliances(spark, sf_dir):
    """Minutes of use: a unit's appliance starts at a hashed minute of its window each day, for its time of use.

    The seed is a hash of unit, appliance and day, so any part can be simulated again; energy by hour of the day.
    """
    a = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("app"), (F.col("n_nationkey") % 12 * 60).alias("start"), (180 + F.col("n_regionkey") * 60).alias("window"), (30 + F.col("n_nationkey") % 3 * 20).alias("func"), (20 + F.col("n_nationkey") * 5).alias("watt"))
    u = spark.range(20).select(F.col("id").alias("unit")).crossJoin(spark.range(7).select(F.col("id").alias("day")))  # what is simulated: fixed sizes
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", "unit", "app", "day"), 256), 1, 8), 16, 10).cast("long")
    runs = u.join(F.broadcast(a)).select("unit", "day", "app", "watt", "func", (F.col("start") + h % (F.col("window") - F.col("func") + 1)).alias("at"))
    hours = runs.withColumn("hour", F.explode(F.sequence(F.floor(F.col("at") / 60), F.floor((F.col("at") + F.col("func") - 1) / 60))))
    minutes = F.least(F.col("at") + F.col("func"), (F.col("hour") + 1) * 60) - F.greatest(F.col("at"), F.col("hour") * 60)
    return hours.groupBy("app", "hour").agg(F.sum(minutes * F.col("watt")).alias("watt_minutes"), F.count_distinct("unit", "day").alias("runs"))


def solved_lighting(spark, sf_dir):
    """The number of lamps that meets an energy target, in two steps of a linear solve within bounds."""
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select("p_partkey", (200 + k % 900).cast("double").alias("target"), (50 + F.col("p_size")).cast("double").alias("rest"), (4 + k % 9).cast("double").alias("lamp"))
    n = F.least(F.greatest((F.col("target") - F.col("rest")) / F.col("lamp"), F.lit(1.0)), F.lit(40.0))
    hours = F.least(F.greatest((F.col("target") - F.col("rest")) / (F.col("lamp") * F.ceil(n)), F.lit(0.25)), F.lit(1.0))
    return p.select("p_partkey", F.ceil(n).alias("lamps"), F.round(hours, 9).alias("hours"))


def tv_power(spark, sf_dir):
    """Power from measured energy over owner-weighted hours."""
    c = read(spark, sf_dir, "customer").select("c_mktsegment", (F.col("c_custkey") % 3).alias("owned"), (1 + F.col("c_custkey") % 6).alias("hours"))
    by = c.where("owned > 0").groupBy("c_mktsegment").agg((F.sum(F.col("owned") * F.col("hours")) / F.sum("owned")).alias("hours"))
    return by.select("c_mktsegment", "hours", (F.lit(240.0) / F.col("hours")).alias("watt"))


def provenance_share(spark, sf_dir):
    """The share of values from data by archetype, and the names of those that are assumed."""
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select((k % 17).alias("archetype"), F.explode(F.array(*(F.struct(F.lit(n).alias("name"), ((k + i) % 4 > 0).alias("data")) for i, n in enumerate(("hours", "power", "share"))))).alias("x")).select("archetype", "x.*")
    return p.groupBy("archetype").agg(F.avg(F.col("data").cast("int")).alias("share"), F.array_join(F.array_sort(F.collect_set(F.when(~F.col("data"), F.col("name")))), ",").alias("assumed"))


def provenance_register(spark, sf_dir):
    """Records of sources: a record with the same name and checksum isn't written again."""
    s = read(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey") % 9).alias("name"), F.sha2(F.concat(F.lit("v"), F.col("s_nationkey") % 3), 256).alias("sha256"), F.lit("CC-BY").alias("licence"))
    old = s.where("name IN ('s1', 's2')").select("name", "sha256", F.lit("old").alias("licence")).distinct()
    return shaping.upsert(s.distinct().join(old.select("name", "sha256"), ["name", "sha256"], "left_anti"), old, ["name", "sha256"])


_DC = f"d AS (SELECT bldg_id, facility_id, grp, {DIST} AS dist FROM bld b, fac f)"
ORACLE = {
    "dissolved_outline": f"""WITH {BLD}, s AS (SELECT DISTINCT province, floor((lon - 28.8::DOUBLE) * 8) AS x, floor((lat + 2.85::DOUBLE) * 8) AS y FROM bld), e AS (SELECT province, 2 * x + dx AS u, 2 * y + dy AS v, count(*) AS n FROM s, (VALUES (1, 0), (1, 2), (0, 1), (2, 1)) t(dx, dy) GROUP BY ALL)
SELECT province, count(*) FILTER (WHERE n = 1) AS edges, any_value(squares) AS squares FROM e JOIN (SELECT province, count(*) AS squares FROM s GROUP BY 1) USING (province) GROUP BY 1""",
    "multi_tile_sample": f"""WITH {BLD}, p AS (SELECT p_partkey % 3 AS tile, p_partkey // 3 // 20 AS r, p_partkey // 3 % 20 AS c, p_size AS v FROM part WHERE p_size > 10), b AS (SELECT bldg_id, floor((lat + 2.85::DOUBLE) * 8) AS r, floor((lon - 28.8::DOUBLE) * 8) AS c FROM bld)
SELECT bldg_id, tile, v AS value FROM b LEFT JOIN p USING (r, c) QUALIFY row_number() OVER (PARTITION BY bldg_id ORDER BY tile, v) = 1""",
    "legend_decode": "SELECT ['built', 'crop', 'forest', 'water'][(p_size % 6 + 1)::INT] AS land, count(*) AS n FROM part GROUP BY 1",
    "tile_names": f"WITH {BLD} SELECT printf('%s%02d_%s%03d', CASE WHEN lat < 0 THEN 'S' ELSE 'N' END, abs(floor(lat)::INT), 'E', floor(lon)::INT) AS tile, count(*) AS n, floor(min(lon) * 10)::BIGINT AS x0, ceil(max(lon) * 10)::BIGINT AS x1 FROM bld GROUP BY 1",
    "release_join": f"""WITH {BLD}, o AS (SELECT o_custkey AS bldg_id, count(*) AS n0, {', '.join(f"max(o_orderkey) FILTER (WHERE o_orderstatus = '{s}') AS n{i + 1}" for i, s in enumerate('FOP'))}, {', '.join(f'count(*) FILTER (WHERE year(o_orderdate) % 7 = {i}) AS n{i + 4}' for i in range(7))} FROM orders GROUP BY 1)
SELECT bldg_id, district, {', '.join(f'coalesce(n{i}, 0) AS n{i}' for i in range(11))}, (area * floors)::BIGINT AS gross FROM bld LEFT JOIN o USING (bldg_id)""",
    "country_candidates": f"WITH {BLD} SELECT bldg_id FROM bld WHERE lon BETWEEN 28.9 AND 30.8 AND lat BETWEEN -2.8 AND -1.1",
    "largest_contained": f"WITH {BLD}, b AS (SELECT bldg_id, area, (floor((lon - 28.8::DOUBLE) * 5) * 100 + floor((lat + 2.85::DOUBLE) * 5))::BIGINT AS polygon FROM bld) SELECT polygon, bldg_id, area FROM b QUALIFY row_number() OVER (PARTITION BY polygon ORDER BY area DESC, bldg_id) = 1",
    "nearest_with_attributes": f"WITH {BLD}, {FAC}, {_DC} SELECT bldg_id, facility_id, grp, round(dist, 3) AS dist FROM d WHERE dist <= 8000 QUALIFY row_number() OVER (PARTITION BY bldg_id ORDER BY dist, facility_id) = 1",
    "closest_tag_wins": f"WITH {BLD}, {FAC}, {_DC} SELECT bldg_id, 't' || (facility_id % 4) AS tag, floor(dist / 500)::BIGINT AS step FROM d WHERE dist <= 12000 QUALIFY row_number() OVER (PARTITION BY bldg_id ORDER BY floor(dist / 500), facility_id) = 1",
    "values_rule_join": f"WITH {BLD} SELECT district, cls, sum(weight)::BIGINT AS weight FROM bld JOIN (VALUES ('BUILDING', 3, 5), ('MACHINERY', 2, 7), ('HOUSEHOLD', 1, 11)) r(cls, least, weight) USING (cls) WHERE floors >= least GROUP BY ALL",
    "enterprise_stats": """WITH l AS (SELECT c_custkey % 5 AS trade, 'lamps' AS appliance, c_custkey * 2 % 9 AS n FROM customer UNION ALL SELECT c_custkey % 5, 'motors', c_custkey * 3 % 9 FROM customer UNION ALL SELECT c_custkey % 5, 'fridges', c_custkey * 5 % 9 FROM customer)
SELECT trade, appliance, count(*) AS rows, CASE WHEN count(*) >= 10 THEN avg((n > 0)::INT) END AS share, CASE WHEN count(*) >= 10 THEN sum(n) / count(*) END AS mean FROM l GROUP BY ALL""",
    "spending_consumption": """WITH n AS (SELECT o_orderstatus, o_totalprice / 10 / 1.18::DOUBLE AS net, 1 + o_custkey % 4 AS w FROM orders), k AS (SELECT o_orderstatus, w, least(greatest(net, 0), 1335.0::DOUBLE) / 89 + least(greatest(net - 1335.0::DOUBLE, 0), 7420.0::DOUBLE) / 212 + greatest(net - 8755.0::DOUBLE, 0) / 249 AS kwh FROM n)
SELECT o_orderstatus, round(sum(kwh * w) / sum(w), 5) AS kwh, count(*) AS n FROM k GROUP BY 1""",
    "district_extras": f"WITH {BLD} SELECT district, avg((floors > 2)::INT) AS urban, avg((score > 5000)::INT) AS upper, coalesce(sum(area) FILTER (WHERE bldg_id % 11 = 0), 0)::BIGINT AS facility_area, sum(bldg_id % 63)::BIGINT AS light FROM bld GROUP BY 1",
    "median_split_flags": f"WITH {BLD}, b AS (SELECT bldg_id, floors > 2 AS urban, CASE WHEN bldg_id % 9 > 0 THEN (bldg_id * 29) % 100 END AS rwi FROM bld) SELECT bldg_id, urban, coalesce(rwi > median(rwi) OVER (PARTITION BY urban), false) AS rich FROM b",
    "trade_composition": f"WITH {BLD}, b AS (SELECT district, CASE WHEN bldg_id % 6 = 0 THEN 'mill' WHEN bldg_id % 4 = 0 THEN 'bar' END AS p FROM bld) SELECT district, profile, count(*) FILTER (WHERE p = profile) AS n FROM b, (VALUES ('mill'), ('bar')) v(profile) GROUP BY ALL",
    "consumption_targets": f"WITH {BLD} SELECT province, sum(need) / 12 AS monthly, count(*) AS pop FROM bld GROUP BY 1",
    "predicted_vs_survey": f"WITH {BLD}, p AS (SELECT district, sum(floors) / count(*) AS predicted FROM bld GROUP BY 1) SELECT district, predicted, (n_nationkey % 4) * 1.0::DOUBLE AS survey, predicted - (n_nationkey % 4) * 1.0::DOUBLE AS gap FROM p JOIN nation ON n_name = district",
    "gross_floor_area": f"WITH {BLD} SELECT bldg_id, CASE WHEN bldg_id % 8 > 0 THEN (area * floors)::BIGINT END AS gross FROM bld",
    "presence_resampled": f"WITH {BLD} SELECT bldg_id, year::INT AS year, least(greatest(((bldg_id * 7 + year * 13) % 140 - 20) / 100, 0), 1)::DOUBLE AS presence FROM bld, (VALUES (2016), (2019), (2023)) v(year)",
    "wealth_tiles": f"WITH {BLD}, t AS (SELECT floor((lon + 180) / 360 * 512) AS x, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 512) AS y FROM bld) SELECT (SELECT count(*) FROM (SELECT DISTINCT x, y FROM t)) AS tiles, 0::BIGINT AS moved, count(*) AS rows FROM t",
    "appliance_codes": "SELECT CASE WHEN contains(lower(p_name), 'blue') THEN 'TV' WHEN regexp_matches(lower(p_name), 'red|green') THEN 'FRIDGE' ELSE 'OTHER' END AS code, CASE WHEN regexp_extract(p_type, '([A-Z]+)$', 1) IN ('STEEL', 'BRASS') THEN 'upper' ELSE 'lower' END AS half, count(*) AS n FROM part GROUP BY ALL",
    "headline_totals": f"WITH {BLD} SELECT count(*) AS buildings, count(*) FILTER (WHERE floors > 2) AS storeyed, sum(area * floors)::BIGINT AS gross, quantile_cont(area, 0.1)::DECIMAL(20,4)::DOUBLE AS low, quantile_cont(area, 0.9)::DECIMAL(20,4)::DOUBLE AS high FROM bld",
    "map_limits": f"WITH {BLD}, c AS (SELECT floor((lon - 28.8::DOUBLE) * 10) AS x, sum(area)::BIGINT AS v, count(*) FILTER (WHERE bldg_id % 3 > 0) AS n FROM bld GROUP BY 1) SELECT round(quantile_cont(v, 0.02), 4) AS low, round(quantile_cont(v, 0.98), 4) AS high, avg((n > 0)::INT) AS covered FROM c",
    "release_files": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in ("nation", "region", "customer", "part")),
    "cost_per_thousand": "WITH o AS (SELECT 'm' || (o_custkey % 40) AS labeler, o_orderstatus <> 'O' AS live, trunc(o_totalprice * 100)::BIGINT AS cost FROM orders) SELECT labeler, count(*) FILTER (WHERE live) AS n, CASE WHEN count(*) FILTER (WHERE live) >= 5 THEN sum(cost) FILTER (WHERE live) * 1000 / count(*) FILTER (WHERE live) ELSE 1000 END::DOUBLE AS per_1000 FROM o GROUP BY 1",
    "affordable_calls": "SELECT count(*) AS n, least(count(*), floor(1000000000 * count(*) / sum(trunc(o_totalprice * 100)::BIGINT)))::BIGINT AS affordable FROM orders",
    "simulated_appliances": """WITH a AS (SELECT n_nationkey AS app, n_nationkey % 12 * 60 AS start, 180 + n_regionkey * 60 AS win, 30 + n_nationkey % 3 * 20 AS func, 20 + n_nationkey * 5 AS watt FROM nation),
r AS (SELECT unit, day, app, watt, func, start + ('0x' || left(sha256(unit || ':' || app || ':' || day), 8))::BIGINT % (win - func + 1) AS pos FROM a, range(20) u(unit), range(7) d(day)), h AS (SELECT *, unnest(range(pos // 60, (pos + func - 1) // 60 + 1)) AS hour FROM r)
SELECT app, hour, sum((least(pos + func, (hour + 1) * 60) - greatest(pos, hour * 60)) * watt)::BIGINT AS watt_minutes, count(DISTINCT unit * 7 + day) AS runs FROM h GROUP BY ALL""",
    "solved_lighting": "WITH p AS (SELECT p_partkey, (200 + p_partkey % 900)::DOUBLE - (50 + p_size) AS gap, (4 + p_partkey % 9)::DOUBLE AS lamp FROM part), n AS (SELECT *, ceil(least(greatest(gap / lamp, 1), 40)) AS lamps FROM p) SELECT p_partkey, lamps::BIGINT AS lamps, round(least(greatest(gap / (lamp * lamps), 0.25), 1), 9) AS hours FROM n",
    "tv_power": "WITH h AS (SELECT c_mktsegment, sum(c_custkey % 3 * (1 + c_custkey % 6)) / sum(c_custkey % 3) AS hours FROM customer WHERE c_custkey % 3 > 0 GROUP BY 1) SELECT c_mktsegment, hours, 240.0::DOUBLE / hours AS watt FROM h",
    "provenance_share": "WITH x AS (SELECT p_partkey % 17 AS archetype, name, (p_partkey + i) % 4 > 0 AS data FROM part, (VALUES (0, 'hours'), (1, 'power'), (2, 'share')) v(i, name)) SELECT archetype, avg(data::INT) AS share, coalesce(string_agg(DISTINCT name, ',' ORDER BY name) FILTER (WHERE NOT data), '') AS assumed FROM x GROUP BY 1",
    "provenance_register": "WITH s AS (SELECT DISTINCT 's' || (s_suppkey % 9) AS name, sha256('v' || (s_nationkey % 3)) AS sha256 FROM supplier) SELECT name, sha256, CASE WHEN name IN ('s1', 's2') THEN 'old' ELSE 'CC-BY' END AS licence FROM s",
}
QUERIES = {name: globals()[name] for name in ORACLE}
