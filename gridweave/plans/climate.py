"""Contract queries of climate composites: interpolation, lapse shift before thresholds, humidity, radiation, elevation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import first_match
from ..operators import climate
from ..sources import read
from .core import BLD, buildings


def _nodes(spark, sf_dir):
    """Hours of ten nodes on a grid of five by two: value as temperature."""
    n = F.col("user_id") % 10
    return read(spark, sf_dir, "events").select((n % 5).alias("i"), F.floor(n / 5).alias("j"), F.timestamp_add("HOUR", F.lit(2), "ts").alias("ts"), F.round(F.col("value") * 100).cast("long").alias("v"))


def _elevation():
    return ((F.col("i") * 37 + F.col("j") * 91) % 500).cast("double")


def _targets(spark, sf_dir):
    """Cells with their place on the node grid, their elevation and how many buildings they hold."""
    b = buildings(spark, sf_dir).groupBy(F.floor((F.col("lon") - 28.8) * 2).alias("cx"), F.floor((F.col("lat") + 2.85) * 2).alias("cy")).agg(F.count(F.lit(1)).alias("n"))
    return b.select((F.col("cx") * 100 + F.col("cy")).alias("cell"), "n", F.least((F.col("cx") * 0.75), F.lit(4.0)).alias("x"), F.least(F.col("cy") * 0.25, F.lit(1.0)).alias("y"), ((F.col("cx") * 53 + F.col("cy") * 17) % 700).cast("double").alias("elev"))


def target_cells(spark, sf_dir):
    return _targets(spark, sf_dir)


def lapse_fit(spark, sf_dir):
    day = climate.daily(_nodes(spark, sf_dir), ["i", "j"], "ts", "v")
    return climate.lapse_rate(day.withColumn("elev", _elevation()), ["i", "j"], "elev", "mean").select(F.round("slope", 9).alias("slope"), F.round("intercept", 6).alias("intercept"))


def climate_composite(spark, sf_dir):
    """By cell: the mean, the 95th percentile of daily maxima, degree days over two bases, and the class of cooling need."""
    day = climate.daily(_nodes(spark, sf_dir), ["i", "j"], "ts", "v").withColumn("elev", _elevation())
    out = climate.composite(_targets(spark, sf_dir), day, "cell", bases=[4000.0, 5000.0])
    need = first_match([(F.col("top_p95") >= 8000, "high"), (F.col("top_p95") >= 6500, "medium")], F.lit("low"))
    return out.select("cell", *(F.round(c, 4).alias(c) for c in ("mean", "top_p95", "over_4000", "over_5000")), "days", need.alias("cooling"))


def humidity_mean(spark, sf_dir):
    """Relative humidity from temperature and dew point by the Magnus formula, clipped to 0..100."""
    e = read(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("node"), (F.col("value") / 4).alias("t"), (F.col("value") / 4 - F.col("user_id") % 13).alias("td"))
    return e.groupBy("node").agg(F.round(F.avg(climate.humidity(F.col("t"), F.col("td"))), 6).alias("rh"), F.count(F.lit(1)).alias("n"))


def radiation_mean(spark, sf_dir):
    """Multi-year means by coarse node, without fill values."""
    e = read(spark, sf_dir, "events").select((F.col("user_id") % 4).alias("node"), F.when(F.col("user_id") % 9 == 0, -999).otherwise(F.round(F.col("value") * 100).cast("long")).alias("ghi"), F.month("ts").alias("m"))
    return e.where("ghi > -900").groupBy("node", "m").agg((F.sum("ghi") / F.count(F.lit(1))).alias("ghi"), F.count(F.lit(1)).alias("n"))


def node_elevation(spark, sf_dir):
    """Elevations of nodes by rounded coordinates; raises if a node has none."""
    n = _nodes(spark, sf_dir).select("i", "j").distinct().select((F.col("i") / 10 + 1e-9).alias("lon"), (F.col("j") / 10).alias("lat"))
    known = spark.range(0, 100).select((F.floor(F.col("id") / 10) / 10).alias("lon"), ((F.col("id") % 10) / 10).alias("lat"), ((F.floor(F.col("id") / 10) * 37 + (F.col("id") % 10) * 91) % 500).alias("elev"))
    return climate.looked_up(n, known, ["lon", "lat"], 1, "elev")


def weighted_exposure(spark, sf_dir):
    """Shares and means over cells, weighed by the buildings they hold."""
    t = _targets(spark, sf_dir).select("n", "elev", (F.col("elev") > 300).cast("int").alias("high"))
    return t.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("elev")) / F.sum("n")).alias("mean_elev"), (F.sum(F.col("n") * F.col("high")) / F.sum("n")).alias("share_high"))


def enclosing_nodes(spark, sf_dir):
    """Grid nodes around a box and one ring more, in whole steps so that no coordinate drifts."""
    box = buildings(spark, sf_dir).agg(F.floor(F.min("lon") * 10).alias("x0"), F.ceil(F.max("lon") * 10).alias("x1"), F.floor(F.min("lat") * 10).alias("y0"), F.ceil(F.max("lat") * 10).alias("y1"))
    n = box.select(F.explode(F.expr("sequence(x0 - 1, x1 + 1)")).alias("x"), "y0", "y1").select("x", F.explode(F.expr("sequence(y0 - 1, y1 + 1)")).alias("y"))
    return n.select((F.col("x") / 10).alias("lon"), (F.col("y") / 10).alias("lat"))


def hourly_arrays(spark, sf_dir):
    """JSON arrays of an API's answer as a long table: times and values side by side."""
    e = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 5).alias("node")).agg(F.array_sort(F.collect_set(F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd'T'HH:mm"))).alias("time"))
    text = F.to_json(F.struct(F.lit("UTC").alias("timezone"), F.struct("time", F.transform("time", lambda t, i: i * 2 + F.col("node")).alias("t2m")).alias("hourly")))
    r = e.select("node", F.from_json(text, "timezone string, hourly struct<time:array<string>,t2m:array<long>>").alias("r")).where("r.timezone = 'UTC'")
    return r.select("node", F.explode(F.arrays_zip(F.col("r.hourly.time").alias("time"), F.col("r.hourly.t2m").alias("t2m"))).alias("x")).select("node", F.to_timestamp("x.time").alias("ts"), "x.t2m")


_TGT = f"""tgt AS (SELECT cx * 100 + cy AS cell, n, least(cx * 0.75::DOUBLE, 4) AS x, least(cy * 0.25::DOUBLE, 1) AS y, ((cx * 53 + cy * 17) % 700)::DOUBLE AS elev FROM (SELECT floor((lon - 28.8::DOUBLE) * 2)::BIGINT AS cx, floor((lat + 2.85::DOUBLE) * 2)::BIGINT AS cy, count(*) AS n FROM bld GROUP BY ALL))"""
_DAY = """hrs AS (SELECT user_id % 10 % 5 AS i, (user_id % 10) // 5 AS j, ts + INTERVAL 2 HOUR AS ts, round(value * 100)::BIGINT AS v FROM events),
day AS (SELECT i, j, ts::DATE AS day, sum(v) / count(*) AS mean, max(v)::DOUBLE AS top, ((i * 37 + j * 91) % 500)::DOUBLE AS elev FROM hrs GROUP BY ALL),
fit AS (SELECT regr_slope(m, elev) AS slope, regr_intercept(m, elev) AS intercept FROM (SELECT i, j, elev, avg(mean) AS m FROM day GROUP BY ALL))"""
ORACLE = {
    "target_cells": f"WITH {BLD}, {_TGT} SELECT * FROM tgt",
    "lapse_fit": f"WITH {_DAY} SELECT round(slope, 9) AS slope, round(intercept, 6) AS intercept FROM fit",
    "climate_composite": f"""WITH {BLD}, {_TGT}, {_DAY}, crn AS (SELECT cell, elev, i, j, (1 - abs(x - i)) * (1 - abs(y - j)) AS w FROM tgt, (SELECT DISTINCT i, j FROM day) WHERE abs(x - i) < 1 AND abs(y - j) < 1),
grd AS (SELECT cell, sum(w * n.elev) AS e FROM crn JOIN (SELECT DISTINCT i, j, elev FROM day) n USING (i, j) GROUP BY 1),
ser AS (SELECT cell, day, sum(w * mean) / sum(w) + any_value((crn.elev - grd.e) * slope) AS mean, sum(w * top) / sum(w) + any_value((crn.elev - grd.e) * slope) AS top FROM crn JOIN day USING (i, j) JOIN grd USING (cell), fit GROUP BY ALL),
yrs AS (SELECT cell, year(day) AS y, sum(greatest(mean - 4000, 0)) AS a, sum(greatest(mean - 5000, 0)) AS b FROM ser GROUP BY ALL), avgs AS (SELECT cell, avg(a) AS a, avg(b) AS b FROM yrs GROUP BY 1),
o AS (SELECT cell, avg(mean) AS mean, quantile_cont(top, 0.95) AS p, count(*) AS days FROM ser GROUP BY 1)
SELECT cell, round(mean, 4) AS mean, round(p, 4) AS top_p95, round(a, 4) AS over_4000, round(b, 4) AS over_5000, days, CASE WHEN round(p, 4) >= 8000 THEN 'high' WHEN round(p, 4) >= 6500 THEN 'medium' ELSE 'low' END AS cooling FROM o JOIN avgs USING (cell)""",
    "humidity_mean": """WITH e AS (SELECT user_id % 10 AS node, value / 4 AS t, value / 4 - user_id % 13 AS td FROM events)
SELECT node, round(avg(least(greatest(100 * exp(17.625::DOUBLE * td / (243.04::DOUBLE + td)) / exp(17.625::DOUBLE * t / (243.04::DOUBLE + t)), 0), 100)), 6) AS rh, count(*) AS n FROM e GROUP BY 1""",
    "radiation_mean": "SELECT user_id % 4 AS node, month(ts)::INT AS m, sum(round(value * 100)::BIGINT) / count(*) AS ghi, count(*) AS n FROM events WHERE user_id % 9 > 0 GROUP BY ALL",
    "node_elevation": "SELECT DISTINCT (user_id % 10 % 5) / 10 AS lon, ((user_id % 10) // 5) / 10 AS lat, ((user_id % 10 % 5) * 37 + ((user_id % 10) // 5) * 91) % 500 AS elev FROM events",
    "weighted_exposure": f"WITH {BLD}, {_TGT} SELECT sum(n)::BIGINT AS n, sum(n * elev) / sum(n) AS mean_elev, sum(n * (elev > 300)::INT) / sum(n) AS share_high FROM tgt",
    "enclosing_nodes": f"WITH {BLD}, b AS (SELECT floor(min(lon) * 10)::BIGINT AS x0, ceil(max(lon) * 10)::BIGINT AS x1, floor(min(lat) * 10)::BIGINT AS y0, ceil(max(lat) * 10)::BIGINT AS y1 FROM bld), x AS (SELECT unnest(range(x0 - 1, x1 + 2)) AS x FROM b), y AS (SELECT unnest(range(y0 - 1, y1 + 2)) AS y FROM b) SELECT x / 10 AS lon, y / 10 AS lat FROM x, y",
    "hourly_arrays": "WITH d AS (SELECT DISTINCT user_id % 5 AS node, date_trunc('day', ts)::TIMESTAMP AS ts FROM events) SELECT node, ts, (row_number() OVER (PARTITION BY node ORDER BY ts) - 1) * 2 + node AS t2m FROM d",
}
QUERIES = {name: globals()[name] for name in ORACLE}
