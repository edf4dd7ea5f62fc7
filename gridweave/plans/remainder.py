"""Contract queries of units, text folding, canonical hashes, renormalised shares, agreement and document bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import first_match
from ..operators import curation, shaping
from ..sources import read, shared_folder
from .core import BLD, buildings


def bbox_struct_scan(spark, sf_dir):
    """A nested box column: the predicate on its fields reaches the scan, which skips row groups by their statistics."""
    import uuid

    at = f"{shared_folder(spark)}/boxes-{uuid.uuid4().hex}"
    b = buildings(spark, sf_dir)
    box = F.struct(F.col("lon").alias("xmin"), (F.col("lon") + 0.001).alias("xmax"), F.col("lat").alias("ymin"), (F.col("lat") + 0.001).alias("ymax"))
    b.select("bldg_id", "province", box.alias("bbox")).repartitionByRange("bbox.xmin").sortWithinPartitions("bbox.xmin").write.partitionBy("province").parquet(at)
    return spark.read.parquet(at).where("bbox.xmin >= 29.4 AND bbox.xmax <= 30.2 AND province IN ('ASIA', 'AFRICA')").select("bldg_id", "province")


def unit_conversion(spark, sf_dir):
    """Values in listed units to watts, kilowatt-hours and degrees by one small table; unknown units are null."""
    units = spark.createDataFrame([("W", 1.0, 0.0), ("kW", 1000.0, 0.0), ("MJ", 0.2777777777777778, 0.0), ("K", 1.0, -273.15), ("pct", 0.01, 0.0)], "unit string, factor double, shift double")
    p = read(spark, sf_dir, "part").select("p_partkey", F.element_at(F.array(*map(F.lit, ("W", "kW", "MJ", "K", "pct", "yd"))), (F.col("p_partkey") % 6 + 1).cast("int")).alias("unit"), F.col("p_size").cast("double").alias("v"))
    return p.join(F.broadcast(units), "unit", "left").select("p_partkey", "unit", (F.col("v") * F.col("factor") + F.col("shift")).alias("value"))


def extracted_fields(spark, sf_dir):
    """First numbers, tags, slugs and clock times out of texts."""
    k = F.col("p_partkey")
    text = F.concat(F.lit('h='), (k % 40).cast("string"), F.lit('m "use"=>"'), F.col("p_type"), F.lit('", opens '), (k % 24).cast("string"), F.lit("h"), F.lpad((k % 60).cast("string"), 2, "0"))
    clock = F.regexp_extract(text, r"opens (\d+)h(\d\d)", 1).cast("int") * 60 + F.regexp_extract(text, r"opens (\d+)h(\d\d)", 2).cast("int")
    slug = F.regexp_replace(F.regexp_replace(F.lower("p_name"), "[^a-z0-9]+", "-"), "^-|-$", "")
    return read(spark, sf_dir, "part").select("p_partkey", F.regexp_extract(text, r"(\d+(?:\.\d+)?)", 1).cast("double").alias("height"), F.regexp_extract(text, '"use"=>"([^"]*)"', 1).alias("use"), clock.cast("int").alias("minute"), slug.alias("slug"))


def folded_quotes(spark, sf_dir):
    """Quotes checked after full compatibility folding (NFKC) of both sides."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("page"))
    odd = F.translate(F.substring("page", 5, 30), "aeo", "ａｅｏ")
    return d.select("doc_id", F.contains(curation.folded(F.col("page")), curation.folded(odd)).alias("verified"))


def canonical_hashes(spark, sf_dir):
    """Keys of requests: the sha256 of JSON with sorted keys, whatever order the fields came in."""
    c = read(spark, sf_dir, "customer")
    one = F.to_json(curation.sorted_map(F.create_map(F.lit("seg"), F.col("c_mktsegment"), F.lit("id"), F.col("c_custkey").cast("string"))))
    return c.select("c_custkey", F.sha2(one, 256).alias("key"))


def calibrated_shares(spark, sf_dir):
    """Class shares times prior factors, over their sum; a sum near 0 leaves zeros."""
    k = F.col("bldg_id")
    raw = {"a": k % 5, "b": (k * 3) % 7, "c": (k * 5) % 11}
    factor = {"a": 2.0, "b": 0.5, "c": 0.0}
    own = {c: raw[c] * factor[c] for c in raw}
    total = F.greatest(sum(list(own.values())[1:], own["a"]), F.lit(1e-9))
    return buildings(spark, sf_dir).select("bldg_id", *((v / total).alias(c) for c, v in own.items()))


def census_trade_split(spark, sf_dir):
    """A census count by the national shares of activities of each setting, whole units with the rest to the first."""
    b = buildings(spark, sf_dir).groupBy("district").agg(F.sum("floors").alias("census"), F.count_if(F.col("floors") > 2).alias("urban"), F.count(F.lit(1)).alias("n"))
    shares = spark.createDataFrame([("mill", 5, 40), ("tailor", 30, 25), ("bar", 65, 35)], "trade string, town long, country long")
    part = F.floor(F.col("census") * (F.col("urban") * F.col("town") + (F.col("n") - F.col("urban")) * F.col("country")) / (F.col("n") * 100))
    return b.join(F.broadcast(shares)).select("district", "trade", part.cast("long").alias("units"))  # three rows


def run_agreement(spark, sf_dir):
    """In how many of ten noisy runs a building keeps its most frequent class, and bands added in quadrature."""
    b = buildings(spark, sf_dir).select("bldg_id", "district", "area", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("run"))
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("bldg_id").cast("string"), F.col("run").cast("string"))), 1, 6), 16, 10).cast("long")
    b = b.withColumn("cls", (F.col("bldg_id") % 3 + F.when(h % 4 == 0, 1).otherwise(0)) % 3)
    n = b.groupBy("bldg_id", "district", "cls").agg(F.count(F.lit(1)).alias("n")).groupBy("bldg_id", "district").agg(F.max("n").alias("most"))
    return n.groupBy("district").agg((F.sum("most") / (F.count(F.lit(1)) * 10)).alias("agreement"), F.round(F.sqrt(F.pow(F.max("most").cast("double"), F.lit(2.0)) + F.pow(F.min("most").cast("double"), F.lit(2.0))), 9).alias("band"))


def curated_quotes(spark, sf_dir):
    """Entries of a curated list whose quote stands in the text that they cite."""
    b = read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("page"))
    e = b.select("item", F.when(F.abs(F.hash("item")) % 2 >= 0, F.substring("page", 3, 25)).alias("quote"), F.lit("ok").alias("entry"))
    bad = b.select("item", F.concat(F.lit("no such "), "item").alias("quote"), F.lit("bad").alias("entry"))
    both = e.unionAll(bad).join(b, "item")
    return both.select("item", "entry", F.contains(curation.plain_text(F.col("page")), curation.plain_text(F.col("quote"))).alias("verified"))


def raster_context(spark, sf_dir):
    """Layers of rasters at each building, one join a layer, with the latest layer's version alone."""
    p = read(spark, sf_dir, "part").select("p_partkey", F.expr("p_partkey div 20").alias("row"), (F.col("p_partkey") % 20).alias("col"), "p_size")
    b = buildings(spark, sf_dir).select("bldg_id", F.floor((F.col("lat") + 2.85) * 10).alias("row"), F.floor((F.col("lon") - 28.8) * 10).alias("col"))
    land = p.select("row", "col", (F.col("p_size") % 5).alias("land"))
    people = p.where("p_partkey % 2 = 0").select("row", "col", (F.col("p_size") * 3).alias("people"))
    return b.join(land, ["row", "col"], "left").join(people, ["row", "col"], "left").select("bldg_id", "land", "people")


def assembled_grid(spark, sf_dir):
    """Two tiles of a grid, each averaged over blocks, put together on one snapped grid; where they overlap the first stays."""
    p = read(spark, sf_dir, "part").select((F.col("p_partkey") % 2).alias("tile"), F.expr("p_partkey div 40").alias("r"), (F.col("p_partkey") % 40).alias("c"), "p_size")
    blocks = p.groupBy("tile", F.floor(F.col("r") / 4).alias("row"), F.floor((F.col("c") + F.col("tile") * 6) / 4).alias("col")).agg(F.avg((F.col("p_size") > 20).cast("int")).alias("share"))
    return blocks.groupBy("row", "col").agg(F.min_by("share", "tile").alias("share"), F.min("tile").alias("tile"))


def profile_documents(spark, sf_dir):
    """A document a profile: its appliances in order with hours and an upper bound, and where each comes from."""
    p = read(spark, sf_dir, "part").select((F.col("p_partkey") % 9).alias("profile"), "p_partkey", (F.col("p_size") % 24).alias("hours"), (F.col("p_size") * 10).alias("watt"))
    item = F.struct("p_partkey", "hours", (F.col("hours") * F.col("watt")).alias("wh"))
    return p.groupBy("profile").agg(F.sum("watt").alias("watt"), F.sha2(F.to_json(F.array_sort(F.collect_list(item))), 256).alias("doc"), F.count(F.lit(1)).alias("n"), F.sum(F.col("hours") * F.col("watt")).alias("most_wh"))


def merged_shards(spark, sf_dir):
    """Shards of sub-districts merged by district, with a national sum by year and without some keys."""
    o = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 6).alias("district"), (F.col("o_custkey") % 30).alias("sub"), F.year("o_orderdate").alias("year"), (F.col("o_totalprice") * 100).cast("long").alias("v"))
    sub = o.groupBy("district", "sub", "year").agg(F.sum("v").alias("v"))
    by = sub.groupBy("district", "year").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("shards"))
    nation = by.groupBy("year").agg(F.sum("v").alias("v"), F.sum("shards").alias("shards")).select(F.lit(None).cast("long").alias("district"), "year", "v", "shards")
    return by.select("district", "year", "v", "shards").unionAll(nation)


def rule_profile_ids(spark, sf_dir):
    """Ids of profiles that rules name, without references to other classes."""
    rules = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("rule"), F.map_from_arrays(F.array(F.concat(F.lit("p"), (F.col("p_partkey") % 14).cast("string")), F.concat(F.when(F.col("p_partkey") % 3 == 0, "@c").otherwise("q"), (F.col("p_partkey") % 5).cast("string"))), F.array(F.lit(1.0), F.lit(2.0))).alias("profiles"))
    ids = rules.select(F.explode(F.map_keys("profiles")).alias("profile_id")).where("profile_id NOT LIKE '@%'")
    return ids.groupBy("profile_id").agg(F.count(F.lit(1)).alias("rules"))


def source_catalogue(spark, sf_dir):
    """Sources with the steps that use them: a small catalogue join, unused ones kept."""
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source"), F.col("n_name").alias("title"))
    steps = read(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 12).alias("source"), F.concat(F.lit("step"), (F.col("s_suppkey") % 5).cast("string")).alias("step")).distinct()
    return n.join(steps, "source", "left").groupBy("source", "title").agg(F.array_join(F.array_sort(F.collect_set("step")), ",").alias("steps"))


def centroid_and_box(spark, sf_dir):
    """The centroid by area, the box and the corners of a ring with a notch."""
    k = F.col("bldg_id")
    x, y, w = (k * 7 % 90).cast("double"), (k * 13 % 70).cast("double"), (4 + k % 7 * 2).cast("double")
    pts = [(0.0, 0.0), (1.0, 0.0), (1.0, 0.5), (0.5, 0.5), (0.5, 1.0), (0.0, 1.0), (0.0, 0.0)]
    ring = F.array(*(F.struct((x + w * a).alias("x"), (y + w * b).alias("y")) for a, b in pts))
    n = F.size("ring")
    terms = F.zip_with(F.slice("ring", F.lit(1), n - 1), F.slice("ring", F.lit(2), n - 1), lambda a, b: F.struct((a["x"] * b["y"] - b["x"] * a["y"]).alias("c"), (a["x"] + b["x"]).alias("sx"), (a["y"] + b["y"]).alias("sy")))
    out = buildings(spark, sf_dir).select("bldg_id", ring.alias("ring")).select("bldg_id", "ring", terms.alias("t"))
    total = lambda f: F.aggregate("t", F.lit(0.0), lambda s, t: s + f(t))
    double = total(lambda t: t["c"])
    return out.select("bldg_id", F.round(total(lambda t: t["sx"] * t["c"]) / (3 * double), 7).alias("cx"), F.round(total(lambda t: t["sy"] * t["c"]) / (3 * double), 7).alias("cy"), F.array_max(F.transform("ring", lambda p: p["x"])).alias("xmax"), F.array_min(F.transform("ring", lambda p: p["y"])).alias("ymin"), (F.size("ring") - 1).alias("corners"))


def within_fifteen_metres(spark, sf_dir):
    """Candidates within 15 m of each other on a dense street, each pair once."""
    from ..operators import neighbours

    k = F.col("bldg_id")
    b = buildings(spark, sf_dir).select("bldg_id", (29 + (k * 7919 % 5000) / 1e6).alias("lon"), (-2 + (k * 104729 % 5000) / 1e6).alias("lat"))
    pairs = neighbours.within(b, b, 15.0, -2.0).where("bldg_id < r_bldg_id")
    return pairs.select(F.col("bldg_id").alias("a"), F.col("r_bldg_id").alias("b"), F.round("dist", 4).alias("dist"))


def measured_source_mix(spark, sf_dir):
    """Values from a survey, evidence or an assumption by priority, with what was taken."""
    k = F.col("s_suppkey")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 3 == 0, k * 1.0).alias("survey"), F.when(k % 2 == 0, k * 2.0).alias("evidence"))
    kind = first_match([(F.col("survey").isNotNull(), "survey"), (F.col("evidence").isNotNull(), "evidence")], F.lit("assumption"))
    return s.select("s_suppkey", F.coalesce("survey", "evidence", F.lit(5.0)).alias("value"), kind.alias("kind"))


def label_extract(spark, sf_dir):
    """Labels for training: one labeller's sure ones, as class numbers."""
    l = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    return l.where("t = 0").select("doc_id", shaping.tier(F.col("q"), {1: 1}).alias("cls"))


_PROB = "SELECT bldg_id, (bldg_id % 5) * 2.0::DOUBLE AS a, ((bldg_id * 3) % 7) * 0.5::DOUBLE AS b, ((bldg_id * 5) % 11) * 0.0::DOUBLE AS c FROM bld"
ORACLE = {
    "bbox_struct_scan": f"WITH {BLD} SELECT bldg_id, province FROM bld WHERE lon >= 29.4 AND lon + 0.001 <= 30.2 AND province IN ('ASIA', 'AFRICA')",
    "unit_conversion": "WITH p AS (SELECT p_partkey, ['W', 'kW', 'MJ', 'K', 'pct', 'yd'][(p_partkey % 6 + 1)::INT] AS unit, p_size::DOUBLE AS v FROM part) SELECT p_partkey, unit, v * factor + shift AS value FROM p LEFT JOIN (VALUES ('W', 1.0::DOUBLE, 0.0::DOUBLE), ('kW', 1000, 0), ('MJ', 0.2777777777777778::DOUBLE, 0), ('K', 1, -273.15::DOUBLE), ('pct', 0.01::DOUBLE, 0)) u(unit, factor, shift) USING (unit)",
    "extracted_fields": "SELECT p_partkey, (p_partkey % 40)::DOUBLE AS height, p_type AS use, (p_partkey % 24 * 60 + p_partkey % 60)::INT AS minute, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM part",
    "folded_quotes": "SELECT doc_id, CASE WHEN text IS NOT NULL THEN true END AS verified FROM documents",
    "canonical_hashes": """SELECT c_custkey, sha256('{"id":"' || c_custkey || '","seg":"' || c_mktsegment || '"}') AS key FROM customer""",
    "calibrated_shares": f"WITH {BLD}, p AS ({_PROB}) SELECT bldg_id, a / greatest(a + b + c, 1e-9::DOUBLE) AS a, b / greatest(a + b + c, 1e-9::DOUBLE) AS b, c / greatest(a + b + c, 1e-9::DOUBLE) AS c FROM p",
    "census_trade_split": f"WITH {BLD}, b AS (SELECT district, sum(floors) AS census, count(*) FILTER (WHERE floors > 2) AS urban, count(*) AS n FROM bld GROUP BY 1) SELECT district, trade, ((census * (urban * town + (n - urban) * country)) // (n * 100))::BIGINT AS units FROM b, (VALUES ('mill', 5, 40), ('tailor', 30, 25), ('bar', 65, 35)) v(trade, town, country)",
    "run_agreement": f"""WITH {BLD}, r AS (SELECT bldg_id, district, (bldg_id % 3 + CASE WHEN ('0x' || left(md5(bldg_id || ':' || run), 6))::BIGINT % 4 = 0 THEN 1 ELSE 0 END) % 3 AS cls FROM bld, range(10) t(run)), n AS (SELECT bldg_id, district, cls, count(*) AS n FROM r GROUP BY ALL), m AS (SELECT bldg_id, district, max(n) AS most FROM n GROUP BY ALL)
SELECT district, sum(most) / (count(*) * 10) AS agreement, round(sqrt(max(most)::DOUBLE ** 2 + min(most)::DOUBLE ** 2), 9) AS band FROM m GROUP BY 1""",
    "curated_quotes": "SELECT item_id::VARCHAR AS item, 'ok' AS entry, true AS verified FROM benchmark WHERE text IS NOT NULL UNION ALL SELECT item_id::VARCHAR, 'bad', false FROM benchmark WHERE text IS NOT NULL",
    "raster_context": f"WITH {BLD}, p AS (SELECT p_partkey AS k, p_partkey // 20 AS r, p_partkey % 20 AS c, p_size FROM part), b AS (SELECT bldg_id, floor((lat + 2.85::DOUBLE) * 10) AS r, floor((lon - 28.8::DOUBLE) * 10) AS c FROM bld) SELECT bldg_id, p_size % 5 AS land, CASE WHEN k % 2 = 0 THEN p_size * 3 END AS people FROM b LEFT JOIN p USING (r, c)",
    "assembled_grid": "WITH b AS (SELECT p_partkey % 2 AS tile, p_partkey // 40 // 4 AS row, (p_partkey % 40 + p_partkey % 2 * 6) // 4 AS col, avg((p_size > 20)::INT) AS share FROM part GROUP BY ALL) SELECT row, col, arg_min(share, tile) AS share, min(tile) AS tile FROM b GROUP BY ALL",
    "profile_documents": """WITH p AS (SELECT p_partkey % 9 AS profile, p_partkey, p_size % 24 AS hours, p_size * 10 AS watt FROM part)
SELECT profile, sum(watt)::BIGINT AS watt, sha256('[' || string_agg('{"p_partkey":' || p_partkey || ',"hours":' || hours || ',"wh":' || hours * watt || '}', ',' ORDER BY p_partkey) || ']') AS doc, count(*) AS n, sum(hours * watt)::BIGINT AS most_wh FROM p GROUP BY 1""",
    "merged_shards": "WITH s AS (SELECT o_custkey % 6 AS district, o_custkey % 30 AS sub, year(o_orderdate)::INT AS year, sum(trunc(o_totalprice * 100)::BIGINT)::BIGINT AS v FROM orders GROUP BY ALL), d AS (SELECT district, year, sum(v)::BIGINT AS v, count(*) AS shards FROM s GROUP BY ALL) SELECT * FROM d UNION ALL SELECT NULL, year, sum(v)::BIGINT, sum(shards)::BIGINT FROM d GROUP BY year",
    "rule_profile_ids": "WITH i AS (SELECT 'p' || (p_partkey % 14) AS profile_id FROM part UNION ALL SELECT 'q' || (p_partkey % 5) FROM part WHERE p_partkey % 3 > 0) SELECT profile_id, count(*) AS rules FROM i GROUP BY 1",
    "source_catalogue": "WITH s AS (SELECT DISTINCT s_nationkey % 12 AS source, 'step' || (s_suppkey % 5) AS step FROM supplier) SELECT n_nationkey AS source, n_name AS title, coalesce(string_agg(step, ',' ORDER BY step), '') AS steps FROM nation LEFT JOIN s ON source = n_nationkey GROUP BY 1, 2",
    "centroid_and_box": f"WITH {BLD}, b AS (SELECT bldg_id, (bldg_id * 7 % 90)::DOUBLE AS x, (bldg_id * 13 % 70)::DOUBLE AS y, (4 + bldg_id % 7 * 2)::DOUBLE AS w FROM bld) SELECT bldg_id, round(x + w * 5 / 12, 7) AS cx, round(y + w * 5 / 12, 7) AS cy, x + w AS xmax, y AS ymin, 6 AS corners FROM b",
    "within_fifteen_metres": f"""WITH {BLD}, b AS (SELECT bldg_id, 29 + (bldg_id * 7919 % 5000) / 1e6::DOUBLE AS lon, -2 + (bldg_id * 104729 % 5000) / 1e6::DOUBLE AS lat FROM bld), d AS (SELECT a.bldg_id AS a, b.bldg_id AS b, sqrt(power((a.lon - b.lon) * (111320.0::DOUBLE * cos(radians(-2.0::DOUBLE))), 2) + power((a.lat - b.lat) * 111320.0::DOUBLE, 2)) AS dist FROM b a JOIN b ON a.bldg_id < b.bldg_id)
SELECT a, b, round(dist, 4) AS dist FROM d WHERE dist <= 15""",
    "measured_source_mix": "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 1.0::DOUBLE WHEN s_suppkey % 2 = 0 THEN s_suppkey * 2.0::DOUBLE ELSE 5 END AS value, CASE WHEN s_suppkey % 3 = 0 THEN 'survey' WHEN s_suppkey % 2 = 0 THEN 'evidence' ELSE 'assumption' END AS kind FROM supplier",
    "label_extract": "SELECT doc_id, max(quality)::INT AS cls FROM labels GROUP BY 1 HAVING max(toxic) = 0",
}
QUERIES = {name: globals()[name] for name in ORACLE}
