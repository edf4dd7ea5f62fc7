"""Contract queries of rings, tiles, neighbour means, survey groups, curation, quotes, sensitivity and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import half_open, keep_likely, mercator_tile, quadkey
from ..operators import curation, geometry, neighbours, picks
from ..sources import read
from .core import BLD, DIST, FAC, LAT0, buildings, facilities

WORDS = ["an", "qu", "th", "rt", "ing", "zz"]


def _n():
    return F.count(F.lit(1))


def _union(parts):
    return reduce(lambda a, b: a.unionByName(b), parts)


def bbox_scan(spark, sf_dir):
    return buildings(spark, sf_dir).where("lon >= 29.2 AND lon < 29.9 AND lat >= -2.5 AND lat < -1.7").select("bldg_id", "district", F.round("lon", 4).alias("lon"), F.round("lat", 4).alias("lat"))


def threshold_class(spark, sf_dir):
    a = F.col("area")
    return buildings(spark, sf_dir).select("bldg_id", F.when(a < 60, "low").when(a < 120, "medium").otherwise("high").alias("level"))


def plausibility_flags(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    group = p.groupBy("p_brand").agg(F.median("p_retailprice").alias("middle"), _n().alias("n"))
    price, mid = F.col("p_retailprice"), F.col("middle")
    far = (F.col("n") >= 3) & ((price > mid * 1.4) | (price < mid / 1.4))
    flags = F.array_compact(F.array(F.when(~price.between(950, 1800), "range"), F.when(far, "consensus"), F.when(F.col("p_size") > 48, "size")))
    return p.join(group, "p_brand").select("p_partkey", F.explode(flags).alias("flag"))


def prob_threshold_renorm(spark, sf_dir):
    a = F.col("area") % 60 + 20
    probs = F.create_map(F.lit("res"), a / 100.0, F.lit("comm"), (90 - a) / 100.0, F.lit("other"), F.lit(0.1))
    b = buildings(spark, sf_dir).select("bldg_id", keep_likely(probs, 0.355, F.lit("res")).alias("kept"))
    return b.select("bldg_id", F.explode("kept").alias("cls", "p")).select("bldg_id", "cls", F.round("p", 6).alias("p"))


def left_join_chain(spark, sf_dir):
    b = buildings(spark, sf_dir)
    spend = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("bldg_id")).agg(_n().alias("n_orders"), F.round(F.max("o_totalprice"), 2).alias("most"))
    seen = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("bldg_id")).agg(_n().alias("n_events"))
    return b.select("bldg_id", "district").join(spend, "bldg_id", "left").join(seen, "bldg_id", "left")


def _flat(df):
    return df.withColumn("x", (F.col("lon") - 28.8) * 100.0).withColumn("y", (F.col("lat") + 2.85) * 100.0)


def nearest_distance(spark, sf_dir):
    f = _flat(facilities(spark, sf_dir))
    lines = f.select(F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + 3 + F.col("facility_id") % 7).alias("x2"), (F.col("y") + 5 - F.col("facility_id") % 11).alias("y2"))
    return geometry.nearest_segment(_flat(buildings(spark, sf_dir)), lines, "bldg_id", 20.0).select("bldg_id", F.round("dist", 4).alias("dist"))


def tile_lookup_join(spark, sf_dir):
    def tiled(df):
        x, y = mercator_tile(F.col("lon"), F.col("lat"), 9)
        return df.withColumn("tile_x", x).withColumn("tile_y", y)

    held = tiled(facilities(spark, sf_dir)).groupBy("tile_x", "tile_y").agg(_n().alias("n"))
    out = tiled(buildings(spark, sf_dir)).join(held, ["tile_x", "tile_y"], "left")
    return out.select("bldg_id", "tile_x", "tile_y", quadkey(F.col("tile_x"), F.col("tile_y"), 9).alias("quadkey"), "n")


def point_in_box_admin(spark, sf_dir):
    k = F.col("n_nationkey")
    cx, cy, r = 20.0 + (k % 5) * 42, 18.0 + F.floor(k / 5) * 36, 28.0 + k % 3
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(point(cx - r, cy * 1.0), point(cx, cy + r), point(cx + r, cy * 1.0), point(cx, cy - r), point(cx - r, cy * 1.0))
    areas = read(spark, sf_dir, "nation").select(k.alias("admin_id"), ring.alias("ring"))
    return geometry.smallest_container(_flat(buildings(spark, sf_dir)), areas, "bldg_id", "admin_id", 60.0)


def _rings(spark, sf_dir):
    a, s = F.col("area") / 10.0, F.col("floors") * 1.0
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    zero = F.lit(0.0)
    return buildings(spark, sf_dir).select("bldg_id", F.array(point(zero, zero), point(a, s), point(a + 1, s + a / 2), point(zero, s + 3), point(zero, zero)).alias("ring"))


def footprint_metrics(spark, sf_dir):
    r = F.col("ring")
    return _rings(spark, sf_dir).select("bldg_id", F.round(geometry.area(r), 4).alias("area"), F.round(geometry.perimeter(r), 4).alias("perimeter"), F.round(geometry.compactness(r), 4).alias("compactness"), (F.size(r) - 1).cast("long").alias("n_vertices"))


def min_rotated_rect(spark, sf_dir):
    return _rings(spark, sf_dir).select("bldg_id", geometry.orientation(F.col("ring")).alias("degrees"))


def survey_group_stats(spark, sf_dir):
    size = half_open(F.col("area"), [0, 70, 140, 1000], ["small", "middle", "large"])
    b = buildings(spark, sf_dir).select(F.explode(F.array(F.lit("all"), "province", "cls", size)).alias("grp"), "area", "floors")
    own = F.when(F.col("floors") > 1, F.col("floors"))
    return b.groupBy("grp").agg(_n().alias("n"), F.round(F.avg((F.col("floors") > 1).cast("int")), 6).alias("share"), F.round(F.avg(own), 6).alias("mean"), *(F.round(F.percentile("area", q), 4).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)))


def _cells(spark, sf_dir):
    return buildings(spark, sf_dir).withColumn("row", F.floor((F.col("lat") + 2.85) * 10)).withColumn("col", F.floor((F.col("lon") - 28.8) * 10))


def ring_smoothed_mean(spark, sf_dir):
    c = _cells(spark, sf_dir).groupBy("row", "col").agg(F.sum("area").alias("s"), _n().alias("n"))
    return neighbours.disk_means(c, c.select("row", "col", F.lit(1).alias("k")), "k").select("row", "col", "n", F.round("mean", 6).alias("mean"))


def ring_weighted_features(spark, sf_dir):
    b = _cells(spark, sf_dir).withColumn("setting", F.when(F.col("floors") > 2, "urban").otherwise("rural"))
    c = b.groupBy("row", "col").agg(F.sum("floors").alias("s"), _n().alias("n"))
    wanted = b.select("row", "col", "setting", F.when(F.col("setting") == "urban", 1).otherwise(2).alias("k")).distinct()
    return neighbours.disk_means(c, wanted, "k").select("row", "col", "setting", F.round("mean", 6).alias("mean"), F.round(F.ln(F.col("n").cast("double")), 6).alias("log_n"))


def prefix_share_wealth(spark, sf_dir):
    b = buildings(spark, sf_dir).withColumn("rwi", F.when(F.col("area") % 17 != 0, F.col("score")))
    mid = b.groupBy("district").agg(F.median("rwi").alias("mid"))
    b = b.join(mid, "district").withColumn("rwi", F.coalesce("rwi", "mid"))
    return picks.prefix_share(b, "district", "rwi", "floors", F.lit(0.5), "bldg_id").select("bldg_id", F.col("flag").alias("upper"))


def local_days(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("at", F.expr("ts + INTERVAL 2 HOURS"))
    days = e.groupBy((F.col("user_id") % 3).alias("node"), F.to_date("at").alias("day")).agg(F.count_distinct(F.hour("at")).alias("hours"), F.round(F.avg("value"), 3).alias("mean"))
    return days.where("hours >= 20")


def monthly_climatology(spark, sf_dir):
    e = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 5).alias("node"), F.to_date("ts").alias("day")).agg(F.avg("value").alias("m"))
    return e.groupBy("node", F.month("day").alias("month")).agg(_n().alias("days"), F.round(F.avg("m"), 3).alias("mean"))


def series_crosscheck(spark, sf_dir):
    def one(k, name):
        e = read(spark, sf_dir, "events").where(F.col("user_id") % 2 == k)
        return e.groupBy(F.date_trunc("day", "ts").alias("at")).agg(F.avg("value").alias(name))

    both = one(0, "a").join(one(1, "b"), "at")
    return both.agg(_n().alias("n"), F.round(F.avg(F.col("a") - F.col("b")), 4).alias("bias"), F.round(F.corr("a", "b"), 4).alias("corr"))


def zonal_weighted_median(spark, sf_dir):
    pix = read(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 50).alias("row"), (F.col("p_partkey") % 50).alias("col"), F.col("p_size").alias("v"))
    x, y = (F.col("bldg_id") * 7 % 180) / 4.0, (F.col("bldg_id") * 11 % 60) / 4.0
    boxes = buildings(spark, sf_dir).select("bldg_id", x.alias("x0"), y.alias("y0"), (x + F.col("floors") * 0.75).alias("x1"), (y + 1.25).alias("y1"))
    return geometry.zonal_median(boxes, pix, "bldg_id", "v")


def candidate_score(spark, sf_dir):
    b, w = buildings(spark, sf_dir), W.partitionBy("province")
    ends = b.groupBy("province").agg(*(f(c).alias(f"{c}_{k}") for c in ("area", "score", "floors") for k, f in (("lo", F.min), ("hi", F.max))))
    scaled = lambda c: F.coalesce((F.col(c) - F.col(f"{c}_lo")) / F.nullif(F.col(f"{c}_hi") - F.col(f"{c}_lo"), F.lit(0.0)), F.lit(0.0))
    return b.join(ends, "province").select("bldg_id", F.round(100 * (0.5 * scaled("area") + 0.3 * scaled("score") + 0.2 * scaled("floors")), 3).alias("points"))


def census_split(spark, sf_dir):
    b = buildings(spark, sf_dir)
    national = b.groupBy("cls").agg(F.sum("floors").alias("units"))
    total = national.agg(F.sum("units").alias("all"))
    counts = b.groupBy("district").agg(_n().alias("n"))
    shares = national.join(F.broadcast(total)).select("cls", (F.col("units") / F.col("all")).alias("share"))  # one row, and one per class
    return counts.join(F.broadcast(shares)).select("district", "cls", F.round(F.col("n") * F.col("share"), 6).alias("units"))


def cap_sensitivity(spark, sf_dir):
    """The base cap of 2, its half, its double and fourfold, and none (0): cells are ranked once for all of them."""
    b = _cells(spark, sf_dir).withColumn("cell", F.floor(F.col("row") / 4) * 100 + F.floor(F.col("col") / 4))
    ranked = picks.ranked_in_cells(b, "district", "cell", "score", "bldg_id").select("bldg_id", "district", "cell", "score", "need", "area", "in_cell")
    runs = ranked.withColumn("first", F.explode(F.array(*map(F.lit, (1, 2, 4, 8, 1 << 20))))).withColumn("run", F.concat_ws("/", F.col("first").cast("string"), "district"))
    got = picks.take_spaced(runs, "run", "cell", "score", "need", "bldg_id", "first")
    cap = F.when(F.col("first") == 1 << 20, 0).otherwise(F.col("first"))
    return got.groupBy(cap.cast("int").alias("cap")).agg(_n().alias("n"), F.sum("area").alias("area"), F.max("in_cell").cast("long").alias("most"))


def noise_bands(spark, sf_dir):
    b = buildings(spark, sf_dir).select("bldg_id", "district", "area", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("run"))
    h = F.md5(F.concat_ws(":", F.col("bldg_id").cast("string"), F.col("run").cast("string")))
    u = lambda at: (F.conv(F.substring(h, at, 7), 16, 10).cast("double") + 0.5) / 268435456.0
    import math

    z = F.sqrt(-2 * F.ln(u(1))) * F.cos(2 * math.pi * u(8))
    runs = b.groupBy("district", "run").agg(F.sum(F.col("area") * F.exp(0.5 * z)).alias("t"))
    return runs.groupBy("district").agg(*(F.round(F.percentile("t", q), 3).alias(f"p{int(q * 100)}") for q in (0.1, 0.5, 0.9)))


def union_find_groups(spark, sf_dir):
    return curation.near_groups(buildings(spark, sf_dir), "bldg_id", 2000.0, LAT0)


def benchmark_ratio(spark, sf_dir):
    o, b = read(spark, sf_dir, "orders"), buildings(spark, sf_dir)
    rows = [("customers", b.agg(_n().alias("model")), 1000.0), ("orders", o.agg(_n().alias("model")), 20000.0), ("area", b.agg(F.sum("area").alias("model")), 90000.0)]
    ratio = F.col("model") / F.col("official")
    out = _union([df.select(F.lit(name).alias("item"), F.col("model").cast("double").alias("model"), F.lit(v).alias("official")) for name, df, v in rows])
    return out.select("item", "model", "official", F.round(ratio, 6).alias("ratio"), F.when(F.greatest(ratio, 1 / ratio) <= 1.25, "ok").when(F.greatest(ratio, 1 / ratio) <= 2, "check").otherwise("fail").alias("verdict"))


def quote_verify(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.max("text").alias("text"))
    c = c.withColumn("following", F.lead("text").over(W.partitionBy("conv_id").orderBy("turn")))
    k = F.col("turn") % 3
    t, nxt = F.col("text"), F.coalesce("following", F.lit(""))
    quote = F.when(k == 0, F.substring(t, 6, 30)).when(k == 1, F.concat(F.substring(t, 6, 30), F.lit("#"))).otherwise(F.substring(nxt, 1, 25))
    return c.select("conv_id", "turn", curation.quote_holds(quote, t, F.col("following")).alias("verified"))


def keyword_pages(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.max("text").alias("text"))
    hits = c.select("conv_id", "turn", curation.keyword_hits(F.col("text"), WORDS).alias("hits")).where("hits >= 2")
    return hits.withColumn("r", F.row_number().over(W.partitionBy("conv_id").orderBy(F.desc("hits"), "turn"))).where("r <= 2").select("conv_id", "turn", "hits")


def context_card(spark, sf_dir):
    b = _cells(spark, sf_dir)
    cell = b.groupBy("row", "col").agg(_n().alias("n"), F.max("area").alias("largest"))
    near = neighbours.nearest(facilities(spark, sf_dir), b.select("bldg_id", "lon", "lat"), "facility_id", "bldg_id", 1.0, LAT0).groupBy("bldg_id").agg(_n().alias("at"))
    own = b.join(cell, ["row", "col"]).join(near, "bldg_id", "left")
    return own.select("bldg_id", F.format_string("%d m2, %d floors, %s; cell of %d, largest %d m2; facilities here: %d", "area", "floors", F.lower("cls"), "n", "largest", F.coalesce("at", F.lit(0))).alias("card"))


def cross_table_invariants(spark, sf_dir):
    o, li, c = (read(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    checks = {
        "order_without_customer": o.join(c, o.o_custkey == c.c_custkey, "left_anti"),
        "line_without_order": li.join(o, li.l_orderkey == o.o_orderkey, "left_anti"),
        "quantity_not_positive": li.where("l_quantity <= 0"),
        "discount_out_of_range": li.where("l_discount < 0 OR l_discount > 0.1"),
        "repeated_order": o.groupBy("o_orderkey").agg(_n().alias("n")).where("n > 1"),
    }
    found = [df.agg(_n().alias("violations")).select(F.lit(name).alias("name"), "violations", (F.col("violations") == 0).alias("ok")) for name, df in checks.items()]
    return _union(found)


_C = f"{BLD}, cel AS (SELECT *, floor((lat + 2.85::DOUBLE) * 10)::BIGINT AS r, floor((lon - 28.8::DOUBLE) * 10)::BIGINT AS c FROM bld)"
_FLAT = "(lon - 28.8::DOUBLE) * 100 AS x, (lat + 2.85::DOUBLE) * 100 AS y"
_TILE = "floor((lon + 180) / 360 * 512)::BIGINT AS tile_x, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 512)::BIGINT AS tile_y"
_RING = f"{BLD}, p AS (SELECT bldg_id, area / 10.0::DOUBLE AS a, floors::DOUBLE AS s FROM bld), v AS (SELECT bldg_id, unnest([0, 1, 2, 3]) AS i, unnest([0, a, a + 1, 0]) AS x, unnest([0, s, s + a / 2, s + 3]) AS y FROM p)"
_CHK = "SELECT '{0}' AS name, count(*) AS violations, count(*) = 0 AS ok FROM {1}"
_PAGES = "c AS (SELECT conv_id, turn, max(text) AS text FROM conversations GROUP BY ALL)"
_NORM = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
_HITS = " + ".join(f"contains(lower(text), '{w}')::INT" for w in WORDS)

ORACLE = {
    "bbox_scan": f"WITH {BLD} SELECT bldg_id, district, round(lon, 4) AS lon, round(lat, 4) AS lat FROM bld WHERE lon >= 29.2::DOUBLE AND lon < 29.9::DOUBLE AND lat >= -2.5::DOUBLE AND lat < -1.7::DOUBLE",
    "threshold_class": f"WITH {BLD} SELECT bldg_id, CASE WHEN area < 60 THEN 'low' WHEN area < 120 THEN 'medium' ELSE 'high' END AS level FROM bld",
    "plausibility_flags": """WITH g AS (SELECT p_brand, median(p_retailprice) AS m, count(*) AS n FROM part GROUP BY 1), v AS (SELECT * FROM part JOIN g USING (p_brand))
SELECT p_partkey, 'range' AS flag FROM v WHERE p_retailprice < 950 OR p_retailprice > 1800 UNION ALL
SELECT p_partkey, 'consensus' FROM v WHERE n >= 3 AND (p_retailprice > m * 1.4::DOUBLE OR p_retailprice < m / 1.4::DOUBLE) UNION ALL SELECT p_partkey, 'size' FROM v WHERE p_size > 48""",
    "prob_threshold_renorm": f"""WITH {BLD}, q AS (SELECT bldg_id, area % 60 + 20 AS a FROM bld), l AS (SELECT bldg_id, unnest(['res', 'comm', 'other']) AS cls, unnest([a / 100.0::DOUBLE, (90 - a) / 100.0::DOUBLE, 0.1]) AS p FROM q),
k AS (SELECT bldg_id, cls, p FROM l WHERE p >= 0.355), s AS (SELECT bldg_id, cls, round(p / sum(p) OVER (PARTITION BY bldg_id), 6) AS p FROM k)
SELECT * FROM s UNION ALL SELECT bldg_id, 'res', 1.0 FROM bld WHERE bldg_id NOT IN (SELECT bldg_id FROM k)""",
    "left_join_chain": f"""WITH {BLD}, o AS (SELECT o_custkey AS bldg_id, count(*) AS n_orders, round(max(o_totalprice), 2) AS most FROM orders GROUP BY 1), e AS (SELECT user_id AS bldg_id, count(*) AS n_events FROM events GROUP BY 1)
SELECT bldg_id, district, n_orders, most, n_events FROM bld LEFT JOIN o USING (bldg_id) LEFT JOIN e USING (bldg_id)""",
    "nearest_distance": f"""WITH {BLD}, {FAC}, b AS (SELECT bldg_id, {_FLAT} FROM bld), f AS (SELECT {_FLAT}, 3 + facility_id % 7 AS dx, 5 - facility_id % 11 AS dy FROM fac),
t AS (SELECT bldg_id, b.x - f.x AS px, b.y - f.y AS py, dx, dy, least(greatest(((b.x - f.x) * dx + (b.y - f.y) * dy) / (dx * dx + dy * dy), 0), 1) AS t FROM b, f),
d AS (SELECT bldg_id, min(sqrt(power(px - t * dx, 2) + power(py - t * dy, 2))) AS d FROM t GROUP BY 1) SELECT bldg_id, CASE WHEN d <= 20 THEN round(d, 4) END AS dist FROM d""",
    "tile_lookup_join": f"""WITH {BLD}, {FAC}, b AS (SELECT bldg_id, {_TILE} FROM bld), f AS (SELECT tile_x, tile_y, count(*) AS n FROM (SELECT {_TILE} FROM fac) GROUP BY ALL)
SELECT bldg_id, tile_x, tile_y, array_to_string([((tile_x >> (8 - k)) & 1) + 2 * ((tile_y >> (8 - k)) & 1) for k in range(9)], '') AS quadkey, n FROM b LEFT JOIN f USING (tile_x, tile_y)""",
    "point_in_box_admin": f"""WITH {BLD}, b AS (SELECT bldg_id, {_FLAT} FROM bld), n AS (SELECT n_nationkey AS k, 20 + (n_nationkey % 5) * 42 AS cx, 18 + (n_nationkey // 5) * 36 AS cy, 28 + n_nationkey % 3 AS r FROM nation),
m AS (SELECT bldg_id, min_by(k, (r, k)) AS k FROM b, n WHERE abs(x - cx) + abs(y - cy) < r GROUP BY 1) SELECT bldg_id, k AS admin_id FROM b LEFT JOIN m USING (bldg_id)""",
    "footprint_metrics": f"""WITH {_RING}, e AS (SELECT a.*, b.x AS x2, b.y AS y2 FROM v a JOIN v b ON a.bldg_id = b.bldg_id AND b.i = (a.i + 1) % 4),
m AS (SELECT bldg_id, abs(sum(x * y2 - x2 * y)) / 2 AS a, sum(sqrt(power(x2 - x, 2) + power(y2 - y, 2))) AS p, count(*) AS n FROM e GROUP BY 1)
SELECT bldg_id, round(a, 4) AS area, round(p, 4) AS perimeter, round(4 * pi() * a / (p * p), 4) AS compactness, n AS n_vertices FROM m""",
    "min_rotated_rect": f"""WITH {_RING}, t AS (SELECT a.bldg_id, a.i, b.i AS j, atan2(b.y - a.y, b.x - a.x) AS t FROM v a JOIN v b ON a.bldg_id = b.bldg_id AND a.i != b.i),
x AS (SELECT t.bldg_id, i, j, t, round(max(x * cos(t) + y * sin(t)) - min(x * cos(t) + y * sin(t)), 6) AS w, round(max(y * cos(t) - x * sin(t)) - min(y * cos(t) - x * sin(t)), 6) AS h FROM t JOIN (SELECT bldg_id, x, y FROM v) q ON q.bldg_id = t.bldg_id GROUP BY ALL),
g AS (SELECT bldg_id, round(w * h, 4) AS area, (round(degrees(t) + CASE WHEN w >= h THEN 0 ELSE 90 END, 6) + 360) % 180 AS g FROM x) SELECT bldg_id, min_by(g, (area, g)) AS degrees FROM g GROUP BY 1""",
    "survey_group_stats": f"""WITH {BLD}, l AS (SELECT unnest(['all', province, cls, CASE WHEN area < 70 THEN 'small' WHEN area < 140 THEN 'middle' ELSE 'large' END]) AS grp, area, floors FROM bld)
SELECT grp, count(*) AS n, round(avg((floors > 1)::INT), 6) AS share, round(avg(floors) FILTER (floors > 1), 6) AS mean, round(quantile_cont(area::DOUBLE, 0.25), 4) AS q25, round(quantile_cont(area::DOUBLE, 0.5), 4) AS q50, round(quantile_cont(area::DOUBLE, 0.75), 4) AS q75 FROM l GROUP BY 1""",
    "ring_smoothed_mean": f"""WITH {_C}, g AS (SELECT DISTINCT r, c FROM cel)
SELECT g.r AS row, g.c AS col, count(*) AS n, round(avg(area), 6) AS mean FROM g JOIN cel ON abs(g.r - cel.r) <= 1 AND abs(g.c - cel.c) <= 1 GROUP BY ALL""",
    "ring_weighted_features": f"""WITH {_C}, g AS (SELECT DISTINCT r, c, CASE WHEN floors > 2 THEN 'urban' ELSE 'rural' END AS setting, CASE WHEN floors > 2 THEN 1 ELSE 2 END AS k FROM cel)
SELECT g.r AS row, g.c AS col, setting, round(avg(floors), 6) AS mean, round(ln(count(*)), 6) AS log_n FROM g JOIN cel ON abs(g.r - cel.r) <= k AND abs(g.c - cel.c) <= k GROUP BY ALL""",
    "prefix_share_wealth": f"""WITH {BLD}, w AS (SELECT *, CASE WHEN area % 17 != 0 THEN score END AS rwi FROM bld), m AS (SELECT district, median(rwi) AS mid FROM w GROUP BY 1), f AS (SELECT bldg_id, district, floors, coalesce(rwi, mid) AS rwi FROM w JOIN m USING (district))
SELECT bldg_id, coalesce(sum(floors) OVER (PARTITION BY district ORDER BY rwi DESC, bldg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 0.5::DOUBLE * sum(floors) OVER (PARTITION BY district) AS upper FROM f""",
    "local_days": "WITH e AS (SELECT *, ts + INTERVAL 2 HOUR AS t0 FROM events) SELECT user_id % 3 AS node, t0::DATE AS day, count(DISTINCT hour(t0)) AS hours, round(avg(value), 3) AS mean FROM e GROUP BY ALL HAVING count(DISTINCT hour(t0)) >= 20",
    "monthly_climatology": "WITH e AS (SELECT user_id % 5 AS node, ts::DATE AS day, avg(value) AS m FROM events GROUP BY ALL) SELECT node, month(day)::INT AS month, count(*) AS days, round(avg(m), 3) AS mean FROM e GROUP BY ALL",
    "series_crosscheck": """WITH a AS (SELECT ts::DATE AS t0, avg(value) AS a FROM events WHERE user_id % 2 = 0 GROUP BY 1), b AS (SELECT ts::DATE AS t0, avg(value) AS b FROM events WHERE user_id % 2 = 1 GROUP BY 1)
SELECT count(*) AS n, round(avg(a - b), 4) AS bias, round(corr(a, b), 4) AS corr FROM a JOIN b USING (t0)""",
    "zonal_weighted_median": f"""WITH {BLD}, z AS (SELECT bldg_id, (bldg_id * 7 % 180) / 4.0::DOUBLE AS x0, (bldg_id * 11 % 60) / 4.0::DOUBLE AS y0, floors * 0.75::DOUBLE AS w FROM bld), p AS (SELECT p_partkey // 50 AS r, p_partkey % 50 AS c, p_size AS v FROM part),
o AS (SELECT bldg_id, v, (least(x0 + w, c + 1) - greatest(x0, c)) * (least(y0 + 1.25::DOUBLE, r + 1) - greatest(y0, r)) AS w FROM z JOIN p ON c + 1 > x0 AND c < x0 + w AND r + 1 > y0 AND r < y0 + 1.25::DOUBLE),
s AS (SELECT bldg_id, v, sum(w) OVER (PARTITION BY bldg_id ORDER BY v) AS run, sum(w) OVER (PARTITION BY bldg_id) AS total FROM o)
SELECT bldg_id, min(v) FILTER (run >= total / 2) AS median, count(*) AS n FROM s GROUP BY 1""",
    "candidate_score": f"""WITH {BLD}, s AS (SELECT bldg_id, (area - min(area) OVER w)::DOUBLE / nullif(max(area) OVER w - min(area) OVER w, 0) AS a, (score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0) AS b,
(floors - min(floors) OVER w)::DOUBLE / nullif(max(floors) OVER w - min(floors) OVER w, 0) AS c FROM bld WINDOW w AS (PARTITION BY province))
SELECT bldg_id, round(100 * (0.5::DOUBLE * coalesce(a, 0) + 0.3::DOUBLE * coalesce(b, 0) + 0.2::DOUBLE * coalesce(c, 0)), 3) AS points FROM s""",
    "census_split": f"""WITH {BLD}, n AS (SELECT cls, sum(floors)::DOUBLE / (SELECT sum(floors) FROM bld) AS share FROM bld GROUP BY 1), d AS (SELECT district, count(*) AS n FROM bld GROUP BY 1)
SELECT district, cls, round(n * share, 6) AS units FROM d, n""",
    "cap_sensitivity": f"""WITH {_C}, k AS (SELECT *, row_number() OVER (PARTITION BY district, (r // 4) * 100 + c // 4 ORDER BY score DESC, bldg_id) AS p FROM cel), caps AS (SELECT unnest([1, 2, 4, 8, 1048576]) AS cap),
t AS (SELECT cap, district, need, min(f) AS f FROM (SELECT cap, i, cap * 2 ** i AS f, district, need, count(*) FILTER (p <= cap * 2 ** i) AS n FROM caps, range(9) g(i), k GROUP BY ALL) WHERE n >= need OR i = 8 GROUP BY ALL),
q AS (SELECT t.cap, k.*, row_number() OVER (PARTITION BY t.cap, k.district ORDER BY score DESC, bldg_id) AS place FROM t JOIN k USING (district) WHERE p <= f)
SELECT (CASE WHEN cap = 1048576 THEN 0 ELSE cap END)::INT AS cap, count(*) AS n, sum(area)::BIGINT AS area, max(p) AS most FROM q WHERE place <= need GROUP BY 1""",
    "noise_bands": f"""WITH {BLD}, u AS (SELECT district, area, run, md5(bldg_id || ':' || run) AS h FROM bld, range(10) g(run)), z AS (SELECT district, area, run, (('0x' || h[1:7])::BIGINT + 0.5::DOUBLE) / 268435456 AS a, (('0x' || h[8:14])::BIGINT + 0.5::DOUBLE) / 268435456 AS b FROM u),
t AS (SELECT district, run, sum(area * exp(0.5::DOUBLE * sqrt(-2 * ln(a)) * cos(2 * pi() * b))) AS t FROM z GROUP BY ALL)
SELECT district, round(quantile_cont(t, 0.1), 3) AS p10, round(quantile_cont(t, 0.5), 3) AS p50, round(quantile_cont(t, 0.9), 3) AS p90 FROM t GROUP BY 1""",
    "union_find_groups": f"""WITH RECURSIVE {BLD}, e AS (SELECT b.bldg_id AS u, f.bldg_id AS v FROM bld b JOIN bld f ON b.bldg_id != f.bldg_id AND {DIST} <= 2000),
g(a, b) AS (SELECT bldg_id, bldg_id FROM bld UNION SELECT g.a, e.v FROM g JOIN e ON g.b = e.u) SELECT a AS bldg_id, min(b) AS "group" FROM g GROUP BY 1""",
    "benchmark_ratio": f"""WITH {BLD}, t AS (SELECT 'customers' AS item, count(*)::DOUBLE AS model, 1000::DOUBLE AS official FROM bld UNION ALL SELECT 'orders', count(*), 20000 FROM orders UNION ALL SELECT 'area', sum(area), 90000 FROM bld), r AS (SELECT *, model / official AS q FROM t)
SELECT item, model, official, round(q, 6) AS ratio, CASE WHEN greatest(q, 1 / q) <= 1.25 THEN 'ok' WHEN greatest(q, 1 / q) <= 2 THEN 'check' ELSE 'fail' END AS verdict FROM r""",
    "quote_verify": f"""WITH {_PAGES}, f AS (SELECT *, coalesce(lead(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS nxt FROM c),
q AS (SELECT conv_id, turn, {_NORM.format("text")} AS p, {_NORM.format("nxt")} AS n, {_NORM.format("CASE turn % 3 WHEN 0 THEN substr(text, 6, 30) WHEN 1 THEN substr(text, 6, 30) || '#' ELSE substr(nxt, 1, 25) END")} AS q FROM f)
SELECT conv_id, turn, q != '' AND (contains(p, q) OR (contains(p || ' ' || n, q) AND NOT contains(n, q))) AS verified FROM q""",
    "keyword_pages": f"""WITH {_PAGES}, h AS (SELECT conv_id, turn, {_HITS} AS hits FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY hits DESC, turn) AS r FROM h WHERE hits >= 2) SELECT conv_id, turn, hits FROM r WHERE r <= 2""",
    "context_card": f"""WITH {_C}, {FAC}, g AS (SELECT r, c, count(*) AS n, max(area) AS most FROM cel GROUP BY ALL), d AS (SELECT facility_id, b.bldg_id, row_number() OVER (PARTITION BY facility_id ORDER BY {DIST}, b.bldg_id) AS k FROM bld b JOIN fac f ON {DIST} <= 1),
a AS (SELECT bldg_id, count(*) AS held FROM d WHERE k = 1 GROUP BY 1)
SELECT bldg_id, format('{{}} m2, {{}} floors, {{}}; cell of {{}}, largest {{}} m2; facilities here: {{}}', area, floors, lower(cls), n, most, coalesce(held, 0)) AS card FROM cel JOIN g USING (r, c) LEFT JOIN a USING (bldg_id)""",
    "cross_table_invariants": " UNION ALL ".join(
        _CHK.format(*x)
        for x in (
            ("order_without_customer", "orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
            ("line_without_order", "lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
            ("quantity_not_positive", "lineitem WHERE l_quantity <= 0"),
            ("discount_out_of_range", "lineitem WHERE l_discount < 0 OR l_discount > 0.1"),
            ("repeated_order", "(SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)"),
        )
    ),
}
QUERIES = {name: globals()[name] for name in ORACLE}
