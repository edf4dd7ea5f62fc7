"""Contract queries of staged allocation, shifts, series, boxes, rasters, text tables and metrics."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import allocation, calibrate, neighbours, series, shapes, stats
from ..sources import read
from .core import BLD, DIST, FAC, LAT0, buildings, facilities
from .flagship import HOURS, LIB_SQL, W_SQL, hourly, profile_weights


def staged_allocation(spark, sf_dir):
    stages = [
        ("large", F.col("cls") == "BUILDING", F.col("area").cast("double"), F.col("need") * 2),
        ("rich", F.col("score") > 2000, F.col("score"), F.col("need") * 3),
        ("rest", F.lit(True), F.col("floors") * F.col("area") * 1.0, F.col("need")),
    ]
    return allocation.staged(buildings(spark, sf_dir), "district", "bldg_id", stages).where("stage IS NOT NULL").select("bldg_id", "district", "stage")


def logit_shift(spark, sf_dir):
    b = buildings(spark, sf_dir).withColumn("p", (F.col("area") % 89 + 5) / 100.0)
    target = b.groupBy("district").agg((0.3 + F.max("need") / 20.0).alias("target"))
    return calibrate.logit_shift(b, "district", "p", target).select("district", F.round("shift", 5).alias("shift"))


def floor_cutpoints(spark, sf_dir):
    b = buildings(spark, sf_dir).withColumn("height", F.col("floors") * 3.0 + F.col("area") % 7)
    return calibrate.best_threshold(b, "height", F.col("floors") >= 3, [4 + 0.5 * k for k in range(25)])


def storey_grid_search(spark, sf_dir):
    b = buildings(spark, sf_dir).withColumn("height", F.col("floors") * 3.0 + F.col("area") % 7)
    grid = [2.0 + 0.25 * k for k in range(13)]
    per = b.groupBy("floors").agg(*(F.avg(F.abs(F.greatest(F.floor(F.col("height") / s + 0.5), F.lit(1)) - F.col("floors"))).alias(f"e{i}") for i, s in enumerate(grid)))
    best = per.agg(F.array_min(F.array(*(F.struct(F.round(F.avg(f"e{i}"), 6).alias("err"), F.lit(s).alias("s")) for i, s in enumerate(grid)))).alias("b"))
    return best.select(F.col("b.s").alias("storey"), F.col("b.err").alias("err"))


def coincident_vs_noncoincident_peak(spark, sf_dir):
    one = hourly(profile_weights(spark, sf_dir), "bldg_id")
    sums = [F.sum(f"w{h}") for h in HOURS]
    out = one.agg(F.greatest(*sums).alias("coincident"), F.sum(F.greatest(*(F.col(f"w{h}") for h in HOURS))).alias("separate"))
    return out.select(F.round("coincident", 3).alias("coincident_w"), F.round("separate", 3).alias("separate_w"), F.round(F.col("coincident") / F.col("separate"), 6).alias("ratio"))


def gap_fill_short_runs(spark, sf_dir):
    e = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 10).alias("node"), F.date_trunc("hour", "ts").alias("hour")).agg(F.max("value").alias("value"))
    out = series.fill_short_gaps(series.complete(e, "node", "hour", "1 HOUR"), "node", "hour", "value", 3)
    return out.select("node", "hour", F.round("value", 4).alias("value"))


def hot_hours(spark, sf_dir):
    e = read(spark, sf_dir, "events").where("value > 100")
    return e.groupBy(F.month("ts").alias("month"), F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def _boxes(df, size):
    x, y = (F.col("lon") - 28.8) * 1000, (F.col("lat") + 2.85) * 1000
    return df.select(F.col("bldg_id").alias("id"), x.alias("x0"), y.alias("y0"), (x + size).alias("x1"), (y + size).alias("y1"))


def box_overlap_pairs(spark, sf_dir):
    b = buildings(spark, sf_dir)
    left, right = _boxes(b, F.lit(20.0)), _boxes(b, F.col("area") / 5.0)
    return shapes.overlaps(left, right, 40.0).select("id", "r_id", F.round("shared", 4).alias("shared"), F.round("iou", 6).alias("iou"))


def best_overlap_match(spark, sf_dir):
    b = buildings(spark, sf_dir)
    pairs = shapes.overlaps(_boxes(b, F.lit(20.0)), _boxes(b, F.col("area") / 5.0), 40.0).where("id != r_id").withColumn("iou", F.round("iou", 6))
    best = pairs.groupBy("id").agg(F.min(F.struct((-F.col("iou")).alias("loss"), "r_id")).alias("b"))
    return best.select("id", F.col("b.r_id").alias("r_id"), (-F.col("b.loss")).alias("iou"))


def focal_share_disk(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.expr("p_partkey div 50").alias("row"), (F.col("p_partkey") % 50).alias("col"), (F.col("p_size") > 25).cast("int").alias("one"))
    return shapes.focal_share(p, "one", 3.0).select("row", "col", F.round("share", 6).alias("share"))


def mutual_nearest_assignment(spark, sf_dir):
    both = neighbours.mutual_nearest(facilities(spark, sf_dir), buildings(spark, sf_dir), "facility_id", "bldg_id", 20_000.0, LAT0, 4)
    return both.select("bldg_id", "facility_id", F.round("dist", 3).alias("dist"))


def weighted_auc_logloss(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_returnflag", ((F.col("l_partkey") % 97 + 1) / 100.0).alias("score"), (F.col("l_quantity") > 25).alias("hit"), (1 + F.col("l_orderkey") % 5).alias("wt"))
    return stats.weighted_auc(li, "l_returnflag", "score", "hit", "wt").select("l_returnflag", F.round("auc", 6).alias("auc"), F.round("brier", 6).alias("brier"))


def label_entropy(spark, sf_dir):
    return stats.entropy(buildings(spark, sf_dir), "district", "cls").select("district", "n", "k", F.round("entropy", 6).alias("entropy"))


def mode_and_argmin(spark, sf_dir):
    b = buildings(spark, sf_dir)
    most = b.groupBy("district", "cls").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("score", "bldg_id")).alias("least"))
    return most.groupBy("district").agg(F.min(F.struct((-F.col("n")).alias("n"), "cls")).alias("m"), F.min("least").alias("least")).select("district", F.col("m.cls").alias("mode"), F.col("least.bldg_id").alias("poorest"))


def multi_level_rollup(spark, sf_dir):
    b = buildings(spark, sf_dir).groupBy("province", "district", "cls").agg(F.sum("area").alias("area"), F.count(F.lit(1)).alias("n"))
    levels = [("cls", "cls"), ("district", "district"), ("province", "province")]
    parts = [b.groupBy(F.col(c).alias("name")).agg(F.sum("n").alias("n"), F.sum("area").alias("area")).select(F.lit(k).alias("level"), "name", "n", "area") for k, c in levels]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def cell_rank_features(spark, sf_dir):
    w = W.partitionBy("cell")
    b = buildings(spark, sf_dir).withColumn("cell", F.floor(F.col("lon") * 4) * 1000 + F.floor((F.col("lat") + 3) * 4))
    return b.select("bldg_id", F.count(F.lit(1)).over(w).alias("n"), F.round(F.median("area").over(w), 4).alias("middle"), F.max("area").over(w).alias("largest"), F.rank().over(w.orderBy(F.desc("area"))).alias("place"))


def stratified_sample(spark, sf_dir):
    b = buildings(spark, sf_dir)
    w = W.partitionBy("province", "cls").orderBy(F.sha2(F.concat(F.col("bldg_id").cast("string"), F.lit(":7")), 256), "bldg_id")
    return b.withColumn("r", F.row_number().over(w)).where("r <= 5").select("bldg_id", "province", "cls", (F.col("r") <= 2).alias("gold"))


def label_export_last_wins(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max(F.struct("turn", "role", F.length("text").alias("n"))).alias("m"))
    return c.select("conv_id", F.col("m.turn").alias("turn"), F.col("m.role").alias("role"), F.col("m.n").cast("long").alias("n"))


def ledger_spend(spark, sf_dir):
    w = W.partitionBy("conv_id").orderBy("turn", "cost").rowsBetween(W.unboundedPreceding, 0)
    price = F.when(F.col("role") == "user", 3.0).otherwise(15.0)
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", (F.length("text") / 4 * price).alias("cost"))
    spent = c.withColumn("spent", F.sum("cost").over(w)).groupBy("conv_id", "turn").agg(F.max("spent").alias("spent"))
    return spent.select("conv_id", "turn", F.round("spent", 4).alias("spent"), (F.col("spent") > 3000).alias("over"))


def html_claims(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit(r"<p[ >]")).cast("long").alias("n_p"), F.regexp_count("html", F.lit(r"href=\"http")).cast("long").alias("n_links"))


def complete_grid(spark, sf_dir):
    e = read(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("node"), F.hour("ts").alias("hour"))
    nodes = e.select("node").distinct().select("node", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    return nodes.join(e.groupBy("node", "hour").agg(F.count(F.lit(1)).alias("n")), ["node", "hour"], "left").fillna(0)


def growth_rescale(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y"))
    b = buildings(spark, sf_dir).select("bldg_id", "district")
    n = o.join(b, F.col("o_custkey") == F.col("bldg_id")).groupBy("district", "y").agg(F.count(F.lit(1)).alias("n"))
    run = F.sum("n").over(W.partitionBy("district").orderBy("y"))
    own = n.withColumn("c", F.ln(run.cast("double"))).groupBy("district").agg(F.regr_slope("c", F.col("y").cast("double")).alias("slope"))
    total = own.agg(F.avg("slope").alias("mean"))
    return own.join(F.broadcast(total)).select("district", F.round(F.col("slope") * 0.023 / F.col("mean"), 6).alias("rate"))


_BOX = "l AS (SELECT bldg_id AS id, (lon - 28.8::DOUBLE) * 1000 AS x0, (lat + 2.85::DOUBLE) * 1000 AS y0, area / 5.0::DOUBLE AS s FROM bld)"
_PAIRS = f"""{BLD}, {_BOX}, q AS (SELECT a.id, b.id AS r_id, b.s,
  (least(a.x0 + 20, b.x0 + b.s) - greatest(a.x0, b.x0)) AS w, (least(a.y0 + 20, b.y0 + b.s) - greatest(a.y0, b.y0)) AS h FROM l a, l b
  WHERE greatest(a.x0, b.x0) < least(a.x0 + 20, b.x0 + b.s) AND greatest(a.y0, b.y0) < least(a.y0 + 20, b.y0 + b.s)),
p AS (SELECT id, r_id, w * h AS shared, round(w * h / (400 + s * s - w * h), 6) AS iou FROM q)"""
_HEIGHT = f"{BLD}, v AS (SELECT floors, floors * 3.0::DOUBLE + area % 7 AS height FROM bld)"
_STAGE = "SELECT bldg_id, district FROM (SELECT *, row_number() OVER (PARTITION BY district ORDER BY {score} DESC, bldg_id) AS r FROM {frm} WHERE {ok}) WHERE r <= need * {k}"
_S1 = _STAGE.format(score="area", frm="bld", ok="cls = 'BUILDING'", k=2)
_S2 = _STAGE.format(score="score", frm="bld", ok="score > 2000 AND bldg_id NOT IN (SELECT bldg_id FROM s1)", k=3)
_S3 = _STAGE.format(score="floors * area", frm="bld", ok="bldg_id NOT IN (SELECT bldg_id FROM s1 UNION ALL SELECT bldg_id FROM s2)", k=1)

ORACLE = {
    "staged_allocation": f"WITH {BLD}, s1 AS ({_S1}), s2 AS ({_S2}), s3 AS ({_S3}) SELECT *, 'large' AS stage FROM s1 UNION ALL SELECT *, 'rich' FROM s2 UNION ALL SELECT *, 'rest' FROM s3",
    "logit_shift": f"""WITH RECURSIVE {BLD}, x AS (SELECT district, (area % 89 + 5) / 100.0::DOUBLE AS p FROM bld),
t AS (SELECT district, 0.3::DOUBLE + max(need) / 20.0::DOUBLE AS target FROM bld GROUP BY 1),
b(i, district, target, lo, hi) AS (SELECT 0, district, target, -15.0::DOUBLE, 15.0::DOUBLE FROM t UNION ALL
  SELECT i + 1, district, target, CASE WHEN s < target THEN (lo + hi) / 2 ELSE lo END, CASE WHEN s < target THEN hi ELSE (lo + hi) / 2 END FROM (
    SELECT b.i, b.district, b.target, b.lo, b.hi, avg(1 / (1 + exp(-(ln(x.p / (1 - x.p)) + (b.lo + b.hi) / 2)))) AS s FROM b JOIN x USING (district) WHERE b.i < 45 GROUP BY ALL))
SELECT district, round((lo + hi) / 2, 5) AS shift FROM b WHERE i = 45""",
    "floor_cutpoints": f"""WITH {_HEIGHT}, g AS (SELECT 4 + 0.5::DOUBLE * k AS t FROM range(25) r(k)),
s AS (SELECT t, (count(*) FILTER (floors >= 3 AND height >= t) / count(*) FILTER (floors >= 3) + count(*) FILTER (floors < 3 AND height < t) / count(*) FILTER (floors < 3)) / 2 AS a FROM v, g GROUP BY t)
SELECT t AS threshold, round(a, 6) AS score FROM s ORDER BY a DESC, t LIMIT 1""",
    "storey_grid_search": f"""WITH {_HEIGHT}, g AS (SELECT 2 + 0.25::DOUBLE * k AS s FROM range(13) r(k)),
e AS (SELECT s, floors, avg(abs(greatest(floor(height / s + 0.5::DOUBLE), 1) - floors)) AS e FROM v, g GROUP BY ALL), m AS (SELECT s, round(avg(e), 6) AS err FROM e GROUP BY s)
SELECT s AS storey, err FROM m ORDER BY err, s LIMIT 1""",
    "coincident_vs_noncoincident_peak": f"""WITH {W_SQL}, {LIB_SQL}, c AS (SELECT bldg_id, hour, sum(units * watt) AS w FROM w JOIN lib USING (profile_id) GROUP BY ALL),
a AS (SELECT max(s) AS c FROM (SELECT sum(w) AS s FROM c GROUP BY hour)), b AS (SELECT sum(m) AS d FROM (SELECT max(w) AS m FROM c GROUP BY bldg_id))
SELECT round(c, 3) AS coincident_w, round(d, 3) AS separate_w, round(c / d, 6) AS ratio FROM a, b""",
    "gap_fill_short_runs": """WITH e AS (SELECT user_id % 10 AS node, date_trunc('hour', ts) AS hour, max(value) AS v FROM events GROUP BY ALL),
k AS (SELECT *, lead(hour) OVER (PARTITION BY node ORDER BY hour) AS nh, lead(v) OVER (PARTITION BY node ORDER BY hour) AS nv FROM e),
s AS (SELECT *, coalesce(date_diff('hour', hour, nh), 1) AS d FROM k), f AS (SELECT *, unnest(range(d)) AS j FROM s)
SELECT node, hour + to_hours(j) AS hour, round(CASE WHEN j = 0 THEN v WHEN d <= 4 THEN v + (nv - v) * j / d END, 4) AS value FROM f""",
    "hot_hours": "SELECT month(ts)::INT AS month, hour(ts)::INT AS hour, count(*) AS n FROM events WHERE value > 100 GROUP BY ALL",
    "box_overlap_pairs": f"WITH {_PAIRS} SELECT id, r_id, round(shared, 4) AS shared, iou FROM p",
    "best_overlap_match": f"WITH {_PAIRS} SELECT id, min_by(r_id, (-iou, r_id)) AS r_id, max(iou) AS iou FROM p WHERE id != r_id GROUP BY id",
    "focal_share_disk": """WITH p AS (SELECT p_partkey // 50 AS r, p_partkey % 50 AS c, (p_size > 25)::INT AS one FROM part)
SELECT a.r AS row, a.c AS col, round(avg(b.one), 6) AS share FROM p a JOIN p b ON abs(a.r - b.r) <= 3 AND abs(a.c - b.c) <= 3 AND (a.r - b.r) ** 2 + (a.c - b.c) ** 2 <= 9 GROUP BY ALL""",
    "mutual_nearest_assignment": f"""WITH {BLD}, {FAC}, d AS (SELECT bldg_id, facility_id, round({DIST}, 4) AS dist, {DIST} AS exact FROM bld b, fac f),
r AS (SELECT *, row_number() OVER (PARTITION BY bldg_id ORDER BY dist, facility_id) AS x, row_number() OVER (PARTITION BY facility_id ORDER BY dist, bldg_id) AS y FROM d WHERE exact <= 20000)
SELECT bldg_id, facility_id, round(dist, 3) AS dist FROM r WHERE x = 1 AND y = 1""",
    "weighted_auc_logloss": """WITH v AS (SELECT l_returnflag, (l_partkey % 97 + 1) / 100.0::DOUBLE AS s, (l_quantity > 25)::INT AS y, 1 + l_orderkey % 5 AS w FROM lineitem),
g AS (SELECT l_returnflag, s, sum(w * y)::DOUBLE AS p, sum(w * (1 - y))::DOUBLE AS q, sum(w * (s - y) * (s - y)) AS e FROM v GROUP BY ALL),
u AS (SELECT *, sum(q) OVER (PARTITION BY l_returnflag ORDER BY s) - q / 2 AS m FROM g)
SELECT l_returnflag, round(sum(p * m) / (sum(p) * sum(q)), 6) AS auc, round(sum(e) / sum(p + q), 6) AS brier FROM u GROUP BY 1""",
    "label_entropy": f"""WITH {BLD}, c AS (SELECT district, cls, count(*) AS m FROM bld GROUP BY ALL), s AS (SELECT *, m / sum(m) OVER (PARTITION BY district) AS f FROM c)
SELECT district, sum(m)::BIGINT AS n, count(*) AS k, round(CASE WHEN count(*) > 1 THEN -sum(f * ln(f)) / ln(count(*)) ELSE 0 END, 6) AS entropy FROM s GROUP BY 1""",
    "mode_and_argmin": f"""WITH {BLD}, c AS (SELECT district, cls, count(*) AS n FROM bld GROUP BY ALL), m AS (SELECT district, min_by(cls, (-n, cls)) AS mode FROM c GROUP BY 1)
SELECT district, mode, min_by(bldg_id, (score, bldg_id)) AS poorest FROM bld JOIN m USING (district) GROUP BY ALL""",
    "multi_level_rollup": f"WITH {BLD} " + " UNION ALL ".join(f"SELECT '{c}' AS level, {c} AS name, count(*) AS n, sum(area)::BIGINT AS area FROM bld GROUP BY {c}" for c in ("cls", "district", "province")),
    "cell_rank_features": f"""WITH {BLD}, c AS (SELECT *, floor(lon * 4) * 1000 + floor((lat + 3) * 4) AS cell FROM bld)
SELECT bldg_id, count(*) OVER w AS n, round(median(area) OVER w, 4) AS middle, max(area) OVER w AS largest, rank() OVER (PARTITION BY cell ORDER BY area DESC) AS place FROM c WINDOW w AS (PARTITION BY cell)""",
    "stratified_sample": f"WITH {BLD}, r AS (SELECT *, row_number() OVER (PARTITION BY province, cls ORDER BY sha256(bldg_id || ':7'), bldg_id) AS r FROM bld) SELECT bldg_id, province, cls, r <= 2 AS gold FROM r WHERE r <= 5",
    "label_export_last_wins": "SELECT conv_id, turn, role, n FROM (SELECT conv_id, turn, role, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, length(text) DESC) AS r FROM conversations) WHERE r = 1",
    "ledger_spend": """WITH c AS (SELECT conv_id, turn, length(text) / 4 * CASE WHEN role = 'user' THEN 3 ELSE 15 END AS cost FROM conversations),
s AS (SELECT conv_id, turn, sum(cost) OVER (PARTITION BY conv_id ORDER BY turn, cost ROWS UNBOUNDED PRECEDING) AS spent FROM c)
SELECT conv_id, turn, round(max(spent), 4) AS spent, max(spent) > 3000 AS over FROM s GROUP BY ALL""",
    "html_claims": """SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<p[ >]')) AS n_p, len(regexp_extract_all(html, 'href="http')) AS n_links FROM pages""",
    "complete_grid": """WITH e AS (SELECT user_id % 10 AS node, hour(ts)::INT AS hour FROM events), g AS (SELECT DISTINCT node FROM e), c AS (SELECT node, hour, count(*) AS n FROM e GROUP BY ALL)
SELECT node, h.hour::INT AS hour, coalesce(n, 0) AS n FROM g CROSS JOIN range(24) h(hour) LEFT JOIN c USING (node, hour)""",
    "growth_rescale": f"""WITH {BLD}, n AS (SELECT district, year(o_orderdate) AS y, count(*) AS n FROM orders JOIN bld ON o_custkey = bldg_id GROUP BY ALL),
c AS (SELECT district, y, ln(sum(n) OVER (PARTITION BY district ORDER BY y)) AS c FROM n), s AS (SELECT district, regr_slope(c, y) AS slope FROM c GROUP BY 1)
SELECT district, round(slope * 0.023::DOUBLE / avg(slope) OVER (), 6) AS rate FROM s""",
}
QUERIES = {name: globals()[name] for name in ORACLE}
