"""Contract queries of the relational, statistical, picking, neighbour and calibration operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import first_match, half_open, kwh_from_spend
from ..operators import calibrate, neighbours, picks, stats
from ..sources import read
from .flagship import HOURS, LIB_SQL, PROFILES, W_SQL, curve_metrics, hourly, profile_weights, watts

LAT0 = -2.0
TARIFF = [(15.0, 89.0), (35.0, 212.0), (1e9, 249.0)]


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    own = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    return own.select(
        k.alias("bldg_id"), F.col("n_name").alias("district"), F.col("r_name").alias("province"), F.col("c_acctbal").alias("score"), F.col("c_mktsegment").alias("cls"),
        (28.8 + ((k * 7919) % 21000) / 10000.0).alias("lon"), (-2.85 + ((k * 104729) % 18100) / 10000.0).alias("lat"), (10 + k % 190).alias("area"), (1 + k % 4).alias("floors"), (3 + F.col("n_nationkey") % 5).cast("long").alias("need"),
    )


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(k.alias("facility_id"), (k % 3).alias("grp"), (28.8 + ((k * 15485863) % 21000) / 10000.0).alias("lon"), (-2.85 + ((k * 32452843) % 18100) / 10000.0).alias("lat"))


BLD = """bld AS (SELECT c_custkey AS bldg_id, n_name AS district, r_name AS province, c_acctbal AS score, c_mktsegment AS cls,
  28.8::DOUBLE + ((c_custkey * 7919) % 21000) / 10000.0::DOUBLE AS lon, (-2.85)::DOUBLE + ((c_custkey * 104729) % 18100) / 10000.0::DOUBLE AS lat,
  10 + c_custkey % 190 AS area, 1 + c_custkey % 4 AS floors, 3 + n_nationkey % 5 AS need
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
FAC = """fac AS (SELECT s_suppkey AS facility_id, s_suppkey % 3 AS grp, 28.8::DOUBLE + ((s_suppkey * 15485863) % 21000) / 10000.0::DOUBLE AS lon,
  (-2.85)::DOUBLE + ((s_suppkey * 32452843) % 18100) / 10000.0::DOUBLE AS lat FROM supplier)"""
DIST = "sqrt(power((b.lon - f.lon) * (111320.0::DOUBLE * cos(radians(-2.0::DOUBLE))), 2) + power((b.lat - f.lat) * 111320.0::DOUBLE, 2))"


def area_load_curve(spark, sf_dir):
    """Units are summed by district and profile straight from the rows: no step per building, and few rows before the 24 sums."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % PROFILES).alias("profile_id"), F.col("l_quantity").alias("units"))
    home = buildings(spark, sf_dir).select("bldg_id", "district")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(home, F.col("o_custkey") == F.col("bldg_id")).select("o_orderkey", "district")
    sums = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("district", "profile_id").agg(F.sum("units").alias("units"))
    return curve_metrics(hourly(sums, "district"), "district")


def expected_vs_potential_energy(spark, sf_dir):
    daily = sum((watts(F.col("profile_id"), h) for h in HOURS), F.lit(0.0)) / 1000
    own = profile_weights(spark, sf_dir).groupBy("profile_id").agg(F.sum("units").alias("units"), F.sum(F.col("units") * F.col("p_grid")).alias("on_grid"))
    return own.select("profile_id", F.round(F.col("units") * daily, 3).alias("potential_kwh"), F.round(F.col("on_grid") * daily, 3).alias("expected_kwh"))


def take_top_variable_k(spark, sf_dir):
    return picks.take_top(buildings(spark, sf_dir), "district", "score", "need", "bldg_id").select("district", "bldg_id", "rank")


def take_spaced_caps(spark, sf_dir):
    b = buildings(spark, sf_dir).withColumn("cell", F.floor(F.col("lon") * 2) * 1000 + F.floor((F.col("lat") + 3) * 2)).withColumn("need", F.col("need") * 4)
    return picks.take_spaced(b, "district", "cell", "score", "need", "bldg_id", cap=1).select("district", "bldg_id", "cap", "rank")


def capacity_fill(spark, sf_dir):
    b = buildings(spark, sf_dir).withColumn("need", F.col("need") * 10)
    return picks.fill(b, "district", "score", "floors", "need", "bldg_id").where("units > 0").select("district", "bldg_id", F.col("units").cast("long").alias("units"))


def prefix_share_setting(spark, sf_dir):
    out = picks.prefix_share(buildings(spark, sf_dir), "district", "score", "area", F.lit(0.35), "bldg_id")
    return out.groupBy("district").agg(F.count_if("flag").alias("n_urban"), F.sum(F.when(F.col("flag"), F.col("area")).otherwise(0)).alias("urban_area"))


def size_terciles(spark, sf_dir):
    out = picks.terciles(buildings(spark, sf_dir), "district", "area", "bldg_id")
    return out.groupBy("district", "third").agg(F.count(F.lit(1)).alias("n"), F.max("area").alias("largest"))


def dedup_first(spark, sf_dir):
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return read(spark, sf_dir, "orders").withColumn("rn", F.row_number().over(w)).where("rn = 1").select("o_custkey", "o_orderkey", "o_totalprice")


def compound_shares(spark, sf_dir):
    w = W.partitionBy("district", "area")
    b = buildings(spark, sf_dir).withColumn("share", F.round(1 / F.count(F.lit(1)).over(w), 9))
    return b.withColumn("rural", F.sum(F.when(F.col("score") < 4000, F.col("share")).otherwise(0.0)).over(w) >= 0.5).select("bldg_id", "share", "rural")


def first_stable_year(spark, sf_dir):
    o = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("bldg_id")).agg(*(F.least(F.lit(1.0), F.count_if(F.year("o_orderdate") == y) / 3.0).alias(f"p{y}") for y in range(1995, 2002)))
    last_miss = F.array_max(F.array(*(F.when(F.col(f"p{y}") < 0.3, F.lit(y)).otherwise(F.lit(1994)) for y in range(1995, 2002))))
    return o.select("bldg_id", F.when(last_miss < 2001, last_miss + 1).alias("first_year"))


def weighted_quantiles(spark, sf_dir):
    return stats.weighted_quantiles(read(spark, sf_dir, "lineitem"), "l_returnflag", "l_discount", "l_quantity", [0.25, 0.5, 0.75])


def block_tariff_inversion(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.round(kwh_from_spend(F.col("o_totalprice") / 10, TARIFF, 1.18), 6).alias("kwh"))


def district_table(spark, sf_dir):
    b = buildings(spark, sf_dir)
    return b.groupBy("district").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("cls") == "BUILDING").cast("int")), 6).alias("share"), F.round(F.median("score"), 4).alias("median"), F.round(F.percentile("score", F.lit(0.9)), 4).alias("p90"), F.count_distinct("cls").alias("classes"))


def small_cell_suppression(spark, sf_dir):
    return stats.suppressed(buildings(spark, sf_dir), ["district", "cls"], "score")


def ols_and_corr(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").groupBy("l_returnflag")
    return li.agg(F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"), F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 3).alias("intercept"), F.round(F.regr_r2("l_extendedprice", "l_quantity"), 6).alias("r2"), F.round(F.corr("l_extendedprice", "l_quantity"), 6).alias("r"))


def log_histogram(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy("o_orderstatus", F.floor(F.log10("o_totalprice") * 15).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def crosstab_rates(spark, sf_dir):
    own = buildings(spark, sf_dir).groupBy("province", "cls").agg(F.count(F.lit(1)).alias("n"))
    return own.withColumn("rate", F.round(F.col("n") / F.sum("n").over(W.partitionBy("province")), 6))


def band_join_nearest(spark, sf_dir):
    out = neighbours.nearest(buildings(spark, sf_dir).select("bldg_id", "lon", "lat"), facilities(spark, sf_dir), "bldg_id", "facility_id", 6000.0, LAT0)
    return out.withColumn("dist", F.round("dist", 3))


def multi_radius_counts(spark, sf_dir):
    return neighbours.counts_within(buildings(spark, sf_dir).select("bldg_id", "lon", "lat"), facilities(spark, sf_dir), "bldg_id", [3000.0, 6000.0, 12000.0], LAT0)


def first_match_rule_class(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    rules = [(F.col("p_type").startswith("ECONOMY"), "light"), (F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#13"), "branded"), (F.col("p_name").rlike("(green|blue)"), "coloured"), (F.col("p_size") >= 40, "large")]
    return p.select("p_partkey", F.coalesce(first_match(rules), F.lit("other")).alias("use"))


def half_open_bins(spark, sf_dir):
    label = half_open(F.col("p_size"), [0, 10, 25, 50], ["small", "medium", "large"])
    return read(spark, sf_dir, "part").groupBy(label.alias("size_class")).agg(F.count(F.lit(1)).alias("n"))


def flag_concat_explode(spark, sf_dir):
    flags = F.concat_ws(",", F.when(F.col("area") < 30, "tiny"), F.when(F.col("floors") == 4, "tall"), F.when(F.col("score") < 0, "debt"))
    b = buildings(spark, sf_dir).select("bldg_id", flags.alias("flags")).where("flags != ''")
    return b.select(F.explode(F.split("flags", ",")).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def sentinel_to_null(spark, sf_dir):
    return buildings(spark, sf_dir).groupBy("district").agg(F.count(F.when(F.col("score") >= 0, F.col("score"))).alias("n_seen"), F.round(F.avg(F.when(F.col("score") >= 0, F.col("score"))), 4).alias("mean"))


def full_outer_reconcile(spark, sf_dir):
    a = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = read(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), "c_acctbal")
    return a.join(b, "k", "full_outer").agg(F.count_if(F.col("n_orders").isNull()).alias("only_right"), F.count_if(F.col("c_acctbal").isNull()).alias("only_left"), F.count(F.lit(1)).alias("n"))


def anti_join_tags(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").join(o, "c_custkey", "left_anti").select("c_custkey", "c_mktsegment")


def semi_join_ids(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").join(o, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


def ece_bins(spark, sf_dir):
    d = read(spark, sf_dir, "labels").withColumn("confidence", (F.col("doc_id") % 101) / 100.0)
    return stats.calibration_error(d, "confidence", "quality")


def macro_f1_confusion(spark, sf_dir):
    return stats.macro_f1(read(spark, sf_dir, "labels").withColumn("guess", (F.col("doc_id") % 3 > 0).cast("int")), "quality", "guess").select(F.col("class"), "n_gold", "n_guess", "n_hit", "f1")


def prior_calibration(spark, sf_dir):
    want = {"BUILDING": 0.4, "AUTOMOBILE": 0.3, "MACHINERY": 0.2, "HOUSEHOLD": 0.1}
    return calibrate.prior_factors(buildings(spark, sf_dir).withColumn("one", F.lit(1.0)), "cls", "one", want)


def region_raking(spark, sf_dir):
    b = buildings(spark, sf_dir)
    target = b.groupBy("district").agg((F.count(F.lit(1)) * 120.0).alias("target"))
    return calibrate.ratio_raking(b, "district", F.col("area") * F.col("floors") * 1.0, target).select("district", F.round("total", 3).alias("total"), "target", F.round("scale", 6).alias("scale"))


def degree_days(spark, sf_dir):
    e = read(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("node"), F.to_date(F.expr("ts + INTERVAL 2 HOURS")).alias("day"), "value")
    daily = e.groupBy("node", "day").agg(F.avg("value").alias("mean"), F.max("value").alias("top"))
    return daily.groupBy("node").agg(F.round(F.sum(F.greatest(F.col("mean") - 40, F.lit(0.0))), 4).alias("degree_days"), F.round(F.percentile("top", F.lit(0.95)), 4).alias("p95"), F.count(F.lit(1)).alias("days"))


def deaccumulate_reset(spark, sf_dir):
    e = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 10).alias("node"), F.date_trunc("hour", "ts").alias("hour")).agg(F.max("value").alias("acc"))
    w = W.partitionBy("node").orderBy("hour")
    step = F.when(F.hour("hour") == 1, F.col("acc")).otherwise(F.greatest(F.col("acc") - F.lag("acc").over(w), F.lit(0.0)))
    return e.select("node", "hour", F.round(step, 6).alias("step"))


def content_hash_ids(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.left(F.sha2(F.concat("source", F.lit("|"), "text"), 256), F.lit(16)).alias("content_id"))


def block_fraction(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 50).alias("row"), (F.col("p_partkey") % 50).alias("col"), "p_size")
    return p.groupBy(F.floor(F.col("row") / 10).cast("long").alias("r"), F.floor(F.col("col") / 10).cast("long").alias("c")).agg(F.round(F.avg((F.col("p_size") > 25).cast("int")), 6).alias("share"))


def contract_violations(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return li.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("l_discount").between(0, 0.1)).alias("bad_discount"), F.count_if(F.col("l_quantity") > 45).alias("over_45"), F.count_if(~F.col("l_returnflag").isin("A", "N", "R")).alias("bad_flag"), (F.count(F.lit(1)) - F.count_distinct("l_orderkey", "l_linenumber")).alias("repeated_keys"))


_CURVE = """round(max(w), 4) AS peak_w, min_by(hour, (-w, hour))::INT AS peak_hour, round(sum(w) / 24 / nullif(max(w), 0), 6) AS load_factor,
  round(sum(CASE WHEN hour BETWEEN 18 AND 22 THEN w ELSE 0 END) / nullif(sum(w), 0), 6) AS evening_share, round(sum(w) / 1000, 6) AS daily_kwh"""
_BEFORE = "coalesce(sum({c}) OVER (PARTITION BY district ORDER BY score DESC, bldg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"

ORACLE = {
    "area_load_curve": f"""WITH {W_SQL}, {LIB_SQL}, {BLD}, c AS (SELECT district, hour, sum(units * watt) AS w FROM w JOIN orders ON w.bldg_id = o_orderkey JOIN bld b ON o_custkey = b.bldg_id JOIN lib USING (profile_id) GROUP BY ALL)
SELECT district, {_CURVE} FROM c GROUP BY district""",
    "expected_vs_potential_energy": f"""WITH {W_SQL}, {LIB_SQL}, d AS (SELECT profile_id, sum(watt) / 1000 AS kwh FROM lib GROUP BY ALL)
SELECT profile_id, round(sum(units) * any_value(kwh), 3) AS potential_kwh, round(sum(units * p_grid) * any_value(kwh), 3) AS expected_kwh FROM w JOIN d USING (profile_id) GROUP BY profile_id""",
    "take_top_variable_k": f"WITH {BLD}, r AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY score DESC, bldg_id) AS rank FROM bld) SELECT district, bldg_id, rank::INT AS rank FROM r WHERE rank <= need",
    "take_spaced_caps": f"""WITH {BLD}, r AS (SELECT * REPLACE (need * 4 AS need), row_number() OVER (PARTITION BY district, floor(lon * 2), floor((lat + 3) * 2) ORDER BY score DESC, bldg_id) AS k FROM bld),
n AS (SELECT district, cap, count(*) FILTER (WHERE k <= cap) AS n, any_value(need) AS need FROM r, (VALUES (1),(2),(4),(8),(16),(32),(64),(128),(256)) v(cap) GROUP BY ALL),
c AS (SELECT district, coalesce(min(cap) FILTER (WHERE n >= need), 256) AS cap FROM n GROUP BY ALL),
t AS (SELECT district, bldg_id, cap, need, row_number() OVER (PARTITION BY district ORDER BY score DESC, bldg_id) AS rank FROM r JOIN c USING (district) WHERE k <= cap)
SELECT district, bldg_id, cap::BIGINT AS cap, rank::INT AS rank FROM t WHERE rank <= need""",
    "capacity_fill": f"WITH {BLD}, u AS (SELECT district, bldg_id, least(floors, greatest(need * 10 - {_BEFORE.format(c='floors')}, 0))::BIGINT AS units FROM bld) SELECT * FROM u WHERE units > 0",
    "prefix_share_setting": f"WITH {BLD}, f AS (SELECT district, area, {_BEFORE.format(c='area')} < 0.35::DOUBLE * sum(area) OVER (PARTITION BY district) AS flag FROM bld) SELECT district, count(*) FILTER (WHERE flag) AS n_urban, coalesce(sum(area) FILTER (WHERE flag), 0)::BIGINT AS urban_area FROM f GROUP BY district",
    "size_terciles": f"""WITH {BLD}, r AS (SELECT district, area, row_number() OVER (PARTITION BY district ORDER BY area, bldg_id) AS r, count(*) OVER (PARTITION BY district) AS n FROM bld)
SELECT district, (CASE WHEN 3 * (r - 1) <= n - 1 THEN 0 WHEN 3 * (r - 1) <= 2 * (n - 1) THEN 1 ELSE 2 END)::INT AS third, count(*) AS n, max(area) AS largest FROM r GROUP BY 1, 2""",
    "dedup_first": "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1",
    "compound_shares": f"""WITH {BLD}, s AS (SELECT *, round(1.0::DOUBLE / count(*) OVER (PARTITION BY district, area), 9) AS share FROM bld)
SELECT bldg_id, share, sum(CASE WHEN score < 4000 THEN share ELSE 0 END) OVER (PARTITION BY district, area) >= 0.5 AS rural FROM s""",
    "first_stable_year": """WITH y AS (SELECT y FROM range(1995, 2002) t(y)), c AS (SELECT DISTINCT o_custkey FROM orders),
p AS (SELECT c.o_custkey, y, least(1.0, count(o_orderkey) / 3.0) AS p FROM c CROSS JOIN y LEFT JOIN orders o ON o.o_custkey = c.o_custkey AND year(o_orderdate) = y GROUP BY ALL),
m AS (SELECT o_custkey, coalesce(max(y) FILTER (WHERE p < 0.3), 1994) AS l FROM p GROUP BY ALL)
SELECT o_custkey AS bldg_id, (CASE WHEN l < 2001 THEN l + 1 END)::INT AS first_year FROM m""",
    "weighted_quantiles": """WITH v AS (SELECT l_returnflag, l_discount, sum(l_quantity) AS w FROM lineitem GROUP BY ALL),
c AS (SELECT *, sum(w) OVER (PARTITION BY l_returnflag ORDER BY l_discount) AS c, sum(w) OVER (PARTITION BY l_returnflag) AS t FROM v)
SELECT l_returnflag, q::DOUBLE AS q, min(l_discount) AS quantile FROM c, (VALUES (0.25),(0.5),(0.75)) x(q) WHERE c >= q::DOUBLE * t - 1e-9 GROUP BY 1, 2""",
    "block_tariff_inversion": """WITH n AS (SELECT o_orderkey, o_totalprice / 10 / 1.18::DOUBLE AS net FROM orders)
SELECT o_orderkey, round(least(greatest(net, 0), 1335.0::DOUBLE) / 89 + least(greatest(net - 1335.0::DOUBLE, 0), 7420.0::DOUBLE) / 212 + greatest(net - 8755.0::DOUBLE, 0) / 249, 6) AS kwh FROM n""",
    "district_table": f"WITH {BLD} SELECT district, count(*) AS n, round(avg((cls = 'BUILDING')::INT), 6) AS share, round(median(score), 4) AS median, round(quantile_cont(score, 0.9), 4) AS p90, count(DISTINCT cls) AS classes FROM bld GROUP BY district",
    "small_cell_suppression": f"WITH {BLD} SELECT district, cls, count(*) AS n, CASE WHEN count(*) >= 10 THEN round(avg(score), 4) END AS mean FROM bld GROUP BY ALL",
    "ols_and_corr": "SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, round(corr(l_extendedprice, l_quantity), 6) AS r FROM lineitem GROUP BY 1",
    "log_histogram": "SELECT o_orderstatus, floor(log10(o_totalprice) * 15)::BIGINT AS bin, count(*) AS n FROM orders GROUP BY ALL",
    "crosstab_rates": f"WITH {BLD}, g AS (SELECT province, cls, count(*) AS n FROM bld GROUP BY ALL) SELECT province, cls, n, round(n / sum(n) OVER (PARTITION BY province), 6)::DOUBLE AS rate FROM g",
    "band_join_nearest": f"WITH {BLD}, {FAC}, d AS (SELECT bldg_id, facility_id, {DIST} AS dist FROM bld b, fac f) SELECT bldg_id, facility_id, round(dist, 3) AS dist FROM (SELECT *, row_number() OVER (PARTITION BY bldg_id ORDER BY dist, facility_id) AS r FROM d WHERE dist <= 6000) WHERE r = 1",
    "multi_radius_counts": f"WITH {BLD}, {FAC}, d AS (SELECT bldg_id, {DIST} AS dist FROM bld b, fac f) SELECT bldg_id, count(*) FILTER (WHERE dist <= 3000) AS n_3000, count(*) FILTER (WHERE dist <= 6000) AS n_6000, count(*) FILTER (WHERE dist <= 12000) AS n_12000 FROM d GROUP BY 1",
    "first_match_rule_class": "SELECT p_partkey, CASE WHEN starts_with(p_type, 'ECONOMY') THEN 'light' WHEN p_brand IN ('Brand#11', 'Brand#12', 'Brand#13') THEN 'branded' WHEN regexp_matches(p_name, '(green|blue)') THEN 'coloured' WHEN p_size >= 40 THEN 'large' ELSE 'other' END AS use FROM part",
    "half_open_bins": "SELECT CASE WHEN p_size >= 0 AND p_size < 10 THEN 'small' WHEN p_size >= 10 AND p_size < 25 THEN 'medium' WHEN p_size >= 25 AND p_size < 50 THEN 'large' END AS size_class, count(*) AS n FROM part GROUP BY 1",
    "flag_concat_explode": f"WITH {BLD}, f AS (SELECT 'tiny' AS flag FROM bld WHERE area < 30 UNION ALL SELECT 'tall' FROM bld WHERE floors = 4 UNION ALL SELECT 'debt' FROM bld WHERE score < 0) SELECT flag, count(*) AS n FROM f GROUP BY 1",
    "sentinel_to_null": f"WITH {BLD} SELECT district, count(CASE WHEN score >= 0 THEN 1 END) AS n_seen, round(avg(CASE WHEN score >= 0 THEN score END), 4) AS mean FROM bld GROUP BY 1",
    "full_outer_reconcile": "WITH a AS (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1), b AS (SELECT c_custkey AS k, c_acctbal FROM customer WHERE c_acctbal > 0) SELECT count(*) FILTER (WHERE n_orders IS NULL) AS only_right, count(*) FILTER (WHERE c_acctbal IS NULL) AS only_left, count(*) AS n FROM a FULL JOIN b USING (k)",
    "anti_join_tags": "SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')",
    "semi_join_ids": "SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
    "ece_bins": "SELECT least(floor((doc_id % 101) / 100.0::DOUBLE * 10), 9)::INT AS bin, count(*) AS n, round(avg(quality::DOUBLE), 6) AS accuracy, round(avg((doc_id % 101) / 100.0::DOUBLE), 6) AS confidence FROM labels GROUP BY 1",
    "macro_f1_confusion": """WITH l AS (SELECT quality AS g, (doc_id % 3 > 0)::INT AS p FROM labels), c AS (SELECT DISTINCT g AS class FROM l UNION SELECT DISTINCT p FROM l)
SELECT class, count(*) FILTER (WHERE g = class) AS n_gold, count(*) FILTER (WHERE p = class) AS n_guess, count(*) FILTER (WHERE g = class AND p = class) AS n_hit,
  round(2 * count(*) FILTER (WHERE g = class AND p = class) / nullif(count(*) FILTER (WHERE g = class) + count(*) FILTER (WHERE p = class), 0), 6) AS f1 FROM c, l GROUP BY class""",
    "prior_calibration": f"WITH {BLD}, h AS (SELECT cls, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM bld GROUP BY 1) SELECT cls, round(least(coalesce(v.want, 0)::DOUBLE / share, 50), 6) AS factor FROM h LEFT JOIN (VALUES ('BUILDING', 0.4), ('AUTOMOBILE', 0.3), ('MACHINERY', 0.2), ('HOUSEHOLD', 0.1)) v(k, want) ON cls = k",
    "region_raking": f"WITH {BLD} SELECT district, round(sum(area * floors)::DOUBLE, 3) AS total, count(*) * 120.0::DOUBLE AS target, round(count(*) * 120.0::DOUBLE / nullif(sum(area * floors)::DOUBLE, 0), 6) AS scale FROM bld GROUP BY 1",
    "degree_days": "WITH d AS (SELECT user_id % 10 AS node, (ts + INTERVAL 2 HOUR)::DATE AS day, avg(value) AS mean, max(value) AS top FROM events GROUP BY ALL) SELECT node, round(sum(greatest(mean - 40, 0)), 4) AS degree_days, round(quantile_cont(top, 0.95), 4) AS p95, count(*) AS days FROM d GROUP BY 1",
    "deaccumulate_reset": "WITH e AS (SELECT user_id % 10 AS node, date_trunc('hour', ts) AS hour, max(value) AS acc FROM events GROUP BY ALL), l AS (SELECT *, lag(acc) OVER (PARTITION BY node ORDER BY hour) AS p FROM e) SELECT node, hour, round(CASE WHEN extract(hour FROM hour) = 1 THEN acc WHEN p IS NULL THEN 0 ELSE greatest(acc - p, 0) END, 6) AS step FROM l",
    "content_hash_ids": "SELECT doc_id, left(sha256(source || '|' || text), 16) AS content_id FROM documents",
    "block_fraction": "SELECT (p_partkey // 50) // 10 AS r, (p_partkey % 50) // 10 AS c, round(avg((p_size > 25)::INT), 6) AS share FROM part GROUP BY 1, 2",
    "contract_violations": "SELECT count(*) AS n, count(*) FILTER (WHERE NOT l_discount BETWEEN 0 AND 0.1::DOUBLE) AS bad_discount, count(*) FILTER (WHERE l_quantity > 45) AS over_45, count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')) AS bad_flag, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS repeated_keys FROM lineitem",
}
QUERIES = {name: globals()[name] for name in ORACLE}
