"""Contract queries of predicates, overrides, probability vectors, key-wise writes and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import first_match
from ..operators import shaping
from ..sources import read
from .core import BLD, FAC, buildings

CLASSES = ["residential", "commercial", "religious", "institutional"]


def exclude_columns(spark, sf_dir):
    """All columns but some: the ones left out aren't read."""
    return read(spark, sf_dir, "customer").drop("c_name", "c_acctbal")


def setting_predicate(spark, sf_dir):
    b = buildings(spark, sf_dir)
    k = F.col("bldg_id")
    kind = F.when(k % 6 == 0, "centre").when(k % 6 == 1, "dense").when(k % 6 == 2, "village")
    s = shaping.setting(F.when(k % 9 > 0, (k * 61) % 997), kind, 800, ["centre", "dense"])
    return b.select("bldg_id", s.alias("setting"), F.when(s == "urban", "town").otherwise("grain_mill").alias("score_group"))


def eligibility_predicate(spark, sf_dir):
    k = F.col("bldg_id")
    flags = F.concat_ws(",", F.when(k % 4 == 0, "overlap"), F.when(k % 7 == 0, "tiny"), F.when(k % 11 == 0, "shape"))
    label, facility = F.when(k % 5 == 0, "ancillary").when(k % 5 == 1, "residential"), F.when(k % 13 == 0, "health")
    ok = shaping.eligible(F.col("area"), flags, label, facility, 25, ["tiny", "shape"], ["ancillary"])
    return buildings(spark, sf_dir).select("bldg_id", ok.alias("eligible"))


def informative_tags(spark, sf_dir):
    """Tags that say something: not empty, not 'yes', and not only a building's own word."""
    own = F.lower(F.col("p_type"))
    told = F.length(F.trim(own)).between(1, 40) & ~own.isin("yes", "building") & ~own.rlike("^(standard|promo) ")
    return read(spark, sf_dir, "part").where(told).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p_type").alias("kinds"))


def kept_labels(spark, sf_dir):
    """Labels that are sure enough and of a kept class."""
    k = F.col("doc_id")
    l = read(spark, sf_dir, "labels").select("doc_id", F.element_at(F.array(*map(F.lit, CLASSES)), (k % 4 + 1).cast("int")).alias("label"), (k % 10).alias("conf"))
    return l.where((F.col("conf") >= 6) & F.col("label").isin("commercial", "religious", "institutional"))


def tier_and_verdict(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 9000).cast("double").alias("wh"), (1 + F.col("o_custkey") % 3000).cast("double").alias("anchor"))
    k = F.col("o_orderkey")
    low, high = F.when(k % 3 == 0, F.col("anchor") * 0.5), F.when(k % 3 == 0, F.col("anchor") * 2)
    return o.select("o_orderkey", shaping.tier(F.col("wh"), {1: 12, 2: 200, 3: 1000, 4: 3400, 5: 8200}).alias("tier"), shaping.verdict(F.col("wh") + 1, F.col("anchor"), low, high).alias("verdict"))


def layer_split(spark, sf_dir):
    """Rows to layers by the first key that is set, with that key and its value."""
    k = F.col("p_partkey")
    tags = {"amenity": F.when(k % 3 == 0, F.col("p_brand")), "shop": F.when(k % 4 == 0, F.col("p_brand")), "office": F.when(k % 5 == 0, F.col("p_type"))}
    key = F.coalesce(*(F.when(v.isNotNull(), F.lit(n)) for n, v in tags.items()))
    out = read(spark, sf_dir, "part").select("p_partkey", key.alias("poi_key"), F.coalesce(*tags.values()).alias("poi_value"))
    return out.where("poi_key IS NOT NULL")


def evidence_overrides(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.round("s_acctbal", 2).alias("value"))
    over = read(spark, sf_dir, "supplier").where("s_suppkey % 4 = 0").select("s_suppkey", (F.col("s_nationkey") * 10.0).alias("value"), (F.col("s_suppkey") % 12 == 0).alias("exclude"))
    return shaping.overridden(s, over, "s_suppkey", "value")


def provenance_types(spark, sf_dir):
    """Where a value comes from, by the form of its reference."""
    ref = F.concat(F.element_at(F.array(*map(F.lit, ("survey:", "measured:", "ev-", "assumed", ""))), (F.col("p_partkey") % 5 + 1).cast("int")), F.when(F.col("p_partkey") % 5 < 3, F.col("p_size").cast("string")).otherwise(""))
    kind = first_match([(ref.startswith("survey:"), "survey"), (ref.startswith("measured:"), "measured"), (ref.rlike("^ev-[0-9]+$"), "evidence"), (ref == "assumed", "assumption")], F.lit("unsourced"))
    return read(spark, sf_dir, "part").groupBy(kind.alias("provenance")).agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("total"))


def probability_vectors(spark, sf_dir):
    """JSON maps of probabilities as vectors in the order of classes, and the top class."""
    k = F.col("doc_id")
    text = F.concat(F.lit('{"commercial": '), (k % 5).cast("string"), F.lit(', "residential": '), (k % 3).cast("string"), F.lit(', "religious": '), (k % 4).cast("string"), F.lit(', "_confidence": 9}'))
    vec = shaping.vector(F.from_json(text, "map<string,double>"), CLASSES)
    out = read(spark, sf_dir, "documents").select("doc_id", vec.alias("v"))
    return out.select("doc_id", *(F.col("v")[i].alias(c) for i, c in enumerate(CLASSES)), F.when(F.col("v").isNotNull(), shaping.top_class(F.col("v"), CLASSES)).alias("top"))


def viability_criteria(spark, sf_dir):
    k = F.col("bldg_id")
    own = [F.when(k % 7 > 0, k % 14), F.when(k % 8 > 0, (k * 13) % 2600), F.when(k % 9 > 0, (k * 61) % 20000), F.when(k % 10 > 0, (k * 17) % 6000), F.when(k % 11 > 0, (k % 300) / 100.0 - 1), F.when(k % 12 > 0, (k % 100) / 100.0), F.col("area")]
    parts = shaping.criteria(*own)
    weights = {"market_access": 30, "demand_density": 20, "grid_proximity": 15, "ability_to_pay": 15, "agri_context": 0, "building_size": 20}
    b = buildings(spark, sf_dir).select("bldg_id", *(v.alias(n) for n, v in parts.items()))
    return b.select("bldg_id", *(F.round(n, 8).alias(n) for n in parts), F.round(shaping.weighted_score({n: F.col(n) for n in parts}, weights), 6).alias("score"))


def upsert_by_key(spark, sf_dir):
    old = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.lit("old").alias("run"))
    new = read(spark, sf_dir, "nation").where("n_regionkey = 1").select("n_nationkey", F.upper("n_name").alias("n_name"), F.lit("new").alias("run"))
    return shaping.upsert(old, new, ["n_nationkey"])


def insert_or_replace(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return shaping.last_written(o, ["o_custkey"], "o_orderkey")


def distinct_union(spark, sf_dir):
    """Ids of either side of a pair, each once."""
    li = read(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"))
    return li.select(F.col("a").alias("id")).union(li.select(F.col("b").alias("id"))).distinct()


def id_reconciliation(spark, sf_dir):
    """Ids that some of eight sources lack."""
    k, c = F.col("c_custkey"), read(spark, sf_dir, "customer")
    sides = {f"s{i}": c.where(k % (i + 5) > 0).select(k.alias("id")) for i in range(7)}
    sides["orders"] = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    return shaping.reconciled(sides, "id")


def top_categories(spark, sf_dir):
    """The ten most frequent categories: a top-k report."""
    p = read(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    return p.orderBy(F.desc("n"), "p_type").limit(10)


def top_candidates(spark, sf_dir):
    """The 15 best candidates: a top-k report."""
    return read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(15)


def stable_row_ids(spark, sf_dir):
    """Row numbers over a whole table, without one task that holds it: counts of pieces, and ranks within each."""
    from ..operators import picks

    c = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.lit(1).alias("all"))
    return picks.running(c, "all", "c_acctbal", F.lit(1), "c_custkey").select("c_custkey", (F.col("_before") + 1).cast("long").alias("row_id"))


def validated_merge(spark, sf_dir):
    """A one-to-one merge that counts the keys that stand twice on either side instead of multiplying them."""
    a = read(spark, sf_dir, "customer").groupBy(F.col("c_custkey").alias("k")).agg(F.count(F.lit(1)).alias("na"), F.max("c_acctbal").alias("balance"))
    b = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("nb"), F.max("o_totalprice").alias("price"))
    m = a.join(b, "k")
    return m.agg(F.count_if(F.col("na") > 1).alias("twice_left"), F.count_if(F.col("nb") > 1).alias("twice_right"), F.count(F.lit(1)).alias("keys"))


def value_mix(spark, sf_dir):
    """Expected units and the use mix, with every class listed."""
    classes = spark.createDataFrame([("AUTOMOBILE",), ("BUILDING",), ("FURNITURE",), ("HOUSEHOLD",), ("MACHINERY",), ("SHIPYARD",)], "cls string")
    n = buildings(spark, sf_dir).groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.sum("floors").alias("units"))
    return F.broadcast(classes).join(n, "cls", "left").select("cls", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("units", F.lit(0)).alias("units"))


def weighted_means(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("double").alias("w"), F.floor(F.col("l_extendedprice") * 100).cast("long").alias("v"))
    return li.groupBy("l_returnflag", "l_linestatus").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("mean"), F.count(F.lit(1)).alias("n"))


def survey_memberships(spark, sf_dir):
    """Ownership, mean number and hours' quartiles over overlapping groups; each row is dealt to its groups once."""
    k = F.col("c_custkey")
    c = read(spark, sf_dir, "customer").select(F.array(F.lit("all"), F.concat(F.lit("seg:"), "c_mktsegment"), F.when(k % 2 == 0, "urban").otherwise("rural"), F.when(k % 3 == 0, "poor").otherwise("rich")).alias("groups"), (k % 4).alias("owned"), (k % 24).alias("hours"))
    g = c.select(F.explode("groups").alias("grp"), "owned", "hours")
    return g.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("owned") > 0).cast("int")).alias("share"), F.avg(F.when(F.col("owned") > 0, F.col("owned"))).alias("mean_number"), *(F.percentile("hours", F.lit(q)).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)))


def survey_share_scaled(spark, sf_dir):
    """A district's share scaled so that the nation's meets another survey's, clipped to 0..1."""
    b = buildings(spark, sf_dir).groupBy("district").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("floors") > 1).alias("yes"))
    nation = b.agg((F.sum("yes") / F.sum("n")).alias("nation"))
    share = F.col("yes") / F.col("n")
    return b.join(F.broadcast(nation)).select("district", share.alias("share"), F.least(F.greatest(share * (0.9 / F.col("nation")), F.lit(0.0)), F.lit(1.0)).alias("scaled"))  # one row


def coverage_matrix(spark, sf_dir):
    """Classes by statuses: how many rows cover each pair."""
    o = read(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 7).alias("appliance")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    return o.select("appliance", *(F.coalesce(F.col(c), F.lit(0)).alias(f"n_{c.lower()}") for c in "FOP"))


def agreement_stats(spark, sf_dir):
    """Bias, mean and median error and correlation of two measures of one thing, by group."""
    li = read(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("long").alias("a"), (F.col("l_partkey") % 50).alias("b"))
    d = F.col("a") - F.col("b")
    return li.groupBy("l_returnflag").agg((F.sum(d) / F.count(F.lit(1))).alias("bias"), (F.sum(F.abs(d)) / F.count(F.lit(1))).alias("mae"), F.median(F.abs(d)).alias("median_error"), F.round(F.corr("a", "b"), 8).alias("r"))


def national_rollup(spark, sf_dir):
    """Thirteen aggregates by province in one pass."""
    b = buildings(spark, sf_dir).withColumn("gross", (F.col("area") * F.col("floors")).cast("long"))
    return b.groupBy("province").agg(
        F.count(F.lit(1)).alias("n"), F.sum("area").alias("area"), F.sum("gross").alias("gross"), F.median("area").alias("median_area"), F.round(F.percentile("area", F.lit(0.9)), 4).alias("p90_area"), F.max("floors").cast("long").alias("top"), F.count_distinct("district").alias("districts"),
        F.count_distinct("cls").alias("classes"), F.avg((F.col("floors") > 1).cast("int")).alias("storeyed"), F.count_if(F.col("score") < 0).alias("in_debt"), F.min("bldg_id").alias("first"), F.max_by("bldg_id", F.struct("gross", "bldg_id")).alias("largest"), F.mode("cls", True).alias("mode"),
    )


def combined_matches(spark, sf_dir):
    """A polygon's match beats a point's; tags are coalesced, and the source of the match is told."""
    k = F.col("c_custkey")
    c = read(spark, sf_dir, "customer").select(k.alias("bldg_id"))
    poly = read(spark, sf_dir, "customer").where(k % 5 == 0).select(k.alias("bldg_id"), F.concat(F.lit("p"), k % 7).alias("ptag"), F.when(k % 2 == 0, F.concat(F.lit("n"), k % 3)).alias("pname"))
    point = read(spark, sf_dir, "customer").where(k % 3 == 0).select(k.alias("bldg_id"), F.concat(F.lit("q"), k % 4).alias("qtag"), F.concat(F.lit("m"), k % 2).alias("qname"))
    m = c.join(poly, "bldg_id", "left").join(point, "bldg_id", "left")
    kind = first_match([(F.col("ptag").isNotNull(), "polygon"), (F.col("qtag").isNotNull(), "point")], F.lit("none"))
    return m.select("bldg_id", kind.alias("source"), F.coalesce("ptag", "qtag").alias("tag"), F.coalesce("pname", "qname").alias("name"))


def quantile_bins(spark, sf_dir):
    """Ten bins of equal size by rank, with their means: what a calibration plot shows."""
    from ..operators import picks

    o = read(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") * 100).cast("long").alias("v"), (F.col("o_orderstatus") == "F").cast("int").alias("y"), F.lit(1).alias("all"))
    ranked = picks.running(o, "all", "v", F.lit(1), "o_orderkey", falling=False)
    return ranked.withColumn("bin", F.floor(F.col("_before") * 10 / F.col("_total")).cast("int")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), (F.sum("v") / F.count(F.lit(1))).alias("mean"), F.avg("y").alias("rate"))


def hierarchy_fallback(spark, sf_dir):
    """The parent that a point lies in, else the nearest one; the nearest is looked for on misses alone."""
    from .core import facilities

    k = F.col("bldg_id")
    b = buildings(spark, sf_dir).select("bldg_id", "lon", F.when(k % 4 > 0, F.floor((F.col("lon") - 28.8) * 2)).alias("col"))
    parents = facilities(spark, sf_dir).groupBy(F.floor((F.col("lon") - 28.8) * 2).alias("col")).agg(F.min("facility_id").alias("parent"))
    inside = b.join(parents, "col", "left")
    hit = inside.where("parent IS NOT NULL").select("bldg_id", "parent", F.lit("inside").alias("how"))
    miss = inside.where("parent IS NULL").select("bldg_id", F.floor((F.col("lon") - 28.8) * 2).alias("at"))
    near = miss.withColumn("col", F.explode(F.sequence(F.col("at") - 5, F.col("at") + 5))).join(parents, "col")
    best = near.groupBy("bldg_id").agg(F.min(F.struct(F.abs(F.col("col") - F.col("at")).alias("d"), "parent")).alias("m"))
    return hit.unionAll(best.select("bldg_id", F.col("m.parent").alias("parent"), F.lit("nearest").alias("how")))


_CRIT = """c AS (SELECT bldg_id, 0.5::DOUBLE * least(coalesce(CASE WHEN bldg_id % 7 > 0 THEN bldg_id % 14 END, 0) / 10::DOUBLE, 1) + 0.5::DOUBLE * (1 - least(coalesce(CASE WHEN bldg_id % 8 > 0 THEN (bldg_id * 13) % 2600 END, 2000) / 2000::DOUBLE, 1)) AS market_access,
least(log10(1 + coalesce(CASE WHEN bldg_id % 9 > 0 THEN (bldg_id * 61) % 20000 END, 0)) / log10(15001), 1) AS demand_density, 1 - least(coalesce(CASE WHEN bldg_id % 10 > 0 THEN (bldg_id * 17) % 6000 END, 5000) / 5000::DOUBLE, 1) AS grid_proximity,
coalesce(CASE WHEN bldg_id % 11 > 0 THEN least(greatest(((bldg_id % 300) / 100.0::DOUBLE - 1 + 0.415::DOUBLE) / (1.248::DOUBLE + 0.415::DOUBLE), 0), 1) END, 0.5) AS ability_to_pay, coalesce(CASE WHEN bldg_id % 12 > 0 THEN (bldg_id % 100) / 100.0::DOUBLE END, 0) AS agri_context,
least(greatest(log10(greatest(area, 20) / 20::DOUBLE) / log10(25), 0), 1) AS building_size FROM bld)"""
ORACLE = {
    "exclude_columns": "SELECT * EXCLUDE (c_name, c_acctbal) FROM customer",
    "setting_predicate": f"WITH {BLD}, s AS (SELECT bldg_id, coalesce(CASE WHEN bldg_id % 9 > 0 THEN (bldg_id * 61) % 997 END, 0) >= 800 OR bldg_id % 6 < 2 AS u FROM bld) SELECT bldg_id, CASE WHEN u THEN 'urban' ELSE 'rural' END AS setting, CASE WHEN u THEN 'town' ELSE 'grain_mill' END AS score_group FROM s",
    "eligibility_predicate": f"WITH {BLD} SELECT bldg_id, area >= 25 AND bldg_id % 7 <> 0 AND bldg_id % 11 <> 0 AND bldg_id % 5 <> 0 AND bldg_id % 13 <> 0 AS eligible FROM bld",
    "informative_tags": "SELECT p_brand, count(*) AS n, count(DISTINCT p_type) AS kinds FROM part WHERE length(trim(p_type)) BETWEEN 1 AND 40 AND lower(p_type) NOT IN ('yes', 'building') AND NOT regexp_matches(lower(p_type), '^(standard|promo) ') GROUP BY 1",
    "kept_labels": "WITH l AS (SELECT doc_id, ['residential', 'commercial', 'religious', 'institutional'][(doc_id % 4 + 1)::INT] AS label, doc_id % 10 AS conf FROM labels) SELECT * FROM l WHERE conf >= 6 AND label <> 'residential'",
    "tier_and_verdict": """WITH o AS (SELECT o_orderkey, (o_orderkey % 9000)::DOUBLE AS wh, (o_orderkey % 9000)::DOUBLE + 1 AS sim, (1 + o_custkey % 3000)::DOUBLE AS a FROM orders),
r AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN sim BETWEEN a * 0.5 AND a * 2 THEN 1 ELSE greatest(a * 0.5 / sim, sim / (a * 2)) END ELSE greatest(sim / a, a / sim) END AS r FROM o)
SELECT o_orderkey, (CASE WHEN wh >= 8200 THEN 5 WHEN wh >= 3400 THEN 4 WHEN wh >= 1000 THEN 3 WHEN wh >= 200 THEN 2 WHEN wh >= 12 THEN 1 ELSE 0 END)::INT AS tier, CASE WHEN r <= 1.5 THEN 'ok' WHEN r <= 3 THEN 'check' ELSE 'fail' END AS verdict FROM r""",
    "layer_split": "WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'amenity' WHEN p_partkey % 4 = 0 THEN 'shop' WHEN p_partkey % 5 = 0 THEN 'office' END AS poi_key, CASE WHEN p_partkey % 3 = 0 THEN p_brand WHEN p_partkey % 4 = 0 THEN p_brand WHEN p_partkey % 5 = 0 THEN p_type END AS poi_value FROM part) SELECT * FROM p WHERE poi_key IS NOT NULL",
    "evidence_overrides": "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey * 10.0::DOUBLE ELSE round(s_acctbal, 2) END AS value FROM supplier WHERE s_suppkey % 12 <> 0",
    "provenance_types": "SELECT ['survey', 'measured', 'evidence', 'assumption', 'unsourced'][(p_partkey % 5 + 1)::INT] AS provenance, count(*) AS n, sum(p_size)::BIGINT AS total FROM part GROUP BY 1",
    "probability_vectors": """WITH v AS (SELECT doc_id, (doc_id % 3)::DOUBLE AS r, (doc_id % 5)::DOUBLE AS c, (doc_id % 4)::DOUBLE AS g FROM documents), t AS (SELECT *, nullif(r + c + g, 0) AS t FROM v)
SELECT doc_id, r / t AS residential, c / t AS commercial, g / t AS religious, CASE WHEN t IS NOT NULL THEN 0::DOUBLE END AS institutional, CASE WHEN t IS NULL THEN NULL WHEN r >= c AND r >= g THEN 'residential' WHEN c >= g THEN 'commercial' ELSE 'religious' END AS top FROM t""",
    "viability_criteria": f"WITH {BLD}, {_CRIT} SELECT bldg_id, {', '.join(f'round({c}, 8) AS {c}' for c in ('market_access', 'demand_density', 'grid_proximity', 'ability_to_pay', 'agri_context', 'building_size'))}, round(100 * (market_access * 30 + demand_density * 20 + grid_proximity * 15 + ability_to_pay * 15 + building_size * 20) / 100, 6) AS score FROM c",
    "upsert_by_key": "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN upper(n_name) ELSE n_name END AS n_name, CASE WHEN n_regionkey = 1 THEN 'new' ELSE 'old' END AS run FROM nation",
    "insert_or_replace": "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1",
    "distinct_union": "SELECT l_partkey AS id FROM lineitem WHERE l_quantity > 45 UNION SELECT l_suppkey FROM lineitem WHERE l_quantity > 45",
    "id_reconciliation": f"""WITH s AS (SELECT DISTINCT o_custkey AS id, 'orders' AS side FROM orders UNION ALL {' UNION ALL '.join(f"SELECT c_custkey, 's{i}' FROM customer WHERE c_custkey % {i + 5} > 0" for i in range(7))}), k AS (SELECT DISTINCT id FROM s), n AS (SELECT * FROM (VALUES ('orders'), {', '.join(f"('s{i}')" for i in range(7))}) v(side))
SELECT id, string_agg(side, ',' ORDER BY side) AS missing FROM k CROSS JOIN n ANTI JOIN s USING (id, side) GROUP BY 1""",
    "top_categories": "SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 10",
    "top_candidates": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 15",
    "stable_row_ids": "SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS row_id FROM customer",
    "validated_merge": "WITH a AS (SELECT c_custkey AS k, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) SELECT count(*) FILTER (WHERE a.n > 1) AS twice_left, count(*) FILTER (WHERE b.n > 1) AS twice_right, count(*) AS keys FROM a JOIN b USING (k)",
    "value_mix": f"WITH {BLD}, v AS (SELECT * FROM (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY'), ('SHIPYARD')) v(cls)) SELECT cls, count(bldg_id) AS n, coalesce(sum(floors), 0)::BIGINT AS units FROM v LEFT JOIN bld USING (cls) GROUP BY 1",
    "weighted_means": "SELECT l_returnflag, l_linestatus, sum(l_quantity::DOUBLE * floor(l_extendedprice * 100)::BIGINT) / sum(l_quantity::DOUBLE) AS mean, count(*) AS n FROM lineitem GROUP BY ALL",
    "survey_memberships": """WITH c AS (SELECT unnest(['all', 'seg:' || c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN 'urban' ELSE 'rural' END, CASE WHEN c_custkey % 3 = 0 THEN 'poor' ELSE 'rich' END]) AS grp, c_custkey % 4 AS owned, c_custkey % 24 AS hours FROM customer)
SELECT grp, count(*) AS n, avg((owned > 0)::INT) AS share, avg(CASE WHEN owned > 0 THEN owned END) AS mean_number, quantile_cont(hours, 0.25)::DOUBLE AS q25, quantile_cont(hours, 0.5)::DOUBLE AS q50, quantile_cont(hours, 0.75)::DOUBLE AS q75 FROM c GROUP BY 1""",
    "survey_share_scaled": f"WITH {BLD}, s AS (SELECT district, avg((floors > 1)::INT) AS share FROM bld GROUP BY 1) SELECT district, share, least(greatest(share * (0.9::DOUBLE / (SELECT avg((floors > 1)::INT) FROM bld)), 0), 1) AS scaled FROM s",
    "coverage_matrix": "SELECT o_custkey % 7 AS appliance, " + ", ".join(f"count(*) FILTER (WHERE o_orderstatus = '{c}') AS n_{c.lower()}" for c in "FOP") + " FROM orders GROUP BY 1",
    "agreement_stats": "WITH l AS (SELECT l_returnflag, l_quantity::BIGINT AS a, l_partkey % 50 AS b FROM lineitem) SELECT l_returnflag, sum(a - b) / count(*) AS bias, sum(abs(a - b)) / count(*) AS mae, median(abs(a - b))::DOUBLE AS median_error, round(corr(a, b), 8) AS r FROM l GROUP BY 1",
    "national_rollup": f"""WITH {BLD}, b AS (SELECT *, (area * floors)::BIGINT AS gross FROM bld), m AS (SELECT province, cls FROM (SELECT province, cls, row_number() OVER (PARTITION BY province ORDER BY count(*) DESC, cls) AS r FROM b GROUP BY province, cls) WHERE r = 1)
SELECT province, count(*) AS n, sum(area)::BIGINT AS area, sum(gross)::BIGINT AS gross, median(area) AS median_area, round(quantile_cont(area, 0.9), 4) AS p90_area, max(floors)::BIGINT AS top, count(DISTINCT district) AS districts, count(DISTINCT b.cls) AS classes, avg((floors > 1)::INT) AS storeyed, count(*) FILTER (WHERE score < 0) AS in_debt,
min(bldg_id) AS first, arg_max(bldg_id, gross * 1000000000 + bldg_id) AS largest, any_value(m.cls) AS mode FROM b JOIN m USING (province) GROUP BY 1""",
    "combined_matches": """SELECT c_custkey AS bldg_id, CASE WHEN c_custkey % 5 = 0 THEN 'polygon' WHEN c_custkey % 3 = 0 THEN 'point' ELSE 'none' END AS source, CASE WHEN c_custkey % 5 = 0 THEN 'p' || (c_custkey % 7) WHEN c_custkey % 3 = 0 THEN 'q' || (c_custkey % 4) END AS tag,
CASE WHEN c_custkey % 10 = 0 THEN 'n' || (c_custkey % 3) WHEN c_custkey % 3 = 0 THEN 'm' || (c_custkey % 2) END AS name FROM customer""",
    "quantile_bins": "WITH r AS (SELECT floor(o_totalprice * 100)::BIGINT AS v, (o_orderstatus = 'F')::INT AS y, o_orderkey FROM orders), b AS (SELECT v, y, ((row_number() OVER (ORDER BY v, o_orderkey) - 1) * 10 // count(*) OVER ())::INT AS bin FROM r) SELECT bin, count(*) AS n, sum(v) / count(*) AS mean, avg(y) AS rate FROM b GROUP BY 1",
    "hierarchy_fallback": """WITH {BLD}, {FAC}, b AS (SELECT bldg_id, CASE WHEN bldg_id % 4 > 0 THEN floor((lon - 28.8::DOUBLE) * 2) END AS col, floor((lon - 28.8::DOUBLE) * 2) AS pos FROM bld), p AS (SELECT floor((lon - 28.8::DOUBLE) * 2) AS col, min(facility_id) AS parent FROM fac GROUP BY 1), i AS (SELECT b.*, parent FROM b LEFT JOIN p USING (col))
SELECT bldg_id, parent, 'inside' AS how FROM i WHERE parent IS NOT NULL UNION ALL SELECT bldg_id, p.parent, 'nearest' FROM i, p WHERE i.parent IS NULL QUALIFY row_number() OVER (PARTITION BY bldg_id ORDER BY abs(p.col - pos), p.parent) = 1""".replace("{BLD}", BLD).replace("{FAC}", FAC),
}


QUERIES = {name: globals()[name] for name in ORACLE}
