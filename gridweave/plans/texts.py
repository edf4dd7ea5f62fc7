"""Contract queries of labels, cues, claims, evidence, reviews and report bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import first_match
from ..operators import notes, stats
from ..sources import read
from .core import BLD, buildings

_C = ("residential", "commercial", "religious")


def label_export(spark, sf_dir):
    k = F.col("c_custkey")
    probs = [F.lit('{"label": "'), F.element_at(F.array(*map(F.lit, _C)), (k % 3 + 1).cast("int")), F.lit('", "probs": {"residential": '), (k % 5).cast("string"), F.lit(', "commercial": '), (k % 4).cast("string"), F.lit(', "religious": '), (k % 7).cast("string"), F.lit('}, "abstain": '), F.when(k % 6 == 0, "true").otherwise("false"), F.lit("}")]
    answer = F.when(k % 11 == 0, "I can't tell").otherwise(F.concat(*probs))
    runs = read(spark, sf_dir, "customer").select((k % 400).alias("bldg_id"), F.lit("m").alias("labeler"), k.alias("created"), answer.alias("answer"), (k % 13 == 0).alias("refused"))
    return notes.parsed_labels(runs, ["bldg_id", "labeler"], "answer", F.col("refused"), "created")


def label_evaluation(spark, sf_dir):
    """Accuracy of each labeller by group and its price, and the cheapest one near the best."""
    k = F.col("doc_id")
    gold = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("gold"))
    l = gold.select("doc_id", "gold", F.explode(F.array(*(F.struct(F.lit(f"m{i}").alias("labeler"), F.lit(c).alias("price"), F.when(k % i == 0, 1 - F.col("gold")).otherwise(F.col("gold")).alias("guess")) for i, c in ((3, 10), (5, 30), (6, 35), (7, 90))))).alias("x")).select("doc_id", "gold", "x.*")
    by = l.groupBy("labeler").agg(F.avg((F.col("gold") == F.col("guess")).cast("int")).alias("accuracy"), F.max("price").alias("price"), F.count(F.lit(1)).alias("n"))
    return notes.cheapest_within(by, "accuracy", "price", "labeler", 0.05)


def neighbourhood_cues(spark, sf_dir):
    """How usual a building is within its cell: the spread of sizes, its robust z, its share of larger neighbours, an alignment."""
    b = buildings(spark, sf_dir).select("bldg_id", (F.floor((F.col("lon") - 28.8) * 2) * 100 + F.floor((F.col("lat") + 2.85) * 2)).alias("cell"), "area", (F.col("bldg_id") * 37 % 180).alias("angle"))
    z = notes.robust_z(b.withColumn("size", F.ln("area")), "cell", "size")
    by = b.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.stddev("area").alias("sd"), F.avg("area").alias("mean"), F.count_if(F.abs((F.col("angle") + 45) % 90 - 45) <= 15).alias("aligned"))
    cv = F.col("sd") / F.col("mean")
    told = first_match([(cv < 0.5, "uniform"), (cv < 1.0, "mixed"), (cv.isNotNull(), "very mixed")])
    out = z.join(by, "cell").where("n >= 5")
    return out.select("bldg_id", "n", told.alias("sizes"), F.round(cv, 7).alias("cv"), F.round("z", 7).alias("z"), (F.col("aligned") / F.col("n")).alias("aligned"), F.coalesce(F.abs("z") >= 2, F.lit(False)).alias("unusual"))


def place_cues(spark, sf_dir):
    """Land use, the size against the cell's median, and the tags of the cell, most frequent first, as one line each."""
    b = buildings(spark, sf_dir).select("bldg_id", F.floor((F.col("lon") - 28.8) * 2).alias("cell"), "area", "cls")
    tags = b.groupBy("cell", "cls").agg(F.count(F.lit(1)).alias("n"))
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "cls"))), lambda x: F.concat(x["cls"], F.lit(" x"), (-x["m"]).cast("string"))), ", ")
    by = b.groupBy("cell").agg(F.median("area").alias("mid")).join(tags.groupBy("cell").agg(line.alias("tags")), "cell")  # few classes a cell
    size = first_match([(F.col("area") >= 2 * F.col("mid"), "much larger"), (F.col("area") > F.col("mid"), "larger")], F.lit("not larger"))
    return b.join(by, "cell").select("bldg_id", F.concat(F.lit("size: "), size, F.lit("; tags nearby: "), "tags").alias("cue"))


def web_claims(spark, sf_dir):
    """Bullets with digits in whole texts, and the address each names."""
    d = read(spark, sf_dir, "documents")
    text = F.concat(F.col("text"), F.lit("\n- kept "), F.col("doc_id").cast("string"), F.lit(" units, see data"), (F.col("doc_id") % 9).cast("string"), F.lit(".org\n* no figures\n* 7 of "), F.col("lang"))
    return notes.bullet_claims(d.select("doc_id", text.alias("t")), "doc_id", "t").select("doc_id", "claim", "source")


def claim_rows(spark, sf_dir):
    """Claims by page with their index; rows that name an index take the claim's quote and page, others have none."""
    conv = read(spark, sf_dir, "conversations")
    claims = conv.groupBy("conv_id").agg(F.array_sort(F.collect_set("turn")).alias("turns")).select("conv_id", F.posexplode("turns").alias("claim", "page"))
    rows = conv.select("conv_id", (F.col("turn") % 3).alias("claim")).distinct()
    return rows.join(claims, ["conv_id", "claim"], "left").select("conv_id", "claim", "page")


def token_estimate(spark, sf_dir):
    """A dry run's tokens and costs from lengths, by source."""
    d = read(spark, sf_dir, "documents").select("source", F.ceil(F.length(F.coalesce("text", F.lit(""))) / 4).alias("t"))
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("calls"), F.sum("t").alias("tokens"), (F.sum("t") * 3 + F.count(F.lit(1)) * 150).alias("micro_usd"))


def statistics_tables(spark, sf_dir):
    """Numbers of a label's last line in a text, '-' as null, as a tidy table."""
    k = F.col("p_partkey")
    text = F.concat(F.lit("Homes 1 2 3\nShops - 5\nHomes "), (k % 100).cast("string"), F.lit(" - "), F.col("p_size").cast("string"), F.lit("\nTotal 9"))
    last = F.element_at(F.regexp_extract_all(text, F.lit(r"(?m)^Homes (.*)$"), F.lit(1)), -1)
    p = read(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split(last, " ")).alias("place", "raw"))
    return p.select("p_partkey", "place", F.when(F.col("raw") != "-", F.col("raw").cast("int")).alias("value"))


def anchor_totals(spark, sf_dir):
    """Regional anchors against the national one: the gap, and whether it is within a hundredth."""
    b = buildings(spark, sf_dir).groupBy("province").agg(F.sum("area").alias("part"))
    t = b.agg(F.sum("part").alias("parts"))
    n = buildings(spark, sf_dir).agg((F.sum("area") + F.max("floors")).cast("long").alias("nation"))
    return t.join(F.broadcast(n)).select("parts", "nation", ((F.col("parts") - F.col("nation")) / F.col("nation")).alias("gap"), (F.abs((F.col("parts") - F.col("nation")) / F.col("nation")) <= 0.01).alias("ok"))  # one row each


def survey_priors(spark, sf_dir):
    """Indicators to shares with ids and flags: only known ones, and small samples are flagged."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") % 6).alias("ind"), (F.col("s_suppkey") * 7 % 101).alias("pct"), (F.col("s_suppkey") * 13 % 60).alias("n"))
    return s.withColumn("name", F.expr("try_element_at(map(0, 'electric', 1, 'radio', 2, 'tv', 3, 'fridge'), CAST(ind AS INT))")).where("name IS NOT NULL").select(F.concat(F.lit("dhs-"), "name", F.lit("-"), F.col("s_suppkey").cast("string")).alias("id"), "name", (F.col("pct") / 100).alias("share"), F.when(F.col("n") < 25, "small").otherwise("").alias("flag"))


def evidence_union(spark, sf_dir):
    """Three origins as one table; a dotted parameter becomes family, appliance and population."""
    p = read(spark, sf_dir, "part").select(F.lit("survey").alias("origin"), F.concat_ws(".", F.concat(F.lit("f"), (F.col("p_partkey") % 3).cast("string")), F.lit("tv"), F.lit("all.urban")).alias("parameter"), F.col("p_size").cast("double").alias("value"))
    s = read(spark, sf_dir, "supplier").select(F.lit("web").alias("origin"), F.concat(F.lit("f"), (F.col("s_suppkey") % 4).cast("string"), F.lit(".radio")).alias("parameter"), F.col("s_nationkey").cast("double").alias("value"))
    n = read(spark, sf_dir, "nation").select(F.lit("curated").alias("origin"), F.lit("f1.fridge.rural").alias("parameter"), F.col("n_regionkey").cast("double").alias("value"))
    parts = F.split("parameter", r"\.", 3)
    out = p.unionByName(s).unionByName(n).select("origin", "value", parts[0].alias("family"), F.get(parts, F.lit(1)).alias("appliance"), F.get(parts, F.lit(2)).alias("population")).where("family IN ('f0', 'f1')")
    return out.groupBy("origin", "family", "appliance", "population").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def review_sheet(spark, sf_dir):
    """Quotes of at most 300 characters with blank decision columns, in the order of review."""
    d = read(spark, sf_dir, "documents").where("source IN ('src1', 'src2')")
    return d.select("doc_id", "lang", F.substring(F.col("text"), F.lit(1), F.lit(300)).alias("quote"), F.lit("").alias("decision"), F.lit("").alias("note")).orderBy("lang", "doc_id")


def kept_overrides(spark, sf_dir):
    """Flagged ids unless overridden; overrides of an (id, check) pair outlive a new run."""
    k = F.col("o_orderkey")
    flags = read(spark, sf_dir, "orders").select(k.alias("id"), F.explode(F.array_compact(F.array(F.when(k % 5 == 0, "range"), F.when(k % 7 == 0, "unit")))).alias("check"))
    old = read(spark, sf_dir, "orders").where("o_orderkey % 10 = 0").select(k.alias("id"), F.lit("range").alias("check"), F.lit("accepted").alias("override"))
    out = flags.join(old, ["id", "check"], "left").select("id", "check", F.coalesce("override", F.lit("")).alias("override"))
    return out.groupBy("check", "override").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(F.col("override") == "", F.col("id"))).alias("flagged"))


def area_summary(spark, sf_dir):
    """Establishments by area: what districts report against what buildings sum to, by source."""
    b = buildings(spark, sf_dir).select("district", (F.col("bldg_id") % 3).alias("src"), F.col("floors").cast("long").alias("units"))
    own = b.groupBy("district").agg(F.sum("units").alias("summed"), *(F.sum(F.when(F.col("src") == i, F.col("units")).otherwise(0)).alias(f"src{i}") for i in range(3)))
    told = b.select("district").distinct().select("district", (F.length("district") * 10).cast("long").alias("reported"))
    return own.join(told, "district").select("*", (F.col("summed") - F.col("reported")).alias("gap"))


def evidence_index(spark, sf_dir):
    """Every cited id resolved by its prefix to a quote, a survey or a measurement."""
    k = F.col("c_custkey")
    docs = read(spark, sf_dir, "customer").select(k.alias("id"), F.array(F.concat(F.lit("ev-"), (k % 30).cast("string")), F.concat(F.lit("sv-"), (k % 8).cast("string")), F.concat(F.lit("xx-"), (k % 2).cast("string"))).alias("ids"))
    origins = {"ev-": read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("value")), "sv-": read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("value"))}
    return notes.cited(docs, "id", "ids", origins, "key", "value")


def constraint_bundle(spark, sf_dir):
    """A validation report: sums of targets, the greatest shift, share at the cap and the band, one row by province."""
    b = buildings(spark, sf_dir)
    return b.groupBy("province").agg(F.sum("need").alias("target"), F.max(F.abs(F.col("floors") * 10 - F.col("area"))).cast("long").alias("max_shift"), (F.count_if(F.col("floors") == 4) / F.count(F.lit(1))).alias("at_cap"), F.percentile("area", F.array(F.lit(0.0), F.lit(1.0)))[0].alias("low"), F.percentile("area", F.array(F.lit(0.0), F.lit(1.0)))[1].alias("high"))


def meta_bundle(spark, sf_dir):
    """What a site's meta document holds, as one JSON text with sorted keys."""
    b = buildings(spark, sf_dir).agg(F.count(F.lit(1)).alias("buildings"), F.count_distinct("district").alias("districts"))
    return b.select(F.to_json(F.struct("buildings", "districts", F.lit("v1").alias("version"))).alias("meta"))


def shard_details(spark, sf_dir):
    """Details sharded by cell: one JSON line a building, nulls kept, with the shard's size."""
    b = buildings(spark, sf_dir).select((F.col("bldg_id") % 16).alias("shard"), F.to_json(F.struct("bldg_id", F.when(F.col("bldg_id") % 3 == 0, F.col("area")).alias("area")), {"ignoreNullFields": "false"}).alias("line"))
    return b.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("line")).alias("chars"))


def profile_checks(spark, sf_dir):
    """Profiles against tiers and anchors, with the mix by the share of upper homes."""
    from ..operators import shaping

    b = buildings(spark, sf_dir).select((F.col("bldg_id") % 6).alias("profile"), (F.col("area") * F.col("floors") * 4).cast("double").alias("wh"), (F.col("score") > 5000).cast("int").alias("upper"))
    by = b.groupBy("profile").agg((F.sum("wh") / F.count(F.lit(1))).alias("wh"), F.avg("upper").alias("upper"))
    none = F.lit(None).cast("double")
    return by.select("profile", "wh", "upper", shaping.tier(F.col("wh"), {1: 12, 2: 200, 3: 1000, 4: 3400, 5: 8200}).alias("tier"), shaping.verdict(F.col("wh"), 300 + F.col("profile") * 100.0, none, none).alias("verdict"))


def derived_profiles(spark, sf_dir):
    """Profiles scaled from a base one, with the factor told."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("profile_id"), (F.col("p_size") * 1.0).alias("kwh"))
    return p.unionAll(p.where("profile_id % 5 = 0").select((F.col("profile_id") + 10_000_000).alias("profile_id"), (F.col("kwh") * 0.5).alias("kwh")))


def archetype_violations(spark, sf_dir):
    """Contract checks of archetypes: windows as long as the use, shares in 0..1, every value sourced, an upper bound of energy."""
    k = F.col("p_partkey")
    a = read(spark, sf_dir, "part").select("p_partkey", (k % 30 * 20).alias("func"), (k % 50 * 10).alias("window"), (k % 120 / 100).alias("share"), F.when(k % 9 > 0, "s").alias("source"), (F.col("p_size") * 10).alias("watt"))
    return a.agg(F.count_if(F.col("func") > F.col("window")).alias("short_windows"), F.count_if(~F.col("share").between(0, 1)).alias("bad_shares"), F.count_if(F.col("source").isNull()).alias("unsourced"), F.max(F.col("watt") * F.least("func", "window")).alias("most_wh_minutes"))


def sampled_strata(spark, sf_dir):
    """A quarter tagged, the rest by terciles of size, each stratum by a seeded hash; a gold part nested in it."""
    from ..operators import picks

    b = picks.terciles(buildings(spark, sf_dir), "province", "area", "bldg_id")
    s = b.select("bldg_id", F.concat_ws("/", F.when(F.col("bldg_id") % 4 == 0, "tagged").otherwise("plain"), F.col("third").cast("string")).alias("stratum"), F.sha2(F.concat(F.col("bldg_id").cast("string"), F.lit(":7")), 256).alias("h"))
    ranked = picks.running(s.withColumn("v", F.conv(F.substring("h", 1, 12), 16, 10).cast("long")), "stratum", "v", F.lit(1), "bldg_id", falling=False)
    quota = F.when(F.col("stratum").startswith("tagged"), 5).otherwise(15)
    return ranked.where(F.col("_before") < quota).select("bldg_id", "stratum", (F.col("_before") < 2).alias("gold"))


def label_coverage(spark, sf_dir):
    """Entropy of labels by source, as the share of its greatest value."""
    out = stats.entropy(read(spark, sf_dir, "documents"), "source", "lang")
    return out.select("source", "n", "k", F.round("entropy", 8).alias("entropy"))


_GOLD = "gold AS (SELECT doc_id, max(quality) AS gold FROM labels GROUP BY 1)"
_ACC = " UNION ALL ".join(f"SELECT 'm{i}' AS labeler, {c} AS price, avg((doc_id % {i} <> 0)::INT) AS accuracy FROM gold" for i, c in ((3, 10), (5, 30), (6, 35), (7, 90)))
ORACLE = {
    "label_export": """WITH r AS (SELECT c_custkey AS k, c_custkey % 400 AS bldg_id, c_custkey % 11 = 0 OR c_custkey % 13 = 0 AS bad, ['residential', 'commercial', 'religious'][(c_custkey % 3 + 1)::INT] AS label, c_custkey % 5 AS a, c_custkey % 4 AS b, c_custkey % 7 AS c FROM customer QUALIFY row_number() OVER (PARTITION BY c_custkey % 400 ORDER BY c_custkey DESC) = 1)
SELECT bldg_id, 'm' AS labeler, CASE WHEN bad THEN 'unknown' ELSE label END AS label, CASE WHEN NOT bad THEN least(1, (CASE label WHEN 'residential' THEN a WHEN 'commercial' THEN b ELSE c END)::DOUBLE / (CASE WHEN a + b + c = 0 THEN 1 ELSE a + b + c END)) END AS confidence, bad OR k % 6 = 0 AS abstain FROM r""",
    "label_evaluation": f"WITH {_GOLD}, s AS ({_ACC}) SELECT labeler, price, accuracy FROM s WHERE accuracy >= (SELECT max(accuracy) FROM s) - 0.05::DOUBLE ORDER BY price, accuracy DESC, labeler LIMIT 1",
    "neighbourhood_cues": f"""WITH {BLD}, b AS (SELECT bldg_id, floor((lon - 28.8::DOUBLE) * 2) * 100 + floor((lat + 2.85::DOUBLE) * 2) AS cell, area, ln(area) AS size, bldg_id * 37 % 180 AS angle FROM bld), m AS (SELECT *, median(size) OVER (PARTITION BY cell) AS mid FROM b),
d AS (SELECT *, median(abs(size - mid)) OVER (PARTITION BY cell) * 1.4826::DOUBLE AS mad, count(*) OVER w AS n, stddev(area) OVER w / avg(area) OVER w AS cv, count(*) FILTER (WHERE abs((angle + 45) % 90 - 45) <= 15) OVER w AS al FROM m WINDOW w AS (PARTITION BY cell)), z AS (SELECT *, CASE WHEN mad > 0 THEN (size - mid) / mad END AS z FROM d WHERE n >= 5)
SELECT bldg_id, n, CASE WHEN cv < 0.5 THEN 'uniform' WHEN cv < 1 THEN 'mixed' ELSE 'very mixed' END AS sizes, round(cv, 7) AS cv, round(z, 7) AS z, al / n AS aligned, coalesce(abs(z) >= 2, false) AS unusual FROM z""",
    "place_cues": f"""WITH {BLD}, b AS (SELECT bldg_id, floor((lon - 28.8::DOUBLE) * 2) AS cell, area, cls FROM bld), t AS (SELECT cell, string_agg(cls || ' x' || n, ', ' ORDER BY n DESC, cls) AS tags FROM (SELECT cell, cls, count(*) AS n FROM b GROUP BY ALL) GROUP BY 1), m AS (SELECT cell, median(area) AS mid FROM b GROUP BY 1)
SELECT bldg_id, 'size: ' || CASE WHEN area >= 2 * mid THEN 'much larger' WHEN area > mid THEN 'larger' ELSE 'not larger' END || '; tags nearby: ' || tags AS cue FROM b JOIN t USING (cell) JOIN m USING (cell)""",
    "web_claims": r"""WITH l AS (SELECT doc_id, trim(unnest(regexp_split_to_array(text || chr(10) || '- kept ' || doc_id || ' units, see data' || (doc_id % 9) || '.org' || chr(10) || '* no figures' || chr(10) || '* 7 of ' || lang, '\r?\n'))) AS line FROM documents),
c AS (SELECT doc_id, line, regexp_extract(line, '(?i)https?://[^\s)\]]+|\b[a-z0-9-]+(?:\.[a-z0-9-]+)*\.(?:org|com|net|int|edu|gov)\b') AS url FROM l WHERE regexp_matches(line, '^[-*] ') AND regexp_matches(line, '[0-9]')) SELECT doc_id, trim(line[3:]) AS claim, CASE WHEN url = '' THEN 'unnamed' ELSE url END AS source FROM c""",
    "claim_rows": "WITH c AS (SELECT conv_id, turn AS page, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS claim FROM (SELECT DISTINCT conv_id, turn FROM conversations)), r AS (SELECT DISTINCT conv_id, turn % 3 AS claim FROM conversations) SELECT conv_id, claim, page FROM r LEFT JOIN c USING (conv_id, claim)",
    "token_estimate": "SELECT source, count(*) AS calls, sum(ceil(length(coalesce(text, '')) / 4))::BIGINT AS tokens, (sum(ceil(length(coalesce(text, '')) / 4)) * 3 + count(*) * 150)::BIGINT AS micro_usd FROM documents GROUP BY 1",
    "statistics_tables": "SELECT p_partkey, 0 AS place, (p_partkey % 100)::INT AS value FROM part UNION ALL SELECT p_partkey, 1, NULL FROM part UNION ALL SELECT p_partkey, 2, p_size::INT FROM part",
    "anchor_totals": f"WITH {BLD}, t AS (SELECT sum(area)::BIGINT AS parts, (sum(area) + max(floors))::BIGINT AS nation FROM bld) SELECT parts, nation, (parts - nation) / nation AS gap, abs((parts - nation) / nation) <= 0.01::DOUBLE AS ok FROM t",
    "survey_priors": "WITH s AS (SELECT s_suppkey, ['electric', 'radio', 'tv', 'fridge'][(s_nationkey % 6 + 1)::INT] AS name FROM supplier) SELECT 'dhs-' || name || '-' || s_suppkey AS id, name, (s_suppkey * 7 % 101) / 100 AS share, CASE WHEN s_suppkey * 13 % 60 < 25 THEN 'small' ELSE '' END AS flag FROM s WHERE name IS NOT NULL",
    "evidence_union": """WITH u AS (SELECT 'survey' AS origin, 'f' || (p_partkey % 3) AS family, 'tv' AS appliance, 'all.urban' AS population, p_size::DOUBLE AS value FROM part UNION ALL SELECT 'web', 'f' || (s_suppkey % 4), 'radio', NULL, s_nationkey FROM supplier UNION ALL SELECT 'curated', 'f1', 'fridge', 'rural', n_regionkey FROM nation)
SELECT origin, family, appliance, population, count(*) AS n, sum(value) AS total FROM u WHERE family IN ('f0', 'f1') GROUP BY ALL""",
    "review_sheet": "SELECT doc_id, lang, left(text, 300) AS quote, '' AS decision, '' AS note FROM documents WHERE source IN ('src1', 'src2') ORDER BY lang, doc_id",
    "kept_overrides": """WITH f AS (SELECT o_orderkey AS id, 'range' AS "check", CASE WHEN o_orderkey % 10 = 0 THEN 'accepted' ELSE '' END AS override FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT o_orderkey, 'unit', '' FROM orders WHERE o_orderkey % 7 = 0)
SELECT "check", override, count(*) AS n, count(DISTINCT CASE WHEN override = '' THEN id END) AS flagged FROM f GROUP BY ALL""",
    "area_summary": f"WITH {BLD} SELECT district, sum(floors)::BIGINT AS summed, {', '.join(f'coalesce(sum(floors) FILTER (WHERE bldg_id % 3 = {i}), 0)::BIGINT AS src{i}' for i in range(3))}, (length(district) * 10)::BIGINT AS reported, (sum(floors) - length(district) * 10)::BIGINT AS gap FROM bld GROUP BY district",
    "evidence_index": """WITH r AS (SELECT DISTINCT c_custkey AS id, unnest(['ev-' || (c_custkey % 30), 'sv-' || (c_custkey % 8), 'xx-' || (c_custkey % 2)]) AS ref FROM customer), o AS (SELECT 'ev-' || n_nationkey AS ref, 'ev-' AS origin, n_name AS value FROM nation UNION ALL SELECT 'sv-' || r_regionkey, 'sv-', r_name FROM region)
SELECT id, ref, origin, value FROM r LEFT JOIN o USING (ref)""",
    "constraint_bundle": f"WITH {BLD} SELECT province, sum(need)::BIGINT AS target, max(abs(floors * 10 - area))::BIGINT AS max_shift, count(*) FILTER (WHERE floors = 4) / count(*) AS at_cap, min(area)::DOUBLE AS low, max(area)::DOUBLE AS high FROM bld GROUP BY 1",
    "meta_bundle": f"""WITH {BLD} SELECT '{{"buildings":' || count(*) || ',"districts":' || count(DISTINCT district) || ',"version":"v1"}}' AS meta FROM bld""",
    "shard_details": f"""WITH {BLD} SELECT bldg_id % 16 AS shard, count(*) AS n, sum(length('{{"bldg_id":' || bldg_id || ',"area":' || CASE WHEN bldg_id % 3 = 0 THEN area::VARCHAR ELSE 'null' END || '}}'))::BIGINT AS chars FROM bld GROUP BY 1""",
    "profile_checks": f"""WITH {BLD}, p AS (SELECT bldg_id % 6 AS profile, sum(area * floors * 4) / count(*) AS wh, avg((score > 5000)::INT) AS upper FROM bld GROUP BY 1), r AS (SELECT *, greatest(wh / (300 + profile * 100), (300 + profile * 100) / wh) AS r FROM p)
SELECT profile, wh, upper, (CASE WHEN wh >= 8200 THEN 5 WHEN wh >= 3400 THEN 4 WHEN wh >= 1000 THEN 3 WHEN wh >= 200 THEN 2 WHEN wh >= 12 THEN 1 ELSE 0 END)::INT AS tier, CASE WHEN r <= 1.5 THEN 'ok' WHEN r <= 3 THEN 'check' ELSE 'fail' END AS verdict FROM r""",
    "derived_profiles": "SELECT p_partkey AS profile_id, p_size * 1.0::DOUBLE AS kwh FROM part UNION ALL SELECT p_partkey + 10000000, p_size * 0.5::DOUBLE FROM part WHERE p_partkey % 5 = 0",
    "archetype_violations": "SELECT count(*) FILTER (WHERE p_partkey % 30 * 20 > p_partkey % 50 * 10) AS short_windows, count(*) FILTER (WHERE p_partkey % 120 > 100) AS bad_shares, count(*) FILTER (WHERE p_partkey % 9 = 0) AS unsourced, max(p_size * 10 * least(p_partkey % 30 * 20, p_partkey % 50 * 10))::BIGINT AS most_wh_minutes FROM part",
    "sampled_strata": f"""WITH {BLD}, r AS (SELECT bldg_id, row_number() OVER (PARTITION BY province ORDER BY area, bldg_id) AS r, count(*) OVER (PARTITION BY province) AS n FROM bld),
s AS (SELECT bldg_id, CASE WHEN bldg_id % 4 = 0 THEN 'tagged' ELSE 'plain' END || '/' || CASE WHEN 3 * (r - 1) <= n - 1 THEN 0 WHEN 3 * (r - 1) <= 2 * (n - 1) THEN 1 ELSE 2 END AS stratum, left(sha256(bldg_id || ':7'), 12) AS h FROM r), k AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, bldg_id) - 1 AS k FROM s)
SELECT bldg_id, stratum, k < 2 AS gold FROM k WHERE k < CASE WHEN starts_with(stratum, 'tagged') THEN 5 ELSE 15 END""",
    "label_coverage": "WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL), t AS (SELECT source, sum(n)::BIGINT AS n, count(*) AS k, sum(n * ln(n)) AS s FROM c GROUP BY 1) SELECT source, n, k, round(CASE WHEN k > 1 THEN (ln(n) - s / n) / ln(k) ELSE 0 END, 8) AS entropy FROM t",
}
QUERIES = {name: globals()[name] for name in ORACLE}
