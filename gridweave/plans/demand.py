"""Contract queries of load characteristics, profile weights, back-casts and training tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import first_match
from ..operators import demand, picks
from ..sources import read
from .core import BLD, buildings
from .flagship import PROFILES, watts

YEARS, BASE, AHEAD, SEEN = list(range(2016, 2024)), 2023, [2024, 2025, 2026], 60
RATE = 0.031  # yearly growth of households that a census tells
HOURS = range(24)


def load_characteristics(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % PROFILES).alias("p"), F.col("l_quantity").cast("double").alias("u"))
    curve = {"a": lambda h: watts(F.col("p"), h), "d": lambda h: watts(F.col("p"), h) + F.col("p") % 5, "e": lambda h: watts(F.col("p"), h) + h % 7}
    sums = [F.sum(F.col("u") * f(h)).alias(f"{n}{h}") for n, f in curve.items() for h in HOURS]
    low = F.sum(F.col("u") * (5 + F.col("p"))).alias("annual_p10"), F.sum(F.col("u") * (50 + F.col("p"))).alias("annual_p90")
    df = li.groupBy(F.col("l_orderkey").alias("bldg_id")).agg(*sums, *low)
    return demand.characteristics(df, ["bldg_id", "annual_p10", "annual_p90"], "a", "d", "e")


def minute_load_summary(spark, sf_dir):
    """Daily and hourly energy of a minute load, the weekend's part, and the peak of the sum over all units."""
    e = read(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("unit"), "ts", F.floor(F.col("value") * 100).cast("long").alias("v"))
    day = e.groupBy("unit", F.to_date("ts").alias("day")).agg(F.sum("v").alias("kwh"))
    daily = day.groupBy("unit").agg(F.count(F.lit(1)).alias("days"), F.round(F.percentile("kwh", F.lit(0.1)), 4).alias("p10"), F.round(F.percentile("kwh", F.lit(0.9)), 4).alias("p90"), F.sum("kwh").alias("total"))
    off = e.groupBy("unit").agg(F.sum(F.when(F.weekday("ts") >= 5, F.col("v")).otherwise(0)).alias("weekend"), *(F.sum(F.when(F.hour("ts") == h, F.col("v")).otherwise(0)).alias(f"h{h:02d}") for h in (0, 8, 19)))
    peak = e.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.sum("v").alias("all")).agg(F.max("all").alias("coincident_peak"))
    return daily.join(off, "unit").join(F.broadcast(peak))  # one row


def weighted_metrics(spark, sf_dir):
    p = read(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_linestatus") == "O").cast("int").alias("y"), ((F.col("l_partkey") % 97 + 1) / 99).alias("g"), F.col("l_quantity").alias("w"))
    out = demand.regression_metrics(p, "l_returnflag", F.col("y"), F.col("g"), F.col("w"))
    return out.select("l_returnflag", *(F.round(c, 7).alias(c) for c in ("logloss", "brier", "mae", "r2")))


def _presence(k, y):
    return (k * 7 + y * 13) % 100


def _stock(spark, sf_dir):
    b = buildings(spark, sf_dir)
    k = F.col("bldg_id")
    first = first_match([(_presence(k, y) >= SEEN, y) for y in YEARS], F.lit(None).cast("int"))
    pot = (F.col("area") * F.col("floors")).cast("long")
    return b.select("bldg_id", "district", "province", first.cast("int").alias("first_y"), pot.alias("potential"), *((pot * (50 + (k + y) % 50)).alias(f"e{y}") for y in YEARS))


def first_detected_year(spark, sf_dir):
    return _stock(spark, sf_dir).select("bldg_id", "first_y")


def _cast(spark, sf_dir, area="district"):
    return demand.back_cast(_stock(spark, sf_dir), area, BASE, YEARS, AHEAD, RATE)


def backcast_by_year(spark, sf_dir):
    out = _cast(spark, sf_dir)
    return out.select("district", "year", "kind", *(F.round(c, 4).alias(c) for c in ("potential", "expected")), *(F.round(c, 7).alias(c) for c in ("stock_index", "growth_rate", "presence_weight")))


def sector_year_series(spark, sf_dir):
    """National and provincial totals by year: the districts' back-casts summed."""
    home = buildings(spark, sf_dir).select("district", "province").distinct()
    out = _cast(spark, sf_dir).join(home, "district")
    return out.groupBy("province", "year").agg(F.round(F.sum("potential"), 3).alias("potential"), F.round(F.sum("expected"), 3).alias("expected"), F.count(F.lit(1)).alias("districts"))


RULES = {
    "residential": [("area < 60 AND floors = 1", {"house_low": 1.0}), ("floors >= 3", {"house_high": 2.0, "lift": 0.5}), ("true", {"house_mid": 1.0})],
    "commercial": [("cls = 'BUILDING'", {"shop": 1.0, "sign": 0.25}), ("true", {"shop": 1.0})],
    "mixed": [("floors >= 2", {"@commercial": 1.0, "@residential": 2.0}), ("true", {"@commercial": 0.5, "@residential": 1.0, "shop": 0.25})],
    "institutional": [("area >= 150", {"school": 1.0, "@mixed": 0.5})],
}


def class_profile_weights(spark, sf_dir):
    """Additive weights: probabilities of classes times their contextual rules, whose references are expanded."""
    k = F.col("bldg_id")
    probs = {"residential": (k % 8).cast("double"), "commercial": (k % 4).cast("double"), "mixed": (k % 3).cast("double"), "institutional": (k % 2).cast("double")}
    rules = {c: [(F.expr(t), p) for t, p in rs] for c, rs in RULES.items()}
    out = demand.profile_weights(buildings(spark, sf_dir), "bldg_id", probs, rules)
    return out.withColumn("weight", F.round("weight", 9))


def storey_grid_holdout(spark, sf_dir):
    """The storey height with the least mean of per-level errors on even ids, and its error on odd ids."""
    k = F.col("bldg_id")
    b = buildings(spark, sf_dir).select((k % 2).alias("half"), F.col("floors").cast("long").alias("level"), (F.col("floors") * 300 + (k * 17) % 100).alias("cm"))
    seen = b.groupBy("half", "level", "cm").agg(F.count(F.lit(1)).alias("n"))  # heights are few, rows are many
    grid = spark.range(240, 420, 5).select(F.col("id").alias("s"))
    miss = F.abs(F.greatest(F.lit(1), F.floor((2 * F.col("cm") + F.col("s")) / (2 * F.col("s")))) - F.col("level"))
    level = seen.join(F.broadcast(grid)).groupBy("half", "s", "level").agg(F.sum(miss * F.col("n")).alias("e"), F.sum("n").alias("n"))  # 36 heights
    score = level.groupBy("half", "s").agg(F.round(F.avg(F.col("e") / F.col("n")), 9).alias("mae"))
    best = score.where("half = 0").agg(F.min_by("s", F.struct("mae", "s")).alias("s"), F.min("mae").alias("fit_mae"))
    return best.join(score.where("half = 1").select("s", F.col("mae").alias("test_mae")), "s", "left").select(F.col("s").alias("storey_cm"), "fit_mae", "test_mae")


def floor_two_cuts(spark, sf_dir):
    """Two cut-points between one, two and more floors by balanced accuracy, the upper one above the lower; and floors."""
    k = F.col("bldg_id")
    b = buildings(spark, sf_dir).select((F.col("floors") * 3 + (k * 17) % 5).alias("h"), F.least(F.col("floors"), F.lit(3)).alias("c"))
    seen = b.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"))
    cuts = spark.range(3, 16).select(F.col("id").alias("t12"))
    grid = cuts.join(F.broadcast(cuts.select(F.col("t12").alias("t23"))), F.col("t23") > F.col("t12"))  # 13 values
    guess = F.when(F.col("h") < F.col("t12"), 1).when(F.col("h") < F.col("t23"), 2).otherwise(3)
    tried = seen.join(F.broadcast(grid)).groupBy("t12", "t23", "c").agg((F.sum(F.when(guess == F.col("c"), F.col("n")).otherwise(0)) / F.sum("n")).alias("hit"))
    score = tried.groupBy("t12", "t23").agg(F.round(F.avg("hit"), 9).alias("score"))
    return score.orderBy(F.desc("score"), "t12", "t23").limit(1)


def building_features(spark, sf_dir):
    """A feature table: own attributes, what the cell and the wider cell hold, and ranks within the district.

    Counts, medians and shares of a cell are grouped and joined, so no cell is sorted in one task; ranks come from pieces.
    """
    b = buildings(spark, sf_dir).select("bldg_id", "district", "cls", "area", "floors", F.floor((F.col("lon") - 28.8) * 20).alias("x"), F.floor((F.col("lat") + 2.85) * 20).alias("y"))
    b = b.withColumn("gross", F.col("area") * F.col("floors"))
    near = b.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n_cell"), F.median("area").alias("median_cell"), F.max("floors").alias("top_cell"), F.avg((F.col("cls") == "BUILDING").cast("int")).alias("share_cell"))
    far = b.groupBy(F.floor(F.col("x") / 4).alias("wx"), F.floor(F.col("y") / 4).alias("wy")).agg(F.count(F.lit(1)).alias("n_wide"), F.sum("gross").alias("gross_wide"), F.count_distinct("cls").alias("classes_wide"))
    out = b.join(near, ["x", "y"]).join(far, (F.floor(F.col("x") / 4) == F.col("wx")) & (F.floor(F.col("y") / 4) == F.col("wy")))
    ties = b.groupBy("district", "area").agg(F.count(F.lit(1)).alias("same"))
    run = picks.running(ties, "district", "area", F.col("same"), "area", falling=False)
    dense = picks.running(ties, "district", "area", F.lit(1), "area", falling=False).select("district", "area", (F.col("_before") + 1).cast("int").alias("dense"))
    rank = run.select("district", "area", (F.col("_before") + 1).cast("int").alias("rank"), F.when(F.col("_total") > 1, F.col("_before") / (F.col("_total") - 1)).otherwise(0.0).alias("pct"))
    out = out.join(rank, ["district", "area"]).join(dense, ["district", "area"])
    shape = [F.ln("area").alias("ln_area"), F.col("floors").cast("long").alias("floors"), F.col("gross").cast("long").alias("gross"), (F.col("area") / F.col("median_cell")).alias("rel_area"), (F.col("n_cell") / F.col("n_wide")).alias("density_ratio")]
    return out.select("bldg_id", *(F.round(c, 9).alias(n) if n in ("ln_area", "rel_area", "density_ratio") else c.alias(n) for c, n in zip(shape, ("ln_area", "floors", "gross", "rel_area", "density_ratio"), strict=True)), "n_cell", "median_cell", F.col("top_cell").cast("long").alias("top_cell"), F.round("share_cell", 9).alias("share_cell"), "n_wide", "gross_wide", "classes_wide", "rank", "dense", F.round("pct", 9).alias("pct"))


def training_set(spark, sf_dir):
    """A tag wins over a label; excluded ids go; only known classes stay; features are joined by id."""
    k = F.col("doc_id")
    d = read(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    tags = d.where(k % 5 == 0).select("doc_id", F.concat(F.lit("tag"), k % 3).alias("target"), F.lit("tag").alias("origin"))
    labels = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q")).select("doc_id", F.concat(F.lit("q"), F.col("q")).alias("target"), F.lit("label").alias("origin"))
    both = tags.unionByName(labels.join(tags, "doc_id", "left_anti"))
    out = read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    return both.join(out, "doc_id", "left_anti").join(d, "doc_id")


def class_weights(spark, sf_dir):
    """(most / count) to a power, capped."""
    n = read(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(n.agg(F.max("n").alias("most")))).select("lang", "n", F.round(F.least(F.pow(F.col("most") / F.col("n"), F.lit(0.5)), F.lit(3.0)), 9).alias("weight"))


def grouped_folds(spark, sf_dir):
    return demand.greedy_folds(read(spark, sf_dir, "documents"), "source", 4)


def permuted_importance(spark, sf_dir):
    """The loss of accuracy when one feature is dealt anew by a hashed order within the whole table."""
    k = F.col("doc_id")
    rows = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("y")).join(read(spark, sf_dir, "documents").select("doc_id", "n_chars").groupBy("doc_id").agg(F.max("n_chars").alias("n")), "doc_id")
    rows = rows.select("doc_id", "y", (F.col("n") % 3).alias("a"), (k % 2).alias("b"))
    own = rows.withColumn("place", F.row_number().over(W.partitionBy("b").orderBy("doc_id")))
    dealt = rows.select("b", F.col("a").alias("a2"), F.row_number().over(W.partitionBy("b").orderBy(F.sha2(F.col("doc_id").cast("string"), 256), "doc_id")).alias("place"))
    hit = lambda a: F.avg(((F.col(a) > 0).cast("int") == F.col("y")).cast("int"))
    return own.join(dealt, ["b", "place"]).groupBy("b").agg(F.round(hit("a"), 9).alias("accuracy"), F.round(hit("a") - hit("a2"), 9).alias("importance"))


def two_row_likelihood(spark, sf_dir):
    """Shares as two weighted rows each, and the log-likelihood of a constant model by group."""
    b = buildings(spark, sf_dir).groupBy("district", "cls").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("floors") > 2).alias("yes"))
    two = b.select("district", F.explode(F.array(F.struct(F.lit(1).alias("y"), F.col("yes").alias("w")), F.struct(F.lit(0).alias("y"), (F.col("n") - F.col("yes")).alias("w")))).alias("r")).select("district", "r.*")
    p = two.groupBy("district").agg(F.sum("w").alias("n"), (F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("p"))
    ll = F.col("p") * F.ln(F.greatest("p", F.lit(1e-9))) + (1 - F.col("p")) * F.ln(F.greatest(1 - F.col("p"), F.lit(1e-9)))
    return p.select("district", "n", F.round("p", 9).alias("p"), F.round(ll, 9).alias("mean_ll"))


def cell_predictions(spark, sf_dir):
    """Scores of the distinct cells and settings, joined back to buildings; the cells are few against the rows."""
    b = buildings(spark, sf_dir).select("bldg_id", F.floor((F.col("lon") - 28.8) * 10).alias("x"), F.floor((F.col("lat") + 2.85) * 10).alias("y"), (F.col("floors") > 2).alias("urban"))
    cells = b.groupBy("x", "y", "urban").agg(F.count(F.lit(1)).alias("n"))
    scored = cells.select("x", "y", "urban", F.round(1 / (1 + F.exp(-(F.col("n") * 0.25 - 1 + F.col("urban").cast("int")))), 9).alias("p_connected"))
    return b.join(scored, ["x", "y", "urban"]).select("bldg_id", "urban", "p_connected")


_LI = "li AS (SELECT l_orderkey AS bldg_id, l_partkey % 23 AS p, l_quantity::DOUBLE AS u FROM lineitem)"
_WATT = "(10 + (p * 31 + h * 17) % 100 + CASE WHEN h BETWEEN 18 AND 22 AND p % 3 = 0 THEN 50 ELSE 0 END)"
_E = ", ".join(f"potential * (50 + (bldg_id + {y}) % 50) AS e{y}" for y in YEARS)
_STOCK = f"""{BLD}, stock AS (SELECT *, {_E} FROM (SELECT bldg_id, district, province, (CASE {' '.join(f'WHEN (bldg_id * 7 + {y} * 13) % 100 >= {SEEN} THEN {y}' for y in YEARS)} END)::INT AS first_y, (area * floors)::BIGINT AS potential FROM bld))"""
_UNPIVOT = "UNION ALL ".join(f"SELECT bldg_id, district, first_y, potential, {y} AS year, e{y} AS e FROM stock " for y in YEARS)
_CLIP = "least(greatest({}, 0), 1)"
_CAST = f"""{_STOCK}, long AS ({_UNPIVOT}),
c AS (SELECT district, year, coalesce(sum(potential) FILTER (WHERE first_y <= year), 0) AS c, sum(potential) FILTER (WHERE first_y IS NOT NULL) AS a FROM long GROUP BY ALL),
g AS (SELECT district, regr_slope(ln(greatest(c / a, 1e-9::DOUBLE)), year::DOUBLE) AS s FROM c GROUP BY 1),
nat AS (SELECT regr_slope(ln(greatest(c / a, 1e-9::DOUBLE)), year::DOUBLE) AS s FROM (SELECT year, sum(c) AS c, sum(a) AS a FROM c GROUP BY 1)),
gr AS (SELECT district, g.s * ({RATE!r}::DOUBLE / nat.s) AS growth_rate FROM g, nat),
e AS (SELECT district, year, {', '.join(f"coalesce(sum({c}) FILTER (WHERE {t}), 0)::DOUBLE AS {n}_{a}" for c, a in (('e', 'e'), ('potential', 'p')) for n, t in (('seen', 'first_y <= year'), ('never', 'first_y IS NULL'), ('later', 'first_y > year')))} FROM long GROUP BY ALL),
i AS (SELECT *, exp(-growth_rate * ({BASE} - year)) AS stock_index, exp(-growth_rate * ({BASE} - year)) * (seen_e + never_e + later_e) AS target FROM e JOIN gr USING (district)),
r AS (SELECT *, {_CLIP.format('(target - seen_e) / greatest(never_e, 1e-9::DOUBLE)')} AS rn, {_CLIP.format('(target - seen_e - never_e) / greatest(later_e, 1e-9::DOUBLE)')} AS rl FROM i),
past AS (SELECT district, year::INT AS year, CASE WHEN year = {BASE} THEN 'base' ELSE 'backcast' END AS kind, CASE WHEN year = {BASE} THEN seen_p + never_p + later_p ELSE seen_p + rn * never_p + rl * later_p END AS potential,
  CASE WHEN year = {BASE} THEN seen_e + never_e + later_e ELSE seen_e + rn * never_e + rl * later_e END AS expected, stock_index, growth_rate, rn AS presence_weight FROM r),
ahead AS (SELECT district, y::INT AS year, 'projection' AS kind, potential * exp(growth_rate * (y - {BASE})) AS potential, expected * exp(growth_rate * (y - {BASE})) AS expected, exp(growth_rate * (y - {BASE})) AS stock_index, growth_rate, NULL::DOUBLE AS presence_weight
  FROM past, range({AHEAD[0]}, {AHEAD[-1] + 1}) t(y) WHERE kind = 'base'),
years AS (SELECT * FROM past UNION ALL SELECT * FROM ahead)"""


def _units_sql(cls: str) -> dict[str, str]:
    out: dict[str, str] = {}
    tests = [t for t, _ in RULES[cls]]
    for i, (test, profiles) in enumerate(RULES[cls]):
        fires = " AND ".join([f"NOT ({t})" for t in tests[:i]] + [f"({test})"])
        for profile, n in profiles.items():
            for p, u in (_units_sql(profile[1:]) if profile.startswith("@") else {profile: "1.0"}).items():
                add = f"CASE WHEN {fires} THEN ({u}) * {n}::DOUBLE ELSE 0::DOUBLE END"
                out[p] = f"{out[p]} + {add}" if p in out else add
    return out


def _weights_sql() -> str:
    share = {"residential": "bldg_id % 8", "commercial": "bldg_id % 4", "mixed": "bldg_id % 3", "institutional": "bldg_id % 2"}
    total = " + ".join(share.values())
    found: dict[str, str] = {}
    for cls, p in share.items():
        for profile, u in _units_sql(cls).items():
            add = f"({p})::DOUBLE / (CASE WHEN {total} = 0 THEN 1 ELSE {total} END) * ({u})"
            found[profile] = f"{found[profile]} + {add}" if profile in found else add
    parts = " UNION ALL ".join(f"SELECT bldg_id, '{p}' AS profile_id, {w} AS weight FROM bld" for p, w in found.items())
    return f"WITH {BLD}, w AS ({parts}) SELECT bldg_id, profile_id, round(weight, 9) AS weight FROM w WHERE weight > 1e-6::DOUBLE"


ORACLE = {
    "load_characteristics": f"""WITH {_LI}, c AS (SELECT bldg_id, h, sum(u * {_WATT}) AS a, sum(u * ({_WATT} + p % 5)) AS d, sum(u * ({_WATT} + h % 7)) AS e FROM li, range(24) t(h) GROUP BY ALL),
q AS (SELECT bldg_id, sum(u * (5 + p)) AS annual_p10, sum(u * (50 + p)) AS annual_p90 FROM li GROUP BY 1),
m AS (SELECT bldg_id, max(a) AS peak_w, min(h) FILTER (WHERE a = top)::INT AS peak_hour, sum(a) / 24 / max(a) AS load_factor, sum(a) FILTER (WHERE h BETWEEN 18 AND 22) / sum(a) AS evening_share, sum(a) FILTER (WHERE h BETWEEN 8 AND 16) / sum(a) AS daytime_share,
  sum(a) FILTER (WHERE h < 5) / 5 AS night_base_w, sum(d) / sum(e) AS weekday_weekend_ratio FROM (SELECT *, max(a) OVER (PARTITION BY bldg_id) AS top FROM c) GROUP BY 1)
SELECT *, CASE WHEN evening_share >= 0.4::DOUBLE AND peak_hour BETWEEN 17 AND 22 THEN 'evening peak' WHEN daytime_share >= 0.5 THEN 'daytime' WHEN load_factor >= 0.6::DOUBLE THEN 'flat' ELSE 'mixed' END AS shape FROM m JOIN q USING (bldg_id)""",
    "minute_load_summary": """WITH e AS (SELECT user_id % 7 AS unit, ts, floor(value * 100)::BIGINT AS v FROM events), d AS (SELECT unit, ts::DATE AS day, sum(v) AS kwh FROM e GROUP BY ALL),
q AS (SELECT unit, count(*) AS days, round(quantile_cont(kwh, 0.1), 4) AS p10, round(quantile_cont(kwh, 0.9), 4) AS p90, sum(kwh)::BIGINT AS total FROM d GROUP BY 1),
o AS (SELECT unit, coalesce(sum(v) FILTER (WHERE isodow(ts) >= 6), 0)::BIGINT AS weekend, coalesce(sum(v) FILTER (WHERE hour(ts) = 0), 0)::BIGINT AS h00, coalesce(sum(v) FILTER (WHERE hour(ts) = 8), 0)::BIGINT AS h08, coalesce(sum(v) FILTER (WHERE hour(ts) = 19), 0)::BIGINT AS h19 FROM e GROUP BY 1)
SELECT *, (SELECT max(a)::BIGINT FROM (SELECT sum(v) AS a FROM e GROUP BY date_trunc('hour', ts))) AS coincident_peak FROM q JOIN o USING (unit)""",
    "weighted_metrics": """WITH l AS (SELECT l_returnflag, (l_linestatus = 'O')::INT::DOUBLE AS y, (l_partkey % 97 + 1) / 99.0::DOUBLE AS g, l_quantity::DOUBLE AS w FROM lineitem)
SELECT l_returnflag, round(-sum(w * (y * ln(g) + (1 - y) * ln(1 - g))) / sum(w), 7) AS logloss, round(sum(w * (g - y) * (g - y)) / sum(w), 7) AS brier, round(sum(w * abs(g - y)) / sum(w), 7) AS mae,
round(1 - sum(w * (g - y) * (g - y)) / nullif(sum(w * y * y) - sum(w * y) * sum(w * y) / sum(w), 0), 7) AS r2 FROM l GROUP BY 1""",
    "first_detected_year": f"WITH {_STOCK} SELECT bldg_id, first_y FROM stock",
    "backcast_by_year": f"WITH {_CAST} SELECT district, year, kind, round(potential, 4) AS potential, round(expected, 4) AS expected, round(stock_index, 7) AS stock_index, round(growth_rate, 7) AS growth_rate, round(presence_weight, 7) AS presence_weight FROM years",
    "sector_year_series": f"WITH {_CAST} SELECT province, year, round(sum(potential), 3) AS potential, round(sum(expected), 3) AS expected, count(*) AS districts FROM years JOIN (SELECT DISTINCT district, province FROM bld) USING (district) GROUP BY ALL",
    "class_profile_weights": _weights_sql(),
    "storey_grid_holdout": f"""WITH {BLD}, b AS (SELECT bldg_id % 2 AS half, floors AS level, floors * 300 + (bldg_id * 17) % 100 AS cm FROM bld),
l AS (SELECT half, s, level, sum(abs(greatest(1, (2 * cm + s) // (2 * s)) - level)) / count(*) AS e FROM b, range(240, 420, 5) t(s) GROUP BY ALL), m AS (SELECT half, s, round(avg(e), 9) AS mae FROM l GROUP BY ALL)
SELECT a.s AS storey_cm, a.mae AS fit_mae, b.mae AS test_mae FROM (SELECT * FROM m WHERE half = 0 ORDER BY mae, s LIMIT 1) a LEFT JOIN m b ON b.half = 1 AND b.s = a.s""",
    "floor_two_cuts": f"""WITH {BLD}, b AS (SELECT floors * 3 + (bldg_id * 17) % 5 AS h, least(floors, 3) AS c FROM bld),
t AS (SELECT t12, t23, c, avg((CASE WHEN h < t12 THEN 1 WHEN h < t23 THEN 2 ELSE 3 END = c)::INT) AS hit FROM b, range(3, 16) x(t12), range(3, 16) y(t23) WHERE t23 > t12 GROUP BY ALL)
SELECT t12, t23, round(avg(hit), 9) AS score FROM t GROUP BY ALL ORDER BY score DESC, t12, t23 LIMIT 1""",
    "building_features": f"""WITH {BLD}, b AS (SELECT bldg_id, district, cls, area, floors, area * floors AS gross, floor((lon - 28.8::DOUBLE) * 20) AS x, floor((lat + 2.85::DOUBLE) * 20) AS y FROM bld)
SELECT bldg_id, round(ln(area), 9) AS ln_area, floors::BIGINT AS floors, gross::BIGINT AS gross, round(area / median(area) OVER n, 9) AS rel_area, round(count(*) OVER n / count(*) OVER w, 9) AS density_ratio, count(*) OVER n AS n_cell, median(area) OVER n AS median_cell, max(floors) OVER n::BIGINT AS top_cell,
round(avg((cls = 'BUILDING')::INT) OVER n, 9) AS share_cell, count(*) OVER w AS n_wide, sum(gross) OVER w::BIGINT AS gross_wide, count(DISTINCT cls) OVER w AS classes_wide, rank() OVER d::INT AS rank, dense_rank() OVER d::INT AS dense, round(percent_rank() OVER d, 9) AS pct
FROM b WINDOW n AS (PARTITION BY x, y), w AS (PARTITION BY floor(x / 4), floor(y / 4)), d AS (PARTITION BY district ORDER BY area)""",
    "training_set": """WITH t AS (SELECT doc_id, 'tag' || (doc_id % 3) AS target, 'tag' AS origin FROM documents WHERE doc_id % 5 = 0), l AS (SELECT doc_id, 'q' || max(quality) AS target, 'label' AS origin FROM labels GROUP BY 1),
u AS (SELECT * FROM t UNION ALL SELECT * FROM l WHERE doc_id NOT IN (SELECT doc_id FROM t)) SELECT u.*, source, n_chars FROM u JOIN documents USING (doc_id) WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)""",
    "class_weights": "SELECT lang, count(*) AS n, round(least(pow(max(count(*)) OVER () / count(*), 0.5), 3), 9) AS weight FROM documents GROUP BY 1",
    "grouped_folds": """WITH RECURSIVE s AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY n DESC, source) AS r FROM s),
f AS (SELECT 0::BIGINT AS r, ''::VARCHAR AS source, 0::BIGINT AS n, -1 AS fold, 0::BIGINT AS a, 0::BIGINT AS b, 0::BIGINT AS c, 0::BIGINT AS d UNION ALL
SELECT o.r, o.source, o.n, k, a + CASE WHEN k = 0 THEN o.n ELSE 0 END, b + CASE WHEN k = 1 THEN o.n ELSE 0 END, c + CASE WHEN k = 2 THEN o.n ELSE 0 END, d + CASE WHEN k = 3 THEN o.n ELSE 0 END
FROM (SELECT *, CASE least(a, b, c, d) WHEN a THEN 0 WHEN b THEN 1 WHEN c THEN 2 ELSE 3 END AS k FROM f) g JOIN o ON o.r = g.r + 1) SELECT source, n, fold::INT AS fold FROM f WHERE r > 0""",
    "permuted_importance": """WITH r AS (SELECT doc_id, y, n % 3 AS a, doc_id % 2 AS b FROM (SELECT doc_id, max(quality) AS y FROM labels GROUP BY 1) JOIN (SELECT doc_id, max(n_chars) AS n FROM documents GROUP BY 1) USING (doc_id)),
o AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY doc_id) AS place FROM r), p AS (SELECT b, a AS a2, row_number() OVER (PARTITION BY b ORDER BY sha256(doc_id::VARCHAR), doc_id) AS place FROM r)
SELECT b, round(avg(((a > 0)::INT = y)::INT), 9) AS accuracy, round(avg(((a > 0)::INT = y)::INT) - avg(((a2 > 0)::INT = y)::INT), 9) AS importance FROM o JOIN p USING (b, place) GROUP BY 1""",
    "two_row_likelihood": f"WITH {BLD}, p AS (SELECT district, count(*) AS n, avg((floors > 2)::INT) AS p FROM bld GROUP BY 1) SELECT district, n, round(p, 9) AS p, round(p * ln(greatest(p, 1e-9::DOUBLE)) + (1 - p) * ln(greatest(1 - p, 1e-9::DOUBLE)), 9) AS mean_ll FROM p",
    "cell_predictions": f"WITH {BLD}, b AS (SELECT bldg_id, floor((lon - 28.8::DOUBLE) * 10) AS x, floor((lat + 2.85::DOUBLE) * 10) AS y, floors > 2 AS urban FROM bld) SELECT bldg_id, urban, round(1 / (1 + exp(-(count(*) OVER (PARTITION BY x, y, urban) * 0.25::DOUBLE - 1 + urban::INT))), 9) AS p_connected FROM b",
}
QUERIES = {name: globals()[name] for name in ORACLE}
