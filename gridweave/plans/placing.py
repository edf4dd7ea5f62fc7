"""Contract queries of the staged allocation: its state, its report, its weight rows and its invariants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import picks, placing
from ..operators.placing import Stage
from ..sources import settled
from .core import BLD, buildings

#: Which classes a kept label may stand for, and what is left to later stages.
KEPT, LATER = ("institutional", "religious", "commercial", "productive_use"), ("institutional", "productive_use", "commercial", "mixed_shop_house")
OWN = ("institutional", "religious", "industrial_warehouse", "ancillary")
SCORES = {"pr": 31, "ps": 37, "pc": 41, "pi": 43, "pg": 47, "pa": 53, "pw": 59}
RURAL = {"bar": "bar_rural", "health_centre": "health_centre_rural", "kiosk_shop": "kiosk_rural"}
HOMES = {(True, True): "household_town_upper", (True, False): "household_town", (False, True): "household_country_upper", (False, False): "household_country"}


def _listed(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{n}'" for n in names)


_CASES = {
    "tag": "CASE bldg_id % 20 WHEN 0 THEN 'residential' WHEN 1 THEN 'commercial' WHEN 2 THEN 'religious' WHEN 3 THEN 'institutional' WHEN 4 THEN 'ancillary' END",
    "trade": "CASE WHEN bldg_id % 29 = 0 THEN 'mill' WHEN bldg_id % 31 = 0 THEN 'tailor' END",
    "svc": "CASE WHEN bldg_id % 37 = 0 THEN 'bar' END",
    "label": "CASE bldg_id % 23 WHEN 1 THEN 'institutional' WHEN 2 THEN 'religious' WHEN 3 THEN 'residential' WHEN 4 THEN 'commercial' WHEN 5 THEN 'productive_use' END",
    "facility": "CASE WHEN bldg_id % 11 = 0 THEN concat(district, ':', bldg_id % 3) END",
    "fac_profile": "CASE WHEN bldg_id % 11 <> 0 THEN NULL WHEN bldg_id % 3 = 0 THEN 'health_centre' WHEN bldg_id % 3 = 1 THEN 'school' ELSE 'kiosk_shop' END",
    "cell": "concat(district, '/', bldg_id % 4)",
    "rwi": "CASE WHEN bldg_id % 9 > 0 THEN (bldg_id * 29) % 100 END",
    "density": "(bldg_id * 61) % 997",
    "road": "(bldg_id * 13) % 1500",
    "keep": f"coalesce(bldg_id % 10 >= 6 AND bldg_id % 23 IN (1, 2, 4, 5), false)",
} | {c: f"(bldg_id * {m}) % 1000" for c, m in SCORES.items()}
_SURE = {"pi": "institutional", "pg": "religious", "pc": "commercial"}
#: Prepared columns, each a SQL expression that both engines read; a kept label is certain of its class.
_PREPARED = {c: f"CASE WHEN keep THEN {f'CASE WHEN label = {chr(39)}{_SURE[c]}{chr(39)} THEN 1000 ELSE 0 END' if c in _SURE else '0'} ELSE {c} END" for c in SCORES}
_T = f"CASE WHEN keep AND label NOT IN ({_listed(LATER)}) THEN label ELSE tag END"
_FIRST = [
    ("own_tag", f"coalesce(t IN ({_listed(OWN)}), false)"),
    ("est", "CASE WHEN NOT own_tag THEN coalesce(trade, svc) END"),
    ("use", "CASE WHEN trade IS NOT NULL AND NOT own_tag THEN 'productive_use' WHEN svc IS NOT NULL AND NOT own_tag THEN 'commercial' WHEN own_tag THEN t END"),
    ("shop", "coalesce(t = 'commercial', false) AND est IS NULL"),
    ("est", "CASE WHEN shop THEN 'kiosk_shop' ELSE est END"),
    ("use", "CASE WHEN shop THEN 'commercial' ELSE use END"),
    ("source", f"CASE WHEN use IS NULL THEN NULL WHEN keep AND label NOT IN ({_listed(LATER)}) THEN 'llm' ELSE 'tag' END"),
    ("est", "CASE WHEN use = 'religious' AND est IS NULL THEN 'church' ELSE est END"),
    ("est_w", "CAST(1 AS DOUBLE)"),
    ("tagged_fac", "bldg_id % 22 = 0 AND fac_profile IS NOT NULL"),
    ("near_fac", "coalesce(fac_profile <> 'kiosk_shop', false) AND NOT tagged_fac AND use IS NULL AND est IS NULL AND pi >= pr AND area >= 30"),
    ("pharmacy", "tagged_fac AND fac_profile = 'kiosk_shop' AND est IS NULL"),
    ("use", "CASE WHEN pharmacy THEN 'commercial' ELSE use END"),
    ("source", "CASE WHEN pharmacy THEN 'tag' ELSE source END"),
    ("est", "CASE WHEN pharmacy THEN 'kiosk_shop' ELSE est END"),
    ("member", "(tagged_fac OR near_fac) AND fac_profile <> 'kiosk_shop' AND est IS NULL"),
]
_KEPT_LEFT = "keep AND use IS NULL AND est IS NULL AND label = '{}'"
_LATE = [
    ("l_inst", _KEPT_LEFT.format("institutional")), ("l_shop", _KEPT_LEFT.format("commercial")), ("l_work", _KEPT_LEFT.format("productive_use")),
    ("use", "CASE WHEN l_inst THEN 'institutional' WHEN l_shop THEN 'commercial' WHEN l_work THEN 'productive_use' ELSE use END"),
    ("source", "CASE WHEN l_inst OR l_shop OR l_work THEN 'llm' ELSE source END"),
    ("est", "CASE WHEN l_inst THEN 'office' WHEN l_shop THEN 'kiosk_shop' WHEN l_work AND urban THEN 'tailor' WHEN l_work THEN 'workshop_rural' ELSE est END"),
    ("est", "CASE WHEN est IS NULL AND use = 'institutional' THEN CASE WHEN bldg_id % 2 = 0 THEN 'school' ELSE 'health_post' END ELSE est END"),
    ("est", "CASE WHEN est IS NULL AND use = 'religious' THEN 'church' ELSE est END"),
]
_LAST = [
    ("use", "CASE WHEN households > 0 AND est = 'kiosk_shop' THEN 'mixed_shop_house' WHEN households > 0 AND use IS NULL THEN 'residential' ELSE use END"),
    ("source", "CASE WHEN households > 0 AND source IS NULL THEN 'census' ELSE source END"),
    ("est", f"CASE {' '.join(f'WHEN country AND est = {chr(39)}{a}{chr(39)} THEN {chr(39)}{b}{chr(39)}' for a, b in RURAL.items())} ELSE est END"),
    ("use", "coalesce(use, 'ancillary')"),
    ("source", "coalesce(source, 'remainder')"),
    ("est_w", "CASE WHEN est IS NOT NULL THEN round(est_w, 6) END"),
    ("household_profile", f"CASE {' '.join(f'WHEN urban = {str(u).lower()} AND upper = {str(r).lower()} THEN {chr(39)}{n}{chr(39)}' for (u, r), n in HOMES.items())} END"),
]
#: item, profile, class, pool, score, source, cap
_STAGES = [
    ("pu:mill", "mill", "productive_use", "bldg_id % 2 = 0 AND NOT urban AND road <= 1000", "1000 - pa + (bldg_id * 67) % 500 + CASE WHEN keep AND label = 'productive_use' THEN 5000 ELSE 0 END", "census", 1),
    ("pu:tailor", "tailor", "productive_use", "bldg_id % 2 = 0 AND urban", "1000 - pa + (bldg_id * 67) % 500 + CASE WHEN keep AND label = 'productive_use' THEN 5000 ELSE 0 END", "census", 2),
    ("svc:bar", "bar", "commercial", "area >= 25", "(pc + ps) * (500 + density)", "census", 1),
    ("retail:kiosk_shop", "kiosk_shop", "commercial", "area >= 25", "pc + ps", "census", 6),
    ("registry:school", "school", "institutional", "area >= 40", "pi", "registry", 1),
    ("registry:health_centre", "health_centre", "institutional", "area >= 40", "pi", "registry", 1),
    ("registry:church", "church", "religious", "area >= 25", "pg", "registry", 1),
]
_WANTED = {"pu:mill": "need", "pu:tailor": "need + 1", "svc:bar": "need", "retail:kiosk_shop": "2 * need", "registry:school": "need - 2", "registry:health_centre": "1", "registry:church": "need - 1"}


def _steps(df: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    return reduce(lambda d, s: d.withColumn(s[0], F.expr(s[1])), steps, df)


def _allocated(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(state, report) after all stages."""
    b = buildings(spark, sf_dir).select("bldg_id", "district", "area", "floors", "need")
    df = b.select("*", *(F.expr(e).alias(c) for c, e in _CASES.items()))
    df = df.select(*(F.expr(_PREPARED[c]).alias(c) if c in _PREPARED else F.col(c) for c in df.columns)).withColumn("slots", F.expr("CASE WHEN area >= 20 THEN (pr + ps) * floors ELSE 0 END"))
    town = picks.running(df, "district", "density", F.col("slots"), "bldg_id").withColumn("urban", F.expr("_before * 100 < need * 7 * _total")).drop("_before", "_total")
    df = _steps(town.withColumn("t", F.expr(_T)), _FIRST)
    df = settled(placing.compounds(df, F.col("member"), "facility", F.col("fac_profile"), "institutional", F.expr("CASE WHEN near_fac THEN 'facility' ELSE 'tag' END")))
    districts = settled(df.groupBy("district").agg(F.max("need").alias("need")))
    targets = reduce(DataFrame.unionAll, [districts.select("district", F.lit(i).alias("item"), F.expr(e).cast("long").alias("target")) for i, e in _WANTED.items()])
    reports = []
    for item, profile, cls, pool, score, source, cap in _STAGES:
        df, told = placing.place(df, targets, Stage(item, profile, cls, F.expr(pool), F.expr(score), source, cap=cap))
        reports.append(told)
    # What no census counts: its rate among labelled buildings of each setting, without those that are tagged.
    by = df.groupBy("district").agg(F.count_if("urban").alias("_nu"), F.count_if(~F.col("urban")).alias("_nr"), F.count_if(F.expr("use = 'productive_use'")).alias("_had"))
    labelled = df.where("label IS NOT NULL").agg(*(F.coalesce(F.avg(F.expr(f"CASE WHEN {s} THEN CAST(label = 'productive_use' AS INT) END")), F.lit(0.0)).alias(c) for s, c in (("urban", "_ru"), ("NOT urban", "_rr"))))
    rates = labelled.first()  # one row
    wanted = by.select("district", F.lit("model:productive_use").alias("item"), (F.col("_had") + F.bround(F.greatest(F.col("_nu") * rates["_ru"] + F.col("_nr") * rates["_rr"] - F.col("_had"), F.lit(0.0)))).cast("long").alias("target"), "_had")
    df, told = placing.place(df.withColumn("est_w", F.expr("est_w")), wanted.withColumn("target", F.col("target") - F.col("_had")).drop("_had"), Stage("model:productive_use", "", "productive_use", F.expr("area >= 25"), F.expr("pw"), "model", spaced=False))
    reports.append(told)
    df = _steps(df.withColumn("est", F.expr("CASE WHEN est = '' OR (use = 'productive_use' AND est IS NULL) THEN 'workshop' ELSE est END")), _LATE)
    needs = districts.select("district", F.expr("10 * need").cast("long").alias("total"), F.expr("4 * need").cast("long").alias("town"), F.expr("6 * need").cast("long").alias("country"))
    df = placing.households(df, needs, F.expr("(use IS NULL OR est = 'kiosk_shop') AND area >= 20"), F.expr("pr + ps + CASE WHEN t = 'residential' THEN 1000 ELSE 0 END"), F.col("floors"))
    home = df.groupBy("district").agg(F.sum("households").alias("assigned")).join(needs, "district")
    reports.append(home.select("district", F.lit("households").alias("item"), F.col("total").alias("target"), F.lit(0).cast("long").alias("tagged"), "assigned", F.greatest(F.col("total") - F.col("assigned"), F.lit(0)).alias("shortfall")))
    middle = df.agg(F.median("rwi")).first()[0]
    homes = df.where("households > 0").select("bldg_id", F.concat("district", F.expr("CASE WHEN urban THEN '|town' ELSE '|country' END")).alias("_key"), (F.coalesce(F.col("rwi").cast("double"), F.lit(middle)) * 1000 + F.col("area")).alias("_rank"), "households", F.expr("CASE WHEN urban THEN need * 9 ELSE 50 END").alias("_pct"))
    upper = picks.running(homes, "_key", "_rank", F.col("households"), "bldg_id").where("_before * 100 < _pct * _total").select(F.col("bldg_id").alias("_id"))
    df = df.join(upper, F.col("bldg_id") == F.col("_id"), "left").withColumn("upper", F.col("_id").isNotNull()).drop("_id")
    half = df.where("est_w < 1 AND facility IS NOT NULL").groupBy(F.col("facility").alias("_f")).agg((2 * F.count_if(~F.col("urban")) >= F.count(F.lit(1))).alias("_most"))
    df = df.join(half, (F.col("facility") == F.col("_f")) & (F.col("est_w") < 1), "left").withColumn("country", F.coalesce("_most", ~F.col("urban"))).drop("_f", "_most")
    return _steps(df, _LAST), reduce(DataFrame.unionAll, reports)


def staged_allocation_full(spark, sf_dir):
    return _allocated(spark, sf_dir)[0].select("bldg_id", "district", "urban", "use", "est", "est_w", "households", "upper", "source", "household_profile")


def allocation_report(spark, sf_dir):
    return _allocated(spark, sf_dir)[1]


def allocation_weights(spark, sf_dir):
    return placing.weight_rows(_allocated(spark, sf_dir)[0])


def allocation_invariants(spark, sf_dir):
    """Per item: rows whose target isn't met by what is tagged, assigned and short; a 0 in each says all is accounted for."""
    told = _allocated(spark, sf_dir)[1]
    return told.groupBy("item").agg(F.count_if(F.expr("least(tagged, target) + assigned + shortfall <> target")).alias("broken"), F.sum("shortfall").alias("short"))


def target_vector(spark, sf_dir):
    """A national registry spread over districts by their share of households, halves to even."""
    b = buildings(spark, sf_dir).groupBy("district").agg(F.sum("floors").alias("homes"))
    total = b.agg(F.sum("homes")).first()[0] or 1
    spread = [F.bround(F.col("homes") * n / F.lit(total)).cast("long").alias(c) for c, n in (("church", 500), ("health_post", 75), ("clinic", 25))]
    return b.select("district", F.col("homes").alias("households"), *spread)


def _sql_steps(name: str, before: str, steps: list[tuple[str, str]], columns: list[str]) -> tuple[str, str, list[str]]:
    out = []
    for i, (c, e) in enumerate(steps):
        step = f"{name}{i}"
        out.append(f"{step} AS (SELECT {f'* REPLACE ({e} AS {c})' if c in columns else f'*, {e} AS {c}'} FROM {before})")
        before, columns = step, columns if c in columns else [*columns, c]
    return ", ".join(out), before, columns


def _sql_place(i: int, before: str, item: str, profile: str, cls: str, pool: str, score: str, source: str, cap: int | None, target: str) -> str:
    caps = ",".join(f"({cap * 2**k})" for k in range(9)) if cap else "(1000000000)"
    return f"""n{i} AS MATERIALIZED (SELECT district, tagged, target, greatest(target - tagged, 0) AS need FROM (SELECT district, CAST(round_even(sum(CASE WHEN est = '{profile}' THEN est_w ELSE 0 END), 0) AS BIGINT) AS tagged FROM {before} GROUP BY 1) JOIN ({target}) USING (district)),
r{i} AS MATERIALIZED (SELECT bldg_id, district, {score} AS score, n{i}.need, row_number() OVER (PARTITION BY district, cell ORDER BY {score} DESC, bldg_id) AS k FROM {before} b JOIN n{i} USING (district) WHERE use IS NULL AND est IS NULL AND ({pool})),
c{i} AS (SELECT district, coalesce(min(cap) FILTER (WHERE n >= need), max(cap)) AS cap FROM (SELECT district, cap, any_value(need) AS need, count(*) FILTER (WHERE k <= cap) AS n FROM r{i}, (VALUES {caps}) v(cap) GROUP BY district, cap) GROUP BY 1),
p{i} AS MATERIALIZED (SELECT bldg_id, district FROM (SELECT bldg_id, district, need, row_number() OVER (PARTITION BY district ORDER BY score DESC, bldg_id) AS rank FROM r{i} JOIN c{i} USING (district) WHERE k <= cap) WHERE rank <= need),
s{i} AS MATERIALIZED (SELECT b.* REPLACE (CASE WHEN p.bldg_id IS NOT NULL THEN '{cls}' ELSE use END AS use, CASE WHEN p.bldg_id IS NOT NULL THEN '{profile}' ELSE est END AS est, CASE WHEN p.bldg_id IS NOT NULL THEN '{source}' ELSE source END AS source) FROM {before} b LEFT JOIN p{i} p USING (bldg_id)),
t{i} AS (SELECT district, '{item}' AS item, CAST(target AS BIGINT) AS target, tagged, CAST(coalesce(got, 0) AS BIGINT) AS assigned, CAST(greatest(need - coalesce(got, 0), 0) AS BIGINT) AS shortfall FROM n{i} LEFT JOIN (SELECT district, count(*) AS got FROM p{i} GROUP BY 1) USING (district))"""


def _sql() -> str:
    """The whole allocation as one chain of CTEs: `done` is the state and `told` the report."""
    columns = ["bldg_id", "district", "area", "floors", "need", *_CASES]
    cases = "".join(f", {e} AS {c}" for c, e in _CASES.items()).replace("THEN (bldg_id * 29) % 100", "THEN CAST((bldg_id * 29) % 100 AS INT)")
    first, at, columns = _sql_steps("f", "a3", _FIRST, [*columns, "slots", "urban", "t"])
    parts = [BLD, f"a0 AS (SELECT bldg_id, district, area, floors, need{cases} FROM bld)", f"a1 AS (SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in _PREPARED.items())}) FROM a0)",
        "a2 AS (SELECT *, CASE WHEN area >= 20 THEN (pr + ps) * floors ELSE 0 END AS slots FROM a1)",
        f"""a3 AS MATERIALIZED (SELECT *, coalesce(sum(slots) OVER (PARTITION BY district ORDER BY density DESC, bldg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 100 < need * 7 * sum(slots) OVER (PARTITION BY district) AS urban, {_T} AS t FROM a2)""", first,
        f"""g0 AS MATERIALIZED (SELECT b.* REPLACE (CASE WHEN member THEN fac_profile ELSE est END AS est, CASE WHEN member THEN 'institutional' ELSE use END AS use, CASE WHEN member THEN CASE WHEN near_fac THEN 'facility' ELSE 'tag' END ELSE source END AS source,
  CASE WHEN member THEN 1::DOUBLE / count(*) FILTER (WHERE member) OVER (PARTITION BY facility) ELSE est_w END AS est_w) FROM {at} b)""",
        "d AS MATERIALIZED (SELECT district, max(need) AS need FROM bld GROUP BY 1)"]
    at = "g0"
    for i, (item, profile, cls, pool, score, source, cap) in enumerate(_STAGES):
        parts.append(_sql_place(i, at, item, profile, cls, pool, score, source, cap, f"SELECT district, {_WANTED[item]} AS target FROM d"))
        at = f"s{i}"
    rate = "coalesce(avg((label = 'productive_use')::INT) FILTER (WHERE {} AND label IS NOT NULL), 0)"
    parts.append(f"rates AS MATERIALIZED (SELECT {rate.format('urban')} AS ru, {rate.format('NOT urban')} AS rr FROM {at})")
    n = len(_STAGES)
    wanted = f"SELECT district, round_even(greatest(count(*) FILTER (WHERE urban) * ru + count(*) FILTER (WHERE NOT urban) * rr - count(*) FILTER (WHERE use = 'productive_use'), 0), 0)::BIGINT AS target FROM {at}, rates GROUP BY district, ru, rr"
    parts.append(_sql_place(n, at, "model:productive_use", "", "productive_use", "area >= 25", "pw", "model", None, wanted))
    parts.append(f"m0 AS (SELECT * REPLACE (CASE WHEN est = '' OR (use = 'productive_use' AND est IS NULL) THEN 'workshop' ELSE est END AS est) FROM s{n})")
    late, at, columns = _sql_steps("l", "m0", _LATE, columns)
    parts += [late, f"h0 AS MATERIALIZED (SELECT *, 0::BIGINT AS households, (use IS NULL OR est = 'kiosk_shop') AND area >= 20 AS home, pr + ps + CASE WHEN t = 'residential' THEN 1000 ELSE 0 END AS hs FROM {at})"]
    for i, (pool, need) in enumerate((("home AND urban", "4 * need"), ("home AND NOT urban", "6 * need"), ("home AND households = 0", "short"))):
        short = ", greatest(10 * need - sum(households) OVER (PARTITION BY district), 0) AS short"
        pooled = f"SELECT bldg_id, least(floors, greatest({need} - coalesce(sum(floors) OVER (PARTITION BY district ORDER BY hs DESC, bldg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)) AS u FROM (SELECT *{short} FROM h{i}) WHERE {pool}"
        parts.append(f"h{i + 1} AS MATERIALIZED (SELECT h.* REPLACE (CASE WHEN u > 0 THEN u ELSE households END::BIGINT AS households) FROM h{i} h LEFT JOIN ({pooled}) USING (bldg_id))")
    parts += [
        """w0 AS MATERIALIZED (SELECT h.*, coalesce(w.upper, false) AS upper FROM h3 h LEFT JOIN (SELECT bldg_id, coalesce(sum(households) OVER (PARTITION BY district, urban ORDER BY rank DESC, bldg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 100
  < CASE WHEN urban THEN need * 9 ELSE 50 END * sum(households) OVER (PARTITION BY district, urban) AS upper FROM (SELECT *, coalesce(rwi::DOUBLE, (SELECT median(rwi) FROM h3)) * 1000 + area AS rank FROM h3 WHERE households > 0)) w USING (bldg_id))""",
        "w1 AS (SELECT w.*, coalesce(CASE WHEN est_w < 1 THEN most END, NOT urban) AS country FROM w0 w LEFT JOIN (SELECT facility, 2 * count(*) FILTER (WHERE NOT urban) >= count(*) AS most FROM w0 WHERE est_w < 1 AND facility IS NOT NULL GROUP BY 1) USING (facility))",
    ]
    last, at, _ = _sql_steps("e", "w1", _LAST, [*columns, "households", "home", "hs", "upper", "country"])
    told = " UNION ALL ".join(f"SELECT * FROM t{i}" for i in range(n + 1))
    home = "SELECT district, 'households', 10 * max(need)::BIGINT, 0::BIGINT, sum(households)::BIGINT, greatest(10 * max(need) - sum(households), 0)::BIGINT FROM h3 GROUP BY 1"
    parts += [last, f"done AS MATERIALIZED (SELECT * FROM {at})", f"told AS MATERIALIZED ({told} UNION ALL {home})"]
    return "WITH " + ",\n".join(parts)


_WHOLE = _sql()
ORACLE = {
    "staged_allocation_full": _WHOLE + " SELECT bldg_id, district, urban, use, est, est_w, households, upper, source, household_profile FROM done",
    "allocation_report": _WHOLE + " SELECT * FROM told",
    "allocation_weights": _WHOLE + " SELECT bldg_id, household_profile AS profile_id, households::DOUBLE AS units FROM done WHERE households > 0 UNION ALL SELECT bldg_id, est, est_w FROM done WHERE est IS NOT NULL",
    "allocation_invariants": _WHOLE + " SELECT item, count(*) FILTER (WHERE least(tagged, target) + assigned + shortfall <> target) AS broken, sum(shortfall)::BIGINT AS short FROM told GROUP BY 1",
    "target_vector": f"WITH {BLD}, h AS (SELECT district, sum(floors)::BIGINT AS homes, sum(sum(floors)) OVER () AS total FROM bld GROUP BY 1) SELECT district, homes AS households, " + ", ".join(f"round_even(homes * {n}.0::DOUBLE / total, 0)::BIGINT AS {c}" for c, n in (("church", 500), ("health_post", 75), ("clinic", 25))) + " FROM h",
}
QUERIES = {name: globals()[name] for name in ORACLE}
