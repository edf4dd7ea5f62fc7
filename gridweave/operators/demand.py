"""Load curves' characteristics, weights of classes, back-casts and the tables that models are trained on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hours of the evening, of daytime and of the night.
EVENING, DAYTIME, NIGHT = range(18, 23), range(8, 17), range(0, 5)


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def characteristics(df: DataFrame, keys: list[str], every: str, weekday: str, weekend: str) -> DataFrame:
    """What a 24-hour curve is like, from 24 columns of each prefix: peak, its first hour, load factor, shares, night base,
    weekday over weekend, and shape. A curve that sums to 0 has a peak of 0, the shape 'none', and nulls else."""
    w = [F.col(f"{every}{h}") for h in range(24)]
    total, peak = _sum(w), F.greatest(*w)
    some = total > 0
    hour = F.coalesce(*(F.when(w[h] == peak, F.lit(h)) for h in range(24)))
    evening, day = _sum([w[h] for h in EVENING]) / total, _sum([w[h] for h in DAYTIME]) / total
    factor = total / 24 / peak
    shape = F.when((evening >= 0.4) & hour.between(17, 22), "evening peak").when(day >= 0.5, "daytime").when(factor >= 0.6, "flat").otherwise("mixed")
    off = _sum([F.col(f"{weekend}{h}") for h in range(24)])
    ratio = F.when(some & (off > 0), _sum([F.col(f"{weekday}{h}") for h in range(24)]) / off)
    given = {"load_factor": factor, "evening_share": evening, "daytime_share": day}
    return df.select(
        *keys, F.when(some, peak).otherwise(0.0).alias("peak_w"), F.when(some, hour).alias("peak_hour"), *(F.when(some, c).alias(n) for n, c in given.items()),
        F.when(some, _sum([w[h] for h in NIGHT]) / 5).otherwise(0.0).alias("night_base_w"), ratio.alias("weekday_weekend_ratio"), F.when(some, shape).otherwise("none").alias("shape"),
    )


def expanded(rules: dict[str, list[tuple[Column, dict[str, float]]]], cls: str) -> list[tuple[Column, dict[str, Column]]]:
    """The rules of a class with references ('@class') replaced: each a test and the profiles' units, as columns.

    A referenced class is resolved by its own first matching rule; units multiply along references and add up where
    profiles meet. A reference to itself is an error.
    """

    def units(name: str, above: tuple[str, ...]) -> dict[str, Column]:
        if name in above:
            raise ValueError(f"{name} refers to itself")
        out: dict[str, Column] = {}
        before = F.lit(False)
        for test, profiles in rules[name]:
            fires = test & ~before
            before = before | test
            for profile, n in profiles.items():
                parts = units(profile[1:], (*above, name)) if profile.startswith("@") else {profile: F.lit(1.0)}
                for p, u in parts.items():
                    add = F.when(fires, u * n).otherwise(0.0)
                    out[p] = out[p] + add if p in out else add
        return out

    return [(F.lit(True), units(cls, ()))]


def profile_weights(df: DataFrame, id_col: str, probs: dict[str, Column], rules: dict, least: float = 1e-6) -> DataFrame:
    """(id, profile_id, weight): class probabilities over their sum, times the units of each class's profiles, added up."""
    total = _sum(list(probs.values()))
    share = {c: p / F.when(total == 0, 1.0).otherwise(total) for c, p in probs.items()}
    found: dict[str, Column] = {}
    for cls in rules:
        for _, units in expanded(rules, cls):
            for profile, u in units.items():
                add = share[cls] * u if cls in share else F.lit(0.0)
                found[profile] = found[profile] + add if profile in found else add
    pairs = F.array(*(F.struct(F.lit(p).alias("profile_id"), w.alias("weight")) for p, w in sorted(found.items())))
    return df.select(id_col, F.explode(pairs).alias("x")).select(id_col, "x.profile_id", "x.weight").where(F.col("weight") > least)


def back_cast(df: DataFrame, area: str, base: int, years: list[int], ahead: list[int], census_rate: float) -> DataFrame:
    """(area, year, kind, potential, expected, stock_index, growth_rate, presence_weight).

    df: a row per building with `first_y` (null: never detected), `potential` and `e<year>`. An area's growth is the
    slope of the log of its detected cumulated potential, scaled so that the national slope is census_rate. Demand of a
    past year is the base stock times exp(-growth x years): what is seen by then counts in full, the undetected a share,
    and what is detected later the rest; shares are clipped to 0..1. Later years grow from the base. One pass per table:
    only sums by area and year are joined.
    """
    found = F.col("first_y").isNotNull()
    sums = [F.sum(F.when(found, F.col("potential"))).alias("all")] + [F.coalesce(F.sum(F.when(F.col("first_y") <= y, F.col("potential"))), F.lit(0)).alias(f"c{y}") for y in years]
    steps = lambda t: t.select(*([area] if area in t.columns else []), F.explode(F.array(*(F.struct(F.lit(float(y)).alias("y"), F.ln(F.greatest(F.col(f"c{y}") / F.col("all"), F.lit(1e-9))).alias("v")) for y in years))).alias("p"))
    slope = F.regr_slope(F.col("p.v"), F.col("p.y")).alias("slope")
    nation = steps(df.agg(*sums)).agg(slope.alias("nation"))
    growth = steps(df.groupBy(area).agg(*sums)).groupBy(area).agg(slope).join(F.broadcast(nation)).select(area, (F.col("slope") * (F.lit(census_rate) / F.col("nation"))).alias("growth_rate"))  # one row
    state = lambda c, y: [F.coalesce(F.sum(F.when(t, F.col(c))), F.lit(0)).cast("double").alias(f"{n}_{c}") for n, t in (("seen", F.col("first_y") <= y), ("never", ~found), ("later", F.col("first_y") > y))]
    clip = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    parts = []
    for y in years:
        own = df.withColumn("e", F.col(f"e{y}")).groupBy(area).agg(*state("e", y), *state("potential", y)).join(growth, area)
        index = F.exp(-F.col("growth_rate") * (base - y))
        e = {n: F.col(f"{n}_e") for n in ("seen", "never", "later")}
        target = index * (e["seen"] + e["never"] + e["later"])
        never = clip((target - e["seen"]) / F.greatest(e["never"], F.lit(1e-9)))
        later = clip((target - e["seen"] - e["never"]) / F.greatest(e["later"], F.lit(1e-9)))
        if y >= base:
            later = F.lit(1.0)
        worth = lambda c, a=never if y < base else F.lit(1.0), b=later: F.col(f"seen_{c}") + a * F.col(f"never_{c}") + b * F.col(f"later_{c}")
        parts.append(own.select(area, F.lit(y).alias("year"), F.lit("base" if y == base else "backcast").alias("kind"), worth("potential").alias("potential"), worth("e").alias("expected"), index.alias("stock_index"), "growth_rate", never.alias("presence_weight")))
    last = df.groupBy(area).agg(F.sum("potential").cast("double").alias("potential"), F.sum(f"e{base}").cast("double").alias("expected")).join(growth, area)
    for y in ahead:
        f = F.exp(F.col("growth_rate") * (y - base))
        parts.append(last.select(area, F.lit(y).alias("year"), F.lit("projection").alias("kind"), (F.col("potential") * f).alias("potential"), (F.col("expected") * f).alias("expected"), f.alias("stock_index"), "growth_rate", F.lit(None).cast("double").alias("presence_weight")))
    return reduce(DataFrame.unionAll, parts)


def regression_metrics(df: DataFrame, group: str, truth: Column, guess: Column, weight: Column) -> DataFrame:
    """(group, logloss, brier, mae, r2), weighted; probabilities are held 1e-15 off 0 and 1."""
    p = F.least(F.greatest(guess, F.lit(1e-15)), F.lit(1 - 1e-15))
    own = df.select(group, truth.cast("double").alias("y"), guess.cast("double").alias("g"), p.cast("double").alias("p"), weight.cast("double").alias("w"))
    sums = own.groupBy(group).agg(
        F.sum("w").alias("n"), F.sum(F.expr("w * (y * ln(p) + (1 - y) * ln(1 - p))")).alias("l"), F.sum(F.expr("w * (g - y) * (g - y)")).alias("s"),
        F.sum(F.expr("w * abs(g - y)")).alias("a"), F.sum(F.expr("w * y")).alias("m"), F.sum(F.expr("w * y * y")).alias("q"),
    )
    return sums.select(group, (-F.col("l") / F.col("n")).alias("logloss"), (F.col("s") / F.col("n")).alias("brier"), (F.col("a") / F.col("n")).alias("mae"), (1 - F.col("s") / F.nullif(F.expr("q - m * m / n"), F.lit(0.0))).alias("r2"))


def greedy_folds(df: DataFrame, group: str, k: int) -> DataFrame:
    """(group, n, fold): groups by falling size, each to the fold that holds the fewest rows so far (the first on ties).

    Only the sizes of groups are gathered, as one array; so groups are areas, not rows.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(group).alias("g"))))
    held = lambda acc: acc["held"]

    def add(acc: Column, x: Column) -> Column:
        at = F.array_position(held(acc), F.array_min(held(acc)))
        now = F.transform(held(acc), lambda v, i: F.when(i + 1 == at, v - x["m"]).otherwise(v))
        return F.struct(now.alias("held"), F.concat(acc["out"], F.array(F.struct(x["g"].alias(group), (-x["m"]).alias("n"), (at - 1).cast("int").alias("fold")))).alias("out"))

    kind = df.schema[group].dataType.simpleString()
    zero = F.struct(F.array(*[F.lit(0).cast("long")] * k).alias("held"), F.array().cast(f"array<struct<{group}:{kind},n:bigint,fold:int>>").alias("out"))
    return sizes.agg(F.aggregate(order, zero, add)["out"].alias("o")).select(F.explode("o").alias("x")).select("x.*")
