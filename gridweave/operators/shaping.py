"""Predicates, overrides, tiers, probability vectors and tables put together by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import first_match


def setting(density: Column, kind: Column, least: float, kinds: list[str]) -> Column:
    """'urban' where the density reaches the least or the kind is listed, else 'rural'; a null density is 0."""
    return F.when((F.coalesce(density, F.lit(0)) >= least) | F.coalesce(kind.isin(kinds), F.lit(False)), "urban").otherwise("rural")


def eligible(area: Column, flags: Column, label: Column, facility: Column, least: float, bad_flags: list[str], bad_labels: list[str], no_facilities: bool = True) -> Column:
    """Large enough, without an excluded flag in the comma-joined flags, an excluded label, or a facility."""
    flagged = reduce(lambda a, b: a | b, [F.contains(F.coalesce(flags, F.lit("")), F.lit(f)) for f in bad_flags], F.lit(False))
    return (area >= least) & ~flagged & ~F.coalesce(label.isin(bad_labels), F.lit(False)) & ~(F.lit(no_facilities) & facility.isNotNull())


def tier(x: Column, steps: dict[int, float]) -> Column:
    """The greatest tier whose threshold x reaches; 0 below all."""
    return F.greatest(F.lit(0), *(F.when(x >= least, F.lit(t)).otherwise(F.lit(0)) for t, least in steps.items()))


def verdict(sim: Column, value: Column, low: Column, high: Column) -> Column:
    """'ok' within low..high or a ratio of 1.5, 'check' up to 3, else 'fail'; a range beats a single value."""
    by_range = F.when(sim.between(low, high), F.lit(1.0)).otherwise(F.greatest(low / sim, sim / high))
    ratio = F.when(low.isNotNull() & high.isNotNull(), by_range).otherwise(F.greatest(sim / value, value / sim))
    return first_match([(ratio <= 1.5, "ok"), (ratio <= 3, "check"), (ratio.isNotNull(), "fail")])


def criteria(places: Column, road: Column, density: Column, line: Column, wealth: Column, crops: Column, area: Column) -> dict[str, Column]:
    """Six scaled criteria in 0..1; nulls take the values that stand for 'none there'."""
    share = lambda x, top, none: F.least(F.coalesce(x, F.lit(none)) / top, F.lit(1.0))
    clip = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    return {
        "market_access": 0.5 * share(places, 10, 0) + 0.5 * (1 - share(road, 2000, 2000)),
        "demand_density": F.least(F.log10(1 + F.coalesce(density, F.lit(0))) / F.log10(F.lit(15001.0)), F.lit(1.0)),
        "grid_proximity": 1 - share(line, 5000, 5000),
        "ability_to_pay": F.when(wealth.isNotNull(), clip((wealth + 0.415) / (1.248 + 0.415))).otherwise(0.5),
        "agri_context": clip(F.coalesce(crops, F.lit(0.0))),
        "building_size": clip(F.log10(F.greatest(area, F.lit(20)) / 20) / F.log10(F.lit(25.0))),
    }


def weighted_score(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    """100 times the weighted mean of the parts with a weight."""
    used = {k: v for k, v in weights.items() if v}
    return 100 * reduce(lambda a, b: a + b, [parts[k] * v for k, v in used.items()]) / sum(used.values())


def overridden(df: DataFrame, overrides: DataFrame, id_col: str, value: str) -> DataFrame:
    """Rows whose id is excluded go; a value given for an id replaces the row's own; others stay.

    overrides: (id, value, exclude), at most one row an id; the greatest of each is taken of several.
    """
    by = overrides.groupBy(F.col(id_col).alias("_id")).agg(F.max("value").alias("_value"), F.max(F.col("exclude").cast("int")).alias("_out"))
    out = df.join(by, F.col(id_col) == F.col("_id"), "left").where("coalesce(_out, 0) = 0")
    return out.withColumn(value, F.coalesce("_value", value)).drop("_id", "_value", "_out")


def vector(probs: Column, classes: list[str]) -> Column:
    """A map of probabilities as an array in the fixed order of classes, over their sum; null for a sum of 0.

    Keys that begin with an underscore aren't classes, and missing classes have 0.
    """
    raw = F.array(*(F.coalesce(F.try_element_at(probs, F.lit(c)), F.lit(0.0)) for c in classes))
    total = F.aggregate(raw, F.lit(0.0), lambda s, x: s + x)
    return F.when(total > 0, F.transform(raw, lambda x: x / total))


def top_class(vec: Column, classes: list[str]) -> Column:
    """The class with the greatest share; the first in the order of classes on ties."""
    return F.element_at(F.array(*map(F.lit, classes)), F.array_position(vec, F.array_max(vec)).cast("int"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The old rows whose key isn't among the new ones, and the new rows."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def last_written(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key, the last by `order`; a combined maximum instead of a sort of each key's rows."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in others if c != order])).alias("r"))
    return best.select(*keys, *(F.col(f"r.{c}").alias(c) for c in others))


def reconciled(sides: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, missing): keys that some of the named tables lack, with the names of those, comma-joined in order.

    One union of distinct keys and one count per key, however many tables there are.
    """
    names = sorted(sides)
    rows = reduce(DataFrame.unionAll, [df.select(F.col(key), F.lit(n).alias("side")).distinct() for n, df in sides.items()])
    by = rows.groupBy(key).agg(F.collect_set("side").alias("has"))
    missing = F.array_except(F.array(*map(F.lit, names)), F.col("has"))
    return by.where(F.size(missing) > 0).select(key, F.array_join(F.array_sort(missing), ",").alias("missing"))
