"""Series of grid nodes brought to places: daily values, lapse rate, bilinear corners, thresholds after the shift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import settled


def daily(hours: DataFrame, node: list[str], ts: str, value: str) -> DataFrame:
    """(node, day, mean, top) of whole-number values; sums are exact, so their order doesn't matter."""
    return hours.groupBy(*node, F.to_date(ts).alias("day")).agg((F.sum(value) / F.count(F.lit(1))).alias("mean"), F.max(value).cast("double").alias("top"))


def lapse_rate(days: DataFrame, node: list[str], elevation: str, value: str) -> DataFrame:
    """(slope, intercept) of the nodes' mean values over their elevation: one row."""
    by = days.groupBy(*node, elevation).agg(F.avg(value).alias("m"))
    return by.agg(F.regr_slope("m", elevation).alias("slope"), F.regr_intercept("m", elevation).alias("intercept"))


def humidity(t: Column, dew: Column) -> Column:
    """Relative humidity in per cent, 0 to 100; fixed values of the Magnus formula."""
    es = lambda x: F.exp(F.lit(17.625) * x / (F.lit(243.04) + x))
    return F.least(F.greatest(100 * es(dew) / es(t), F.lit(0.0)), F.lit(100.0))


def corners(places: DataFrame, id_col: str) -> DataFrame:
    """(id, elev, i, j, w): the grid nodes around each place (x, y), with bilinear weights over 0."""
    x, y = F.col("x"), F.col("y")
    ends = F.array(*(F.struct((F.floor(x) + a).alias("i"), (F.floor(y) + b).alias("j")) for a in (0, 1) for b in (0, 1)))
    out = places.select(id_col, "elev", "x", "y", F.explode(ends).alias("c")).select(id_col, "elev", "x", "y", "c.*")
    return out.select(id_col, "elev", "i", "j", ((1 - F.abs(x - F.col("i"))) * (1 - F.abs(y - F.col("j")))).alias("w")).where("w > 0")


def composite(places: DataFrame, days: DataFrame, id_col: str, bases: list[float]) -> DataFrame:
    """(id, mean, top_p95, over_<base>, days): nodes' daily series at each place, shifted by the lapse rate from the grid's
    elevation to the place's before any threshold is taken; degree days are summed by year and averaged over years.

    places: (id, x, y, elev) on the node grid; days: (i, j, day, mean, top, elev). A place is dealt to its four nodes, so
    the join is on nodes and days; weights of absent nodes are left out and the others scaled.
    """
    own = corners(places, id_col)
    nodes = days.select("i", "j", F.col("elev").alias("node_elev")).distinct()
    fit = lapse_rate(days, ["i", "j"], "elev", "mean")
    near = own.join(nodes, ["i", "j"])
    shift = near.groupBy(id_col).agg(F.sum(F.col("w") * F.col("node_elev")).alias("grid"), F.first("elev").alias("elev")).join(F.broadcast(fit))  # one row
    shift = shift.select(id_col, ((F.col("elev") - F.col("grid")) * F.col("slope")).alias("shift"))
    at = own.drop("elev").join(days, ["i", "j"]).groupBy(id_col, "day").agg(*((F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(c) for c in ("mean", "top")))
    series = settled(at.join(shift, id_col).select(id_col, "day", (F.col("mean") + F.col("shift")).alias("mean"), (F.col("top") + F.col("shift")).alias("top")))
    over = [f"over_{b:g}" for b in bases]
    years = series.groupBy(id_col, F.year("day").alias("y")).agg(*(F.sum(F.greatest(F.col("mean") - b, F.lit(0.0))).alias(c) for b, c in zip(bases, over, strict=True)))
    years = years.groupBy(id_col).agg(*(F.avg(c).alias(c) for c in over))
    return series.groupBy(id_col).agg(F.avg("mean").alias("mean"), F.percentile("top", F.lit(0.95)).alias("top_p95"), F.count(F.lit(1)).alias("days")).join(years, id_col)


def looked_up(df: DataFrame, known: DataFrame, keys: list[str], digits: int, value: str) -> DataFrame:
    """Adds `value` by rounded keys; raises if a row has none."""
    own = df.select(*(F.round(k, digits).alias(k) for k in keys))
    side = known.select(*(F.round(k, digits).alias(k) for k in keys), value).groupBy(*keys).agg(F.first(value).alias(value))
    out = own.join(side, keys, "left")
    missing = out.where(F.col(value).isNull()).count()
    if missing:
        raise ValueError(f"{missing} rows have no recorded {value}")
    return out
