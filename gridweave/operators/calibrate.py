"""Meeting known totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import settled


def prior_factors(df: DataFrame, cls: str, weight: str, want: dict[str, float], cap: float = 50.0) -> DataFrame:
    """Per class the share wanted over the share had, at most cap; 0 where nothing is had."""
    have = df.groupBy(cls).agg(F.sum(weight).alias("_h"))
    total = have.agg(F.sum("_h").alias("_t"))
    target = F.coalesce(*(F.when(F.col(cls) == k, F.lit(v)) for k, v in want.items()), F.lit(0.0))
    share = F.col("_h") / F.col("_t")
    return have.join(F.broadcast(total)).select(cls, F.round(F.when(share > 0, F.least(target / share, F.lit(cap))).otherwise(0.0), 6).alias("factor"))


def ratio_raking(df: DataFrame, region: str, value: Column, target: DataFrame) -> DataFrame:
    """(region, total, target, scale): what a region's values are multiplied with to meet its target."""
    have = df.groupBy(region).agg(F.sum(value).alias("total"))
    return have.join(target, region, "left").withColumn("scale", F.col("target") / F.nullif(F.col("total"), F.lit(0.0)))


def logit_shift(df: DataFrame, region: str, prob: str, target: DataFrame, reach: float = 15.0, passes: int = 6, parts: int = 64) -> DataFrame:
    """(region, shift): what is added to the logit of each probability so that a region's mean meets its target.

    target: one row per region, (region, target). Equal probabilities of a region are counted once, and that table is
    written; each pass sums the shifted shares at parts - 1 points between the bounds, keeps the one interval that holds
    the target, and writes a row a region. No group is collected, so a region may hold any number of rows.
    Probabilities of 0 and 1 stay as they are, null ones and regions without a target are ignored.
    """
    own = settled(df.where(F.col(prob).isNotNull()).groupBy(region, prob).agg(F.count(F.lit(1)).alias("_n")))
    bounds = target.select(region, "target", F.lit(-reach).alias("_lo"), F.lit(reach).alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / parts
    odds = F.col(prob) / (1 - F.col(prob))
    for _ in range(passes):
        tried = own.join(bounds, region).withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(parts - 1))))
        sums = tried.groupBy(region, "_k", "target", "_lo", "_hi").agg((F.sum(F.col("_n") * _shifted(odds, F.col("_lo") + step * F.col("_k"))) < F.col("target") * F.sum("_n")).alias("_below"))
        found = sums.groupBy(region, "target", "_lo", "_hi").agg(F.count_if("_below").alias("_k"))
        lo = F.col("_lo") + step * F.col("_k")
        bounds = settled(found.select(region, "target", lo.alias("_lo"), (lo + step).alias("_hi")))
    return bounds.select(region, ((F.col("_lo") + F.col("_hi")) / 2).alias("shift"))


def _shifted(odds: Column, by: Column) -> Column:
    return F.when(odds.isNull(), 1.0).when(odds == 0, 0.0).otherwise(1 / (1 + F.exp(-by) / odds))


def best_threshold(df: DataFrame, value: str, truth: Column, grid: list[float]) -> DataFrame:
    """(threshold, score): the threshold of the grid with the best balanced accuracy, the least one on ties; one pass."""
    yes, no = F.count_if(truth), F.count_if(~truth)
    tried = [F.struct((-(F.count_if(truth & (F.col(value) >= t)) / yes + F.count_if(~truth & (F.col(value) < t)) / no) / 2).alias("loss"), F.lit(float(t)).alias("t")) for t in grid]
    best = F.array_min(F.array(*tried))
    return df.agg(best.alias("b")).select(F.col("b.t").alias("threshold"), F.round(-F.col("b.loss"), 6).alias("score"))
