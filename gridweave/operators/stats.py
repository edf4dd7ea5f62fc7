"""Weighted and survey statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def weighted_quantiles(df: DataFrame, group: str, value: str, weight: str, qs: list[float], slack: float = 1e-9) -> DataFrame:
    """(group, q, quantile): the first value whose cumulative weight reaches q of the total, for all q in one pass.

    Equal values are summed before the shuffle, so the running sums hold distinct values only.
    """
    own = df.groupBy(group, value).agg(F.sum(weight).alias("_w"))
    run = F.sum("_w").over(W.partitionBy(group).orderBy(value).rowsBetween(W.unboundedPreceding, 0))
    total = F.sum("_w").over(W.partitionBy(group))
    first = [F.min(F.when(F.col("_c") >= q * F.col("_t") - slack, F.col(value))).alias(f"_q{i}") for i, q in enumerate(qs)]
    by = own.withColumn("_c", run).withColumn("_t", total).groupBy(group).agg(*first)
    pairs = F.array(*(F.struct(F.lit(q).alias("q"), F.col(f"_q{i}").alias("quantile")) for i, q in enumerate(qs)))
    return by.select(group, F.explode(pairs).alias("_x")).select(group, "_x.q", "_x.quantile")


def suppressed(df: DataFrame, group: list[str], value: str, least: int = 10) -> DataFrame:
    """Counts and means of groups; the mean of a group under `least` rows is null."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.when(F.count(F.lit(1)) >= least, F.round(F.avg(value), 4)).alias("mean"))


def macro_f1(df: DataFrame, gold: str, guess: str) -> DataFrame:
    """Per class counts, precision, recall and F1; one shuffle of the confusion counts."""
    pairs = df.groupBy(gold, guess).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col(gold).alias("c"), F.lit(1).alias("g"), F.lit(0).alias("p")), F.struct(F.col(guess).alias("c"), F.lit(0).alias("g"), F.lit(1).alias("p")))).alias("s"), (F.col(gold) == F.col(guess)).alias("hit"), "n")
    out = sides.groupBy(F.col("s.c").alias("class")).agg(F.sum(F.col("s.g") * F.col("n")).alias("n_gold"), F.sum(F.col("s.p") * F.col("n")).alias("n_guess"), F.sum(F.when(F.col("hit"), F.col("s.g") * F.col("n")).otherwise(0)).alias("n_hit"))
    return out.withColumn("f1", F.round(2 * F.col("n_hit") / F.nullif(F.col("n_gold") + F.col("n_guess"), F.lit(0)), 6))


def calibration_error(df: DataFrame, confidence: str, hit: str, bins: int = 10) -> DataFrame:
    """Bins of confidence with their share of hits, mean confidence and weighted gap."""
    own = df.withColumn("bin", F.least(F.floor(F.col(confidence) * bins), F.lit(bins - 1)).cast("int"))
    return own.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col(hit).cast("double")), 6).alias("accuracy"), F.round(F.avg(confidence), 6).alias("confidence"))


def weighted_auc(df: DataFrame, group: str, score: str, hit: str, weight: str) -> DataFrame:
    """(group, auc, brier): the weighted area under the curve, with equal scores at their middle rank, and the squared gap.

    Rows are summed by score before they are ranked, so the ranking holds distinct scores only.
    """
    y, s, wt = F.col(hit).cast("double"), F.col(score), F.col(weight)
    own = df.groupBy(group, score).agg(F.sum(wt * y).alias("_p"), F.sum(wt * (1 - y)).alias("_q"), F.sum(wt * (s - y) * (s - y)).alias("_e"))
    under = F.coalesce(F.sum("_q").over(W.partitionBy(group).orderBy(score).rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    area = F.sum(F.col("_p") * (F.col("_u") + F.col("_q") / 2)) / F.nullif(F.sum("_p") * F.sum("_q"), F.lit(0.0))
    return own.withColumn("_u", under).groupBy(group).agg(area.alias("auc"), (F.sum("_e") / F.sum(F.col("_p") + F.col("_q"))).alias("brier"))


def entropy(df: DataFrame, group: str, label: str) -> DataFrame:
    """(group, n, k, entropy): rows, distinct labels, and the entropy of labels over its greatest value; 0 for one label."""
    own = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("_n"))
    sums = own.groupBy(group).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.col("_n") * F.ln("_n")).alias("_s"))
    return sums.select(group, "n", "k", F.when(F.col("k") > 1, (F.ln("n") - F.col("_s") / F.col("n")) / F.ln("k")).otherwise(0.0).alias("entropy"))
