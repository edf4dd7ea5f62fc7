"""Regular series by node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def complete(df: DataFrame, node: str, at: str, step: str) -> DataFrame:
    """Every node at every step between its first and its last one; values of absent steps are null."""
    ends = df.groupBy(node).agg(F.min(at).alias("_a"), F.max(at).alias("_b"))
    grid = ends.select(node, F.explode(F.expr(f"sequence(_a, _b, INTERVAL {step})")).alias(at))
    return grid.join(df, [node, at], "left")


def fill_short_gaps(df: DataFrame, node: str, at: str, value: str, most: int) -> DataFrame:
    """Fills runs of up to `most` nulls between two values, in a straight line; longer and outer runs stay null."""
    w = W.partitionBy(node).orderBy(at)
    back, on = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.col("_i"))
    out = df.withColumn("_i", F.row_number().over(w))
    out = out.withColumn("_p", F.last(known, True).over(back)).withColumn("_u", F.last(value, True).over(back))
    out = out.withColumn("_q", F.first(known, True).over(on)).withColumn("_v", F.first(value, True).over(on))
    line = F.col("_u") + (F.col("_v") - F.col("_u")) * (F.col("_i") - F.col("_p")) / (F.col("_q") - F.col("_p"))
    fits = F.col("_q") - F.col("_p") - 1 <= most
    return out.withColumn(value, F.when(F.col(value).isNull() & fits, line).otherwise(F.col(value))).drop("_i", "_p", "_q", "_u", "_v")
