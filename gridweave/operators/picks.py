"""Ranked picks under limits. Every ranking ends with an id, so ties are settled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


RUNS = 64  # pieces that a group's order is cut into


def running(df: DataFrame, group: str, order: str, size: Column, id_col: str, falling: bool = True, runs: int = RUNS) -> DataFrame:
    """Adds _before, the sum of `size` over earlier rows of the group, and _total, its sum over the whole group.

    Rows go by `order` (a number or a time; nulls last), then by id. A group isn't sorted in one task: its order is cut
    at approximate quantiles, pieces are summed (at most runs + 2 sums a group), and each piece is sorted by itself.
    The cuts only balance the work; the result is exact. Rows of a group with one and the same `order` stay together.
    Null sizes count as zero; rows without a group are a group.
    """
    value, columns = F.col(order), df.columns
    cuts = df.groupBy(F.col(group).alias("_g")).agg(F.percentile_approx(value, [k / runs for k in range(1, runs)], 1000).alias("_cuts"))
    earlier = F.size(F.filter("_cuts", (lambda c: c > value) if falling else (lambda c: c < value)))
    cut = df.join(cuts, F.col(group).eqNullSafe(F.col("_g"))).withColumn("_size", F.coalesce(size, F.lit(0)))
    cut = cut.withColumn("_run", F.when(value.isNull(), runs + 1).otherwise(earlier)).select(*columns, "_size", "_run")
    sums = cut.groupBy(F.col(group).alias("_g"), F.col("_run").alias("_r")).agg(F.sum("_size").alias("_sum"))
    each = W.partitionBy("_g")
    sums = sums.withColumn("_total", F.sum("_sum").over(each)).withColumn("_base", F.sum("_sum").over(each.orderBy("_r")) - F.col("_sum"))
    ends = (F.desc_nulls_last if falling else F.asc_nulls_last)(order)
    own = F.sum("_size").over(W.partitionBy(group, "_run").orderBy(ends, id_col).rowsBetween(W.unboundedPreceding, 0)) - F.col("_size")
    out = cut.withColumn("_own", own).join(sums, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_run") == F.col("_r")))
    return out.select(*columns, (F.col("_base") + F.col("_own")).alias("_before"), "_total")


def take_top(df: DataFrame, group: str, score: str, need: str, id_col: str) -> DataFrame:
    """The `need` best rows of each group; need is a column that is constant within a group."""
    ranked = running(df, group, score, F.lit(1), id_col).withColumn("rank", F.col("_before") + 1)
    return ranked.where(F.col("rank") <= F.col(need)).drop("_before", "_total")


def ranked_in_cells(df: DataFrame, group: str, cell: str, score: str, id_col: str) -> DataFrame:
    """Adds in_cell: the rank of a row among those of its group and cell."""
    return df.withColumn("in_cell", F.row_number().over(W.partitionBy(group, cell).orderBy(F.desc_nulls_last(score), id_col)))


def take_spaced(df: DataFrame, group: str, cell: str, score: str, need: str, id_col: str, cap: int | str, doublings: int = 8) -> DataFrame:
    """take_top() with at most `cap` rows of a cell; a group that falls short gets twice the cap, up to `doublings` times.

    A row's rank within its cell is fixed, so the least sufficient cap follows from one count of ranks per group, and
    nothing is tried in turn. cap may be the name of a column that is constant within a group; rows that have their
    rank, in_cell, keep it.
    """
    ranked = df if "in_cell" in df.columns else ranked_in_cells(df, group, cell, score, id_col)
    first = F.col(cap) if isinstance(cap, str) else F.lit(cap)
    counts = [F.count_if(F.col("in_cell") <= first * 2**k).alias(f"n{k}") for k in range(doublings)]
    caps = ranked.groupBy(group).agg(F.max(need).alias("_need"), F.max(first).alias("_first"), *counts)
    fit = F.col("_first") * 2**doublings
    for k in reversed(range(doublings)):
        fit = F.when(F.col(f"n{k}") >= F.col("_need"), F.col("_first") * 2**k).otherwise(fit)
    caps = caps.select(group, fit.cast("long").alias("cap"))
    return take_top(ranked.drop("cap").join(caps, group).where("in_cell <= cap"), group, score, need, id_col)


def fill(df: DataFrame, group: str, score: str, capacity: str, need: str, id_col: str) -> DataFrame:
    """Hands out `need` units in order of score; each row takes up to its capacity, the last one what is left."""
    left = F.greatest(F.col(need) - F.col("_before"), F.lit(0))
    return running(df, group, score, F.col(capacity), id_col).withColumn("units", F.least(F.coalesce(F.col(capacity), F.lit(0)), left)).drop("_before", "_total")


def prefix_share(df: DataFrame, group: str, order: str, size: str, share: Column, id_col: str, falling: bool = True) -> DataFrame:
    """Flags rows, in order, until they hold the share of the group's size: a row counts if less than that is before it."""
    return running(df, group, order, F.col(size), id_col, falling).withColumn("flag", F.col("_before") < share * F.col("_total")).drop("_before", "_total")


def terciles(df: DataFrame, group: str, order: str, id_col: str) -> DataFrame:
    """Quantile thirds of ranks, with edges at 1 + (n-1)/3 and 1 + 2(n-1)/3; unlike ntile() where 3 doesn't divide n."""
    out = running(df, group, order, F.lit(1), id_col, falling=False).withColumnRenamed("_before", "_r").withColumnRenamed("_total", "_n").withColumn("_r", F.col("_r") + 1)
    edge = lambda k: 1 + k * (F.col("_n") - 1) / 3 - 1e-9
    return out.withColumn("third", F.when(F.col("_r") <= edge(1) + 1e-9 * 2, 0).when(F.col("_r") <= edge(2) + 1e-9 * 2, 1).otherwise(2)).drop("_r", "_n")
