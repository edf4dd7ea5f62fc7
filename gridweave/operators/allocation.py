"""Handing rows out in stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Stage = tuple[str, Column, Column, Column]


def staged(df: DataFrame, group: str, id_col: str, stages: list[Stage]) -> DataFrame:
    """Adds `stage`: the name of the first stage that takes a row, else null.

    A stage is (name, eligible, score, need): in each group it takes the `need` best eligible rows that earlier stages
    left, the lesser id on ties. All stages rank within the same groups, so the rows are shuffled once.
    """
    out = df.withColumn("stage", F.lit(None).cast("string"))
    for name, eligible, score, need in stages:
        free = F.col("stage").isNull() & F.coalesce(eligible, F.lit(False))
        rank = F.row_number().over(W.partitionBy(group).orderBy(free.desc(), score.desc_nulls_last(), id_col))
        out = out.withColumn("_rank", rank).withColumn("stage", F.when(free & (F.col("_rank") <= need), F.lit(name)).otherwise(F.col("stage"))).drop("_rank")
    return out
