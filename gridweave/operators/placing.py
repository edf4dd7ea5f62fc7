"""Placing establishments, households and wealth under district targets, stage after stage.

The state is one row per building: `use` (class), `est` (establishment), `est_w` (its share of one), `source`, and what
later stages add. A stage sees free buildings only. Ranks and running sums go through `picks`, whose pieces keep any
district from being sorted in one task; each stage is checkpointed, so plans stay short and lost work is reread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import settled
from . import picks

FREE = "use IS NULL AND est IS NULL"


@dataclass(frozen=True)
class Stage:
    """One item to place: an establishment `profile` of a class, up to `target` (a column of the district table).

    `pool` and `score` are expressions over a building's columns; at most `cap` of a cell, doubled for a district that
    falls short. `spaced` off means no cap.
    """

    item: str
    profile: str
    cls: str
    pool: Column
    score: Column
    source: str
    cell: str = "cell"
    cap: int = 1
    spaced: bool = True


def _taken(df: DataFrame, ids: DataFrame, id_col: str, **put: Column) -> DataFrame:
    """Sets columns of the rows whose id is among ids."""
    marked = df.join(ids.select(F.col(id_col).alias("_id")), F.col(id_col) == F.col("_id"), "left")
    for name, value in put.items():
        marked = marked.withColumn(name, F.when(F.col("_id").isNotNull(), value).otherwise(F.col(name)))
    return marked.drop("_id")


def place(df: DataFrame, targets: DataFrame, stage: Stage, district: str = "district", id_col: str = "bldg_id") -> tuple[DataFrame, DataFrame]:
    """(state, report): the best free buildings of the pool take the item until each district meets its target.

    targets: (district, item, target). What tags have placed already counts, as the rounded sum of shares (halves to
    even); need is never below 0. A report row says target, tagged, assigned and shortfall; districts without a target
    have one of 0. Ties go to the lesser id, rows without a district are never taken.
    """
    own = targets.where(F.col("item") == stage.item).select(F.col(district).alias("_d"), "target")
    tagged = df.groupBy(district).agg(F.bround(F.sum(F.when(F.col("est") == stage.profile, F.col("est_w")).otherwise(0.0))).cast("long").alias("tagged"))
    need = tagged.join(own, F.col(district) == F.col("_d"), "left").select(district, "tagged", F.coalesce("target", F.lit(0)).cast("long").alias("target"))
    need = settled(need.withColumn("_need", F.greatest(F.col("target") - F.col("tagged"), F.lit(0))))
    pool = df.where(FREE).where(stage.pool).select(id_col, district, F.col(stage.cell).alias("_cell"), stage.score.alias("_score")).join(need.select(district, "_need"), district)
    if stage.spaced:
        ids = picks.take_spaced(pool, district, "_cell", "_score", "_need", id_col, stage.cap)
    else:
        ids = picks.take_top(pool, district, "_score", "_need", id_col)
    ids = settled(ids.select(id_col, F.col(district).alias("_d")))
    out = settled(_taken(df, ids, id_col, use=F.lit(stage.cls), est=F.lit(stage.profile), source=F.lit(stage.source)))
    got = ids.groupBy("_d").agg(F.count(F.lit(1)).alias("assigned"))
    report = need.join(got, F.col(district) == F.col("_d"), "left").withColumn("assigned", F.coalesce("assigned", F.lit(0)))
    short = F.greatest(F.col("_need") - F.col("assigned"), F.lit(0))
    return out, report.select(district, F.lit(stage.item).alias("item"), "target", "tagged", "assigned", short.alias("shortfall"))


def compounds(df: DataFrame, member: Column, facility: str, profile: Column, cls: str, source: Column) -> DataFrame:
    """Members of a facility's compound share its profile: each holds 1/n of it, by a count per facility."""
    own = df.withColumn("_m", F.coalesce(member, F.lit(False)))
    n = own.where("_m").groupBy(F.col(facility).alias("_f")).agg(F.count(F.lit(1)).alias("_n"))
    out = own.join(n, F.col("_m") & (F.col(facility) == F.col("_f")), "left")
    for name, value in (("est", profile), ("use", F.lit(cls)), ("source", source), ("est_w", 1 / F.col("_n"))):
        out = out.withColumn(name, F.when(F.col("_m"), value).otherwise(F.col(name)))
    return out.drop("_m", "_f", "_n")


def households(df: DataFrame, targets: DataFrame, home: Column, score: Column, capacity: Column, urban: str = "urban", district: str = "district", id_col: str = "bldg_id") -> DataFrame:
    """Adds `households`: the urban pool, then the rural one, and what a pool couldn't hold goes to homes left empty.

    targets: (district, total, town, country), the last two for the pools; missing ones are 0.
    """
    out = df.join(targets.select(F.col(district).alias("_d"), "total", "town", "country"), F.col(district) == F.col("_d"), "left").drop("_d").withColumn("households", F.lit(0).cast("long"))
    out = out.withColumn("_home", F.coalesce(home, F.lit(False))).withColumn("_score", score).withColumn("_cap", capacity)
    for pool, need in (("_home AND urban", "town"), ("_home AND NOT urban", "country"), (None, None)):
        if pool is None:
            had = out.groupBy(F.col(district).alias("_d")).agg(F.sum("households").alias("_had"))
            out = out.join(had, F.col(district) == F.col("_d"), "left").withColumn("_short", F.greatest(F.col("total") - F.col("_had"), F.lit(0))).drop("_d", "_had")
            pool, need = "_home AND households = 0", "_short"
        filled = picks.fill(out.where(pool.replace("urban", urban)).where(F.col(need) > 0).select(id_col, district, "_score", "_cap", F.col(need).alias("_need")), district, "_score", "_cap", "_need", id_col)
        got = filled.where("units > 0").select(F.col(id_col).alias("_id"), F.col("units").cast("long").alias("_u"))
        out = settled(out.join(got, F.col(id_col) == F.col("_id"), "left").withColumn("households", F.coalesce("_u", "households")).drop("_id", "_u"))
    return out.drop("_home", "_score", "_cap", "_short", "total", "town", "country")


def weight_rows(df: DataFrame, id_col: str = "bldg_id") -> DataFrame:
    """(id, profile_id, units): a row for the households of a building and one for its share of an establishment."""
    home = df.where("households > 0").select(id_col, F.col("household_profile").alias("profile_id"), F.col("households").cast("double").alias("units"))
    return home.unionAll(df.where("est IS NOT NULL").select(id_col, F.col("est").alias("profile_id"), F.col("est_w").alias("units")))
