"""Contract queries of trained models. SQL can't express them; the tests hold them against what a model must reach."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models
from .core import buildings


def use_class_scores(spark, sf_dir):
    """Class probabilities of every building from a forest that is trained on tagged buildings alone."""
    k = F.col("bldg_id")
    b = buildings(spark, sf_dir).select("bldg_id", F.col("area").cast("double").alias("area"), F.col("floors").cast("double").alias("floors"), F.when(k % 9 > 0, F.col("score")).alias("score"), F.when(F.col("area") > 120, 2).when(F.col("floors") > 2, 1).otherwise(0).cast("double").alias("label"))
    model = models.fit_classes(b.where("bldg_id % 3 > 0"), ["area", "floors", "score"], "label")
    out = models.class_scores(model, b, "bldg_id")
    return out.select("bldg_id", "top", *(F.round(F.col("probs")[i], 6).alias(f"p{i}") for i in range(3)))


def connection_cross_validation(spark, sf_dir):
    """Held-out losses of two kinds of model, a baseline and the ceiling, with folds of districts."""
    b = buildings(spark, sf_dir).groupBy("district", "cls").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("floors") > 2).alias("yes"), F.avg("area").alias("area"), F.avg("floors").alias("floors"))
    df = b.withColumn("fold", F.pmod(F.xxhash64("district"), F.lit(3)).cast("int"))
    out = models.cross_validated(df, ["area", "floors"], "yes", "n", "fold", 3)
    return out.select("model", F.round("logloss", 5).alias("logloss"), F.round("brier", 5).alias("brier"))


ORACLE: dict[str, str] = {}
QUERIES = {f.__name__: f for f in (use_class_scores, connection_cross_validation)}
