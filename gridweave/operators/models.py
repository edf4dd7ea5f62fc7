"""Models of use and of connection: weighted classes, shares as two weighted rows, folds by area, choice by held-out loss."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HELD = 1e-6  # how far probabilities are held off 0 and 1 when a loss is taken


def _prepared(features: list[str]) -> list:
    """Missing numbers take the median; whether they were missing is told by the caller's own columns."""
    filled = [f"_filled_{f}" for f in features]
    return [Imputer(inputCols=features, outputCols=filled, strategy="median"), VectorAssembler(inputCols=filled, outputCol="_vector"), StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=True)]


def class_weights(df: DataFrame, label: str, power: float = 0.5, cap: float = 10.0) -> DataFrame:
    """df with _w: (count of the most frequent class / the class's own) to a power, capped."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    w = n.join(F.broadcast(n.agg(F.max("_n").alias("_m")))).select(label, F.least(F.pow(F.col("_m") / F.col("_n"), F.lit(power)), F.lit(cap)).alias("_w"))
    return df.join(w, label)


def fit_classes(df: DataFrame, features: list[str], label: str, trees: int = 20, depth: int = 6, seed: int = 7) -> PipelineModel:
    """A forest over classes 0..k-1 with class weights; trained where the rows are."""
    forest = RandomForestClassifier(labelCol=label, featuresCol="_scaled", weightCol="_w", numTrees=trees, maxDepth=depth, seed=seed, predictionCol="_c")
    return Pipeline(stages=[*_prepared(features), forest]).fit(class_weights(df, label))


def class_scores(model: PipelineModel, df: DataFrame, id_col: str) -> DataFrame:
    """(id, probs, top): probabilities in the order of classes, and the first class with the greatest."""
    p = vector_to_array("probability")
    return model.transform(df).select(id_col, p.alias("probs"), (F.array_position(p, F.array_max(p)) - 1).cast("int").alias("top"))


def two_rows(df: DataFrame, yes: str, n: str) -> DataFrame:
    """Each share as a row of label 1 weighing its yes and one of label 0 weighing the rest; empty ones go."""
    return df.withColumn("_t", F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col(yes).cast("double").alias("w")), F.struct(F.lit(0.0).alias("y"), (F.col(n) - F.col(yes)).cast("double").alias("w"))))).select("*", "_t.y", "_t.w").drop("_t").where("w > 0")


def fit_share(df: DataFrame, features: list[str], yes: str, n: str, kind: str = "logistic", seed: int = 7) -> PipelineModel:
    """Binomial likelihood of shares: logistic, or boosted trees."""
    rows = two_rows(df, yes, n)
    total = rows.agg(F.sum("w")).first()[0] or 1.0
    if kind == "logistic":
        model = LogisticRegression(labelCol="y", featuresCol="_scaled", weightCol="w", regParam=1 / total, predictionCol="_c")
    else:
        model = GBTClassifier(labelCol="y", featuresCol="_scaled", weightCol="w", maxIter=15, maxDepth=3, seed=seed, predictionCol="_c")
    return Pipeline(stages=[*_prepared(features), model]).fit(rows)


def share_losses(df: DataFrame, p: str, yes: str, n: str) -> DataFrame:
    """The log loss of a share's predictions by weight, and the Brier score: one row."""
    q = F.least(F.greatest(F.col(p), F.lit(HELD)), F.lit(1 - HELD))
    loss = -(F.col(yes) * F.ln(q) + (F.col(n) - F.col(yes)) * F.ln(1 - q))
    gap = F.col(yes) * (1 - q) * (1 - q) + (F.col(n) - F.col(yes)) * q * q
    return df.agg((F.sum(loss) / F.sum(n)).alias("logloss"), (F.sum(gap) / F.sum(n)).alias("brier"))


def cross_validated(df: DataFrame, features: list[str], yes: str, n: str, fold: str, folds: int, kinds: tuple[str, ...] = ("logistic", "boosted")) -> DataFrame:
    """(model, logloss, brier) on held-out folds: each kind, the other folds' share ('baseline'), and the own share ('ceiling').

    Folds are of areas, so no area is on both sides. `folds` models of each kind are fitted, one after the other.
    """
    out = []
    for kind in kinds:
        parts = [fit_share(df.where(F.col(fold) != f), features, yes, n, kind).transform(df.where(F.col(fold) == f)).select(yes, n, vector_to_array("probability")[1].alias("p")) for f in range(folds)]
        out.append(share_losses(reduce(DataFrame.unionAll, parts), "p", yes, n).select(F.lit(kind).alias("model"), "*"))
    sums = df.groupBy(fold).agg(F.sum(yes).alias("_y"), F.sum(n).alias("_n"))
    all_ = sums.agg(F.sum("_y").alias("_ay"), F.sum("_n").alias("_an"))
    base = df.join(F.broadcast(sums), fold).join(F.broadcast(all_)).withColumn("p", (F.col("_ay") - F.col("_y")) / F.greatest(F.col("_an") - F.col("_n"), F.lit(1)))  # a row per fold
    out.append(share_losses(base, "p", yes, n).select(F.lit("baseline").alias("model"), "*"))
    out.append(share_losses(df.withColumn("p", F.col(yes) / F.col(n)), "p", yes, n).select(F.lit("ceiling").alias("model"), "*"))
    return reduce(DataFrame.unionAll, out)


def best_model(scores: DataFrame) -> str:
    """The name of the fitted kind with the least held-out log loss."""
    return scores.where("model NOT IN ('baseline', 'ceiling')").orderBy("logloss", "model").first()["model"]


def importance(model: PipelineModel, df: DataFrame, features: list[str], label: str, id_col: str) -> DataFrame:
    """(feature, loss): how much accuracy falls when a feature's values are dealt anew by a hashed order.

    Values move by one place along the hash order of each of 64 slices, so no slice is one task's whole table.
    """
    from pyspark.sql import Window as W

    hit = lambda d: model.transform(d).agg(F.avg((F.col("_c") == F.col(label)).cast("int"))).first()[0]
    own, rows = hit(df), []
    for f in features:
        w = W.partitionBy(F.pmod(F.xxhash64(id_col), F.lit(64))).orderBy(F.xxhash64(F.lit(f), F.col(id_col)), id_col)
        moved = F.coalesce(F.lag(f).over(w), F.last(f).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        rows.append((f, own - hit(df.withColumn(f, moved))))
    return df.sparkSession.createDataFrame(rows, "feature string, loss double")
