"""Load curves of buildings from weights and a library of hourly profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOURS = range(24)
PROFILES = 23


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profile_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(bldg_id, profile_id, units, p_grid): a building's units of each profile, and the share on the grid."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount")
    own = li.groupBy(F.col("l_orderkey").alias("bldg_id"), (F.col("l_partkey") % PROFILES).alias("profile_id"))
    return own.agg(F.sum("l_quantity").alias("units"), (1 - F.avg("l_discount")).alias("p_grid"))


def watts(profile: Column, hour: int) -> Column:
    """The profile library by its formula: hourly watts of one unit."""
    evening = F.when(profile % 3 == 0, 50).otherwise(0) if 18 <= hour <= 22 else F.lit(0)
    return (F.lit(10) + (profile * 31 + hour * 17) % 100 + evening).cast("double")


def hourly(weights: DataFrame, *keys: str) -> DataFrame:
    """Summed hourly watts w0..w23 by keys: 24 sums that are combined before the one shuffle."""
    return weights.groupBy(*keys).agg(*(F.sum(F.col("units") * watts(F.col("profile_id"), h)).alias(f"w{h}") for h in HOURS))


def curve_metrics(curves: DataFrame, *keys: str) -> DataFrame:
    """Peak, first hour of the peak, load factor, evening share and daily energy of a curve w0..w23."""
    w = [F.col(f"w{h}") for h in HOURS]
    total, peak = sum(w[1:], w[0]), F.greatest(*w)
    peak_hour = F.coalesce(*(F.when(w[h] == peak, F.lit(h)) for h in HOURS))
    evening = sum((w[h] for h in range(19, 23)), w[18])
    return curves.select(
        *keys,
        F.round(peak, 4).alias("peak_w"),
        peak_hour.alias("peak_hour"),
        F.round(total / 24 / F.nullif(peak, F.lit(0.0)), 6).alias("load_factor"),
        F.round(evening / F.nullif(total, F.lit(0.0)), 6).alias("evening_share"),
        F.round(total / 1000, 6).alias("daily_kwh"),
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per building: the metrics of its summed load curve.

    A building's rows are few, so its units needn't be summed by profile first: one combined sum, and one shuffle.
    """
    li = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("bldg_id"), (F.col("l_partkey") % PROFILES).alias("profile_id"), F.col("l_quantity").alias("units"))
    return curve_metrics(hourly(li, "bldg_id"), "bldg_id")


W_SQL = """w AS (
  SELECT l_orderkey AS bldg_id, l_partkey % 23 AS profile_id, sum(l_quantity) AS units, 1 - avg(l_discount) AS p_grid
  FROM lineitem GROUP BY ALL)"""
LIB_SQL = """lib AS (
  SELECT p AS profile_id, h AS hour, (10 + (p * 31 + h * 17) % 100 + CASE WHEN h BETWEEN 18 AND 22 AND p % 3 = 0 THEN 50 ELSE 0 END)::DOUBLE AS watt
  FROM range(23) a(p), range(24) b(h))"""
ORACLE = {
    "load_curve_metrics": f"""WITH {W_SQL}, {LIB_SQL},
c AS (SELECT bldg_id, hour, sum(units * watt) AS w FROM w JOIN lib USING (profile_id) GROUP BY ALL)
SELECT bldg_id, round(max(w), 4) AS peak_w, min_by(hour, (-w, hour))::INT AS peak_hour,
  round(sum(w) / 24 / nullif(max(w), 0), 6) AS load_factor,
  round(sum(CASE WHEN hour BETWEEN 18 AND 22 THEN w ELSE 0 END) / nullif(sum(w), 0), 6) AS evening_share,
  round(sum(w) / 1000, 6) AS daily_kwh
FROM c GROUP BY bldg_id"""
}
QUERIES = {"load_curve_metrics": flagship}
