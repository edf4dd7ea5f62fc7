"""Labels from answers, cues of a neighbourhood, claims in text, and evidence that is cited by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

URL = r"(?i)https?://[^\s)\]]+|\b[a-z0-9-]+(?:\.[a-z0-9-]+)*\.(?:org|com|net|int|edu|gov)\b"


def parsed_labels(df: DataFrame, keys: list[str], answer: str, refused: Column, order: str) -> DataFrame:
    """(keys, label, confidence, abstain) of JSON answers {label, probs, abstain}; the last by `order` wins.

    A refusal, or an answer that isn't such JSON, is 'unknown' without a confidence, and abstains. The confidence is the
    label's share of all probabilities, 1 at most; it is 0 if the label has none.
    """
    j = F.from_json(answer, "label string, probs map<string,double>, abstain boolean")
    own = df.withColumn("_j", F.when(~refused, j))
    ok = F.col("_j.label").isNotNull() & F.col("_j.probs").isNotNull()
    total = F.aggregate(F.map_values("_j.probs"), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    share = F.least(F.lit(1.0), F.coalesce(F.try_element_at("_j.probs", F.col("_j.label")), F.lit(0.0)) / F.when(total == 0, 1.0).otherwise(total))
    row = F.struct(order, F.when(ok, F.col("_j.label")).otherwise("unknown").alias("label"), F.when(ok, share).alias("confidence"), F.when(ok, F.coalesce("_j.abstain", F.lit(False))).otherwise(True).alias("abstain"))
    return own.groupBy(*keys).agg(F.max(row).alias("r")).select(*keys, "r.label", "r.confidence", "r.abstain")


def cheapest_within(scores: DataFrame, score: str, cost: str, name: str, tolerance: float) -> DataFrame:
    """The cheapest row whose score is within the tolerance of the best; the better score, then the name, on ties."""
    best = scores.agg(F.max(score).alias("_best"))
    near = scores.join(F.broadcast(best)).where(F.col(score) >= F.col("_best") - tolerance)  # one row
    return near.agg(F.min(F.struct(F.col(cost), (-F.col(score)).alias("_s"), F.col(name))).alias("r")).select(f"r.{name}", f"r.{cost}", (-F.col("r._s")).alias(score))


def robust_z(df: DataFrame, group: str, value: str, least: int = 5) -> DataFrame:
    """Adds z: the distance from the group's median in 1.4826 median absolute deviations; null in small or even groups.

    Medians come from counts of distinct values, and are joined back, so no group is one task's.
    """
    mid = df.groupBy(group).agg(F.median(value).alias("_m"), F.count(value).alias("_n"))
    off = df.join(mid, group)
    mad = off.groupBy(group).agg((F.median(F.abs(F.col(value) - F.col("_m"))) * 1.4826).alias("_mad"))
    out = off.join(mad, group)
    return out.withColumn("z", F.when((F.col("_n") >= least) & (F.col("_mad") > 0), (F.col(value) - F.col("_m")) / F.col("_mad"))).drop("_m", "_n", "_mad")


def bullet_claims(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, place, claim, source): lines that begin with a bullet and hold a digit, and the first address they name."""
    lines = df.select(id_col, F.posexplode(F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x)), lambda x: x.rlike(r"^[-*] ") & x.rlike(r"[0-9]"))).alias("place", "line"))
    found = F.regexp_extract("line", URL, 0)
    return lines.select(id_col, "place", F.trim(F.substring("line", 3, 1 << 30)).alias("claim"), F.when(found == "", "unnamed").otherwise(found).alias("source"))


def cited(docs: DataFrame, id_col: str, ids: str, origins: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """(id, ref, origin, value): each cited id resolved by its prefix among the origins; null for unknown ones."""
    refs = docs.select(id_col, F.explode(ids).alias("ref")).distinct()
    out = None
    for prefix, table in sorted(origins.items()):
        side = table.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("ref"), F.lit(prefix).alias("origin"), F.col(value).cast("string").alias("value"))
        out = side if out is None else out.unionAll(side)
    return refs.join(out, "ref", "left").select(id_col, "ref", "origin", "value")
