"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, apart, connected_components, released, table

BITS = 64
BLOCK = 1 << 13  # shingles whose bits are counted at once


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of one text.

    A-Z are lower-cased, words are runs without ASCII white space, and every run of `size` words (all words, if there
    are fewer) is hashed with XXH64. A bit is set if more than half of the hashes set it. No words or null: 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-size] + 1))
    ends, digest, n = ends[size - 1 :], xxhash.xxh64_intdigest, len(starts)
    del words
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, BLOCK):
        places = zip(starts[k : k + BLOCK].tolist(), ends[k : k + BLOCK].tolist(), strict=True)
        hashes = np.fromiter((digest(line[a:b], seed) for a, b in places), "<u8", min(BLOCK, n - k))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp) for every row, over runs of `size` words; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), size) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(fp)], names=["id", "fp"])
        released()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, fp long")


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v) edges that connect just those distinct fingerprints that differ in `radius` bits or fewer.

    Each fingerprint is sent to all values within half the radius. Two fingerprints within the radius meet at such a
    value, and all that meet there are within the radius of each other; so a star from the least one of a bucket joins
    them without pairs. A fingerprint is sent to 65 values at radius 2, 2081 at 4 and 43745 at 6, and a bucket holds as
    many at most, as the input is distinct. Each edge is verified.
    """
    if radius < 0 or radius % 2:
        raise ValueError("the radius is even: at odd radii, values that meet need not be within it")
    ball = distinct.select("fp", F.col("fp").alias("at"), F.lit(0).alias("low"))
    for _ in range(radius // 2):  # one bit more, above those changed so far, or none
        ball = ball.select("fp", "at", F.explode(F.sequence(F.col("low"), F.lit(BITS))).alias("bit"))
        at = F.when(F.col("bit") == BITS, F.col("at")).otherwise(F.expr("at ^ shiftleft(1L, bit)"))
        ball = ball.select("fp", at.alias("at"), F.least(F.col("bit") + 1, F.lit(BITS)).alias("low"))
    far = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius
    near = ball.select(F.col("fp").alias("u"), F.min("fp").over(W.partitionBy("at")).alias("v"))
    return near.where("v < u").where(far).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, size: int = 3) -> DataFrame:
    """(id_col, fingerprint, component_id), a row for each row of docs.

    fingerprint: 16 lowercase hex digits. component_id: the least id among all rows reachable over fingerprints that
    differ in `radius` bits or fewer, with shingles of `size` words. Rows with one fingerprint (exact copies, or all rows without words) are one node,
    whatever their number; so a group of copies costs one row after a combined count. Null texts have no words. Null
    ids keep their row; a component of null ids only has a null component_id. Repeated rows are kept.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    fps = scratch.keep(fingerprints(docs, id_col, text_col, size), "fp")
    nodes = scratch.keep(fps.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    groups = connected_components(links(nodes.select("fp"), radius), scratch)
    placed = nodes.join(groups, nodes["fp"] == groups["node"], "left").select(nodes["fp"], "least", F.coalesce("component", nodes["fp"]).alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "root").select("fp", "component_id")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(named, "fp").select(F.col("id").alias(id_col), text.alias("fingerprint"), "component_id")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str, radius: int = 2, size: int = 3) -> DataFrame:
    """The rows of docs whose id names their component: one document of each group stays.

    If such an id stands in several rows, the one with the least text stays (then by the other columns as JSON). Rows
    without an id can't be named by a component, and stay. Whole texts are shuffled only of rows whose id is repeated or
    dropped, or shares its place in a bitmap with one that is; all others are decided where they are read.
    """
    scratch = Scratch(spark, "kept")
    named = near_duplicates(docs.where("doc_id IS NOT NULL"), radius=radius, size=size)
    told = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"), F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("stays"))
    odd = scratch.keep(told.where("copies > 1 OR stays = 0").select(F.col("doc_id").alias("odd_id"), "copies", "stays"), "odd")
    fine, asked = apart(docs, odd, "doc_id", "odd_id")
    met = asked.join(odd, F.col("key") == F.col("odd_id"), "left")
    others = F.to_json(F.struct("row"))
    one = met.where("stays = 1 AND copies > 1").groupBy("key").agg(F.min_by("row", F.struct("row.text", others)).alias("row"))
    return fine.unionAll(met.where("odd_id IS NULL").select("key", "row")).unionAll(one).select("row.*")
