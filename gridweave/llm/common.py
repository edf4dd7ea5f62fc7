"""What several operators share: reading tables, tables cut from their lineage, and the registry's small helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def released() -> None:
    """Gives memory that a Python worker no longer uses back to the system, as workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it.

    Only where that setting is absent and Spark runs on one machine, a temporary folder is made and set.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs a reread and not a recomputation."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.n += 1
        at = self.path(f"{name}{self.n}")
        df.write.parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        out.scratch_path = at  # type: ignore[attr-defined]
        return out

    def drop(self, df: DataFrame | None) -> None:
        at = getattr(df, "scratch_path", None)
        if at:
            jvm = self.spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def open_uri(uri: str, write: bool = False):
    """A file in the shared store, by any store that Arrow knows: file, hdfs, s3, gs, abfs."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if write:
        store.create_dir(path.rpartition("/")[0], recursive=True)
        return store, path, store.open_output_stream(path)
    return store, path, store.open_input_file(path)


SEEN_BITS = 1 << 29  # of a bitmap of ids at most: 64 MB


def id_bitmap(ids: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """(bucket, bits) rows of a bitmap of hashed ids, and its number of bits: 16 for each id, and SEEN_BITS at most.

    So what is broadcast has a fixed bound. Where there are more ids than bits, more of the other rows are taken for
    one of them; nothing is lost by that.
    """
    n = ids.count()
    size = min(SEEN_BITS, 1 << max(15, (16 * n).bit_length()))
    spot = _spot(id_col, size)
    return ids.groupBy(F.bitmap_bucket_number(spot).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("_bits")), size


def _spot(id_col: str, size: int) -> F.Column:
    return F.pmod(F.xxhash64(id_col), F.lit(size)) + 1


def apart(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", ids_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Rows (key, row) of docs surely not among ids, and those that may be: only the latter's texts need a shuffle.

    key is the id, and row holds all columns of docs, so that no name can clash. The broadcast bitmap decides each row
    where it is read. A null id counts as an id.
    """
    bitmap, size = id_bitmap(ids, ids_col)
    own = docs.select(docs[id_col].alias("key"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    spot = _spot("key", size)
    marked = own.withColumn("bucket", F.bitmap_bucket_number(spot)).join(F.broadcast(bitmap), F.col("bucket") == F.col("_bucket"), "left")
    at = F.bitmap_bit_position(spot).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    marked = marked.select("key", "row", F.coalesce(F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1, F.lit(False)).alias("hit"))
    return marked.where("NOT hit").drop("hit"), marked.where("hit").drop("hit")


def connected_components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is the least node it reaches.

    edges: two long columns u, v. Alternates large-star and small-star steps (Kiveris et al. 2014): each is a
    grouped minimum, combined before the shuffle, and an equi-join that Spark may split where a node is hot. Each
    round is written to the shared folder, so lineage stays short and no edge reaches the driver. Null ends and
    loops are ignored; an empty input gives an empty result.
    """
    least, most = F.least("u", "v"), F.greatest("u", "v")
    now = scratch.keep(edges.where("u != v").select(most.alias("hi"), least.alias("lo")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if not state["n"] or before == state:
            break
        before = state
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        nxt = scratch.keep(small.unionAll(down.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        scratch.drop(now)
        now = nxt
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("lo").alias("node")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(roots.select("node", F.col("node").alias("component")))
