"""Reading tables, writing them clustered, and tables cut from their lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table; filters and columns reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_clustered(df: DataFrame, path: str, *keys: str) -> None:
    """zstd parquet whose files hold ranges of keys, sorted, so that later filters on them skip row groups."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "zstd").parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; a temporary one only on a single machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read again: no lineage, and sizes that the planner knows."""
    spark = df.sparkSession
    at = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)
