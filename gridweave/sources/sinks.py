"""Sinks and the sources that read them: CSV, JSON lines, GeoJSON, partitioned tables, manifests, caches, samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def clean(df: DataFrame) -> DataFrame:
    """NaN and infinities of all floating columns as null, which JSON can hold."""
    bad = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    return df.select(*(F.when(~bad(F.col(f.name)), F.col(f.name)).alias(f.name) if f.dataType.simpleString() in ("double", "float") else F.col(f.name) for f in df.schema))


def write_csv(df: DataFrame, path: str) -> None:
    """With a header; an empty string and a null stay apart."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "\\N").csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Columns by a given schema: nothing is guessed in a pass of its own."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "\\N").option("emptyValue", "").csv(path)


def write_partitioned(df: DataFrame, path: str, by: str, id_col: str, files: int = 4) -> None:
    """A folder for each value of `by`, with up to `files` files each, so that a large one isn't a single task's."""
    salt = F.pmod(F.xxhash64(id_col), F.lit(files))
    df.repartition(F.col(by), salt).sortWithinPartitions(by, id_col).write.mode("overwrite").partitionBy(by).option("compression", "zstd").parquet(path)


def write_geojson(df: DataFrame, path: str, lon: str, lat: str) -> None:
    """One GeoJSON feature a line; the other columns are its properties, without NaN."""
    own = clean(df)
    point = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*(c for c in df.columns if c not in (lon, lat))).alias("properties"))
    own.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def read_geojson(spark: SparkSession, path: str, properties: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Features of points, a line each; properties is a DDL schema. Lines that aren't features are left out."""
    schema = f"type string, geometry struct<type:string,coordinates:array<double>>, properties struct<{', '.join(x.strip().replace(' ', ':', 1) for x in properties.split(','))}>"
    rows = spark.read.text(path).select(F.from_json("value", schema).alias("f")).where("f.type = 'Feature'")
    return rows.select("f.properties.*", F.col("f.geometry.coordinates")[0].alias(lon), F.col("f.geometry.coordinates")[1].alias(lat))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes, sha256) of each file, hashed where it is read. A file is held whole by its task, 2 GB at most."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def sample_rows(df: DataFrame, n: int, id_col: str, seed: int) -> DataFrame:
    """n rows in the order of a hash of id and seed: the same on any cluster; a bounded heap in each task."""
    return df.orderBy(F.sha2(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))), 256), id_col).limit(n)


def described(df: DataFrame) -> DataFrame:
    """(column, type, nullable) of a table, in order; no row is read."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "place int, column string, type string, nullable boolean")


def get_or_call(asked: DataFrame, held: DataFrame, key: str, call: Callable[[Column], Column]) -> DataFrame:
    """(key, value, cached): values that are held are taken, and only the other keys are called, each once.

    What was called (cached is false) is what to append to the store.
    """
    keys = asked.select(key).distinct()
    known = keys.join(held.select(key, "value"), key)
    missing = keys.join(held.select(key), key, "left_anti").select(key, call(F.col(key)).alias("value"))
    return known.withColumn("cached", F.lit(True)).unionAll(missing.withColumn("cached", F.lit(False)))


def latest(files: DataFrame, name: str, version: str) -> DataFrame:
    """The path of each name's greatest version, compared number by number."""
    parts = F.transform(F.split(version, r"\."), lambda x: x.cast("int"))
    return files.groupBy(name).agg(F.max_by("path", parts).alias("path"))
