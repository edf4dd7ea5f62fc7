"""Hourly loads of an event stream, late rows included: an addition of this library, over any streaming source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hourly_load(events: DataFrame, key: str, ts: str, value: str, id_col: str, late: str = "2 hours") -> DataFrame:
    """(key, hour, n, total): each event once, by hour of its own time.

    Events that come over `late` after the newest one are left out and their state is dropped; so the state is bounded by
    the rows of that time. Events that come again within it are counted once. Works on batch tables as well.
    """
    own = events.where(F.col(ts).isNotNull())
    own = own.withWatermark(ts, late).dropDuplicatesWithinWatermark([id_col]) if events.isStreaming else own.dropDuplicates([id_col])
    hours = own.groupBy(F.col(key), F.window(ts, "1 hour").alias("_w")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return hours.select(key, F.col("_w.start").alias("hour"), "n", "total")


def read_stream(spark: SparkSession, folder: str, schema, files: int = 64) -> DataFrame:
    """New parquet files of a folder as a stream, up to `files` of them at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def write_until_done(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Takes all that is there and ends; begun again with the same checkpoint it goes on where it stopped."""
    query = stream.writeStream.outputMode("append").format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
