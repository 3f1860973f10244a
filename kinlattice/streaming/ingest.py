"""Incremental ingest: the streaming form of the content guard (beyond the batch operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def once_each(events: DataFrame, key: str, at: str, late: str = "1 day") -> DataFrame:
    """IDM-01 on a stream: the first row of a key; state is dropped once the watermark has passed it."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.dropDuplicatesWithinWatermark([key])


def counts(events: DataFrame, at: str, by: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Rows per window and value, late rows within the watermark included."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.window(at, window), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def land(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends all that is there and stops; a second run adds only what is new."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()
