"""Incremental forms of event queries: an extension beside the batch plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and type, with a watermark for late rows; runs on a stream or a table."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), "event_type", "n")


def ingest(spark: SparkSession, source: str, schema: str, step: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Runs `step` over the files of `source` that an earlier run has not seen and appends to `sink`, then ends."""
    stream = step(spark.readStream.schema(schema).parquet(source))
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(sink)
