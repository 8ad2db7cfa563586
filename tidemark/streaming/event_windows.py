"""Tumbling means on an event stream: rows later than the watermark are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl, exact


def event_windows(stream: DataFrame, width: str = "1 day", delay: str = "2 hours") -> DataFrame:
    """Per event type and window: count and mean. State is one row per open window and type."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    counts = timed.groupBy(F.window("ts", width), "event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(exact("value")).alias("total")
    )
    return counts.select(
        "event_type", F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_count",
        (dbl("total") / dbl("event_count")).alias("mean_value"),
    )


def run_event_windows(spark: SparkSession, source: str, table: str, checkpoint: str, width: str = "1 day", delay: str = "2 hours") -> DataFrame:
    """Process what is there into `table`, then stop; windows the watermark has closed are in the result."""
    schema = spark.read.parquet(source).schema
    folder, pattern = source.rsplit("/", 1)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    result = event_windows(stream, width, delay)
    running = (
        result.writeStream.outputMode("append").format("parquet").option("path", table)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return spark.read.schema(result.schema).parquet(table)
