"""Streaming extensions: windows, sessions and duplicates on unbounded input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _timed(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by event type in tumbling windows; rows later than the watermark are left out."""
    return _timed(events).withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("window.start", "window.end", "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Counts and first events of each user's runs of events less than ``gap`` apart."""
    return _timed(events).withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event")).select("s.start", "s.end", "user_id", "n", "first_event")


def first_of_key(events: DataFrame, key: list[str], late: str = "2 hours") -> DataFrame:
    """Duplicates of a key inside the watermark go."""
    return _timed(events).withWatermark("ts", late).dropDuplicatesWithinWatermark(key)


def write_batch(path: str, batch: DataFrame, batch_id: int) -> None:
    """For foreachBatch: a batch is a partition of its own, written over by a repeat, so a batch that failed midway or
    comes twice adds nothing."""
    out = batch.withColumn("batch", F.lit(batch_id))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
