"""Streams over an events table (event_id, ts, user_id, event_type, value): an extension, for which there is no model to match."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.readStream.schema(SCHEMA).options(**options).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "1 day", slide: str = "6 hours", late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width, slide)).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("window.start").alias("window_start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return w.select("user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def distinct_events(events: DataFrame, late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def start_files(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    return df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def expired_leases(tasks: DataFrame, now, seconds: int = 300) -> DataFrame:
    """Leased tasks whose time is over go back to the queue."""
    over = (F.col("state") == "leased") & (F.col("leased_at") < F.lit(now) - F.expr(f"interval {seconds} seconds"))
    return tasks.withColumn("state", F.when(over, F.lit("queued")).otherwise(F.col("state")))
