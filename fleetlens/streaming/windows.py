"""Windowed aggregates of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.scalars import seconds_between


def minute_rate_stream(
    df: DataFrame, delay: str = "10 seconds", time: str = "storedAt"
) -> DataFrame:
    """Events per second and mean latency of each minute, with a watermark."""
    return (
        df.withWatermark(time, delay)
        .groupBy(F.window(time, "1 minute"))
        .agg(
            (F.count("eventId") / 60).alias("events_per_second"),
            F.avg(seconds_between("enqueuedAt", time)).alias("avg_latency_s"),
        )
        .select(
            F.col("window.start").alias("stored_minute"),
            "events_per_second",
            "avg_latency_s",
        )
    )


def summary_stream(df: DataFrame) -> DataFrame:
    """Count, first and last creation time of each device and type so far."""
    return df.groupBy("deviceId", "type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("createdAt").alias("first_at"),
        F.max("createdAt").alias("last_at"),
    )
