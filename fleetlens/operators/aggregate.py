"""Rates, bins, summaries and counters. Every group-by combines on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.scalars import (
    bin_start,
    millis_between,
    minute_of,
    seconds_between,
)
from fleetlens.operators.ordered import first_rows

# Limits of one log capacity unit.
MESSAGES_IN_PER_SECOND = 1000
BYTES_IN_PER_SECOND = 1_000_000
MESSAGES_OUT_PER_SECOND = 4096
BYTES_OUT_PER_SECOND = 2_000_000


def minute_rates(df: DataFrame) -> DataFrame:
    """Events per second and mean latency for each minute of ``storedAt``."""
    return df.groupBy(minute_of("storedAt").alias("stored_minute")).agg(
        (F.count("eventId") / 60).alias("events_per_second"),
        F.avg(seconds_between("enqueuedAt", "storedAt")).alias("avg_latency_s"),
    )


def rate_summary(rates: DataFrame) -> DataFrame:
    """Minutes with data, best rate, and the *lowest* per-minute mean latency."""
    return rates.agg(
        F.count("stored_minute").alias("minutes_with_data"),
        F.max("events_per_second").alias("max_events_per_second"),
        F.min("avg_latency_s").alias("min_latency_s"),
    )


def count_by_bin(
    df: DataFrame, time: str = "createdAt", width: str = "5 minutes"
) -> DataFrame:
    return df.groupBy(bin_start(time, width).alias("bin_start")).agg(
        F.count(F.lit(1)).alias("n")
    )


def device_type_summary(df: DataFrame) -> DataFrame:
    """Count, first and last creation time of each device and type."""
    return df.groupBy("deviceId", "type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("createdAt").alias("first_at"),
        F.max("createdAt").alias("last_at"),
    )


def device_type_mean(df: DataFrame) -> DataFrame:
    return df.groupBy("deviceId", "type").agg(
        F.avg("value").alias("mean_value"), F.count("deviceId").alias("n")
    )


def top_groups(df: DataFrame, n: int = 10, largest: bool = False) -> DataFrame:
    """The first ``n`` groups by count, smallest first as in the sample query."""
    count = F.col("n").desc() if largest else F.col("n").asc()
    return device_type_mean(df).orderBy(count, "deviceId", "type").limit(n)


def batch_latency(
    df: DataFrame,
    batch: Sequence[str],
    arrived: str = "enqueuedAt",
    left: str = "storedAt",
) -> DataFrame:
    """Per message batch: events, first and last arrival, latency in milliseconds."""
    elapsed = millis_between(arrived, left)
    return df.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(arrived).alias("from_at"),
        F.max(arrived).alias("to_at"),
        F.min(elapsed).alias("min_ms"),
        F.max(elapsed).alias("max_ms"),
        F.bround(F.avg(elapsed), 0).alias("avg_ms"),
    )


def log_throughput(
    df: DataFrame,
    log: Sequence[str],
    time: str,
    size: Column,
    units: int = 1,
    outgoing: bool = False,
) -> DataFrame:
    """Messages and bytes per log and minute, with the share of the capacity limit."""
    per_second = MESSAGES_OUT_PER_SECOND if outgoing else MESSAGES_IN_PER_SECOND
    byte_limit = BYTES_OUT_PER_SECOND if outgoing else BYTES_IN_PER_SECOND
    return (
        df.groupBy(*log, minute_of(time).alias("minute"))
        .agg(F.count(F.lit(1)).alias("messages"), F.sum(size).alias("bytes"))
        .withColumns(
            {
                "utilisation": F.col("messages") / F.lit(units * per_second * 60),
                "byte_utilisation": F.col("bytes") / F.lit(units * byte_limit * 60),
            }
        )
    )


def per_minute(rate_per_second: Column | str) -> Column:
    """A per-second mean rate as a per-minute total."""
    column = F.col(rate_per_second) if isinstance(rate_per_second, str) else rate_per_second
    return column * 60


def counter_rate(
    df: DataFrame,
    series: Sequence[str],
    time: str = "TimeGenerated",
    value: str = "Val",
    name: str = "Name",
) -> DataFrame:
    """Per-minute increase between the two newest samples of each counter series,
    summed by counter name. Two rows per series leave each task before the shuffle."""
    newest = first_rows(df, series, [F.col(time).desc(), F.col(value).desc()], 2)
    samples = F.sort_array(
        F.collect_list(F.struct(F.col(time).alias("t"), F.col(value).alias("v"))), False
    )
    pair = newest.groupBy(*series).agg(samples.alias("s")).withColumns(
        {"now": F.get("s", F.lit(0)), "then": F.get("s", F.lit(1))}
    )
    grown = (F.col("now.v") - F.col("then.v")).cast("double")
    rate = F.try_divide(grown, millis_between("then.t", "now.t")) * 60000
    return (
        pair.withColumn("rate", rate)
        .groupBy(F.col(name).alias("name"))
        .agg(
            F.max("now.t").alias("latest_at"),
            F.max("then.t").alias("previous_at"),
            F.sum("now.v").alias("latest"),
            F.sum("then.v").alias("previous"),
            F.sum("rate").alias("per_minute"),
        )
    )


def processing_columns(
    failed: Column, start: str = "enqueuedAt", end: str = "processedAt"
) -> list[Column]:
    """Events, failures and the spread of the processing time, as aggregates."""
    elapsed = millis_between(start, end)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(failed).alias("n_bad"),
        F.min(elapsed).alias("min_ms"),
        F.max(elapsed).alias("max_ms"),
        F.avg(elapsed).alias("avg_ms"),
    ]


def processing_stats(
    df: DataFrame,
    batch: Sequence[str],
    failed: Column,
    start: str = "enqueuedAt",
    end: str = "processedAt",
) -> DataFrame:
    """Per batch: events, failures and the spread of the processing time."""
    return df.groupBy(*batch).agg(*processing_columns(failed, start, end))


def latency_columns(start: str, end: str) -> list[Column]:
    """Sum, count, minimum and maximum of a latency, as aggregates."""
    elapsed = millis_between(start, end)
    return [
        F.sum(elapsed).alias("sum_ms"),
        F.count(elapsed).alias("n"),
        F.min(elapsed).alias("min_ms"),
        F.max(elapsed).alias("max_ms"),
    ]


def latency_metric(df: DataFrame, start: str, end: str) -> DataFrame:
    """Sum, count, minimum and maximum of a latency."""
    return df.agg(*latency_columns(start, end))
