"""Event patterns per device over its last ten events, and silent devices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.ordered import DEFAULT, Limits, cut, first_rows, following

# Tag texts.
FIRST = "FirstTagForThisKey"
COUNTED = "RecordsForThisKey"
BAND = "SeveralTemperaturesIn70s"
BAND_AND_CO2 = "HighCO2WithSeveralTemperaturesIn70s"
SILENT = "NoNewsForAtLeast"


@dataclass(frozen=True)
class Rules:
    """Thresholds of the tags."""

    band_low: float = 70.0
    band_high: float = 80.0
    co2_above: float = 80.0
    ring: int = 10

    def in_band(self) -> Column:
        value = F.col("value")
        return (
            (F.col("type") == "TEMP") & (value >= self.band_low) & (value < self.band_high)
        )

    def high_co2(self) -> Column:
        return (F.col("type") == "CO2") & (F.col("value") > self.co2_above)


def pattern_tags(
    df: DataFrame,
    arrival: tuple[str, ...] = ("enqueuedAt", "eventId"),
    rules: Rules = Rules(),
    limits: Limits = DEFAULT,
    only: Column | None = None,
) -> DataFrame:
    """Tags that each arriving event causes, from a frame over the last ``ring`` events.
    ``only`` selects the events to tag; the others just fill the frame.

    An event that did not qualify on arrival never does later, because the ring only
    loses events; so looking at each event once, when it is the newest, is enough.
    """
    runs = cut(df, ["deviceId"], arrival, limits).with_neighbours(before=rules.ring - 1)
    frame = runs.window.rowsBetween(1 - rules.ring, 0)
    held = runs.df.withColumns(
        {
            "_held": F.count(F.lit(1)).over(frame),
            "_band": F.sum(F.when(rules.in_band(), 1).otherwise(0)).over(frame),
            "_co2": F.max(F.when(rules.high_co2(), 1).otherwise(0)).over(frame),
        }
    )
    n, several = F.col("_held"), F.col("_band") >= 2
    tags = F.array(
        F.when(n == 1, FIRST),
        F.when((n > 1) & (n < rules.ring), F.concat(n.cast("string"), F.lit(COUNTED))),
        F.when(several & rules.in_band(), BAND),
        F.when(several & (F.col("_co2") == 1), BAND_AND_CO2),
    )
    rows = runs.result(held.withColumn("_tags", F.array_compact(tags)))
    if only is not None:
        rows = rows.where(only)
    tagged = rows.select(
        "deviceId",
        F.col("createdAt").alias("trigger_at"),
        F.col("eventId").alias("trigger_id"),
        *[F.col(c).alias(f"_at{i}") for i, c in enumerate(arrival)],
        F.explode("_tags").alias("tag"),
    )
    return distinct_tags(tagged, [f"_at{i}" for i in range(len(arrival))]).select(
        "deviceId", "trigger_at", "trigger_id", "tag"
    )


def distinct_tags(tags: DataFrame, arrival: list[str]) -> DataFrame:
    """Tags are equal if device, event and text are; the first arrival is kept."""
    return first_rows(
        tags, ["deviceId", "trigger_id", "tag"], [F.col(c) for c in arrival]
    )


def silent_devices(
    df: DataFrame,
    silence_ms: int = 45_000,
    delay_ms: int = 60_000,
    flush_at_end: bool = True,
    arrival: tuple[str, ...] = ("enqueuedAt", "eventId"),
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Events after which their device was silent.

    A tag appears if no later event of the device arrived until ``silence_ms`` after the
    event was created plus the watermark delay. ``flush_at_end`` also tags the last event
    of each device, as at the end of a bounded input.
    """
    rows = following(df, ["deviceId"], arrival, {"_next": F.col(arrival[0])}, limits)
    waited = F.unix_micros("_next") - F.unix_micros("createdAt")
    silent = waited > (silence_ms + delay_ms) * 1000
    last = F.col("_next").isNull() & F.lit(flush_at_end)
    tags = rows.where(silent | last).select(
        "deviceId",
        F.col("createdAt").alias("trigger_at"),
        F.col("eventId").alias("trigger_id"),
        *[F.col(c).alias(f"_at{i}") for i, c in enumerate(arrival)],
        F.lit(f"{SILENT}{silence_ms}ms").alias("tag"),
    )
    return distinct_tags(tags, [f"_at{i}" for i in range(len(arrival))]).select(
        "deviceId", "trigger_at", "trigger_id", "tag"
    )
