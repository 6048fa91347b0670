"""Operators on data where one device holds most rows, cut and not cut."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlens import fixtures
from fleetlens.operators import anomaly, dedup, enrich, patterns, quality, series, windows
from fleetlens.operators.ordered import DEFAULT, Limits, cut

DAY = 86_400_000
BAND = patterns.Rules(band_low=10.0, band_high=30.0, co2_above=20.0)
NARROW = Limits(max_rows=40, min_rows=60, max_cuts=10_000)


@pytest.fixture(scope="module")
def hot(spark, sf_dir):
    """Two thirds of the rows on one device, and late, repeated and missing ones."""
    rows = fixtures.with_late(fixtures.with_gaps(fixtures.telemetry(spark, sf_dir, False)))
    rows = rows.where("_event_id < 400")
    busy = F.col("_event_id") % 3 != 0
    rows = rows.withColumns(
        {
            "deviceId": F.when(busy, "busy").otherwise(F.col("deviceId")),
            "deviceSequenceNumber": F.col("_event_id"),
            "storedAt": F.col("enqueuedAt"),
            "batch_id": F.when(busy, 0).otherwise(F.col("_event_id") % 5),
        }
    )
    again = rows.where("_event_id % 10 = 0").withColumn(
        "enqueuedAt", F.timestamp_add("SECOND", F.lit(40), F.col("enqueuedAt"))
    )
    out = rows.unionByName(again).select(
        "eventId", "deviceId", "type", "value", "createdAt", "enqueuedAt", "storedAt",
        "PartitionId", "deviceSequenceNumber", "batch_id", "_event_id",
    )
    return spark.createDataFrame(out.toPandas(), out.schema).cache()


ARRIVAL = ("enqueuedAt", "_event_id")
SPAN = series.Span(datetime(2024, 1, 3), datetime(2024, 1, 9))

OPERATORS = {
    "stored_order_delta": lambda df, c: windows.stored_order_delta(df, c).select(
        "deviceId", "storedAt", "deviceSequenceNumber", "delta"
    ),
    "out_of_sequence": lambda df, c: quality.out_of_sequence(df, c),
    "missing_events": lambda df, c: quality.missing_events(df, c),
    "position_in_batch": lambda df, c: enrich.position_in_batch(
        df, ["batch_id"], ARRIVAL, limits=c
    ),
    "pattern_tags": lambda df, c: patterns.pattern_tags(df, ARRIVAL, BAND, c),
    "silent_devices": lambda df, c: patterns.silent_devices(
        df, DAY, 0, arrival=ARRIVAL, limits=c
    ),
    "late_drop": lambda df, c: anomaly.late_drop(df, arrival=ARRIVAL, limits=c),
    "late_adjust": lambda df, c: anomaly.late_adjust(df, arrival=ARRIVAL, limits=c),
    "late_adjust_per_partition": lambda df, c: anomaly.late_adjust(
        df, arrival=ARRIVAL, keys=["PartitionId"], limits=c
    ),
    "spike_dip": lambda df, c: anomaly.spike_dip(
        df, tie=("_event_id",), duration_ms=DAY, limits=c
    ),
    "spike_dip_robust": lambda df, c: anomaly.spike_dip(
        df, tie=("_event_id",), duration_ms=DAY, robust=True, mode=anomaly.DIPS, limits=c
    ),
    "series_categories": lambda df, c: series.series_categories(
        df,
        SPAN,
        "PT6H",
        series.CategoricalVariable(F.col("type"), {"sensor": ["TEMP", "CO2"]}),
        boundary=timedelta(days=1),
        tie=("enqueuedAt", "_event_id"),
        limits=c,
    ),
    "lru_dedup": lambda df, c: dedup.lru_dedup(df, ["deviceId"], "type", ARRIVAL, 3, c),
    "lru_dedup_ids": lambda df, c: dedup.lru_dedup(df, ["deviceId"], "eventId", ARRIVAL, 20, c),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_cut_equals_whole(hot, name):
    def rows(limits):
        return sorted(map(repr, OPERATORS[name](hot, limits).collect()))

    plain = rows(DEFAULT)
    assert plain
    assert rows(NARROW) == plain


def test_large_group_of_copies(spark):
    """One event stored 500 times: counted, but not kept in one task."""
    at = datetime(2024, 1, 1)
    rows = [("d", at + timedelta(minutes=i), i) for i in range(60) if i not in (20, 40)]
    rows += [("d", at + timedelta(minutes=30), 30)] * 500
    df = spark.createDataFrame(
        rows, "deviceId string, storedAt timestamp, deviceSequenceNumber long"
    )
    limits = Limits(max_rows=20, min_rows=5)
    runs = cut(df, ["deviceId"], ["storedAt", "deviceSequenceNumber"], limits)
    assert runs.has_copies
    for check in (quality.out_of_sequence, quality.missing_events):
        assert check(df, limits).collect() == check(df).collect()


def test_one_hot_key_is_cut_however_small_its_files(spark):
    rows = spark.range(3_000_000).select(F.lit(1).alias("k"), F.col("id").alias("at"))
    runs = cut(rows, ["k"], ["at"])
    assert runs.is_cut
    sizes = [r["count"] for r in runs.df.groupBy("_run").count().collect()]
    assert sum(sizes) == 3_000_000 and max(sizes) < 2_000_000


def test_too_many_neighbours_are_refused_for_small_inputs_too(spark):
    rows = spark.range(10).select(F.lit(1).alias("k"), F.col("id").alias("at"))
    with pytest.raises(ValueError, match="neighbours"):
        cut(rows, ["k"], ["at"], Limits(min_rows=5)).with_neighbours(before=6)
