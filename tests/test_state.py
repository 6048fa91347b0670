"""Device state, quality checks, merges."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import aggregate, dedup, device, quality
from fleetlens.operators.quality import Thresholds

STATUS = "deviceId string, eventId string, deviceSequenceNumber long, value double"


def test_status_keeps_newer_rows_unless_told(spark):
    stored = spark.createDataFrame([("a", "e9", 9, 1.0), ("b", "e1", 1, 1.0)], STATUS)
    batch = spark.createDataFrame([("a", "e5", 5, 2.0), ("b", "e2", 2, 2.0), ("c", "e0", 0, 2.0)], STATUS)
    ids = lambda df: sorted((r["deviceId"], r["eventId"]) for r in df.collect())
    assert ids(device.update_status(stored, batch)) == [("a", "e9"), ("b", "e2"), ("c", "e0")]
    assert ids(device.update_status(stored, batch, always_replace=True)) == [
        ("a", "e5"), ("b", "e2"), ("c", "e0"),
    ]
    again = spark.createDataFrame([("a", "other", 9, 3.0)], STATUS)
    assert ids(device.update_status(stored, again))[0] == ("a", "other")


def test_twins_merge_property_wise(spark):
    twin = "deviceId string, Temperature double, CO2 double"
    current = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, None)], twin)
    update = spark.createDataFrame([("a", None, 9.0), ("c", 4.0, None)], twin)
    got = {r["deviceId"]: (r["Temperature"], r["CO2"]) for r in device.merge_twins(current, update).collect()}
    assert got == {"a": (1.0, 9.0), "b": (3.0, None), "c": (4.0, None)}


def test_patch_with_repeated_path_fails(spark):
    twice = '{"patch":[{"op":"add","path":"/a","value":1},{"op":"replace","path":"/a","value":2}]}'
    df = spark.createDataFrame([(twice, "d", "e")], "body string, subject string, id string")
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        device.patch_flatten(df).collect()


def test_patch_values_of_all_kinds(spark):
    patch = (
        '{"patch":[{"op":"add","path":"/a/b","value":{"x":[1,null]}},'
        '{"op":"replace","path":"/c","value":"t"},{"op":"test","path":"/d","value":1}]}'
    )
    df = spark.createDataFrame([(patch, "d", "e")], "body string, subject string, id string")
    assert device.patch_flatten(df).collect()[0]["props"] == (
        '{"a.b":{"x":[1,null]},"c":"t","deviceId":"d","eventId":"e"}'
    )


EVENT = (
    "eventId string, deviceId string, deviceSequenceNumber long, enqueuedAt timestamp, "
    "storedAt timestamp"
)


def test_report_of_empty_input_and_skipped_checks(spark):
    empty = spark.createDataFrame([], EVENT)
    report = {r["check_name"]: r for r in quality.quality_report(empty).collect()}
    assert {n: r["passed"] for n, r in report.items()} == {
        "throughput": False, "latency": False, "duplicates": True, "out_of_sequence": True,
        "missing": True,
    }
    only = Thresholds(None, None, 0.5, None, None)
    assert [r["check_name"] for r in quality.quality_report(empty, only).collect()] == ["duplicates"]
    none = Thresholds(None, None, None, None, None)
    assert quality.quality_report(empty, none).collect() == []
    failed = quality.failed_checks(quality.quality_report(empty)).collect()
    assert [r["value"] for r in failed] == [
        "throughput: expected 900.0 got nothing", "latency: expected 15000.0 got nothing",
    ]


def test_report_numbers(spark):
    at = datetime(2024, 1, 1)
    rows = [(f"e{i}", "d", i, at, at) for i in range(20) if i != 10]
    df = spark.createDataFrame(rows + rows[:1], EVENT)
    report = {r["check_name"]: r["actual"] for r in quality.quality_report(df).collect()}
    assert report["throughput"] == pytest.approx(20 / 60)
    assert report["duplicates"] == pytest.approx(1 / 20)
    assert report["out_of_sequence"] == report["missing"] == pytest.approx(1 / 20)


def test_require_unique(spark):
    df = spark.createDataFrame([("a",), ("b",)], "eventId string")
    assert dedup.require_unique(df).count() == 2
    with pytest.raises(ValueError, match="duplicate eventId"):
        dedup.require_unique(df.union(df))


def test_merge_into_empty_and_with_hot_key(spark):
    keys = "PartitionId long, eventId string, enqueuedAt long, storedAt long"
    staging = spark.range(3000).select(
        F.lit(1).cast("long").alias("PartitionId"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("eventId"),
        F.col("id").alias("enqueuedAt"),
        F.col("id").alias("storedAt"),
    )
    empty = spark.createDataFrame([], keys)
    fresh = dedup.merge_insert(staging, empty)
    assert fresh.count() == 2001
    assert fresh.where("eventId = 'hot'").collect()[0]["enqueuedAt"] == 0
    assert dedup.merge_result(staging, fresh).count() == 2001


def test_counter_rate_with_one_sample(spark):
    at = [datetime(2024, 1, 1, 0, m) for m in range(3)]
    rows = [("n", "p1", at[0], 1.0), ("n", "p1", at[1], 7.0), ("n", "p1", at[2], 19.0), ("n", "p2", at[2], 5.0)]
    df = spark.createDataFrame(rows, "Name string, pod string, TimeGenerated timestamp, Val double")
    got = aggregate.counter_rate(df, ["Name", "pod"]).collect()[0]
    assert (got["latest"], got["previous"], got["per_minute"]) == (24.0, 7.0, 12.0)
    outgoing = aggregate.log_throughput(
        df, ["pod"], "TimeGenerated", F.lit(4096), units=2, outgoing=True
    ).where("pod = 'p2'").collect()[0]
    assert outgoing["utilisation"] == pytest.approx(1 / (2 * 4096 * 60))
    assert outgoing["byte_utilisation"] == pytest.approx(4096 / (2 * 2_000_000 * 60))
    assert df.select(aggregate.per_minute(F.lit(2.0)).alias("x")).collect()[0]["x"] == 120.0
