"""The registered queries: each operator over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import fixtures
from fleetlens.functions import scalars
from fleetlens.operators import (
    aggregate,
    anomaly,
    decode,
    dedup,
    device,
    enrich,
    hierarchy,
    patterns,
    quality,
    series,
    windows,
)
from fleetlens.operators.ordered import first_rows
from fleetlens.schema import TAG
from fleetlens.session import ROCKSDB_PROVIDER
from fleetlens.sources import files, stores
from fleetlens.sources.files import json_stream
from fleetlens.streaming import batches, metrics, newest, runs, sinks, stateful
from fleetlens.streaming.windows import minute_rate_stream, summary_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
EVENT_COLUMNS = (
    "eventId",
    "type",
    "deviceId",
    "deviceSequenceNumber",
    "value",
    "createdAt",
    "enqueuedAt",
    "PartitionId",
)
SPAN = series.Span(datetime(2024, 1, 5), datetime(2024, 1, 15))
REPORT = quality.Thresholds(
    events_per_second=0.05, latency_ms=15_000, duplicate_fraction=0.0011
)
# The test table has one event per device in about eleven hours.
BAND = patterns.Rules(band_low=10.0, band_high=30.0, co2_above=20.0)
DAY_MS = 86_400_000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: plain(function(spark, sf_dir))
    return function


def plain(df: DataFrame) -> DataFrame:
    """Zone-less times and doubles with six digits, to compare with plain SQL."""
    columns = {}
    for f in df.schema:
        if isinstance(f.dataType, T.TimestampType):
            columns[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DoubleType):
            columns[f.name] = F.round(f.name, 6)
    return df.withColumns(columns) if columns else df


def body_of(df: DataFrame, *extra: str) -> Column:
    """The event as the JSON that a device sends."""
    names = [
        "eventId",
        "complexData",
        "value",
        "type",
        "deviceId",
        "deviceSequenceNumber",
        "createdAt",
    ]
    present = [n for n in [*names, *extra] if n in df.columns]
    return F.to_json(F.struct(*present), {"timestampFormat": MICROS})


def envelope(df: DataFrame) -> DataFrame:
    return df.select(
        body_of(df).cast("binary").alias("body"),
        F.col("enqueuedAt").alias("enqueuedTime"),
        "_event_id",
    )


def messages(df: DataFrame, text: Callable[[Column], Column]) -> DataFrame:
    """Ten events in one message, sent when the last of them was stored."""
    body = body_of(df, "enqueuedAt", "processedAt", "PartitionId")
    return (
        df.select(F.expr("_event_id div 10").alias("batch_id"), body.alias("b"), "storedAt")
        .groupBy("batch_id")
        .agg(
            text(F.collect_list("b")).cast("binary").alias("body"),
            F.max("storedAt").alias("enqueuedTime"),
        )
    )


def device_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.telemetry(spark, sf_dir, sequence=False)
    return rows.select("deviceId", F.col("_user_id").alias("i")).distinct()


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.sample_instances(device_rows(spark, sf_dir), "i")


def thirds_and_halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The whole table as a target and a staging table with repeated rows; they overlap."""
    again = fixtures.with_duplicates(rows)
    return rows.where("_event_id % 3 = 0"), again.where("_event_id % 3 <> 0 OR _event_id % 2 = 0")


# -- rates and quality ---------------------------------------------------------------


@query
def minute_rate_latency(spark, sf_dir):
    return aggregate.minute_rates(fixtures.telemetry(spark, sf_dir, False))


@query
def rate_summary(spark, sf_dir):
    rates = aggregate.minute_rates(fixtures.telemetry(spark, sf_dir, False))
    return aggregate.rate_summary(rates)


@query
def quality_report(spark, sf_dir):
    rows = fixtures.with_duplicates(fixtures.with_gaps(fixtures.telemetry(spark, sf_dir)))
    return quality.quality_report(rows, REPORT)


@query
def failed_checks(spark, sf_dir):
    report = quality.quality_report(
        fixtures.with_gaps(fixtures.telemetry(spark, sf_dir)), REPORT
    )
    return quality.failed_checks(report).select(
        F.substring_index("value", ":", 1).alias("check_name")
    )


@query
def duplicate_fraction(spark, sf_dir):
    return quality.duplicate_fraction(
        fixtures.with_duplicates(fixtures.telemetry(spark, sf_dir, False))
    )


@query
def out_of_sequence(spark, sf_dir):
    late = fixtures.with_late(fixtures.telemetry(spark, sf_dir))
    return quality.out_of_sequence(late.withColumn("storedAt", F.col("enqueuedAt")))


@query
def missing_events(spark, sf_dir):
    return quality.missing_events(fixtures.with_gaps(fixtures.telemetry(spark, sf_dir)))


@query
def stored_order_delta(spark, sf_dir):
    late = fixtures.with_late(fixtures.telemetry(spark, sf_dir))
    rows = windows.stored_order_delta(late.withColumn("storedAt", F.col("enqueuedAt")))
    return rows.where("delta is not null").select("eventId", "deviceId", "deviceSequenceNumber", "delta")


@query
def middle_delta(spark, sf_dir):
    rows = windows.middle_delta(fixtures.with_gaps(fixtures.telemetry(spark, sf_dir)))
    return rows.where("delta is not null").select(
        "eventId", "deviceId", "deviceSequenceNumber", "delta"
    )


@query
def json_valid(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    broken = F.when(F.col("_event_id") % 50 == 3, F.substring("_props", 1, 4))
    return quality.json_valid(
        rows.withColumn("complexData", F.coalesce(broken, F.col("_props")))
    )


# -- group-bys -----------------------------------------------------------------------


@query
def count_by_bin(spark, sf_dir):
    return aggregate.count_by_bin(
        enrich.of_type(fixtures.telemetry(spark, sf_dir, False), "CO2")
    )


@query
def device_type_summary(spark, sf_dir):
    return aggregate.device_type_summary(fixtures.telemetry(spark, sf_dir, False))


@query
def device_type_mean(spark, sf_dir):
    return aggregate.device_type_mean(fixtures.telemetry(spark, sf_dir, False))


@query
def top_groups(spark, sf_dir):
    return aggregate.top_groups(fixtures.telemetry(spark, sf_dir, False))


@query
def batch_latency(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    lines = messages(rows, lambda b: F.concat_ws("\n", F.lit("no JSON"), b))
    out = decode.explode_lines(lines, keep=("batch_id", "enqueuedTime"))
    return aggregate.batch_latency(out, ["batch_id"], "enqueuedAt", "enqueuedTime")


@query
def log_throughput(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    return aggregate.log_throughput(
        rows, ["PartitionId"], "enqueuedAt", F.octet_length("_props")
    )


@query
def counter_rate(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    samples = rows.select(
        F.lit("prometheus").alias("Namespace"),
        F.concat(F.lower("type"), F.lit("_total")).alias("Name"),
        F.to_json(
            F.struct(
                F.concat(F.lit("topic-"), F.col("_user_id") % 2).alias("topic"),
                F.concat(F.lit("pod-"), F.col("PartitionId")).alias("pod_name"),
            )
        ).alias("Tags"),
        F.col("createdAt").alias("TimeGenerated"),
        F.col("_event_id").alias("Val"),
    )
    chosen = enrich.of_counters(
        samples, ["temp_total", "co2_total", "error_total"], "topic", "topic-0", "prometheus"
    ).withColumn("pod_name", F.get_json_object("Tags", "$.pod_name"))
    return aggregate.counter_rate(chosen, ["Name", "pod_name"])


@query
def processing_stats(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    rows = rows.withColumn("batch_id", F.expr("_event_id div 100"))
    return aggregate.processing_stats(rows, ["batch_id"], F.col("type") == "ERROR")


@query
def latency_metric(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    return aggregate.latency_metric(rows, "createdAt", "storedAt")


# -- decode and enrich ---------------------------------------------------------------


@query
def decode_messages(spark, sf_dir):
    out = decode.decode_events(envelope(fixtures.telemetry(spark, sf_dir)))
    return out.withColumn("k", F.col("complexData")["k"]).drop("complexData")


@query
def explode_batches(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir)
    arrays = messages(rows, lambda b: F.concat(F.lit("["), F.concat_ws(",", b), F.lit("]")))
    out = decode.explode_array(arrays)
    return out.withColumn("k", F.col("complexData")["k"]).drop("complexData", "processedAt2")


@query
def map_json_paths(spark, sf_dir):
    rows = envelope(fixtures.telemetry(spark, sf_dir))
    mapping = {
        "eventId": ("$.eventId", "string"),
        "k": ("$.complexData.k", "double"),
        "value": ("$.value", "string"),
        "type": ("$.type", "string"),
        "deviceId": ("$.deviceId", "string"),
        "deviceSequenceNumber": ("$.deviceSequenceNumber", "bigint"),
        "createdAt": ("$.createdAt", "timestamp"),
    }
    return decode.map_paths(rows, mapping, decode.body_text())


@query
def quarantine(spark, sf_dir):
    rows = envelope(fixtures.telemetry(spark, sf_dir, False))
    text = decode.body_text()
    cut_off = F.when(F.col("_event_id") % 40 == 3, F.substring(text, 1, 25)).otherwise(text)
    _, bad = decode.split_malformed(rows.select("_event_id", cut_off.alias("text")), "text")
    return bad.select(F.col("_event_id").alias("event_id"), "reason")


@query
def capture_decode(spark, sf_dir):
    rows = envelope(fixtures.telemetry(spark, sf_dir))
    files = rows.select(
        F.date_format("enqueuedTime", scalars.CAPTURE_TIME).alias("EnqueuedTimeUtc"),
        F.col("body").alias("Body"),
    )
    out = decode.decode_capture(files)
    return out.withColumn("k", F.col("complexData")["k"]).drop("complexData")


@query
def array_round_trip(spark, sf_dir):
    """Packed into JSON arrays of up to 100 events and unpacked again."""
    rows = fixtures.telemetry(spark, sf_dir, False)
    names = ["eventId", "complexData", "value", "type", "deviceId", "createdAt", "enqueuedAt"]
    packed = sinks.array_messages(rows.select(*names), 100, key="deviceId")
    sent = packed.select(
        F.col("value").cast("binary").alias("body"),
        F.col("key").alias("message_key"),
        F.lit(None).cast("timestamp").alias("enqueuedTime"),
    )
    # The envelope's key has to be the device of every event in the message.
    out = decode.explode_array(sent, keep=["message_key"]).where("message_key = deviceId").select(*names)
    return out.withColumn("k", F.col("complexData")["k"]).drop("complexData")


@query
def relay(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False).withColumn("timestamp", F.col("enqueuedAt"))
    out = enrich.relay(rows.drop("enqueuedAt"), processed=F.col("processedAt"))
    return out.select("eventId", "enqueuedAt", "processedAt")


@query
def created_as_enqueued(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    out = enrich.with_document_id(enrich.with_enqueued_from_created(rows))
    return out.select("id", "eventId", "enqueuedAt")


@query
def payload_rows(spark, sf_dir):
    rows = enrich.payload_rows(fixtures.telemetry(spark, sf_dir), "batch-1")
    return rows.select(
        "EventId",
        "BatchId",
        F.get_json_object("ComplexData", "$.k").cast("double").alias("k"),
        F.col("Value").cast("long").alias("Value"),
        "DeviceId",
        "DeviceSequenceNumber",
        "Type",
        "CreatedAt",
        "EnqueuedAt",
        "ProcessedAt",
        "PartitionId",
    )


@query
def position_in_batch(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    rows = rows.withColumn("batch_id", F.expr("_event_id div 100"))
    out = enrich.position_in_batch(rows, ["batch_id"], ["enqueuedAt", "_event_id"], "position")
    return out.select("batch_id", "eventId", "position")


@query
def iso_times(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False).select("eventId", "createdAt", "enqueuedAt")
    texts = scalars.timestamps_to_iso(rows)
    return texts.withColumn("parsedAt", scalars.parse_iso("createdAt"))


@query
def typed_export(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir)
    exported = rows.select(
        F.col("createdAt").alias("timestamp"),
        F.col("deviceId").alias("deviceId_string"),
        F.col("eventId").alias("eventId_string"),
        F.col("deviceSequenceNumber").alias("deviceSequenceNumber_long"),
    )
    return scalars.strip_type_suffix(exported)


@query
def catalog_export(spark, sf_dir):
    """A partitioned export as a table of the catalog. A partition that is written later is
    found when the table is opened again; only the wanted ones are read."""
    base, table = runs.shared_folder(spark, "export"), "fleetlens_export"
    rows = fixtures.telemetry(spark, sf_dir, False).select(
        F.col("createdAt").alias("timestamp"),
        F.col("deviceId").alias("deviceId_string"),
        F.col("value").alias("value_double"),
        F.col("PartitionId").alias("part"),
    )
    rows.where("part < 3").write.partitionBy("part").parquet(base)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # its files are its owner's
    files.external_table(spark, table, base)
    rows.where("part = 3").write.mode("append").partitionBy("part").parquet(base)
    found = files.typed_rows(files.external_table(spark, table, base))
    return found.where("part >= 2").select("deviceId", "value", "createdAt", "storedAt", F.col("part").cast("long").alias("part"))


# -- duplicates and merges -----------------------------------------------------------


@query
def staging_dedup(spark, sf_dir):
    rows = fixtures.with_duplicates(fixtures.telemetry(spark, sf_dir))
    return dedup.staging_dedup(rows).select(*EVENT_COLUMNS)


@query
def merge_insert(spark, sf_dir):
    target, staging = thirds_and_halves(fixtures.telemetry(spark, sf_dir))
    return dedup.merge_insert(staging, target).select(*EVENT_COLUMNS)


@query
def merge_result(spark, sf_dir):
    target, staging = thirds_and_halves(fixtures.telemetry(spark, sf_dir))
    return dedup.merge_result(staging, target).select(*EVENT_COLUMNS)


@query
def lru_dedup(spark, sf_dir):
    rows = fixtures.events(spark, sf_dir).select("event_type", "user_id", "ts", "event_id")
    kept = dedup.lru_dedup(rows, ["event_type"], "user_id", ["ts", "event_id"], size=20)
    return kept.select(
        F.col("event_type").alias("k"), F.col("user_id").alias("id"), "event_id"
    )


@query
def upsert_latest(spark, sf_dir):
    target, changes = thirds_and_halves(fixtures.telemetry(spark, sf_dir))
    by = [F.col("enqueuedAt").desc()]
    return dedup.upsert_latest(target, changes, ["eventId"], by).select(*EVENT_COLUMNS)


@query
def unique_violations(spark, sf_dir):
    rows = fixtures.with_duplicates(fixtures.telemetry(spark, sf_dir, False))
    return dedup.unique_violations(rows)


@query
def partition_assign(spark, sf_dir):
    """What holds for any good hash: numbers in range, one per device, all of them used."""
    rows = fixtures.telemetry(spark, sf_dir, False).select("deviceId")
    first = dedup.assign_partition(rows, "deviceId", 16, "p")
    both = dedup.assign_partition(first, "deviceId", 16, "again")
    per_device = both.groupBy("deviceId").agg(F.min("p").alias("low"), F.max("p").alias("high"), F.max("again").alias("again"))
    return per_device.agg(
        F.count("*").alias("devices"),
        F.count_if((F.col("low") == F.col("high")) & (F.col("high") == F.col("again"))).alias("same"),
        F.count_if(F.col("low").between(0, 15)).alias("in_range"),
        F.least(F.count_distinct("low"), F.lit(8)).alias("used"),
    )


@query
def remove_members(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    batch = rows.where("_event_id % 500 = 0")
    return dedup.remove_members(rows, batch, "deviceId").select("eventId", "deviceId")


# -- latest and newest ---------------------------------------------------------------


@query
def latest_per_device(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir)
    return windows.latest_per_device(rows).select(*EVENT_COLUMNS)


@query
def device_status(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir)
    k = F.col("complexData")["k"]
    detail = F.to_json(F.struct(*[(k / i).alias(f"moreData{i}") for i in (1, 2, 4, 5)]))
    rows = rows.withColumn("ComplexData", detail)
    stored = device.status_rows(rows.where("_event_id % 3 = 0"))
    batch = device.status_rows(rows.where("_event_id % 3 <> 0 OR _event_id % 2 = 0"))
    out = device.update_status(stored, batch)
    numbers = {f"MoreData{i}": F.col(f"MoreData{i}").cast("double") for i in range(1, 6)}
    return out.withColumns(numbers).select(
        "deviceId", "eventId", "deviceSequenceNumber", "createdAt", "value", *numbers
    )


@query
def top_per_partition(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir)
    order = ("storedAt", "_event_id")
    return windows.top_per_partition(rows, n=30, total=100, order=order).select(*EVENT_COLUMNS)


@query
def device_newest(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    out = windows.newest_of_device(
        rows, "device-000005", 1, 100, ("storedAt", "_event_id")
    )
    return out.select("eventId", "deviceId", "type", "value", "storedAt", "PartitionId")


@query
def hot_to_cold(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    out = windows.split_newest(rows, 1000, ("processedAt", "_event_id"))
    return out.select("eventId", "deviceId", "processedAt", "tier")


# -- late events, patterns, anomalies ------------------------------------------------


@query
def late_drop(spark, sf_dir):
    rows = fixtures.with_late(fixtures.telemetry(spark, sf_dir, False))
    out = anomaly.late_drop(rows, arrival=("enqueuedAt", "_event_id"))
    return out.select("eventId", "deviceId", "createdAt", "enqueuedAt")


@query
def late_adjust(spark, sf_dir):
    rows = fixtures.with_late(fixtures.telemetry(spark, sf_dir, False))
    out = anomaly.late_adjust(rows, arrival=("enqueuedAt", "_event_id"))
    return out.select("eventId", "deviceId", "createdAt", "enqueuedAt", "adjusted_at")


@query
def pattern_tags(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    return patterns.pattern_tags(rows, ("enqueuedAt", "_event_id"), BAND)


@query
def silent_devices(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    return patterns.silent_devices(rows, DAY_MS, 0, arrival=("enqueuedAt", "_event_id"))


@query
def spike_dip(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    out = anomaly.spike_dip(
        rows, tie=("_event_id",), duration_ms=DAY_MS // 4, time="enqueuedAt"
    )
    # The scores of near-constant histories are cut to fewer digits to compare them.
    return out.withColumn("score", F.round("score", 4))


@query
def spike_dip_robust(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    out = anomaly.spike_dip(
        rows,
        tie=("_event_id",),
        duration_ms=DAY_MS // 4,
        mode=anomaly.SPIKES,
        robust=True,
        confidence=99.0,
    )
    return out.withColumn("score", F.round("score", 4))


# -- series --------------------------------------------------------------------------


def _variables() -> dict[str, series.NumericVariable]:
    value = F.col("value")
    return {
        "temperature": series.NumericVariable(value, F.avg, F.col("type") == "TEMP"),
        "co2": series.NumericVariable(value, F.max, F.col("type") == "CO2"),
    }


@query
def series_events(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    return series.series_events(
        rows,
        SPAN,
        ids=[f"device-{i:06d}" for i in range(1, 6)],
        where=F.col("type").isin("TEMP", "CO2"),
        properties=["eventId", "type", "value"],
        take=1000,
        tie=("_event_id",),
    )


@query
def series_values(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    doubled = series.NumericVariable(F.col("value") * 2, where=F.col("type") == "CO2")
    return series.series_values(
        rows,
        SPAN,
        _variables(),
        where=F.col("type").isin("TEMP", "CO2"),
        overrides={"co2": doubled},
        names=["temperature", "co2"],
    )


@query
def series_aggregate(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    spread = series.AggregateVariable(lambda e: F.max(e("value")) - F.min(e("value")))
    return series.series_aggregate(
        rows, SPAN, "P1D", {**_variables(), "spread": spread}, fill=True
    )


@query
def series_categories(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    variable = series.CategoricalVariable(
        F.col("type"), {"sensor": ["TEMP", "CO2"], "fault": ["ERROR"]}, "other"
    )
    return series.series_categories(
        rows, SPAN, "PT6H", variable, boundary="P2D", tie=("_event_id",)
    )


@query
def series_interpolate(spark, sf_dir):
    how = series.Interpolation(series.LINEAR, timedelta(days=3))
    return _interpolated(spark, sf_dir, how)


@query
def series_step(spark, sf_dir):
    how = series.Interpolation(series.STEP, timedelta(days=3))
    return _interpolated(spark, sf_dir, how)


def _interpolated(spark, sf_dir, how):
    rows = fixtures.telemetry(spark, sf_dir, False)
    variable = series.NumericVariable(
        F.col("value"), where=F.col("type") == "TEMP", interpolation=how
    )
    return series.series_interpolate(rows, SPAN, "PT12H", variable, tie=("_event_id",))


@query
def availability(spark, sf_dir):
    return series.availability(fixtures.telemetry(spark, sf_dir, False), "PT1H")


@query
def availability_range(spark, sf_dir):
    bins = series.availability(fixtures.telemetry(spark, sf_dir, False), "PT1H")
    return series.availability_range(bins)


@query
def event_schema(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir)
    rows = rows.select("eventId", "value", "deviceSequenceNumber", "createdAt", "_props")
    return series.event_schema(rows, SPAN, "_props")


# -- series model --------------------------------------------------------------------


@query
def events_with_model(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    out = hierarchy.with_model(rows, instances(spark, sf_dir))
    return out.groupBy("typeId", "vehicle", "month").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")
    )


@query
def instance_search(spark, sf_dir):
    return hierarchy.instance_search(
        instances(spark, sf_dir),
        "Device 1",
        hierarchy=("year", "month"),
        path=("2020", "3"),
        take=20,
    ).select("deviceId", "name", "vehicle", "month", "rank")


@query
def hierarchy_tree(spark, sf_dir):
    return hierarchy.hierarchy_tree(instances(spark, sf_dir))


@query
def instance_suggest(spark, sf_dir):
    return hierarchy.instance_suggest(instances(spark, sf_dir), "DEVICE-00001")


@query
def model_upsert(spark, sf_dir):
    model = instances(spark, sf_dir)
    changes = model.where("month <= 3").withColumn("vehicle", F.lit("Truck"))
    gone = model.where("month = 12").select("deviceId")
    put = hierarchy.model_put(model.where("month > 1"), changes)
    return hierarchy.model_delete(put, gone).select("deviceId", "name", "vehicle", "month")


# -- device state --------------------------------------------------------------------


@query
def twin_route(spark, sf_dir):
    return device.route(fixtures.telemetry(spark, sf_dir, False)).select(
        "eventId",
        "deviceId",
        "LastUpdate",
        "Temperature",
        F.col("TemperatureData")["k"].alias("temperature_k"),
        "CO2",
        F.col("CO2Data")["k"].alias("co2_k"),
    )


@query
def twin_state(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir)
    state = device.twin_state(rows, ("enqueuedAt", "_event_id"))
    known = device_rows(spark, sf_dir).select("deviceId")
    return device.twins(known, state).select(
        "deviceId",
        "LastUpdate",
        "deviceSequenceNumber",
        "Temperature",
        F.col("TemperatureData")["k"].alias("temperature_k"),
        "CO2",
        F.col("CO2Data")["k"].alias("co2_k"),
    )


@query
def patch_flatten(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    patch = F.concat(
        F.lit('{"patch":[{"op":"replace","path":"/Front/Temperature","value":'),
        F.col("value").cast("string"),
        F.lit('},{"op":"add","path":"/type","value":"'),
        F.col("type"),
        F.lit('"},{"op":"remove","path":"/old"}]}'),
    )
    removal = F.lit('{"patch":[{"op":"remove","path":"/old"}]}')
    body = F.when(F.col("_event_id") % 10 == 0, removal).otherwise(patch)
    flat = device.patch_flatten(
        rows.select(
            body.alias("body"), F.col("deviceId").alias("subject"), F.col("eventId").alias("id")
        )
    )
    return flat.select(
        "deviceId",
        "eventId",
        F.get_json_object("props", "$['Front.Temperature']").cast("double").alias("temperature"),
        F.get_json_object("props", "$.type").alias("type"),
        F.get_json_object("props", "$.deviceId").alias("subject"),
    )


# -- streams: drained into a folder, which is then read ------------------------------


def _drained(spark, rows: DataFrame, write: sinks.Write, out: str, mode: str = "append"):
    """Run a stream to its end; what it has written under ``out``."""
    checkpoint = runs.shared_folder(spark, "checkpoint")
    writer = runs.pipeline(rows, [], checkpoint, mode).foreachBatch(runs.retried(write))
    runs.drain(writer, timeout_s=1800, need_batches=3)
    return sinks.read_batches(spark, out, rows.schema)


def _use_state_store(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


@query
def stream_ingest(spark, sf_dir):
    out = runs.shared_folder(spark, "ingest")
    rows = decode.decode_events(envelope(fixtures.stream(spark, sf_dir)))
    rows = rows.withColumn("k", F.col("complexData")["k"]).drop(
        "complexData", "deviceSequenceNumber"
    )
    return _drained(spark, rows, sinks.append_once(out), out).drop(sinks.BATCH)


@query
def stream_minute_rates(spark, sf_dir):
    out = runs.shared_folder(spark, "rates")
    # The watermark has to cover the disorder, here the whole span of the table.
    rates = minute_rate_stream(fixtures.stream(spark, sf_dir), delay="60 days")
    written = _drained(spark, rates, sinks.append_once(out), out, "update")
    return first_rows(written, ["stored_minute"], [F.col(sinks.BATCH).desc()]).drop(sinks.BATCH)


@query
def stream_summary(spark, sf_dir):
    out = runs.shared_folder(spark, "summary")
    rows = summary_stream(fixtures.stream(spark, sf_dir))
    written = _drained(spark, rows, sinks.append_once(out), out, "update")
    return first_rows(written, ["deviceId", "type"], [F.col(sinks.BATCH).desc()]).drop(sinks.BATCH)


@query
def stream_merge(spark, sf_dir):
    out = runs.shared_folder(spark, "merge")
    target, _ = thirds_and_halves(fixtures.telemetry(spark, sf_dir, False))
    names = [c for c in EVENT_COLUMNS if c != "deviceSequenceNumber"]
    write = sinks.merge_append(out, buckets=8)
    write(target.select(*names), 0)
    _, staging = thirds_and_halves(fixtures.stream(spark, sf_dir))
    rows = staging.select(*names)
    merged = _drained(spark, rows, lambda batch, n: write(batch, n + 1), out)
    return merged.select(*names)


@query
def stream_pattern_tags(spark, sf_dir):
    _use_state_store(spark)
    out = runs.shared_folder(spark, "tags")
    rows = stateful.tag_stream(
        fixtures.stream(spark, sf_dir, in_order=True), BAND, silence_ms=None, tie="_event_id"
    )
    return _drained(spark, rows, sinks.append_once(out), out).drop(sinks.BATCH)


@query
def stream_lru_dedup(spark, sf_dir):
    _use_state_store(spark)
    out = runs.shared_folder(spark, "lru")
    rows = fixtures.stream(spark, sf_dir, in_order=True).select(
        F.col("type").alias("k"),
        F.col("_user_id").alias("id"),
        "createdAt",
        F.col("_event_id").alias("event_id"),
    )
    kept = stateful.lru_stream(rows, ["k"], "id", ["createdAt", "event_id"], size=20)
    written = _drained(spark, kept, sinks.append_once(out), out)
    return written.select("k", "id", "event_id")


def _kept(writer) -> None:
    runs.drain(writer, timeout_s=1800, need_batches=3)


@query
def stream_upsert(spark, sf_dir):
    """The newest row of each event, kept in the state store and read from there."""
    _use_state_store(spark)
    checkpoint = runs.shared_folder(spark, "checkpoint")
    names = [c for c in EVENT_COLUMNS if c != "deviceSequenceNumber"]
    stored, changes = thirds_and_halves(fixtures.stream(spark, sf_dir))
    rows = stored.select(*names).unionByName(changes.select(*names))
    _kept(newest.keep_newest(rows, checkpoint, ("eventId",)))
    return newest.current(spark, checkpoint).select(*names)


@query
def stream_documents(spark, sf_dir):
    """Events as documents with ISO times; what changed in each micro-batch gives the same."""
    _use_state_store(spark)
    checkpoint, out = runs.shared_folder(spark, "checkpoint"), runs.shared_folder(spark, "changes")
    names = ["eventId", "type", "deviceId", "value", "createdAt", "enqueuedAt"]
    rows = fixtures.with_duplicates(fixtures.stream(spark, sf_dir)).select(*names)
    _kept(newest.keep_documents(rows, checkpoint, sinks.append_once(out)))
    found = newest.current(spark, checkpoint)
    changed = sinks.newest_rows(spark, out, found.schema, ["id"]).select("id", F.col("enqueuedAt").alias("changed_at"))
    return found.join(changed, "id").select("id", *names, "changed_at")


def _numbered_stream(spark, sf_dir) -> DataFrame:
    return fixtures.stream(spark, sf_dir).withColumn("deviceSequenceNumber", F.col("_event_id"))


@query
def stream_history_and_status(spark, sf_dir):
    _use_state_store(spark)
    history, status = runs.shared_folder(spark, "history"), runs.shared_folder(spark, "status")
    rows = _numbered_stream(spark, sf_dir).select(
        "deviceId",
        "eventId",
        "deviceSequenceNumber",
        "createdAt",
        "value",
        F.to_json(F.struct(F.col("complexData")["k"].alias("moreData1"))).alias("ComplexData"),
    )
    writers = newest.history_and_status(rows, history, status, runs.shared_folder(spark, "checkpoint"))
    runs.drain_all(writers, timeout_s=1800, need_batches=3)
    stored = sinks.read_batches(spark, history, rows.schema)
    stored = stored.groupBy("deviceId").agg(F.count(F.lit(1)).alias("n_stored"))
    return newest.current(spark, status).join(stored, "deviceId").select(
        "deviceId",
        "eventId",
        "createdAt",
        "value",
        F.col("MoreData1").cast("double").alias("MoreData1"),
        "n_stored",
    )


@query
def stream_twins(spark, sf_dir):
    """Twin state of a stream, from the newest update of each device and property group."""
    _use_state_store(spark)
    checkpoint, arrival = runs.shared_folder(spark, "checkpoint"), ("enqueuedAt", "_event_id")
    _kept(newest.keep_twins(_numbered_stream(spark, sf_dir), checkpoint, arrival))
    return newest.current_twins(spark, checkpoint, arrival).select(
        "deviceId",
        "LastUpdate",
        "deviceSequenceNumber",
        "Temperature",
        F.col("TemperatureData")["k"].alias("temperature_k"),
        "CO2",
        F.col("CO2Data")["k"].alias("co2_k"),
    )


@query
def stream_unique(spark, sf_dir):
    """Batches under a unique key. A batch that repeats an earlier id, or one of its own, fails."""
    out = runs.shared_folder(spark, "unique-key")
    rows = fixtures.stream(spark, sf_dir).select("eventId", "deviceId", "value")
    write, failed = sinks.unique_append(out, buckets=8), []

    def twice(batch, n):
        write(batch, n)
        for again in (batch, batch.union(batch)):
            try:
                write(again, n + 1)
            except ValueError:
                failed.append(n)

    stored = _drained(spark, rows, twice, out).drop(sinks.BATCH)
    return stored.withColumn("all_failed", F.lit(len(failed) >= 6 and len(failed) % 2 == 0).cast("long"))


@query
def stream_watermark_dedup(spark, sf_dir):
    out = runs.shared_folder(spark, "unique")
    rows = fixtures.with_duplicates(fixtures.stream(spark, sf_dir))
    unique = dedup.within_watermark(rows, ["eventId"], "enqueuedAt", "60 days")
    unique = unique.select("eventId", "type", "deviceId")
    return _drained(spark, unique, sinks.append_once(out), out).drop(sinks.BATCH)


@query
def stream_summary_export(spark, sf_dir):
    """The summary so far as CSV after each run; the newest run is read back."""
    out = runs.shared_folder(spark, "export")
    rows = summary_stream(fixtures.stream(spark, sf_dir))
    checkpoint = runs.shared_folder(spark, "checkpoint")
    writer = runs.pipeline(rows, [], checkpoint, "complete").foreachBatch(sinks.csv_export(out))
    runs.drain(writer, 1800, need_batches=3)
    last = sinks.batch_folder(out, sinks.committed(spark, out)[-1])
    kind = "deviceId string, type string, n long, first_at timestamp, last_at timestamp"
    return spark.read.csv(last, schema=kind, header=True)


@query
def stream_tag_batches(spark, sf_dir):
    tags, memory = runs.shared_folder(spark, "tags"), runs.shared_folder(spark, "rings")
    write = batches.tag_batches(tags, memory, BAND, tie="_event_id", buckets=8)
    checkpoint = runs.shared_folder(spark, "checkpoint")
    writer = runs.pipeline(fixtures.stream(spark, sf_dir, in_order=True), [], checkpoint)
    runs.drain(writer.foreachBatch(write), 1800, need_batches=3)
    return sinks.read_batches(spark, tags, TAG).drop(sinks.BATCH)


@query
def stream_dedup_batches(spark, sf_dir):
    out, memory = runs.shared_folder(spark, "unique"), runs.shared_folder(spark, "ids")
    rows = fixtures.stream(spark, sf_dir, in_order=True).select(
        F.col("type").alias("k"),
        F.col("_user_id").alias("id"),
        "createdAt",
        F.col("_event_id").alias("event_id"),
    )
    write = batches.dedup_batches(out, memory, ["k"], "id", ["createdAt", "event_id"], 20, 4)
    return _drained(spark, rows, write, out).select("k", "id", "event_id")


# -- late policies and spikes of a stream --------------------------------------------


def _late_stream(spark, sf_dir) -> DataFrame:
    return fixtures.with_late(fixtures.stream(spark, sf_dir, in_order=True, late=True))


@query
def stream_late_drop(spark, sf_dir):
    out, memory = runs.shared_folder(spark, "late"), runs.shared_folder(spark, "clock")
    rows = _late_stream(spark, sf_dir).select("eventId", "createdAt", "enqueuedAt", "_event_id")
    write = batches.late_batches(out, memory, arrival=("enqueuedAt", "_event_id"), buckets=1)
    return _drained(spark, rows, write, out).select("eventId", "createdAt", "enqueuedAt")


@query
def stream_late_adjust(spark, sf_dir):
    out, memory = runs.shared_folder(spark, "late"), runs.shared_folder(spark, "clock")
    rows = _late_stream(spark, sf_dir).select("eventId", "createdAt", "enqueuedAt", "PartitionId", "_event_id")
    write = batches.late_batches(
        out, memory, arrival=("enqueuedAt", "_event_id"), tolerance_ms=0, keys=("PartitionId",), adjusted="adjusted_at", buckets=4
    )
    runs.drain(
        runs.pipeline(rows, [], runs.shared_folder(spark, "checkpoint")).foreachBatch(write), 1800, need_batches=3
    )
    kind = "eventId string, createdAt timestamp, adjusted_at timestamp, PartitionId long"
    return sinks.read_batches(spark, out, T.StructType.fromDDL(kind)).drop(sinks.BATCH)


@query
def stream_spike_dip(spark, sf_dir):
    out, memory = runs.shared_folder(spark, "scores"), runs.shared_folder(spark, "values")
    rows = fixtures.stream(spark, sf_dir, in_order=True).select("PartitionId", "enqueuedAt", "value", "_event_id")
    write = batches.spike_batches(out, memory, tie=("_event_id",), duration_ms=6 * 3_600_000, buckets=4)
    runs.drain(
        runs.pipeline(rows, [], runs.shared_folder(spark, "checkpoint")).foreachBatch(write), 1800, need_batches=3
    )
    kind = "PartitionId long, time timestamp, val double, score double, is_anomaly long"
    scores = sinks.read_batches(spark, out, T.StructType.fromDDL(kind)).drop(sinks.BATCH)
    return scores.withColumn("score", F.round("score", 4))


@query
def stream_silent_devices(spark, sf_dir):
    """Pattern and silence tags of a stream with timers.

    A timer goes off in the first micro-batch whose watermark, the newest arrival of the
    batches before it, has passed it; if no event of the device has arrived until then, that
    batch included, the device is silent. After the last one an empty batch follows.
    """
    _use_state_store(spark)
    out = runs.shared_folder(spark, "silent")
    rows = stateful.tag_stream(
        fixtures.stream(spark, sf_dir, in_order=True), BAND, silence_ms=DAY_MS, delay="0 seconds", tie="_event_id"
    )
    return _drained(spark, rows, sinks.append_once(out), out).drop(sinks.BATCH)


@query
def stream_summary_increments(spark, sf_dir):
    """What changed of the summary in each run, with the run's number, as CSV.

    The last export of a device and type is its summary; it was exported once for each run
    that had events of it.
    """
    _use_state_store(spark)
    out = runs.shared_folder(spark, "increments")
    rows = summary_stream(fixtures.stream(spark, sf_dir))
    writer = runs.pipeline(rows, [], runs.shared_folder(spark, "checkpoint"), "update")
    runs.drain(writer.foreachBatch(sinks.csv_export(out)), 1800, need_batches=3)
    kind = "deviceId string, type string, n long, first_at timestamp, last_at timestamp, batch_id long"
    exports = spark.read.csv(out, schema=kind, header=True)
    times = Window.partitionBy("deviceId", "type")
    exports = exports.withColumn("exports", F.count(F.lit(1)).over(times))
    return first_rows(exports, ["deviceId", "type"], [F.col("batch_id").desc()]).drop("batch_id")


@query
def stream_metrics(spark, sf_dir):
    """Processing figures of each micro-batch, observed while its rows are stored."""
    out = runs.shared_folder(spark, "observed")
    rows = metrics.observe_processing(fixtures.stream(spark, sf_dir), F.col("type") == "ERROR")
    listener = metrics.BatchMetrics(metrics.PROCESSING)
    spark.streams.addListener(listener)
    try:
        _drained(spark, rows.select("eventId"), sinks.append_once(out), out)
        found = listener.ended()
    finally:
        spark.streams.removeListener(listener)
    names = ["n", "n_bad", "min_ms", "max_ms", "avg_ms"]
    told = [tuple(row[c] for c in names) for _, row in sorted(found) if row["n"]]
    return spark.createDataFrame(told, "n long, n_bad long, min_ms double, max_ms double, avg_ms double")


# -- sources: the events in the form of a source, read back --------------------------


def _event_names() -> list[str]:
    return ["eventId", "type", "deviceId", "value", "createdAt"]


@query
def json_folder_stream(spark, sf_dir):
    """JSON lines of events as a stream of several files per batch."""
    base, out = runs.shared_folder(spark, "json"), runs.shared_folder(spark, "json-out")
    rows = fixtures.telemetry(spark, sf_dir, False).select(*_event_names(), "_event_id")
    for i in range(3):
        part = rows.where(F.col("_event_id") % 3 == i).select(*_event_names())
        decode.record_to_json(part).write.mode("append").text(base)
    names = len(spark.read.text(base).inputFiles())
    kind = "eventId string, type string, deviceId string, value double, createdAt timestamp"
    stream = json_stream(spark, base, T.StructType.fromDDL(kind), max_files=max(1, names // 3))
    return _drained(spark, stream, sinks.append_once(out), out).drop(sinks.BATCH)


@query
def capture_read(spark, sf_dir):
    base = runs.shared_folder(spark, "captures")
    rows = fixtures.telemetry(spark, sf_dir, False)
    envelope(rows).select(
        F.date_format("enqueuedTime", scalars.CAPTURE_TIME).alias("EnqueuedTimeUtc"), F.col("body").alias("Body")
    ).write.parquet(base)
    return files.capture_events(spark, base, "parquet").select("eventId", "deviceId", "value", "enqueuedAt")


@query
def document_read(spark, sf_dir):
    base = runs.shared_folder(spark, "documents")
    rows = fixtures.telemetry(spark, sf_dir, False).select(*_event_names(), "enqueuedAt", "processedAt", "storedAt")
    rows = rows.withColumn("_ts", F.unix_seconds("storedAt")).drop("storedAt").withColumn("value", F.col("value").cast("string"))
    scalars.timestamps_to_iso(rows).write.json(base)
    names = ["eventId", "deviceId", "createdAt", "enqueuedAt", "storedAt"]
    return stores.documents(spark, base).select(*names)


@query
def event_time_only(spark, sf_dir):
    rows = stores.event_time_only(fixtures.telemetry(spark, sf_dir, False))
    return rows.select("eventId", "createdAt", "enqueuedAt", "storedAt")


@query
def delimited_read(spark, sf_dir):
    """Tab-separated text without a header, read back by name of the format."""
    base = runs.shared_folder(spark, "tsv")
    rows = fixtures.telemetry(spark, sf_dir, False).select("eventId", "type", "value")
    rows.write.csv(base, sep="\t")
    kind = T.StructType.fromDDL("eventId string, type string, value double")
    return files.read_any(spark, base, "tsv", kind)


# -- sinks ---------------------------------------------------------------------------


@query
def sink_json_lines(spark, sf_dir):
    out = runs.shared_folder(spark, "lines")
    rows = fixtures.stream(spark, sf_dir).select(*_event_names())
    checkpoint = runs.shared_folder(spark, "checkpoint")
    runs.drain(runs.pipeline(rows, [], checkpoint).foreachBatch(sinks.json_lines(out)), 1800, need_batches=3)
    kind = "eventId string, type string, deviceId string, value double, createdAt timestamp"
    return spark.read.schema(kind).json(f"{out}/{sinks.BATCH}=*")


@query
def sink_payload(spark, sf_dir):
    """One id and one time of storing per micro-batch: compared by what must hold."""
    out = runs.shared_folder(spark, "payload")
    rows = fixtures.stream(spark, sf_dir).select("eventId", "value")
    stored = _drained(spark, rows, sinks.payload_append(out), out)
    full = spark.read.parquet(out)
    per_batch = full.groupBy(sinks.BATCH).agg(
        F.count_distinct("BatchId").alias("ids"), F.count_distinct("StoredAt").alias("times"), F.count("*").alias("n")
    )
    return per_batch.agg(
        F.sum("n").alias("events"), F.max("ids").alias("ids"), F.max("times").alias("times"), (F.count("*") >= 3).cast("long").alias("several")
    )


@query
def sink_retried(spark, sf_dir):
    """A writer that fails twice per batch leaves each event once."""
    out = runs.shared_folder(spark, "retried")
    failures: dict[int, int] = {}
    once = sinks.append_once(out)

    def flaky(batch, batch_id):
        failures[batch_id] = failures.get(batch_id, 0) + 1
        if failures[batch_id] <= 2:
            raise OSError("planned failure")
        once(batch, batch_id)

    rows = fixtures.stream(spark, sf_dir).select("eventId", "deviceId")
    writer = runs.pipeline(rows, [], runs.shared_folder(spark, "checkpoint"))
    runs.drain(writer.foreachBatch(runs.retried(flaky, wait=lambda s: None)), 1800, need_batches=3)
    return sinks.read_batches(spark, out, rows.schema).drop(sinks.BATCH)


@query
def sink_restarted(spark, sf_dir):
    """A stream that fails after one micro-batch and is run again stores each event once."""
    out, checkpoint = runs.shared_folder(spark, "restarted"), runs.shared_folder(spark, "checkpoint")
    rows = fixtures.stream(spark, sf_dir).select("eventId", "deviceId")
    once = sinks.append_once(out)

    def until_the_second(batch, batch_id):
        once(batch.limit(5) if batch_id else batch, batch_id)  # half-written when it fails
        if batch_id:
            raise OSError("planned failure")

    try:
        runs.drain(runs.pipeline(rows, [], checkpoint).foreachBatch(until_the_second), 1800)
    except StreamingQueryException:
        pass
    before = sinks.committed(spark, out)
    query = runs.drain(runs.pipeline(rows, [], checkpoint).foreachBatch(once), 1800, need_batches=2)
    again = sorted(p["batchId"] for p in query.recentProgress if p["numInputRows"])
    ok = before == [0, 1] and again[0] == 1
    return sinks.read_batches(spark, out, rows.schema).drop(sinks.BATCH).withColumn("restarted", F.lit(int(ok)).cast("long"))


# -- small operators -----------------------------------------------------------------


@query
def clock_columns(spark, sf_dir):
    """Clocks and random ids cannot be compared: what must hold of them."""
    rows = fixtures.telemetry(spark, sf_dir, False).select("eventId", "createdAt")
    rows = enrich.with_batch_id(enrich.with_stored_at(enrich.with_processed_at(rows)))
    rows = rows.withColumn("own", scalars.new_id())
    return rows.agg(
        F.count("*").alias("events"),
        F.count_if(F.col("processedAt") > F.col("createdAt")).alias("processed_later"),
        F.count_if(F.col("storedAt") >= F.col("processedAt")).alias("stored_later"),
        F.count_distinct("BatchId").alias("batch_ids"),
        F.count_distinct("own").alias("own_ids"),
    )


@query
def events_of_type(spark, sf_dir):
    rows = enrich.of_type(fixtures.telemetry(spark, sf_dir, False), "CO2")
    per_day = rows.groupBy(F.to_date("createdAt").cast("string").alias("day"))
    mean = (F.avg("value") / 60).alias("per_second")
    return per_day.agg(mean).select("day", aggregate.per_minute("per_second").alias("per_minute"))


@query
def ranked_newest(spark, sf_dir):
    """The newest rows with their place, so that the order is compared too."""
    rows = windows.newest(fixtures.telemetry(spark, sf_dir, False), 50, ("storedAt", "_event_id"))
    place = F.row_number().over(Window.orderBy(F.col("storedAt").desc(), F.col("_event_id").desc()))
    return rows.select(place.alias("place"), "eventId", "storedAt")


@query
def json_scalars(spark, sf_dir):
    rows = fixtures.telemetry(spark, sf_dir, False)
    return rows.select(
        "eventId",
        scalars.is_json("_props").cast("long").alias("valid"),
        scalars.json_number("_props", "$.k").cast("double").alias("k"),
        scalars.bin_start("createdAt", "1 hour").alias("hour"),
    )


@query
def hot_cold_move(spark, sf_dir):
    hot, cold = runs.shared_folder(spark, "hot"), runs.shared_folder(spark, "cold")
    rows = fixtures.telemetry(spark, sf_dir, False).select("eventId", "deviceId", "processedAt", "_event_id")
    sinks.move_newest(rows, hot, cold, 0, 1000, ("processedAt", "_event_id"))
    parts = [
        sinks.read_batches(spark, path, rows.schema).withColumn("tier", F.lit(tier))
        for path, tier in ((hot, "hot"), (cold, "cold"))
    ]
    return parts[0].unionByName(parts[1]).select("eventId", "deviceId", "processedAt", "tier")


@query
def series_aggregate_interpolated(spark, sf_dir):
    variable = series.NumericVariable(
        F.col("value"),
        where=F.col("type") == "TEMP",
        interpolation=series.Interpolation(series.LINEAR, timedelta(days=3)),
    )
    rows = fixtures.telemetry(spark, sf_dir, False)
    return series.series_aggregate(rows, SPAN, "PT12H", {"value": variable}, fill=True, tie=("_event_id",))


@query
def stream_late_side(spark, sf_dir):
    """The events that the late policy drops, from its side output."""
    out, memory = runs.shared_folder(spark, "late"), runs.shared_folder(spark, "clock")
    side = runs.shared_folder(spark, "late-side")
    rows = _late_stream(spark, sf_dir).select("eventId", "createdAt", "enqueuedAt", "_event_id")
    write = batches.late_batches(out, memory, arrival=("enqueuedAt", "_event_id"), buckets=1, side=side)
    _drained(spark, rows, write, out)
    return sinks.read_batches(spark, side, rows.schema).select("eventId", "createdAt", "enqueuedAt")
