"""Event, envelope and result schemas."""

from __future__ import annotations

from pyspark.sql import types as T

EVENT = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("complexData", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("value", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("deviceId", T.StringType()),
        T.StructField("deviceSequenceNumber", T.LongType()),
        T.StructField("createdAt", T.TimestampType()),
    ]
)

PROCESSED_EVENT = T.StructType(
    EVENT.fields
    + [
        T.StructField("enqueuedAt", T.TimestampType()),
        T.StructField("processedAt", T.TimestampType()),
        T.StructField("processedAt2", T.TimestampType()),
        T.StructField("PartitionId", T.IntegerType()),
    ]
)

LOG_ENVELOPE = T.StructType(
    [
        T.StructField("body", T.BinaryType()),
        T.StructField("offset", T.StringType()),
        T.StructField("sequenceNumber", T.LongType()),
        T.StructField("publisher", T.StringType()),
        T.StructField("partitionKey", T.StringType()),
        T.StructField("enqueuedTime", T.TimestampType()),
    ]
)

KAFKA_ENVELOPE = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

CAPTURE_FILE = T.StructType(
    [
        T.StructField("EnqueuedTimeUtc", T.StringType()),
        T.StructField("Body", T.BinaryType()),
    ]
)

DOCUMENT = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("complexData", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("value", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("deviceId", T.StringType()),
        T.StructField("deviceSequenceNumber", T.LongType()),
        T.StructField("createdAt", T.StringType()),
        T.StructField("enqueuedAt", T.StringType()),
        T.StructField("processedAt", T.StringType()),
        T.StructField("_ts", T.LongType()),
    ]
)

TAG = T.StructType(
    [
        T.StructField("deviceId", T.StringType()),
        T.StructField("trigger_at", T.TimestampType()),
        T.StructField("trigger_id", T.StringType()),
        T.StructField("tag", T.StringType()),
    ]
)


def wide_complex_data(first: int = 0, last: int = 22) -> T.StructType:
    """The struct form of ``complexData``: moreData<first> .. moreData<last>."""
    return T.StructType(
        [T.StructField(f"moreData{i}", T.DoubleType()) for i in range(first, last + 1)]
    )


def event_schema(complex_data: T.DataType | None = None) -> T.StructType:
    """The event schema with another type for ``complexData``."""
    if complex_data is None:
        return EVENT
    return T.StructType(
        [
            T.StructField(f.name, complex_data) if f.name == "complexData" else f
            for f in EVENT.fields
        ]
    )
