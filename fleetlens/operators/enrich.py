"""Times, ids, filters and projections around an event."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.scalars import new_id, now
from fleetlens.operators.ordered import DEFAULT, Limits, numbered


def with_processed_at(df: DataFrame, name: str = "processedAt") -> DataFrame:
    return df.withColumn(name, now())


def with_stored_at(df: DataFrame) -> DataFrame:
    return df.withColumn("storedAt", now())


def with_enqueued_from_created(df: DataFrame) -> DataFrame:
    """For sources without an envelope time."""
    return df.withColumn("enqueuedAt", F.col("createdAt"))


def with_document_id(df: DataFrame) -> DataFrame:
    return df.withColumn("id", F.col("eventId"))


def with_batch_id(df: DataFrame, batch_id: str | None = None) -> DataFrame:
    """One id for the whole write, or a fresh one per row if none is given."""
    return df.withColumn("BatchId", new_id() if batch_id is None else F.lit(batch_id))


def position_in_batch(
    df: DataFrame,
    batch: Sequence[str],
    order: Sequence[str],
    name: str = "positionInBatch",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """1..n inside each batch, in log order; a batch of any size is spread over tasks."""
    return numbered(df, batch, order, name, limits)


def relay(
    df: DataFrame, arrived: str = "timestamp", processed: Column | None = None
) -> DataFrame:
    """Broker time to ``enqueuedAt``, now to ``processedAt``."""
    return df.withColumns(
        {
            "enqueuedAt": F.col(arrived),
            "processedAt": now() if processed is None else processed,
        }
    ).drop(arrived)


def project(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Reorder and rename: ``{"EventId": "eventId"}``. Narrow, keeps the partitioning."""
    return df.select(*[F.col(source).alias(target) for target, source in names.items()])


def payload_rows(df: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Typed rows of the relational target: decimal value, compact JSON detail."""
    rows = with_batch_id(df, batch_id)
    return rows.select(
        F.col("eventId").alias("EventId"),
        F.col("BatchId"),
        F.to_json("complexData").alias("ComplexData"),
        F.col("value").try_cast("decimal(18,0)").alias("Value"),
        F.col("deviceId").alias("DeviceId"),
        F.col("deviceSequenceNumber").alias("DeviceSequenceNumber"),
        F.col("type").alias("Type"),
        F.col("createdAt").alias("CreatedAt"),
        F.col("enqueuedAt").alias("EnqueuedAt"),
        F.col("processedAt").alias("ProcessedAt"),
        F.col("PartitionId"),
    )


def of_type(df: DataFrame, kind: str) -> DataFrame:
    """Equality filter on ``type``; reaches the file scan."""
    return df.where(F.col("type") == kind)


def of_counters(
    df: DataFrame,
    names: Sequence[str],
    tag: str | None = None,
    tag_value: str | None = None,
    namespace: str | None = None,
) -> DataFrame:
    """Samples of the given counters, optionally of one namespace and one tag value."""
    keep = F.col("Name").isin(*names)
    if namespace is not None:
        keep = keep & (F.col("Namespace") == namespace)
    if tag is not None:
        keep = keep & (F.get_json_object("Tags", f"$.{tag}") == tag_value)
    return df.where(keep)
