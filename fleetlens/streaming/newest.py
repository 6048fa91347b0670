"""The newest row of each key, kept by a streaming aggregate.

What a key was last is the state of the aggregate: it lies in Spark's state store, which
checkpoints what changed, takes each micro-batch exactly once and spreads the keys over its
partitions. Copies of a hot key are reduced in the tasks that read them. The query itself
emits the changes of each micro-batch; ``current`` reads all keys from the state store. For
versions of the table and their removal use a table format (``sinks.delta_merge``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetlens.functions.scalars import json_number, timestamps_to_iso
from fleetlens.operators.device import fold_routes, routed
from fleetlens.operators.windows import SEQUENCE
from fleetlens.streaming import sinks

_MET, _ROW = "_met", "_row"


def newest_stream(
    df: DataFrame,
    keys: Sequence[str] = ("id",),
    order: Sequence[str] = ("enqueuedAt",),
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The newest row per key, by ``order``; of rows equal in it that of the later micro-batch,
    and within one micro-batch any of them. Without ``order`` the later micro-batch wins.

    Null order values come first. Needs output mode ``update`` (changed keys) or
    ``complete`` (all keys, each time). The columns ``derived`` are added to the kept rows:
    inside the aggregate, so that they are worked out only when a row replaces another one.
    """
    derived = derived or {}
    names = dict.fromkeys([*df.columns, *derived])
    rest = [derived.get(c, F.col(c)).alias(c) for c in names if c not in keys]
    # The time of the micro-batch: one value for all its rows, and the same in a replay.
    rows = df.withColumn(_MET, F.current_timestamp())
    best = F.max_by(F.struct(*rest), F.struct(*order, _MET))
    return rows.groupBy(*keys).agg(best.alias(_ROW)).select(*keys, f"{_ROW}.*")


def keep_newest(
    df: DataFrame,
    checkpoint: str,
    keys: Sequence[str] = ("id",),
    order: Sequence[str] = ("enqueuedAt",),
    changes: sinks.Write | None = None,
    derived: Mapping[str, Column] | None = None,
) -> DataStreamWriter:
    """A writer that keeps the newest rows in the state below ``checkpoint``.

    ``changes`` gets the changed keys of each micro-batch, e.g. ``sinks.append_once(path)``.
    """
    writer = newest_stream(df, keys, order, derived).writeStream.outputMode("update")
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.format("noop") if changes is None else writer.foreachBatch(changes)


def current(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """All keys with their newest row, after the last finished micro-batch or ``batch_id``.

    Read by Spark's state reader: one task per state partition. The keys come first.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    row = state.schema["value"].dataType.fieldNames()[0]
    return state.select("key.*", f"value.{row}.*")


# -- what the solutions keep ---------------------------------------------------------


def documents(df: DataFrame) -> DataFrame:
    """Events as documents: ``id`` and times as ISO texts, which sort like the times."""
    return timestamps_to_iso(df.withColumn("id", F.col("eventId")))


def keep_documents(df: DataFrame, checkpoint: str, changes: sinks.Write | None = None) -> DataStreamWriter:
    """The newest document of each event id."""
    return keep_newest(documents(df), checkpoint, ("id",), ("enqueuedAt",), changes)


def keep_status(
    events: DataFrame,
    checkpoint: str,
    detail: str = "ComplexData",
    always_replace: bool = False,
    changes: sinks.Write | None = None,
) -> DataStreamWriter:
    """The newest event of each device with the first five detail numbers extracted.

    A row with a higher sequence number stays, unless ``always_replace`` asks for that of
    the later micro-batch.
    """
    columns = {f"MoreData{i}": _number_in(detail, f"moreData{i}") for i in range(1, 6)}
    order = () if always_replace else (SEQUENCE, "eventId")
    return keep_newest(events, checkpoint, ("deviceId",), order, changes, columns)


def _number_in(detail: str, name: str) -> Column:
    """A number of a JSON text, which is parsed only if it can hold the name, plain or escaped."""
    text = F.col(detail)
    return F.when(text.contains(name) | text.contains("\\"), json_number(detail, f"$.{name}"))


def history_and_status(
    events: DataFrame, history: str, status_checkpoint: str, history_checkpoint: str
) -> tuple[DataStreamWriter, DataStreamWriter]:
    """Dual write: all events into the folder ``history``, and the status of each device.

    Two queries over one source, each exactly once by itself; neither waits for the other, so
    run them at once (``runs.drain_all``).
    """
    append = events.writeStream.option("checkpointLocation", history_checkpoint)
    return append.foreachBatch(sinks.payload_append(history)), keep_status(events, status_checkpoint)


def keep_twins(
    events: DataFrame, checkpoint: str, arrival: Sequence[str] = ("enqueuedAt", "eventId")
) -> DataStreamWriter:
    """Twin state of a stream: the newest update of each device and property group."""
    return keep_newest(routed(events, arrival), checkpoint, ("deviceId", "_route"), arrival)


def current_twins(
    spark: SparkSession, checkpoint: str, arrival: Sequence[str] = ("enqueuedAt", "eventId")
) -> DataFrame:
    """One row per device: its few property groups folded into one."""
    return fold_routes(current(spark, checkpoint), arrival)
