"""Message bodies to events. All narrow: no shuffle, usable on batches and streams."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.scalars import ISO_MILLIS, parse_capture_time
from fleetlens.schema import EVENT, PROCESSED_EVENT


def body_text(body: str = "body") -> Column:
    """The body as text, or null if its bytes are no UTF-8."""
    return F.try_validate_utf8(F.col(body).cast("string"))


def decode_events(
    df: DataFrame,
    body: str = "body",
    arrived: str = "enqueuedTime",
    schema: T.StructType = EVENT,
) -> DataFrame:
    """One JSON event per message; the time of the envelope becomes ``enqueuedAt``."""
    event = F.from_json(body_text(body), schema)
    return df.select(event.alias("event"), F.col(arrived).alias("enqueuedAt")).select(
        "event.*", "enqueuedAt"
    )


def explode_array(
    df: DataFrame,
    body: str = "body",
    arrived: str = "enqueuedTime",
    schema: T.StructType = PROCESSED_EVENT,
    keep: Iterable[str] = (),
) -> DataFrame:
    """One JSON array of events per message. A message with a single object also works.

    The events carry their own ``enqueuedAt``; the time of the outer envelope is when the
    processed batch was stored. ``keep`` names further columns of the message.
    """
    events = F.from_json(body_text(body), T.ArrayType(schema))
    return df.select(
        F.explode(events).alias("event"), F.col(arrived).alias("storedAt"), *keep
    ).select("event.*", "storedAt", *keep)


def explode_lines(
    df: DataFrame,
    body: str = "body",
    schema: T.StructType = PROCESSED_EVENT,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Newline-separated JSON events in one message; lines that are no JSON are left out."""
    good, _ = split_malformed(
        df.select(*keep, F.explode(F.split(body_text(body), "\n")).alias("_line")),
        "_line",
        schema,
    )
    return good.drop("_line")


def decode_capture(df: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Rows of capture files: body plus a twelve-hour clock text for the arrival time."""
    event = F.from_json(body_text("Body"), schema)
    return df.select(
        event.alias("event"), parse_capture_time("EnqueuedTimeUtc").alias("enqueuedAt")
    ).select("event.*", "enqueuedAt")


def map_paths(
    df: DataFrame, mapping: Mapping[str, tuple[str, str]], text: Column
) -> DataFrame:
    """Columns from JSON paths: ``{"value": ("$.value", "string")}``.

    The type ``variant`` keeps a dynamic value, ``json`` its text.
    """
    columns = []
    for name, (path, kind) in mapping.items():
        found = F.get_json_object(text, path)
        if kind == "variant":
            found = F.try_parse_json(found)
        elif kind not in ("string", "json"):
            found = found.try_cast(kind)
        columns.append(found.alias(name))
    return df.select(*columns)


def split_malformed(
    df: DataFrame, text: str, schema: T.StructType = EVENT
) -> tuple[DataFrame, DataFrame]:
    """Good events and a quarantine of messages that cannot be read.

    A bad message never fails its batch. ``text`` may hold texts or bytes. The quarantine
    has it as it came, and a reason.
    """
    corrupt = "_corrupt"
    content = body_text(text)
    parsed = F.from_json(
        content,
        T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt},
    )
    others = [c for c in df.columns if c != text]
    # As a generator, the parser runs once per message for both the test and the fields.
    readable = F.filter(F.array(parsed), lambda e: e.isNotNull() & e[corrupt].isNull())
    good = df.select(*others, text, F.inline(readable)).drop(corrupt)
    reason = F.when(F.col(text).isNull(), "empty message").when(content.isNull(), "not UTF-8")
    reason = reason.when(
        parsed.isNull() | parsed[corrupt].isNotNull(), "not a JSON event"
    )
    bad = df.select(*others, text, reason.alias("reason")).where("reason is not null")
    return good, bad


def record_to_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON record, times in UTC with milliseconds, nulls written."""
    options = {
        "timestampFormat": ISO_MILLIS,
        "timeZone": "UTC",
        "ignoreNullFields": "false",
    }
    return df.select(F.to_json(F.struct(*df.columns), options).alias(name))


def json_to_record(
    df: DataFrame, schema: T.StructType, name: str = "value"
) -> DataFrame:
    """Back from :func:`record_to_json`. Any ISO fraction and offset is accepted."""
    text = F.col(name).cast("string")
    return df.select(F.from_json(text, schema).alias("_r")).select("_r.*")
