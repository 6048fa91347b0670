"""Column expressions and schema-driven column rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Time texts of documents and capture files.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSSX"
CAPTURE_TIME = "M/d/y h:mm:ss a"


def minute_of(ts: Column | str) -> Column:
    """Start of the minute."""
    return F.date_trunc("minute", ts)


def seconds_of(ts: Column | str) -> Column:
    """Epoch seconds with fraction."""
    return F.unix_micros(ts) / F.lit(1_000_000.0)


def millis_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed milliseconds with fraction."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1000.0)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed seconds with fraction, from exact microseconds."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text with milliseconds and zone; ``Z`` in a UTC session."""
    return F.date_format(ts, ISO_MILLIS)


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 text with any fraction and any offset; null if it cannot be read."""
    column = F.col(text) if isinstance(text, str) else text
    return column.try_cast("timestamp")


def parse_capture_time(text: Column | str) -> Column:
    """Times of capture files, e.g. ``1/31/2024 11:05:09 PM``; null if unreadable."""
    column = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(column, F.lit(CAPTURE_TIME))


def json_number(json: Column | str, path: str) -> Column:
    """A number inside a JSON text as ``decimal(18,4)``; null if absent or no number."""
    return F.get_json_object(json, path).try_cast("decimal(18,4)")


def partition_of(key: Column | str, partitions: int) -> Column:
    """Deterministic partition number of a key, ``0 .. partitions-1``."""
    return F.pmod(F.hash(key), F.lit(max(int(partitions), 1)))


def bin_start(ts: Column | str, width: str) -> Column:
    """Start of the epoch-aligned bin that holds ``ts``."""
    return F.window(ts, width)["start"]


def is_json(text: Column | str) -> Column:
    """True if the text is valid JSON; null stays null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.when(column.isNotNull(), F.try_parse_json(column).isNotNull())


def record_field(record: str, name: str, kind: str) -> Column:
    """A field of a struct column with a cast."""
    return F.col(record)[name].cast(kind)


def new_id() -> Column:
    """A random id per row. Not repeatable: write it, do not recompute it."""
    return F.uuid()


def now() -> Column:
    """Time of the query or, in a stream, of the micro-batch."""
    return F.current_timestamp()


def timestamps_to_iso(df: DataFrame) -> DataFrame:
    """Every timestamp column as ISO text."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({n: iso_text(n) for n in names}) if names else df


def iso_to_timestamps(df: DataFrame, *names: str) -> DataFrame:
    """The named text columns as timestamps."""
    return df.withColumns({n: parse_iso(n) for n in names})


def structs_to_json(df: DataFrame, *names: str) -> DataFrame:
    """The named struct or map columns as compact JSON text."""
    return df.withColumns({n: F.to_json(n) for n in names})


def strip_type_suffix(
    df: DataFrame, suffixes: tuple[str, ...] = ("_string", "_long", "_double", "_dateTime")
) -> DataFrame:
    """``name_type`` columns of a typed export back to ``name``.

    A column keeps its suffix if two types of the same property are present.
    """
    short = {}
    for name in df.columns:
        for suffix in suffixes:
            if name.endswith(suffix):
                short[name] = name.removesuffix(suffix)
    taken = [*short.values(), *[c for c in df.columns if c not in short]]
    return df.withColumnsRenamed({n: s for n, s in short.items() if taken.count(s) == 1})
