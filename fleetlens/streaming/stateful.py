"""Keyed state in streams: event patterns with silence timers, bounded duplicate memory.

The batch forms (``operators.patterns``, ``operators.dedup``) give the same results on
the same arrival order. State is one small JSON text per key, or per bucket of devices.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, MutableMapping
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetlens.operators.dedup import recently_seen
from fleetlens.operators.patterns import BAND, BAND_AND_CO2, COUNTED, FIRST, SILENT, Rules
from fleetlens.schema import TAG

STATE = T.StructType([T.StructField("state", T.StringType())])
#: Rows that a state function hands out at once.
OUT_ROWS = 10_000


@dataclass
class DeviceMemory:
    """What is remembered of a device: its last events, and the tags given, by event id.

    ``dump`` leaves out ``given``: that holds the tags of a micro-batch, and a stream
    remembers those of earlier ones natively. Of events but the last one only the two
    marks are kept.
    """

    rules: Rules = field(default_factory=Rules)
    ring: list = field(default_factory=list)
    given: MutableMapping[str, list] = field(default_factory=dict)
    tagged: bool = False

    @classmethod
    def load(cls, text: str | None, rules: Rules, given: MutableMapping | None = None) -> DeviceMemory:
        memory = cls(rules, given={} if given is None else given)
        if text:
            event_id, created, marks, memory.tagged = json.loads(text)
            memory.ring = [[None, None, band, high] for band, high in marks]
            if memory.ring:
                memory.ring[-1][:2] = event_id, created
        return memory

    def dump(self) -> str:
        event_id, created = self.ring[-1][:2] if self.ring else (None, None)
        return json.dumps([event_id, created, [[int(e[2]), int(e[3])] for e in self.ring], self.tagged])

    def add(self, event_id, created, kind, value) -> list[tuple]:
        """Remember an event; the tags it causes as ``(created, id, tag)``."""
        rules = self.rules
        first = not self.tagged
        band = kind == "TEMP" and value is not None and rules.band_low <= value < rules.band_high
        high = kind == "CO2" and value is not None and value > rules.co2_above
        self.ring = [*self.ring, [event_id, created, band, high]][-rules.ring :]
        held = len(self.ring)
        several = sum(e[2] for e in self.ring) >= 2
        wanted = [FIRST] if first else []
        if 1 < held < rules.ring:
            wanted.append(f"{held}{COUNTED}")
        if several and band:
            wanted.append(BAND)
        if several and any(e[3] for e in self.ring):
            wanted.append(BAND_AND_CO2)
        return self._tag(event_id, created, wanted)

    def silence(self, timer_ms: int, silence_ms: int) -> list[tuple]:
        """A timer went off: a tag, unless a newer event came in the meantime."""
        if not self.ring:
            return []
        event_id, created = self.ring[-1][:2]
        if timer_ms - created // 1000 < silence_ms:
            return []
        return self._tag(event_id, created, [f"{SILENT}{silence_ms}ms"])

    def _tag(self, event_id, created, wanted) -> list[tuple]:
        """Those of the tags that this event id has not had yet."""
        had = self.given.get(event_id, []) if wanted else []
        new = [tag for tag in wanted if tag not in had]
        if new:
            self.given[event_id] = [*had, *new]
            self.tagged = True
        return [(created, event_id, tag) for tag in new]

    def due(self, silence_ms: int) -> int:
        """When the device is silent, unless it sends another event."""
        return self.ring[-1][1] // 1000 + silence_ms


def _frame(tags: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "deviceId": [t[0] for t in tags],
            "trigger_at": pd.to_datetime([t[1] for t in tags], unit="us", utc=True),
            "trigger_id": [t[2] for t in tags],
            "tag": [t[3] for t in tags],
        }
    )


class TagEvents(StatefulProcessor):
    """Tags per device in arrival order; ``silence_ms`` sets event-time timers.

    A state key is a bucket of devices. A call to the state store takes as long as dozens of
    events, so a micro-batch reads and writes a bucket once, and a bucket has one timer: the
    next one of its devices. Only the last event of a device counts for its silence, so a
    device has one time at which it is due, until it is told silent. A tag may come once more
    for an event id that comes again in another micro-batch.
    """

    def __init__(self, rules: Rules, silence_ms: int | None) -> None:
        self.rules, self.silence_ms = rules, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("devices", STATE)

    def _load(self) -> tuple[int | None, dict]:
        """The timer of the bucket, and by device when it is due and its memory as a text."""
        state = self.state.get()
        timer, devices = json.loads(state[0]) if state else (None, [])
        return timer, {device: (due, text) for device, due, text in devices}

    def _store(self, timer: int | None, devices: dict, watermark: int) -> None:
        """Set the next timer. Those up to the watermark go off, or have done so."""
        following = min((due for due, _ in devices.values() if due is not None), default=None)
        if following != timer:
            if timer is not None and timer > watermark:
                self.handle.deleteTimer(timer)
            if following is not None:
                self.handle.registerTimer(following)
        listed = [[device, *held] for device, held in devices.items()]
        self.state.update((json.dumps([following, listed]),))

    def _silent(self, devices: dict, watermark: int) -> list[tuple]:
        """The tags of devices that are due, which they are no more afterwards."""
        tags = []
        for device, (due, text) in devices.items():
            if due is not None and due <= watermark:
                memory = DeviceMemory.load(text, self.rules)
                tags += [(device, *tag) for tag in memory.silence(due, self.silence_ms)]
                devices[device] = (None, text)
        return tags

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        timer, devices = self._load()
        batch = pd.concat(list(rows)).sort_values(["arrived_us", "arrived_tie"], kind="stable")
        batch["value"] = batch["value"].astype("float64")
        names = ["deviceId", "eventId", "created_us", "type", "value"]
        memories: dict[str, DeviceMemory] = {}
        tags = []
        for device, event_id, created, kind, value in zip(*(batch[c].tolist() for c in names), strict=True):
            if device not in memories:
                _, text = devices.get(device, (None, None))
                memories[device] = DeviceMemory.load(text, self.rules)
            known = None if value != value else value
            tags += [(device, *tag) for tag in memories[device].add(event_id, int(created), kind, known)]
        for device, memory in memories.items():
            due = None if self.silence_ms is None else memory.due(self.silence_ms)
            devices[device] = (due, memory.dump())
        watermark = timerValues.getCurrentWatermarkInMs()
        tags += self._silent(devices, watermark)
        self._store(timer, devices, watermark)
        yield from _frames(tags)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        timer, devices = self._load()
        watermark = timerValues.getCurrentWatermarkInMs()
        tags = self._silent(devices, watermark)
        if tags:
            self._store(timer, devices, watermark)
        yield from _frames(tags)

    def close(self) -> None:
        pass


def _frames(tags: list[tuple]) -> Iterator[pd.DataFrame]:
    for start in range(0, len(tags), OUT_ROWS):
        yield _frame(tags[start : start + OUT_ROWS])


def tag_stream(
    df: DataFrame,
    rules: Rules = Rules(),
    silence_ms: int | None = 45_000,
    delay: str = "60 seconds",
    arrived: str = "enqueuedAt",
    tie: str = "eventId",
    keep_tags_ms: int | None = None,
    buckets: int = 1024,
) -> DataFrame:
    """Pattern and silence tags of a stream. A tag is given once per event id, for as long
    as the state is kept.

    With timers, Spark drops events that arrive behind the watermark. ``silence_ms=None``
    has no timers and no watermark, and takes every event. ``buckets`` of devices must not
    change while a checkpoint lives. ``keep_tags_ms`` is refused, as Spark does: state has a
    time to live in processing time only.
    """
    if keep_tags_ms is not None:
        raise ValueError("keep_tags_ms: Spark has no time to live of state in event time")
    timed = silence_ms is not None
    rows = df.withWatermark(arrived, delay) if timed else df
    # Columns reach the state function as named tuples: no leading underscores.
    narrow = rows.select(
        F.pmod(F.xxhash64("deviceId"), F.lit(buckets)).cast("string").alias("bucket"),
        "deviceId",
        "eventId",
        "type",
        "value",
        F.unix_micros("createdAt").alias("created_us"),
        F.unix_micros(arrived).alias("arrived_us"),
        F.col(tie).alias("arrived_tie"),
        *([arrived] if timed else []),
    )
    tags = narrow.groupBy("bucket").transformWithStateInPandas(
        TagEvents(rules, silence_ms), TAG, "append", "eventTime" if timed else "none"
    )
    return tags.dropDuplicates(["deviceId", "trigger_id", "tag"])


#: Types that pass a state function as texts, and back, without loss.
TEXTS = (T.StringType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def _as_text(column: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    return F.hex(column) if isinstance(kind, T.BinaryType) else F.col(column).cast("string")


def _from_text(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(text.cast("long"))
    return F.unhex(text) if isinstance(kind, T.BinaryType) else text.cast(kind)


def _held_as(kind: T.DataType) -> pa.DataType:
    """The type in which texts are held: the smallest that gives the same texts back."""
    return pa.int64() if isinstance(kind, (T.IntegralType, T.TimestampType)) else pa.large_string()


def _sorted_as(kind: T.DataType) -> pa.DataType:
    """The type whose order is that of the values."""
    if isinstance(kind, T.DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    return pa.float64() if isinstance(kind, (T.FloatType, T.DoubleType)) else _held_as(kind)


class RememberIds(StatefulProcessor):
    """Passes an event on unless its id is among the last ones met for its key.

    Rows come as texts, ``c0``, ``c1`` and so on. Those of a key and micro-batch are held as
    columns, not as objects, are sorted by row numbers, and leave in small parts.
    """

    def __init__(self, kinds: list[T.DataType], id_column: int, order: list[int], size: int) -> None:
        self.kinds, self.id_column, self.order, self.size = kinds, id_column, order, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getValueState("ids", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        memory = json.loads(self.memory.get()[0]) if self.memory.exists() else []
        batch = self._held(rows)
        order = {f"o{i}": batch.column(i).cast(_sorted_as(self.kinds[i])) for i in self.order}
        by = [(name, "ascending") for name in order]
        places = pc.sort_indices(pa.table(order), sort_keys=by, null_placement="at_start")
        del order
        for start in range(0, len(places), OUT_ROWS):
            part = batch.take(places.slice(start, OUT_ROWS))
            fresh, memory = recently_seen(part.column(self.id_column).to_pylist(), self.size, memory)
            kept = part.filter(pa.array(fresh))
            if kept.num_rows:
                yield pd.DataFrame({c: pd.Series(kept.column(c).cast("string").to_pylist(), dtype=object) for c in kept.column_names})
        self.memory.update((json.dumps(memory),))

    def _held(self, rows: Iterator[pd.DataFrame]) -> pa.Table:
        parts = []
        for frame in rows:
            texts = {f"c{i}": pa.array(frame[f"c{i}"], pa.large_string(), from_pandas=True) for i in range(len(self.kinds))}
            parts.append(pa.table({c: texts[c].cast(_held_as(k)) for c, k in zip(texts, self.kinds, strict=True)}))
        return pa.concat_tables(parts).combine_chunks()

    def close(self) -> None:
        pass


class RememberRows(StatefulProcessor):
    """The same on whole rows, for tables with nested columns."""

    def __init__(self, id_column: str, order: list[str], size: int) -> None:
        self.id_column, self.order, self.size = id_column, order, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getValueState("ids", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = json.loads(self.memory.get()[0]) if self.memory.exists() else []
        batch = sorted(rows, key=lambda row: [row[c] for c in self.order])
        ids = [row[self.id_column] for row in batch]
        fresh, memory = recently_seen(ids, self.size, known)
        self.memory.update((json.dumps(memory),))
        yield from (row for row, new in zip(batch, fresh, strict=True) if new)

    def close(self) -> None:
        pass


def lru_stream(
    df: DataFrame, keys: list[str], id_column: str, order: list[str], size: int = 100
) -> DataFrame:
    """Exact bounded duplicate filter of a stream. Ids are texts or whole numbers.

    Columns pass through the state function as texts: pandas would lose digits of missing
    whole numbers, and rows as objects take some ten times the memory. Tables with nested
    columns pass as rows.
    """
    kinds, names = [f.dataType for f in df.schema], df.columns
    if not all(isinstance(k, TEXTS) for k in kinds):
        return df.groupBy(*keys).transformWithState(
            RememberRows(id_column, list(order), size), df.schema, "append", "none"
        )
    texts = [_as_text(c, k).alias(f"c{i}") for i, (c, k) in enumerate(zip(names, kinds, strict=True))]
    # One key that is never missing: pandas would tell a missing number from itself.
    rows = df.select(F.to_json(F.struct(*keys)).alias("of"), *texts)
    wire = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    remember = RememberIds(kinds, names.index(id_column), [names.index(c) for c in order], size)
    kept = rows.groupBy("of").transformWithStateInPandas(remember, wire, "append", "none")
    return kept.select(*[_from_text(F.col(f"c{i}"), k).alias(c) for i, (c, k) in enumerate(zip(names, kinds, strict=True))])
