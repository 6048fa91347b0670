"""Duplicate memory and event patterns: golden cases, random sequences, streams."""

from __future__ import annotations

import json
import math
import os
import random
import re
import tracemalloc
from datetime import datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.streaming import stateful_processor
from pyspark.sql.types import LongType

from fleetlens.operators.anomaly import spike_dip
from fleetlens.operators import anomaly, dedup, patterns
from fleetlens.operators.ordered import DEFAULT, Limits
from fleetlens.streaming import batches, runs, sinks, stateful
from models import remembered, scan_tags

AT = datetime(2019, 10, 15, 12, 43, 27, 748000)
EVENTS = (
    "deviceId string, eventId string, type string, value double, createdAt timestamp, "
    "enqueuedAt timestamp, n long"
)


@pytest.mark.parametrize(
    ("events", "size", "kept"),
    [
        ([("d", "A")], 100, 1),
        ([("d", "A"), ("d", "A")], 100, 1),
        ([("d", "A"), ("other", "A")], 100, 2),
        ([("d", "A")] * 5, 1, 1),
        ([("d", "A"), ("d", "B"), ("d", "A")], 1, 3),
        ([("d", "A"), ("d", "A"), ("other", "A"), ("other", "A"), ("d", "A")], 1, 2),
    ],
)
def test_memory_cases(spark, events, size, kept):
    df = spark.createDataFrame(
        [(*e, i) for i, e in enumerate(events)], "deviceId string, eventId string, n long"
    )
    assert dedup.lru_dedup(df, ["deviceId"], "eventId", ["n"], size).count() == kept


@given(st.lists(st.integers(0, 6), max_size=60), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_memory_equals_model(ids, size):
    fresh, _ = dedup.recently_seen(ids, size)
    assert fresh == remembered(ids, size)
    half = len(ids) // 2
    first, memory = dedup.recently_seen(ids[:half], size)
    second, _ = dedup.recently_seen(ids[half:], size, memory)
    assert first + second == fresh


def test_memory_keeps_large_numbers(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([("d", "A", big, 0), ("d", "B", None, 1)], "d string, i string, x long, n long")
    assert dedup.lru_dedup(df, ["d"], "i", ["n"]).orderBy("n").collect()[0]["x"] == big


def random_events(rng, devices=3, n=200, ids=10_000):
    out = []
    for i in range(n):
        at = AT + timedelta(seconds=i)
        kind = rng.choice(["TEMP", "TEMP", "CO2", "OTHER"])
        out.append(
            (f"d{rng.randrange(devices)}", f"e{rng.randrange(ids)}", kind,
             float(rng.randrange(60, 100)), at, at, i)
        )
    return out


def modelled(events, rules):
    want = []
    for device in {e[0] for e in events}:
        mine = [e[1:4] for e in sorted(events, key=lambda e: (e[5], e[6])) if e[0] == device]
        want += [(device, *t) for t in scan_tags(mine, rules)]
    return sorted(want)


@pytest.mark.parametrize("ids", [10_000, 30])
def test_tags_equal_scan_model(spark, tiny, ids):
    """Unique event ids, and ids repeated with other payloads."""
    rules = patterns.Rules()
    events = random_events(random.Random(ids), ids=ids)
    df = spark.createDataFrame(events, EVENTS)
    for limits in (patterns.DEFAULT, tiny):
        got = patterns.pattern_tags(df, ("enqueuedAt", "n"), rules, limits).collect()
        assert sorted((r["deviceId"], r["trigger_id"], r["tag"]) for r in got) == modelled(
            events, rules
        )


@given(
    st.lists(
        st.tuples(st.integers(0, 12), st.sampled_from(["TEMP", "CO2"]), st.integers(65, 85)),
        max_size=40,
    )
)
@settings(max_examples=500, deadline=None)
def test_device_memory_equals_scan_model(events):
    rules = patterns.Rules()
    named = [(f"e{i}", kind, float(value)) for i, kind, value in events]
    memory, got = stateful.DeviceMemory(rules), []
    for event_id, kind, value in named:
        got += [(t[1], t[2]) for t in memory.add(event_id, 0, kind, value)]
        memory = stateful.DeviceMemory.load(memory.dump(), rules, memory.given)
    assert sorted(got) == sorted(scan_tags(named, rules))


def test_ring_keeps_ten():
    memory = stateful.DeviceMemory()
    for i in range(11):
        memory.add(f"e{i}", i, "CO2", 1.0)
    assert [e[0] for e in memory.ring] == [f"e{i}" for i in range(1, 11)]


SIMPLE = [("d", "x", "CO2", 45.8)] * 2
FULL = [("d", "x", "CO2", 80.8), ("d", "x", "TEMP", 70.8), ("d", "x", "TEMP", 70.8)]
FIRST_TAGS = ["FirstTagForThisKey", "2RecordsForThisKey"]
GOLDEN = [
    (SIMPLE, FIRST_TAGS),
    (
        FULL,
        [
            *FIRST_TAGS,
            "3RecordsForThisKey",
            "SeveralTemperaturesIn70s",
            "HighCO2WithSeveralTemperaturesIn70s",
        ],
    ),
]


@pytest.mark.parametrize(("events", "tags"), GOLDEN)
def test_golden_tags(spark, events, tags):
    rows = [(*e, AT, AT, i) for i, e in enumerate(events)]
    df = spark.createDataFrame(rows, EVENTS)
    got = patterns.pattern_tags(df, ("enqueuedAt", "n"))
    assert sorted(r["tag"] for r in got.collect()) == sorted(tags)
    silent = patterns.silent_devices(df, arrival=("enqueuedAt", "n")).collect()
    assert [r["tag"] for r in silent] == ["NoNewsForAtLeast45000ms"]
    memory, order = stateful.DeviceMemory(), []
    created = int(AT.timestamp() * 1_000_000)
    for _, event_id, kind, value in events:
        order += [t[2] for t in memory.add(event_id, created, kind, value)]
    order += [t[2] for t in memory.silence(created // 1000 + 45_000, 45_000)]
    assert order == [*tags, "NoNewsForAtLeast45000ms"]


def write_batches(spark, folder, events, schema, size):
    """One file per micro-batch, read in the order of their times."""
    import os
    import time

    for i in range(0, len(events), size):
        spark.createDataFrame(events[i : i + size], schema).coalesce(1).write.parquet(
            f"{folder}/part-{i:06d}"
        )
        for name in os.listdir(f"{folder}/part-{i:06d}"):
            os.utime(f"{folder}/part-{i:06d}/{name}", (time.time(), 1_000_000 + i))


def file_stream(spark, folder, schema):
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/part-*")
    )


def test_streams_equal_batch_over_several_batches_and_a_restart(spark, tmp_path):
    rng = random.Random(7)
    events = random_events(rng, n=120, ids=40)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame(events, EVENTS)
    for name, stream, batch in (
        (
            "tags",
            lambda s: stateful.tag_stream(s, silence_ms=None, tie="n"),
            patterns.pattern_tags(df, ("enqueuedAt", "n")),
        ),
        (
            "memory",
            lambda s: stateful.lru_stream(s, ["deviceId"], "eventId", ["n"], 5),
            dedup.lru_dedup(df, ["deviceId"], "eventId", ["n"], 5),
        ),
    ):
        folder = f"{source}-{name}"
        schema = df.schema
        for part in (events[:60], events[60:]):  # the second drain starts from the checkpoint
            offset = 0 if part is events[:60] else 1000
            write_batches(spark, f"{folder}/{offset + len(part) + events.index(part[0])}", part, schema, 30)
            rows = (
                spark.readStream.schema(schema)
                .option("maxFilesPerTrigger", 1)
                .parquet(f"{folder}/*/part-*")
            )
            writer = runs.pipeline(
                rows, [stream], f"{out}-{name}-checkpoint"
            ).foreachBatch(sinks.append_once(f"{out}-{name}"))
            runs.drain(writer, need_batches=1)
        got = sinks.read_batches(spark, f"{out}-{name}", batch.schema).drop("batch_id")
        assert len(sinks.committed(spark, f"{out}-{name}")) >= 4
        assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.collect())), name


def test_micro_batches_equal_batch(spark, tmp_path, tiny):
    """Hot keys cut inside small micro-batches, repeated ids, and a replayed batch."""
    events = random_events(random.Random(3), devices=2, n=160, ids=60)
    df = spark.createDataFrame(events, EVENTS)
    tags, unique = str(tmp_path / "tags"), str(tmp_path / "unique")
    writes = (
        batches.tag_batches(tags, str(tmp_path / "rings"), tie="n", buckets=2, limits=tiny),
        batches.dedup_batches(
            unique, str(tmp_path / "ids"), order=["n"], size=7, buckets=2, limits=tiny
        ),
    )
    for i, start in enumerate((0, 5, 60, 140)):
        part = df.where(f"n >= {start} and n < {(5, 60, 140, 160)[i]}")
        for write in writes:
            write(part, i)
            if i == 2:
                write(part, i)
    want = patterns.pattern_tags(df, ("enqueuedAt", "n"))
    got = sinks.read_batches(spark, tags, want.schema).drop("batch_id")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    want = dedup.lru_dedup(df, ["deviceId"], "eventId", ["n"], 7)
    got = sinks.read_batches(spark, unique, df.schema).drop("batch_id")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_silence_timer(spark, tmp_path):
    """A device that stops is tagged once the watermark has passed its timer."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    later = AT + timedelta(hours=1)
    batches = [
        [("quiet", "q", "CO2", 1.0, AT, AT, 0), ("busy", "b0", "CO2", 1.0, AT, AT, 1)],
        [("busy", "b1", "CO2", 1.0, later, later, 2)],
    ]
    schema = spark.createDataFrame(batches[0], EVENTS).schema
    write_batches(spark, folder, batches[0], schema, 2)
    write_batches(spark, folder + "2", batches[1], schema, 1)
    rows = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in*/part-*")
    )
    writer = runs.pipeline(
        rows, [stateful.tag_stream], str(tmp_path / "checkpoint")
    ).foreachBatch(sinks.append_once(out))
    runs.drain(writer, need_batches=1)
    got = sinks.read_batches(spark, out, stateful.TAG).collect()
    silent = {(r["deviceId"], r["trigger_id"]) for r in got if r["tag"].startswith("NoNews")}
    assert ("quiet", "q") in silent and ("busy", "b1") not in silent
    at = next(r["trigger_at"] for r in got if r["trigger_id"] == "q")
    assert at == AT


def timed_tags(batches, rules, silence_ms):
    """Tags by micro-batch, with a timer for each event and all tags remembered, one by one."""
    rings, given, timers, mark, got = {}, set(), set(), None, []

    def tag(n, device, event_id, created, texts):
        for text in texts:
            if (device, event_id, text) not in given:
                given.add((device, event_id, text))
                got.append((n, device, event_id, created, text))

    for n, batch in enumerate([*batches, []]):
        for device, event_id, kind, value, created, _, _ in sorted(batch, key=lambda e: e[5:]):
            ring = rings.setdefault(device, [])
            first = not ring
            ring.append((event_id, kind, value, created))
            del ring[: -rules.ring]
            in_band = [k == "TEMP" and v is not None and rules.band_low <= v < rules.band_high for _, k, v, _ in ring]
            high = any(k == "CO2" and v is not None and v > rules.co2_above for _, k, v, _ in ring)
            several = sum(in_band) >= 2
            texts = [patterns.FIRST] * first + [f"{len(ring)}{patterns.COUNTED}"] * (1 < len(ring) < rules.ring)
            texts += [patterns.BAND] * (several and in_band[-1]) + [patterns.BAND_AND_CO2] * (several and high)
            tag(n, device, event_id, created, texts)
            timers.add((created + timedelta(milliseconds=silence_ms), device))
        for timer in sorted(timers):
            if mark and timer[0] <= mark:
                timers.remove(timer)
                event_id, _, _, created = rings[timer[1]][-1]
                if timer[0] - created >= timedelta(milliseconds=silence_ms):
                    tag(n, timer[1], event_id, created, [f"{patterns.SILENT}{silence_ms}ms"])
        mark = max([e[5] for e in batch], default=mark)
    return sorted(got)


@pytest.mark.parametrize("buckets", [1, 1024])
def test_timers_of_buckets_equal_one_timer_per_event(spark, tmp_path, buckets):
    """Devices that share a bucket or not, created out of order, with repeated ids, due just now, silent twice."""
    rng = random.Random(5)
    batches, n = [], 0
    for k in range(5):
        start = AT + timedelta(seconds=100 * k)
        part = []
        for i in range(12):
            at, device = start + timedelta(seconds=i), rng.choice([f"d{k}", f"d{k + 1}", "d0"][: 3 if k == 4 else 2])
            late = timedelta(seconds=rng.choice([0, 0, 0, 30, 400]))
            part.append((device, f"e{rng.randrange(25)}", rng.choice(["TEMP", "CO2"]), rng.choice([75.0, 90.0, None]), at - late, at, n))
            n += 1
        batches.append(part)
    batches[1].append(("now", "x", "CO2", 1.0, AT + timedelta(seconds=161), AT + timedelta(seconds=111), n))  # due at 211 s
    batches[4].append(("d1", batches[1][0][1], "CO2", 1.0, AT, AT + timedelta(seconds=412), n + 1))
    schema = spark.createDataFrame(batches[0], EVENTS).schema
    for k, part in enumerate(batches):
        write_batches(spark, f"{tmp_path}/in{k}", part, schema, 100)
        (name,) = (f for f in (tmp_path / f"in{k}" / "part-000000").iterdir() if f.name.endswith(".parquet"))
        os.utime(name, (1_000_000 + k, 1_000_000 + k))
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in*/part-*")
    rules, out = patterns.Rules(), str(tmp_path / "out")
    step = lambda s: stateful.tag_stream(s, rules, 50_000, "0 seconds", tie="n", buckets=buckets)
    runs.drain(runs.pipeline(rows, [step], str(tmp_path / "checkpoint")).foreachBatch(sinks.append_once(out)), need_batches=5)
    names = ["batch_id", "deviceId", "trigger_id", "trigger_at", "tag"]
    got = sorted(tuple(r[c] for c in names) for r in sinks.read_batches(spark, out, stateful.TAG).collect())
    want = timed_tags(batches, rules, 50_000)
    assert got == want and len({t[0] for t in want if t[4].startswith("NoNews")}) >= 3
    assert any(t[1] == "now" and t[0] == 3 and t[4].startswith("NoNews") for t in want)


class CountedState:
    """A state store of one key that counts the calls it gets."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, kind):
        return self

    def getMapState(self, name, key, value, ttl):
        return self

    def _called(self, result=None):
        self.calls += 1
        return result

    exists = lambda self: self._called(self.value is not None)
    get = lambda self: self._called(self.value)
    containsKey = lambda self, key: self._called(False)
    updateValue = lambda self, key, value: self._called()
    registerTimer = lambda self, at: self._called(self.timers.add(at))
    deleteTimer = lambda self, at: self._called(self.timers.discard(at))

    def update(self, value):
        self.value = self._called(value)


def test_a_bucket_is_read_and_written_once():
    columns = ["deviceId", "eventId", "type", "value", "created_us", "arrived_us", "arrived_tie"]
    events = [(f"d{i % 30}", f"e{i}", "TEMP", 75.0, i * 1_000_000, i * 1_000_000, i) for i in range(600)]
    times = lambda ms: stateful_processor.TimerValues(0, ms)
    state, process = CountedState(), stateful.TagEvents(patterns.Rules(), silence_ms=1000)
    process.init(state)
    for start in (0, 300):
        part = pd.DataFrame(events[start : start + 300], columns=columns)
        found = pd.concat(process.handleInputRows(("7",), iter([part]), times(0)))
        assert len(found) >= 300 and state.calls <= 4
        state.calls = 0
    assert state.timers == {571_000}  # the device that is silent first
    tags = pd.concat(process.handleExpiredTimer(("7",), times(580_000), stateful_processor.ExpiredTimerInfo(571_000)))
    assert list(tags["trigger_id"]) == [f"e{i}" for i in range(570, 580)] and state.timers == {571_000, 581_000}
    assert state.calls <= 3 and not list(process.handleExpiredTimer(("7",), times(580_000), None))


def test_tags_are_remembered_over_many_others():
    memory = stateful.DeviceMemory()
    tags = [t[2] for i in range(1300) for t in memory.add(f"e{i}", i, "TEMP", 75.0) if i == 5]
    again = [t[2] for t in memory.add("e5", 1300, "TEMP", 75.0)]
    assert "SeveralTemperaturesIn70s" in tags and "SeveralTemperaturesIn70s" not in again


def test_off_a_flat_history_is_an_anomaly(spark):
    rows = [("p", i, 10.0) for i in range(20)] + [("p", 20, 1e6), ("q", 0, 1.0), ("q", 1, 2.0)]
    df = spark.createDataFrame(rows, "PartitionId string, n long, value double")
    df = df.withColumn("enqueuedAt", F.timestamp_millis("n"))
    got = {(r["PartitionId"], r["val"]): r["is_anomaly"] for r in spike_dip(df, tie=["n"]).collect()}
    assert got == {("p", 10.0): 0, ("p", 1e6): 1, ("q", 1.0): 0, ("q", 2.0): 0}


# -- the duplicate memory without Python, sliding moments ----------------------------


def replayed(rows, size):
    """Rows (key, id, n) that a bounded memory per key lets through, in the order of n."""
    memories, kept = {}, []
    for key, one, n in sorted(rows, key=lambda r: r[2]):
        fresh, memories[key] = dedup.recently_seen([one], size, memories.get(key, []))
        kept += [(key, one, n)] * fresh[0]
    return sorted(kept, key=lambda r: r[2])


@pytest.mark.parametrize("size", [1, 2, 5, 20])
def test_pairs_inside_equal_a_replay(spark, tiny, size):
    rng = random.Random(size)
    # Few ids and many, long runs of two ids, ids that come back late, missing keys and ids.
    rows = [(rng.choice("ab"), f"i{rng.randrange(rng.choice([3, 30, 300]))}") for _ in range(700)]
    rows += [("c", "xy"[k % 2]) for k in range(200)] + [("c", f"u{k}") for k in range(30)] + [("c", "x"), ("c", "y")]
    rows += [(None, rng.choice([None, "p", "q", "r"])) for _ in range(60)] + [("a", "i0")] * 40
    rows = [(*r, n) for n, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, i string, n long").repartition(5)
    want = replayed(rows, size)
    for limits in (DEFAULT, tiny):
        kept = dedup.lru_dedup(df, ["k"], "i", ["n"], size, limits)
        assert [tuple(r) for r in kept.orderBy("n").collect()] == want
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|InArrow", plan)
    alone = [("one", i, n) for _, i, n in rows]
    got = dedup.lru_dedup(df.drop("k"), [], "i", ["n"], size).orderBy("n").collect()
    assert [("one", *r) for r in got] == replayed(alone, size)
    assert dedup.lru_dedup(df.limit(0), ["k"], "i", ["n"], size).count() == 0


@pytest.mark.parametrize("size", [1, 3, 20])
def test_far_questions_equal_a_replay(spark, tiny, size):
    """One id fills nearly all places, so that the others ask back over many wide blocks."""
    rng = random.Random(size)
    rows = [("a", "hot" if rng.random() < 0.97 else f"i{rng.randrange(2 * size)}") for _ in range(6000)]
    rows += [("b", f"i{n}") for n in range(size)] + [("b", "hot")] * 900 + [("b", f"i{n}") for n in range(size)]
    rows = [(*r, n) for n, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, i string, n long").repartition(5)
    for limits in (DEFAULT, tiny):
        kept = dedup.lru_dedup(df, ["k"], "i", ["n"], size, limits)
        assert [tuple(r) for r in kept.orderBy("n").collect()] == replayed(rows, size)


def test_ids_among_many_need_no_pairs(spark):
    """All cases are settled by the rows just before: nothing is joined or counted up."""
    rows = spark.range(20_000).select(F.lit("a").alias("k"), (F.col("id") % 500).alias("i"), F.col("id").alias("n"))
    kept = dedup.lru_dedup(rows, ["k"], "i", ["n"], 20)
    assert kept.count() == 20_000
    assert not re.search("Join|Window", kept._jdf.queryExecution().executedPlan().toString())


def test_robust_scores_with_missing_values_equal_a_model(spark, tiny):
    """Missing values count as rows of the history, and as its largest values."""
    rng = random.Random(5)
    rows = [(k, rng.randrange(400) * 1000, n, rng.choice([None, 1.0, 2.5, 7.0, -3.0])) for n in range(150) for k in "ab"]
    want = []
    for key in "ab":
        line = sorted(r for r in rows if r[0] == key)
        for i, (_, t, n, v) in enumerate(line):
            recent = [r[3] for r in line[max(0, i - 8) : i] if r[1] >= t - 20_000]

            def median(values):
                ordered = sorted(values, key=lambda x: (x is None, x))
                pair = [ordered[len(ordered) // 2], ordered[(len(ordered) - 1) // 2]]
                return None if None in pair else sum(pair) / 2

            middle = median(recent) if recent else None
            spread = median([None if x is None or middle is None else abs(x - middle) for x in recent]) if recent else None
            score = 0.0
            if middle is not None and v is not None and spread is not None:
                if spread > 0:
                    score = (v - middle) / (spread * 1.4826)
                elif len(recent) > 1 and v != middle:
                    score = float("inf") if v > middle else float("-inf")
            elif v is None and spread is not None and spread > 0:
                score = None
            want.append((key, n, score))
    df = spark.createDataFrame(rows, "PartitionId string, t long, n long, value double")
    df = df.withColumn("enqueuedAt", F.timestamp_micros("t"))
    for limits in (DEFAULT, tiny):
        got = spike_dip(df, tie=["n"], history=8, duration_ms=20, robust=True, limits=limits, keep=["n"])
        found = {(r["PartitionId"], r["n"]): r["score"] for r in got.collect()}
        assert len(found) == len(want)
        for key, n, score in want:
            assert found[key, n] == (score if score is None else pytest.approx(score)), (key, n)


def test_robust_scores_of_one_key_are_many_tasks_work(spark):
    rows = spark.range(120_000).select(
        F.lit("p").alias("PartitionId"), F.timestamp_millis("id").alias("enqueuedAt"), "id", (F.col("id") % 9 / 2).alias("value")
    )
    scored = spike_dip(rows, tie=["id"], robust=True)
    assert scored.count() == 120_000
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "_hot" in plan and "array_sort" not in plan


class OneValue:
    """A value state outside of a stream."""

    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


def test_stream_memory_holds_columns_not_objects():
    """A large micro-batch of one key, out of order: some ten bytes per number, small parts out."""
    n = 200_000
    order = [i * 7919 % n for i in range(n)]

    def frames():
        for start in range(0, n, 10_000):
            part = order[start : start + 10_000]
            yield pd.DataFrame({"c0": [str(i % 5_000) for i in part], "c1": [str(i) for i in part]})

    remember = stateful.RememberIds([LongType(), LongType()], 0, [1], 20)
    remember.memory = OneValue()
    tracemalloc.start()
    parts = [(len(f), f["c1"].iloc[0], f["c1"].iloc[-1]) for f in remember.handleInputRows(("k",), frames(), None)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [p[0] for p in parts] == [10_000] * 20 and parts[0][1] == "0" and parts[-1][2] == str(n - 1)
    assert peak < 12_000_000
    assert json.loads(remember.memory.get()[0]) == list(range(4980, 5000))


def test_stream_memory_returns_values_unchanged(spark, tmp_path):
    kinds = "k string, i long, n long, x double, b boolean, t timestamp, d date, c decimal(20,3), y binary"
    rows = [
        (None, 2**60 + 1, 0, float("nan"), None, AT, AT.date(), Decimal("1.500"), b"\x00\xff"),
        (None, None, 1, None, True, None, None, None, None),
        ("", None, 2, -0.0, False, AT, None, Decimal("-7"), b""),
        (None, 2**60 + 1, 3, 1.0, None, None, None, None, None),
        (None, None, 10, 0.1 + 0.2, None, None, None, None, None),
        ("", 5, 11, float("inf"), None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, kinds)
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for size, n in ((1, 6), (3, 4)):
        kept = stateful.lru_stream(source, ["k"], "i", ["n"], size)
        assert kept.dtypes == df.dtypes
        writer = runs.pipeline(kept, [], str(tmp_path / f"checkpoint{size}"))
        runs.drain(writer.foreachBatch(sinks.append_once(f"{out}{size}")), need_batches=1)
        got = sinks.read_batches(spark, f"{out}{size}", df.schema).drop("batch_id").collect()
        want = dedup.lru_dedup(df, ["k"], "i", ["n"], size).collect()
        assert len(got) == n and sorted(map(repr, got)) == sorted(map(repr, want))


def recent_scores(rows, history, age):
    """Plain z-scores: rows (key, microseconds, n, value) against the recent ones before."""
    out, past = {}, {}
    for key, at, n, value in sorted(rows, key=lambda r: (r[1], r[2])):
        before = past.setdefault(key, [])
        some = [v for t, v in before[-history:] if t >= at - age and v is not None and abs(v) != float("inf")]
        score = 0.0
        if value is not None and len(some) > 0:
            mean = sum(some) / len(some)
            spread = (sum((v - mean) ** 2 for v in some) / len(some)) ** 0.5
            if len(set(some)) == 1:
                score = 0.0 if len(some) < 2 or value == some[0] else float("inf") * (1 if value > some[0] else -1)
            else:
                score = (value - mean) / spread
        out[n] = score
        before.append((at, value))
    return out


@pytest.mark.parametrize("history, age_ms", [(5, 40), (60, 1000), (60, 30), (3, 0)])
def test_sliding_moments(spark, tiny, monkeypatch, history, age_ms):
    monkeypatch.setattr(anomaly, "BLOCK", 16)
    rng, rows, at = random.Random(history + age_ms), [], 0
    for n in range(600):
        at += rng.choice([0, 1000, 3000, 3000, 25_000]) if n % 100 else 10**6
        value = rng.choice([None, 5.0, 5.0, 5.0, 1e9, rng.gauss(100, 3), rng.gauss(100, 3), float("inf")])
        rows.append((rng.choice(["a", "a", None]), at, n, 7.25 if 200 < n < 300 else value))
    df = spark.createDataFrame(rows, "PartitionId string, us long, n long, value double")
    df = df.withColumn("enqueuedAt", F.timestamp_micros("us"))
    want = recent_scores(rows, history, age_ms * 1000)
    limits = Limits(max_rows=40, min_rows=max(history, 10))
    for how in (DEFAULT, limits):
        got = spike_dip(df, tie=["n"], history=history, duration_ms=age_ms, limits=how, keep=["n"]).collect()
        assert len(got) == len(rows)
        for r in got:
            score = want[r["n"]]
            if r["val"] is None:  # no score for what is missing
                continue
            assert r["score"] == score or abs(r["score"] - score) < 1e-5 * max(1, abs(score)), (r, score)
    plan = spike_dip(df, tie=["n"])._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_moments_of_one_long_series(spark):
    """Half a million values of one key: many tasks, and digits as good as at the beginning."""
    n = 500_000
    value = 1e6 + F.col("n") / 1000 + F.sin("n")
    df = spark.range(n).select(F.lit("one").alias("PartitionId"), F.col("id").alias("n"), F.timestamp_millis("id").alias("enqueuedAt"))
    df = df.withColumn("value", value)
    out = spike_dip(df, tie=["n"], history=60, duration_ms=55, keep=["n"])
    last = {r["n"]: r["score"] for r in out.where(f"n >= {n - 5}").collect()}
    for k, score in last.items():
        some = [1e6 + i / 1000 + math.sin(i) for i in range(k - 55, k)]
        mean = sum(some) / 55
        spread = (sum((v - mean) ** 2 for v in some) / 55) ** 0.5
        assert abs(score - (1e6 + k / 1000 + math.sin(k) - mean) / spread) < 1e-6
    assert out.count() == n
