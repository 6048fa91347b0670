"""Sources and sinks over temporary folders."""

from __future__ import annotations

import json
import os
import random
import re
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlens import fixtures, schema
from fleetlens.functions import scalars
from fleetlens.operators import aggregate, decode, dedup, device, quality
from fleetlens.sources import files, logs, stores
from fleetlens.streaming import keys, metrics, newest, runs, sinks
from fleetlens.streaming.windows import minute_rate_stream

AT = datetime(2024, 1, 1)
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    columns = ["eventId", "type", "deviceId", "value", "createdAt", "enqueuedAt", "PartitionId"]
    return fixtures.telemetry(spark, sf_dir, False).where("_event_id < 200").select(*columns).cache()


def bag(df):
    return sorted(map(repr, df.collect()))


# -- sources -------------------------------------------------------------------------


def test_log_options():
    params = {"kafka.in.topic": "t", "kafka.in.bootstrap.servers": "h:1", "kafka.out.topic": "o", "x": "y"}
    assert logs.consumer_options(params, max_per_trigger=7000, min_partitions=4) == {
        "subscribe": "t",
        "kafka.bootstrap.servers": "h:1",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "7000",
        "minPartitions": "4",
    }
    assert logs.producer_options(params) == {"topic": "o"}
    assert logs.consumer_options({**params, **logs.sasl_options("s")})["kafka.sasl.mechanism"] == "PLAIN"
    with pytest.raises(ValueError, match="no topic"):
        logs.consumer_options({})
    with pytest.raises(ValueError, match="no topic"):
        logs.producer_options({})


def test_envelope_feeds_the_decoder(spark):
    body = '{"eventId":"e","value":1.5,"createdAt":"2024-01-01T00:00:00Z"}'
    df = spark.createDataFrame([(bytearray(body.encode()), AT, "t", 0, 5)], schema.KAFKA_ENVELOPE)
    event = decode.decode_events(logs.log_envelope(df)).collect()[0]
    assert (event["eventId"], event["createdAt"], event["enqueuedAt"]) == ("e", AT, AT)


def test_jdbc_options():
    read = stores.jdbc_options("jdbc:x", table="t", partition="PartitionId", partitions=16)
    assert read["numPartitions"] == read["upperBound"] == "16" and read["dbtable"] == "t"
    assert "dbtable" not in stores.jdbc_options("jdbc:x", query="SELECT 1")
    with pytest.raises(ValueError):
        stores.jdbc_options("jdbc:x")
    query = stores.warehouse_query("raw", {"eventId": "EventId", "type": "Type"})
    assert query == "SELECT CAST(EventId AS CHAR(36)) AS eventId, Type AS type FROM raw"
    write = sinks.jdbc_write_options("jdbc:x", "t")
    assert (write["batchsize"], write["queryTimeout"]) == ("2500", "600")
    assert sinks.merge_statement("t", "s", ["a", "b"], update=True) == (
        "MERGE INTO t t USING s s ON t.a = s.a AND t.b = s.b "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def test_documents(spark, tmp_path):
    (tmp_path / "d.json").write_text(
        '{"eventId":"e","createdAt":"2024-01-01T00:00:00.1234567Z","_ts":1704067260}\n'
    )
    row = stores.documents(spark, str(tmp_path)).collect()[0]
    assert row["createdAt"] == AT + timedelta(microseconds=123456)
    assert row["storedAt"] == AT + timedelta(minutes=1)
    same = stores.event_time_only(stores.documents(spark, str(tmp_path)).drop("storedAt"))
    assert same.collect()[0]["storedAt"] == row["createdAt"]


def test_delimited_and_other_formats(spark, tmp_path, rows):
    kind = "a string, b double"
    text = {"csv": "a,b\nx,1.5\n", "tsv": "x\t1.5\n", "psv": "x|1.5\n"}
    wide = spark.createDataFrame([], kind).schema
    for name, content in text.items():
        (tmp_path / name).write_text(content)
        assert files.read_any(spark, str(tmp_path / name), name, wide).collect() == [("x", 1.5)]
    pairs = str(tmp_path / "seq")
    spark.sparkContext.parallelize([("k", "v")]).saveAsSequenceFile(pairs)
    assert files.read_any(spark, pairs, "sequencefile").collect() == [("k", "v")]
    rows.write.parquet(str(tmp_path / "p"))
    assert files.read_any(spark, str(tmp_path / "p"), "parquet").count() == 200
    with pytest.raises(ValueError):
        files.read_any(spark, pairs, "pcap")


def test_capture_folder_as_parquet_stand_in(spark, tmp_path, rows):
    body = F.to_json(F.struct("eventId", "value", "createdAt")).cast("binary").alias("Body")
    stamp = F.date_format("enqueuedAt", scalars.CAPTURE_TIME).alias("EnqueuedTimeUtc")
    base = str(tmp_path / "capture")
    for part in range(2):
        rows.where(F.col("PartitionId") % 2 == part).select(stamp, body).write.parquet(f"{base}/p{part}/d")
    assert files.capture_events(spark, f"{base}/p0/*", "parquet").count() == rows.where("PartitionId % 2 = 0").count()
    out = str(tmp_path / "out")
    source = files.capture_stream(spark, base, "parquet", max_files=1)
    stream = runs.pipeline(source, [decode.decode_capture], str(tmp_path / "c"))
    runs.drain(stream.foreachBatch(sinks.append_once(out)), need_batches=1)
    stored = sinks.read_batches(spark, out, schema.T.StructType([*schema.EVENT.fields, *schema.PROCESSED_EVENT.fields[7:8]]))
    assert stored.where("enqueuedAt is not null and eventId is not null").count() == 200


def test_typed_export_and_external_table(spark, tmp_path):
    base = str(tmp_path / "export")
    df = spark.createDataFrame(
        [(AT, "d", "e", 1, 2024)], "timestamp timestamp, deviceId_string string, eventId_string string, deviceSequenceNumber_long long, year int"
    )
    df.write.partitionBy("year").parquet(base)
    row = files.typed_export(spark, base).collect()[0]
    assert row["storedAt"] == row["createdAt"] == AT and row["deviceSequenceNumber"] == 1
    stats = quality.quality_report(files.typed_export(spark, base)).where("check_name = 'latency'")
    assert stats.collect()[0]["actual"] == 0.0


def test_external_table_finds_partitions(spark, tmp_path):
    base = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, 2023), (2, 2024)], "n int, year int")
    rows.write.partitionBy("year").parquet(base)
    try:
        assert files.external_table(spark, "exported", base).where("year = 2024").count() == 1
        rows.withColumn("year", F.lit(2025)).write.mode("append").partitionBy("year").parquet(base)
        assert files.external_table(spark, "exported", base).count() == 4
    finally:
        spark.sql("DROP TABLE IF EXISTS exported")


def test_first_of_table(spark, rows):
    sinks.as_view(rows, "recent_events")
    assert files.first_of_table(spark, "recent_events").count() == 100
    sinks.as_view(rows, "shared_events", shared=True)
    assert spark.table("global_temp.shared_events").count() == 200


# -- running -------------------------------------------------------------------------


def test_retry_waits_and_gives_up():
    waits, calls = [], []

    def action():
        calls.append(1)
        if len(calls) < 4:
            raise OSError("busy")
        return "done"

    assert runs.retry(action, wait=waits.append) == "done"
    assert waits == [0, 1, 3]

    def broken():
        raise OSError("down")

    waits.clear()
    with pytest.raises(OSError):
        runs.retry(broken, wait=waits.append)
    assert waits == [0, 1, 3, 7, 15]


def json_folder(spark, path, rows, files_=4):
    rows.repartition(files_, "eventId").write.mode("append").json(path, timestampFormat=MICROS)


def test_drop_folder_to_table_with_restart(spark, tmp_path, rows):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    columns = schema.T.StructType([f for f in rows.schema.fields])

    def run():
        source = files.json_stream(spark, folder, columns, max_files=2)
        writer = runs.pipeline(source, [], check).foreachBatch(sinks.append_once(out))
        return runs.drain(writer)

    json_folder(spark, folder, rows.where("PartitionId < 2"))
    run()
    json_folder(spark, folder, rows.where("PartitionId >= 2"))
    run()
    stored = sinks.read_batches(spark, out, columns).drop("batch_id")
    assert bag(stored) == bag(rows)
    with pytest.raises(RuntimeError, match="0 micro-batches"):
        source = files.json_stream(spark, folder, columns)
        runs.drain(runs.pipeline(source, [], check).foreachBatch(sinks.append_once(out)), need_batches=1)


def test_minute_rates_append_after_the_watermark(spark, tmp_path, sf_dir):
    out = str(tmp_path / "out")
    rates = minute_rate_stream(fixtures.stream(spark, sf_dir, in_order=True), "20 seconds")
    writer = runs.pipeline(rates, [], str(tmp_path / "c")).foreachBatch(sinks.append_once(out))
    runs.drain(writer)
    whole = minute_rate_stream(fixtures.telemetry(spark, sf_dir, False))
    closed = sinks.read_batches(spark, out, whole.schema).drop("batch_id")
    last = whole.agg(F.max("stored_minute")).collect()[0][0]
    assert bag(closed) == bag(whole.where(F.col("stored_minute") < F.lit(last)))


def test_watermark_dedup(spark, tmp_path, rows):
    folder = str(tmp_path / "in")
    again = rows.withColumn("enqueuedAt", F.timestamp_add("SECOND", F.lit(5), F.col("enqueuedAt")))
    rows.union(again).write.parquet(folder)
    source = files.folder_stream(spark, folder, rows.schema, "parquet")
    out = str(tmp_path / "out")
    stream = dedup.within_watermark(source, ["eventId"], "enqueuedAt", "1 minute")
    runs.drain(runs.pipeline(stream, [], str(tmp_path / "c")).foreachBatch(sinks.append_once(out)))
    assert sinks.read_batches(spark, out, rows.schema).count() == 200


# -- sinks ---------------------------------------------------------------------------


def test_merge_append_replays_and_prunes(spark, tmp_path, rows):
    out = str(tmp_path / "merged")
    write = sinks.merge_append(out)
    first, second = rows.where("PartitionId < 3"), rows.where("PartitionId > 0")
    write(first, 0)
    write(second.union(second), 1)
    write(second.union(second), 1)
    write(first, 2)
    stored = sinks.read_batches(spark, out, rows.schema).drop("batch_id")
    assert bag(stored) == bag(rows)
    assert sinks.committed(spark, out) == [0, 1, 2]


def test_unfinished_batches_are_not_read(spark, tmp_path, rows):
    out = str(tmp_path / "out")
    write = sinks.append_once(out)
    write(rows, 0)
    write(rows, 1)
    (tmp_path / "out" / "batch_id=1" / "_SUCCESS").unlink()
    assert sinks.read_batches(spark, out, rows.schema).count() == 200
    assert sinks.read_batches(spark, str(tmp_path / "none"), rows.schema).count() == 0


def later_batches(spark, folder, parts):
    """A stream with one micro-batch for each of ``parts``."""
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{folder}/part-{i}")
        for name in os.listdir(f"{folder}/part-{i}"):
            os.utime(f"{folder}/part-{i}/{name}", (1_700_000_000, 1_000_000 + i))
    reader = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{folder}/part-*")


def test_documents_kept(spark, tmp_path, rows):
    later = F.timestamp_add("SECOND", F.lit(60), F.col("enqueuedAt"))
    newer = rows.where("PartitionId = 0").withColumns({"value": F.lit(-1.0), "enqueuedAt": later})
    older = newer.withColumn("value", F.lit(-2.0)).withColumn("enqueuedAt", F.col("createdAt"))
    stream = later_batches(spark, str(tmp_path / "in"), [rows, newer.union(older), newer])
    runs.drain(newest.keep_documents(stream, str(tmp_path / "c")), need_batches=3)
    got = newest.current(spark, str(tmp_path / "c"))
    assert got.count() == got.select("id").distinct().count() == 200
    assert got.where("value = -1").count() == newer.count() and got.where("value = -2").count() == 0
    assert got.where("createdAt not like '____-__-__T__:__:__.___Z'").count() == 0
    before = newest.current(spark, str(tmp_path / "c"), batch_id=0)
    assert before.count() == 200 and before.where("value < 0").count() == 0


def test_changes_merged_on_read(spark, tmp_path, rows):
    out = str(tmp_path / "changes")
    newer = rows.where("PartitionId = 0").withColumn("value", F.lit(-1.0))
    write = sinks.append_once(out)
    write(rows, 0)
    write(newer, 1)
    write(newer, 1)
    got = sinks.newest_rows(spark, out, rows.schema, ["eventId"])
    assert bag(got) == bag(rows.where("PartitionId <> 0").union(newer))


@pytest.mark.parametrize("always", [False, True])
def test_history_and_status(spark, tmp_path, rows, always):
    history, status = str(tmp_path / "h"), str(tmp_path / "s")
    events = rows.withColumns(
        {"deviceSequenceNumber": F.col("eventId").cast("long"), "ComplexData": F.lit('{"moreData2":1.5}')}
    )
    new, old = events.where("deviceSequenceNumber >= 100"), events.where("deviceSequenceNumber < 100")
    stream = later_batches(spark, str(tmp_path / "in"), [new, old])
    if always:
        writers = [newest.keep_status(stream, status, always_replace=True)]
    else:
        writers = newest.history_and_status(stream, history, status, str(tmp_path / "c"))
    for writer in writers:
        runs.drain(writer, need_batches=2)
    got = newest.current(spark, status)
    if always:
        last = {r["deviceId"] for r in old.select("deviceId").distinct().collect()}
        assert {r["deviceId"] for r in got.where("deviceSequenceNumber < 100").collect()} == last
        return
    assert bag(got.select("deviceId", "eventId")) == bag(device.status_rows(events).select("deviceId", "eventId"))
    assert str(got.collect()[0]["MoreData2"]) == "1.5000"
    stored = spark.read.parquet(history)
    assert stored.count() == 200 and stored.select("BatchId").distinct().count() == 2


def test_twins_of_a_stream_over_a_restart(spark, tmp_path, rows):
    events = rows.withColumns(
        {"deviceSequenceNumber": F.col("eventId").cast("long"), "complexData": F.create_map(F.lit("k"), F.col("value"))}
    )
    arrival, folder, check = ("enqueuedAt", "eventId"), str(tmp_path / "in"), str(tmp_path / "c")
    parts = [events.where(f"cast(eventId as long) % 3 = {i}") for i in (2, 0, 1)]
    runs.drain(newest.keep_twins(later_batches(spark, folder, parts[:2]), check, arrival), need_batches=2)
    parts[2].write.parquet(f"{folder}/part-9")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/part-*")
    runs.drain(newest.keep_twins(stream, check, arrival), need_batches=1)
    got = newest.current_twins(spark, check, arrival)
    want = device.twin_state(events, arrival).select(*got.columns)
    assert bag(got) == bag(want) and got.count() > 1


def test_texts_and_messages(spark, tmp_path, rows):
    sinks.json_lines(str(tmp_path / "lines"))(rows, 0)
    assert spark.read.json(str(tmp_path / "lines")).count() == 200
    sinks.csv_export(str(tmp_path / "csv"), lambda b: b.groupBy("type").count())(rows, 3)
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["type", "count", "batch_id"]
    messages = [json.loads(r["value"]) for r in sinks.array_messages(rows, 7).collect()]
    assert sum(map(len, messages)) == 200 and max(map(len, messages)) == 7
    keyed = sinks.keyed_json(rows).collect()
    assert {r["key"] for r in keyed} == {json.loads(r["value"])["deviceId"] for r in keyed}
    report = quality.quality_report(stores.event_time_only(rows.withColumn("deviceSequenceNumber", F.lit(1))))
    sinks.json_lines(str(tmp_path / "report"))(quality.failed_checks(report), 0)


def test_shared_folder_comes_from_the_session(spark):
    assert runs.shared_folder(spark, "x") != runs.shared_folder(spark, "x")


def test_merge_compares_keys_whatever_the_day(spark, tmp_path):
    kind = "PartitionId long, eventId string, createdAt timestamp, enqueuedAt timestamp"
    first = spark.createDataFrame([(0, "x", AT, AT)], kind)
    later = spark.createDataFrame([(0, "x", AT + timedelta(days=1), AT), (0, "y", AT, AT)], kind)
    out = str(tmp_path / "out")
    write = sinks.merge_append(out)
    write(first, 0)
    write(later, 1)
    assert {r["eventId"] for r in sinks.read_batches(spark, out, first.schema).collect()} == {"x", "y"}
    assert sinks.read_batches(spark, out, first.schema).count() == 2


def test_the_newest_row_whichever_batch(spark, tmp_path):
    kind = "id string, v long, enqueuedAt timestamp"
    newer = spark.createDataFrame([("x", 1, AT + timedelta(hours=1)), ("y", 1, AT), ("z", 1, None)], kind)
    older = spark.createDataFrame([("x", 2, AT), ("y", 2, AT), ("z", 2, AT), (None, 2, AT)], kind)
    folder = str(tmp_path / "b")
    write = sinks.append_once(folder)
    write(newer, 0)
    write(older, 1)
    runs.drain(newest.keep_newest(later_batches(spark, str(tmp_path / "in"), [newer, older]), str(tmp_path / "c")))
    for state in [newest.current(spark, str(tmp_path / "c")), sinks.newest_rows(spark, folder, newer.schema)]:
        assert {r["id"]: r["v"] for r in state.collect()} == {"x": 1, "y": 2, "z": 2, None: 2}


# -- the key index -------------------------------------------------------------------


KEYED = "PartitionId long, eventId string, enqueuedAt timestamp"


def keyed(spark, first, n):
    return spark.createDataFrame([(k % 3, f"e{k}", AT) for k in range(first, first + n)], KEYED)


def test_a_batch_reads_its_own_buckets_only(spark, tmp_path):
    """The hundredth batch of five keys reads what lies in at most five of 64 buckets."""
    out, names = str(tmp_path / "out"), ["PartitionId", "eventId"]
    index = keys.folder_of(out)
    for n in range(99):
        keys.add(keyed(spark, 5 * n, 5).coalesce(1), index, names, 64, n)
    last = keyed(spark, 493, 5)  # two of these keys are known
    some = keys.touched(last, names, 64)
    found = keys.held(spark, index, last.select(*names).schema, some, 99)
    files = found.inputFiles()
    assert 0 < len(some) <= 5 and {int(re.search(r"bucket=(\d+)/", f)[1]) for f in files} <= set(some)
    every = [p for p in (tmp_path / "out" / "_keys").rglob("*.parquet")]
    read = sum(os.path.getsize(f.removeprefix("file://")) for f in files)
    assert read * 5 < sum(p.stat().st_size for p in every)
    write = sinks.merge_append(out, buckets=64)
    write(last, 99)
    write(last, 99)  # a replay does not meet its own keys
    got = spark.read.parquet(out)
    assert sorted(r["eventId"] for r in got.collect()) == ["e495", "e496", "e497"]


def test_merge_against_a_plain_model(spark, tmp_path):
    rng, out, seen, want = random.Random(4), str(tmp_path / "out"), set(), []
    write = sinks.merge_append(out, ("eventId",), ("at",), buckets=4)
    for n in range(6):
        batch = [(rng.choice([None, *"abcdefghijklmnop"]), rng.randrange(100) + n / 10) for _ in range(rng.randint(0, 12))]
        df = spark.createDataFrame(batch, "eventId string, at double")
        write(df, n)
        if n % 2:
            write(df, n)
        for key in {k for k, _ in batch if k is not None and k not in seen}:
            want.append((key, min(at for k, at in batch if k == key)))
            seen.add(key)
    got = sinks.read_batches(spark, out, df.schema).where("eventId is not null")
    assert sorted((r["eventId"], r["at"]) for r in got.collect()) == sorted(want)


def test_the_index_can_be_made_again(spark, tmp_path):
    out, names = str(tmp_path / "out"), ["PartitionId", "eventId"]
    sinks.append_once(out)(keyed(spark, 0, 50), 0)  # a table without an index
    keys.rebuild(spark.read.schema(KEYED).parquet(out), keys.folder_of(out), names, 8)
    assert len(list((tmp_path / "out" / "_keys").rglob("*.parquet"))) <= 8
    sinks.merge_append(out, buckets=8)(keyed(spark, 40, 20), 1)
    assert spark.read.parquet(out).count() == 60


def test_unique_keys_over_batches(spark, tmp_path):
    out = str(tmp_path / "out")
    write = sinks.unique_append(out, buckets=4)
    write(keyed(spark, 0, 10), 0)
    for bad in (keyed(spark, 9, 3), keyed(spark, 20, 2).union(keyed(spark, 21, 1))):
        with pytest.raises(ValueError, match="duplicate key"):
            write(bad, 1)
    write(keyed(spark, 10, 3), 1)
    write(keyed(spark, 10, 3), 1)
    write(keyed(spark, 0, 0), 2)
    assert sorted(r["eventId"] for r in sinks.read_batches(spark, out, spark.createDataFrame([], KEYED).schema).collect()) == sorted(f"e{k}" for k in range(13))


def test_long_texts_are_split_off_and_not_cut(spark):
    df = spark.createDataFrame([("a" * 5000, 1), ("b", 2), (None, 3)], "t string, n long")
    fit, long = sinks.split_long_texts(df, 4000)
    assert {r["n"] for r in fit.collect()} == {2, 3} and [len(r["t"]) for r in long.collect()] == [5000]


def test_metrics_of_each_batch(spark, tmp_path, rows):
    timed = rows.withColumn("processedAt", F.timestamp_add("SECOND", F.col("PartitionId"), F.col("enqueuedAt")))
    parts = [timed.where(f"PartitionId = {i}") for i in (2, 0, 1)]
    stream = later_batches(spark, str(tmp_path / "in"), parts)
    failed, told = F.col("type") == "CO2", []
    listeners = [metrics.BatchMetrics(metrics.PROCESSING), metrics.BatchMetrics(metrics.LATENCY, lambda n, row: told.append((n, row)))]
    for one in listeners:
        spark.streams.addListener(one)
    seen = metrics.observe_latency(metrics.observe_processing(stream, failed), "createdAt", "processedAt")
    runs.drain(runs.pipeline(seen, [], str(tmp_path / "c")).foreachBatch(sinks.append_once(str(tmp_path / "o"))), need_batches=3)
    found = dict(listeners[0].ended())
    listeners[1].ended()
    for one in listeners:
        spark.streams.removeListener(one)
    assert sorted(found) == [0, 1, 2] and sorted(n for n, _ in told) == [0, 1, 2]
    for n, part in enumerate(parts):
        want = aggregate.processing_stats(part.withColumn("b", F.lit(n)), ["b"], failed).drop("b").first().asDict()
        assert found[n] == want
        assert dict(told)[n] == aggregate.latency_metric(part, "createdAt", "processedAt").first().asDict()


def test_a_catalog_table_reads_the_wanted_partitions(spark, tmp_path, rows):
    base = str(tmp_path / "export")
    rows.select(F.col("createdAt").alias("timestamp"), "eventId", "PartitionId").write.partitionBy("PartitionId").parquet(base)
    spark.sql("DROP TABLE IF EXISTS export_of_test")
    try:
        table = files.external_table(spark, "export_of_test", base)
        some = files.typed_rows(table).where("PartitionId = 1")
        assert some.count() == rows.where("PartitionId = 1").count()
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*PartitionId[^]]* = 1", plan)
        assert "enqueuedAt" in some.columns and files.first_of_table(spark, "export_of_test", 3).count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS export_of_test")


def test_streams_drained_at_once(spark, tmp_path):
    """Each of two streams waits inside its micro-batch for the other one."""
    spark.range(10).write.parquet(str(tmp_path / "in"))
    source, meet = spark.readStream.schema("id long").parquet(str(tmp_path / "in")), threading.Barrier(2)

    def writer(name, body):
        return runs.pipeline(source, [], str(tmp_path / name)).foreachBatch(body)

    both = [writer(name, lambda batch, n: (meet.wait(60), batch.count())) for name in "ab"]
    assert len(runs.drain_all(both, need_batches=1)) == 2

    def fail(batch, n):
        raise ValueError("no")

    with pytest.raises(Exception, match="no"):
        runs.drain_all([writer("c", fail), writer("d", lambda batch, n: None)])
    assert not spark.streams.active


def test_status_numbers_only_from_texts_that_hold_them(spark, tmp_path):
    texts = ['{"moreData1": 1.5}', '{"more\\u0044ata2": 2}', '{"moreData3": "x", "moreData4": 4}', "no json moreData5", None]
    rows = spark.createDataFrame([(f"d{i}", "e", i, t) for i, t in enumerate(texts)], "deviceId string, eventId string, deviceSequenceNumber long, ComplexData string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    runs.drain(newest.keep_status(stream, str(tmp_path / "c")), need_batches=1)
    got = newest.current(spark, str(tmp_path / "c")).orderBy("deviceId").select(*[f"MoreData{i}" for i in range(1, 6)]).collect()
    found = [tuple(None if x is None else float(x) for x in r) for r in got]
    none = (None,) * 5
    assert found == [(1.5, *none[1:]), (None, 2.0, None, None, None), (None, None, None, 4.0, None), none, none]
