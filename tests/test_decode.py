from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from fleetlens import schema
from fleetlens.functions import scalars
from fleetlens.operators import decode, enrich

RECORD = (
    '{"eventId":"0b1c2d3e-0001-4002-8003-0123456789ab","complexData":null,'
    '"value":12.375,"type":"CO2","deviceId":"device-17",'
    '"deviceSequenceNumber":3,"createdAt":"2024-03-05T06:07:08.009Z",'
    '"enqueuedAt":"2024-03-05T06:07:09.010Z","processedAt":"2024-03-05T06:07:10.011Z"}'
)
FIELDS = schema.T.StructType([f for f in schema.PROCESSED_EVENT.fields[:9]])


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_record_round_trip(spark):
    df = spark.createDataFrame([(RECORD,)], "value string")
    event = decode.json_to_record(df, FIELDS)
    row = one(event)
    assert row["value"] == 12.375
    assert row["enqueuedAt"] == datetime(2024, 3, 5, 6, 7, 9, 10000)
    assert one(decode.record_to_json(event))["value"] == RECORD


def test_times_with_any_fraction_and_offset(spark):
    texts = [
        ("2024-03-05T06:07:08Z", datetime(2024, 3, 5, 6, 7, 8)),
        ("2024-03-05T06:07:08.7Z", datetime(2024, 3, 5, 6, 7, 8, 700000)),
        ("2024-03-05T06:07:08.7480001Z", datetime(2024, 3, 5, 6, 7, 8, 748000)),
        ("2024-03-05T06:07:08.748+02:00", datetime(2024, 3, 5, 4, 7, 8, 748000)),
        ("yesterday", None),
        (None, None),
    ]
    df = spark.createDataFrame(texts, "text string, want timestamp")
    for row in df.withColumn("got", scalars.parse_iso("text")).collect():
        assert row["got"] == row["want"], row["text"]


def test_capture_time(spark):
    df = spark.createDataFrame([("1/31/2024 11:05:09 PM",), ("12/1/2024 12:00:00 AM",), ("?",)], "t string")
    got = [r[0] for r in df.select(scalars.parse_capture_time("t")).collect()]
    assert got == [datetime(2024, 1, 31, 23, 5, 9), datetime(2024, 12, 1), None]


def test_array_line_and_single_object_messages(spark):
    body = F.col("t").cast("binary").alias("body")
    arrived = F.lit("2024-01-01").cast("timestamp").alias("enqueuedTime")
    texts = [(f"[{RECORD},{RECORD}]",), (RECORD,), ("[]",), ("no JSON",)]
    df = spark.createDataFrame(texts, "t string").select(body, arrived)
    assert decode.explode_array(df).count() == 3
    lines = spark.createDataFrame([(f"{RECORD}\nbroken\n{RECORD}",)], "t string").select(body)
    assert decode.explode_lines(lines).count() == 2


def test_malformed_messages_are_kept_aside(spark):
    texts = [(RECORD,), ('{"eventId":',), (None,), ("7",), ('{"value":"high"}',)]
    df = spark.createDataFrame(texts, "text string")
    good, bad = decode.split_malformed(df, "text")
    assert good.count() == 1
    assert sorted(r["reason"] for r in bad.collect()) == ["empty message"] + 3 * [
        "not a JSON event"
    ]


def test_paths_to_columns(spark):
    df = spark.createDataFrame([('{"a":{"b":[1,2]},"n":"x"}',)], "t string")
    mapping = {"dyn": ("$.a", "variant"), "text": ("$.a", "json"), "n": ("$.n", "double")}
    row = one(decode.map_paths(df, mapping, F.col("t")).withColumn("dyn", F.to_json("dyn")))
    assert (row["dyn"], row["text"], row["n"]) == ('{"b":[1,2]}', '{"b":[1,2]}', None)


def test_wide_complex_data(spark):
    wide = schema.event_schema(schema.wide_complex_data(1, 3))
    df = spark.createDataFrame([('{"eventId":"e","complexData":{"moreData1":1.5,"moreData9":2}}',)], "value string")
    row = one(decode.json_to_record(df, wide))
    assert row["complexData"].asDict() == {"moreData1": 1.5, "moreData2": None, "moreData3": None}


def test_payload_rows_and_batch_ids(spark):
    df = decode.json_to_record(spark.createDataFrame([(RECORD,)], "value string"), FIELDS)
    row = one(enrich.payload_rows(df.withColumn("PartitionId", F.lit(3))))
    assert row["Value"] == 12 and len(row["BatchId"]) == 36
    names = {"EventId": "eventId", "DeviceId": "deviceId"}
    assert enrich.project(df, names).columns == ["EventId", "DeviceId"]
    assert one(enrich.with_stored_at(enrich.with_processed_at(df)))["storedAt"] is not None


def test_scalars(spark):
    df = spark.createDataFrame(
        [("d1", '{"x":1.23456,"y":"z"}', datetime(2024, 1, 1, 10, 7, 31, 500000))],
        "d string, j string, t timestamp",
    )
    row = one(
        df.select(
            scalars.partition_of("d", 8).alias("p"),
            scalars.partition_of("d", 0).alias("p1"),
            scalars.json_number("j", "$.x").alias("x"),
            scalars.json_number("j", "$.y").alias("y"),
            scalars.bin_start("t", "5 minutes").alias("bin"),
            scalars.minute_of("t").alias("minute"),
            scalars.seconds_of("t").alias("s"),
            scalars.is_json("j").alias("ok"),
            scalars.is_json(F.lit("{")).alias("bad"),
        )
    )
    assert 0 <= row["p"] < 8 and row["p1"] == 0
    assert str(row["x"]) == "1.2346" and row["y"] is None
    assert row["bin"] == datetime(2024, 1, 1, 10, 5) and row["minute"] == datetime(2024, 1, 1, 10, 7)
    assert row["s"] % 60 == 31.5 and row["ok"] and not row["bad"]


def test_strip_type_suffix_keeps_ambiguous_names(spark):
    df = spark.createDataFrame([("a", 1, 2.0, "t")], "id_string string, n_long long, n_double double, x string")
    assert scalars.strip_type_suffix(df).columns == ["id", "n_long", "n_double", "x"]


def test_bytes_that_are_no_text_go_to_the_quarantine(spark):
    rows = [(1, RECORD.encode()), (2, b"\xff\xfe"), (3, b"{"), (4, None)]
    df = spark.createDataFrame(rows, "n long, body binary")
    good, bad = decode.split_malformed(df, "body", FIELDS)
    assert [r["n"] for r in good.collect()] == [1]
    reasons = {r["n"]: r["reason"] for r in bad.collect()}
    assert reasons == {2: "not UTF-8", 3: "not a JSON event", 4: "empty message"}
    enveloped = df.withColumn("enqueuedTime", F.current_timestamp())
    assert decode.decode_events(enveloped).where("eventId is not null").count() == 1
