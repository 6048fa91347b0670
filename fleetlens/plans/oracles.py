"""The registered queries once more, as plain SQL over the same tables."""

from __future__ import annotations

TELEMETRY = """
telemetry AS (
  SELECT CAST(event_id AS VARCHAR) AS eventId,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         value,
         CASE event_type WHEN 'view' THEN 'TEMP' WHEN 'click' THEN 'CO2'
              ELSE upper(event_type) END AS type,
         'device-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS deviceId,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1
           AS deviceSequenceNumber,
         ts AS createdAt,
         ts + to_seconds(event_id % 7) AS enqueuedAt,
         ts + to_seconds(event_id % 7) + to_seconds(event_id % 3) AS processedAt,
         ts + to_seconds(event_id % 7) + to_seconds(event_id % 11) AS storedAt,
         user_id % 4 AS PartitionId,
         event_id, user_id, props
  FROM events)"""

DUPLICATES = """
duplicates AS (
  SELECT * FROM telemetry
  UNION ALL
  SELECT * REPLACE (enqueuedAt + INTERVAL 30 SECOND AS enqueuedAt)
  FROM telemetry WHERE event_id % 1000 = 0)"""

GAPS = "gaps AS (SELECT * FROM telemetry WHERE event_id % 97 <> 13)"

LATE = """
late AS (
  SELECT * REPLACE (CASE WHEN event_id % 50 = 7 THEN enqueuedAt + INTERVAL 2 DAY
                         ELSE enqueuedAt END AS enqueuedAt)
  FROM telemetry)"""

TABLES = f"""
target AS (SELECT * FROM telemetry WHERE event_id % 3 = 0),
staging AS (SELECT * FROM duplicates WHERE event_id % 3 <> 0 OR event_id % 2 = 0)"""

INSTANCES = """
instances AS (
  SELECT DISTINCT deviceId, 'simulated-device' AS typeId,
         'Device #' || CAST(user_id AS VARCHAR) AS name,
         'A simulated device' AS description,
         CAST(2020 AS BIGINT) AS year, user_id % 12 + 1 AS month,
         CASE WHEN user_id % 2 = 0 THEN 'Car' ELSE 'Bus' END AS vehicle
  FROM telemetry)"""

EVENT_COLUMNS = (
    "eventId, type, deviceId, deviceSequenceNumber, round(value, 6) AS value, "
    "createdAt, enqueuedAt, PartitionId"
)
SPAN = (
    "createdAt >= TIMESTAMP '2024-01-05 00:00:00' "
    "AND createdAt < TIMESTAMP '2024-01-15 00:00:00'"
)


def _with(*parts: str) -> str:
    return "WITH " + ",".join((TELEMETRY, *parts))


def _minute_rates(rows: str) -> str:
    return f"""
rates AS (
  SELECT date_trunc('minute', storedAt) AS stored_minute,
         count(eventId) / 60 AS events_per_second,
         avg((epoch_us(storedAt) - epoch_us(enqueuedAt)) / 1e6) AS avg_latency_s
  FROM {rows} GROUP BY 1)"""


def _stored_deltas(rows: str, by: str) -> str:
    return f"""
stored AS (
  SELECT *, deviceSequenceNumber - lag(deviceSequenceNumber) OVER (
           PARTITION BY deviceId ORDER BY {by}, deviceSequenceNumber) AS delta
  FROM {rows})"""


def _middle_deltas(rows: str) -> str:
    return f"""
ranked AS (
  SELECT *, row_number() OVER (
             PARTITION BY deviceId ORDER BY deviceSequenceNumber) / count(*) OVER (
             PARTITION BY deviceId) AS share
  FROM {rows}),
middle AS (
  SELECT *, deviceSequenceNumber - lag(deviceSequenceNumber) OVER (
             PARTITION BY deviceId ORDER BY deviceSequenceNumber) AS delta
  FROM ranked WHERE share >= 0.1 AND share <= 0.9)"""


def _fraction(bad: str, rows: str) -> str:
    return f"""
SELECT n_bad, n_rows, round(n_bad / n_rows, 6) AS fraction
FROM (SELECT ({bad}) AS n_bad, (SELECT count(*) FROM {rows}) AS n_rows)"""


def _report(rows: str) -> str:
    return (
        _with(
            GAPS,
            "again AS (SELECT * FROM gaps UNION ALL SELECT * REPLACE "
            "(enqueuedAt + INTERVAL 30 SECOND AS enqueuedAt) FROM gaps "
            "WHERE event_id % 1000 = 0)",
            _minute_rates(rows),
            _stored_deltas(rows, "storedAt"),
            _middle_deltas(rows),
            f"total AS (SELECT count(*) AS n FROM {rows})",
        )
        + f""",
report AS (
SELECT 'throughput' AS check_name, CAST(0.05 AS DOUBLE) AS expected,
       max(events_per_second) AS actual, max(events_per_second) >= 0.05 AS passed FROM rates
UNION ALL
SELECT 'latency', 15000.0, min(avg_latency_s) * 1000, min(avg_latency_s) * 1000 <= 15000
FROM rates
UNION ALL
SELECT 'duplicates', 0.0011, d / n, d / n <= 0.0011
FROM (SELECT count(*) AS d FROM (SELECT 1 FROM {rows} GROUP BY eventId HAVING count(*) > 1)),
     total
UNION ALL
SELECT 'out_of_sequence', 0.0, d / n, d / n <= 0
FROM (SELECT count(*) AS d FROM stored WHERE delta > 1), total
UNION ALL
SELECT 'missing', 0.0, d / n, d / n <= 0
FROM (SELECT count(*) AS d FROM middle WHERE delta > 1), total)"""
    )


def _instances(*parts: str) -> str:
    return _with(INSTANCES, *parts)


def _interpolation(step: bool) -> str:
    value = (
        "CASE WHEN b_t = ts THEN b_v ELSE a_v END"
        if step
        else "CASE WHEN b_t = ts THEN b_v ELSE a_v + (b_v - a_v) "
        "* (epoch_us(ts) - epoch_us(a_t)) / (epoch_us(b_t) - epoch_us(a_t)) END"
    )
    return (
        _with(
            """
samples AS (
  SELECT deviceId, createdAt, event_id, value FROM telemetry
  WHERE type = 'TEMP' AND createdAt >= TIMESTAMP '2024-01-02 00:00:00'
    AND createdAt < TIMESTAMP '2024-01-18 00:00:00'),
grid AS (
  SELECT deviceId, TIMESTAMP '2024-01-05 00:00:00' + to_hours(12 * i) AS ts
  FROM (SELECT DISTINCT deviceId FROM samples), range(20) AS r(i)),
around AS (
  SELECT g.deviceId, g.ts,
    max(CASE WHEN createdAt < ts THEN
        {'t': createdAt, 'e': event_id, 'v': value} END) AS a,
    min(CASE WHEN createdAt >= ts THEN
        {'t': createdAt, 'e': event_id, 'v': value} END) AS b
  FROM grid g JOIN samples s ON g.deviceId = s.deviceId GROUP BY ALL),
points AS (
  SELECT deviceId, ts, a.t AS a_t, a.v AS a_v, b.t AS b_t, b.v AS b_v FROM around)"""
        )
        + f" SELECT deviceId, ts, round({value}, 6) AS value FROM points"
    )


ORACLES: dict[str, str] = {
    "minute_rate_latency": _with(_minute_rates("telemetry"))
    + """
SELECT stored_minute, round(events_per_second, 6) AS events_per_second,
       round(avg_latency_s, 6) AS avg_latency_s FROM rates""",
    "rate_summary": _with(_minute_rates("telemetry"))
    + """
SELECT count(stored_minute) AS minutes_with_data,
       round(max(events_per_second), 6) AS max_events_per_second,
       round(min(avg_latency_s), 6) AS min_latency_s FROM rates""",
    "quality_report": _report("again")
    + """
SELECT check_name, expected, round(actual, 6) AS actual, passed FROM report""",
    "failed_checks": _report("gaps") + " SELECT check_name FROM report WHERE NOT passed",
    "duplicate_fraction": _with(DUPLICATES)
    + _fraction(
        "SELECT count(*) FROM (SELECT 1 FROM duplicates GROUP BY eventId HAVING count(*) > 1)",
        "duplicates",
    ),
    "out_of_sequence": _with(LATE, _stored_deltas("late", "enqueuedAt"))
    + _fraction("SELECT count(*) FROM stored WHERE delta > 1", "late"),
    "missing_events": _with(GAPS, _middle_deltas("gaps"))
    + _fraction("SELECT count(*) FROM middle WHERE delta > 1", "gaps"),
    "stored_order_delta": _with(LATE, _stored_deltas("late", "enqueuedAt"))
    + """
SELECT eventId, deviceId, deviceSequenceNumber, delta FROM stored WHERE delta IS NOT NULL""",
    "middle_delta": _with(GAPS, _middle_deltas("gaps"))
    + """
SELECT eventId, deviceId, deviceSequenceNumber, delta FROM middle WHERE delta IS NOT NULL""",
    "json_valid": """
SELECT count(*) FILTER (WHERE json_valid(p)) AS n_valid,
       count(*) FILTER (WHERE NOT json_valid(p)) AS n_bad
FROM (SELECT CASE WHEN event_id % 50 = 3 THEN substr(props, 1, 4) ELSE props END AS p
      FROM events)""",
    "count_by_bin": _with()
    + """
SELECT time_bucket(INTERVAL 5 MINUTE, createdAt) AS bin_start, count(*) AS n
FROM telemetry WHERE type = 'CO2' GROUP BY 1""",
    "device_type_summary": _with()
    + """
SELECT deviceId, type, count(*) AS n, min(createdAt) AS first_at, max(createdAt) AS last_at
FROM telemetry GROUP BY 1, 2""",
    "device_type_mean": _with()
    + """
SELECT deviceId, type, round(avg(value), 6) AS mean_value, count(*) AS n
FROM telemetry GROUP BY 1, 2""",
    "top_groups": _with()
    + """
SELECT deviceId, type, round(avg(value), 6) AS mean_value, count(*) AS n
FROM telemetry GROUP BY 1, 2 ORDER BY n, deviceId, type LIMIT 10""",
    "batch_latency": _with()
    + """
, sent AS (SELECT *, event_id // 10 AS batch_id,
                  max(storedAt) OVER (PARTITION BY event_id // 10) AS sentAt FROM telemetry),
 ms AS (SELECT *, (epoch_us(sentAt) - epoch_us(enqueuedAt)) / 1000 AS e FROM sent)
SELECT batch_id, count(*) AS n, min(enqueuedAt) AS from_at, max(enqueuedAt) AS to_at,
       round(min(e), 6) AS min_ms, round(max(e), 6) AS max_ms,
       round_even(avg(e), 0) AS avg_ms
FROM ms GROUP BY 1""",
    "log_throughput": _with()
    + """
SELECT PartitionId, date_trunc('minute', enqueuedAt) AS minute, count(*) AS messages,
       CAST(sum(strlen(props)) AS BIGINT) AS bytes, round(count(*) / 60000, 6) AS utilisation,
       round(sum(strlen(props)) / 60000000, 6) AS byte_utilisation
FROM telemetry GROUP BY 1, 2""",
    "counter_rate": _with()
    + """
, ranked AS (
  SELECT lower(type) || '_total' AS name, PartitionId AS pod, createdAt AS t,
         event_id AS v,
         row_number() OVER (PARTITION BY type, PartitionId
                            ORDER BY createdAt DESC, event_id DESC) AS r
  FROM telemetry
  WHERE type IN ('TEMP', 'CO2', 'ERROR') AND user_id % 2 = 0),
pairs AS (
  SELECT name, pod, max(t) FILTER (WHERE r = 1) AS t1, max(t) FILTER (WHERE r = 2) AS t2,
         max(v) FILTER (WHERE r = 1) AS v1, max(v) FILTER (WHERE r = 2) AS v2
  FROM ranked WHERE r <= 2 GROUP BY 1, 2)
SELECT name, max(t1) AS latest_at, max(t2) AS previous_at,
       CAST(sum(v1) AS BIGINT) AS latest, CAST(sum(v2) AS BIGINT) AS previous,
       round(sum((v1 - v2) / ((epoch_us(t1) - epoch_us(t2)) / 1000) * 60000), 6)
         AS per_minute
FROM pairs GROUP BY 1""",
    "processing_stats": _with()
    + """
, ms AS (SELECT event_id // 100 AS batch_id, type,
                (epoch_us(processedAt) - epoch_us(enqueuedAt)) / 1000 AS e FROM telemetry)
SELECT batch_id, count(*) AS n, count(*) FILTER (WHERE type = 'ERROR') AS n_bad,
       round(min(e), 6) AS min_ms, round(max(e), 6) AS max_ms, round(avg(e), 6) AS avg_ms
FROM ms GROUP BY 1""",
    "latency_metric": _with()
    + """
, ms AS (SELECT (epoch_us(storedAt) - epoch_us(createdAt)) / 1000 AS e FROM telemetry)
SELECT round(sum(e), 6) AS sum_ms, count(e) AS n, round(min(e), 6) AS min_ms,
       round(max(e), 6) AS max_ms FROM ms""",
    "decode_messages": _with()
    + """
SELECT eventId, k, value, type, deviceId, deviceSequenceNumber, createdAt, enqueuedAt
FROM telemetry""",
    "explode_batches": _with()
    + """
SELECT eventId, k, value, type, deviceId, deviceSequenceNumber, createdAt, enqueuedAt,
       processedAt, CAST(PartitionId AS INTEGER) AS PartitionId,
       max(storedAt) OVER (PARTITION BY event_id // 10) AS storedAt
FROM telemetry""",
    "map_json_paths": _with()
    + """
SELECT eventId, k, CAST(value AS VARCHAR) AS value, type, deviceId, deviceSequenceNumber,
       createdAt FROM telemetry""",
    "quarantine": """
SELECT event_id, 'not a JSON event' AS reason FROM events WHERE event_id % 40 = 3""",
    "capture_decode": _with()
    + """
SELECT eventId, k, value, type, deviceId, deviceSequenceNumber, createdAt,
       date_trunc('second', enqueuedAt) AS enqueuedAt FROM telemetry""",
    "relay": _with()
    + """
SELECT eventId, enqueuedAt, processedAt FROM telemetry""",
    "created_as_enqueued": _with()
    + """
SELECT eventId AS id, eventId, createdAt AS enqueuedAt FROM telemetry""",
    "partition_assign": _with()
    + """
SELECT count(DISTINCT deviceId) AS devices, count(DISTINCT deviceId) AS same,
       count(DISTINCT deviceId) AS in_range, least(count(DISTINCT deviceId), 8) AS used
FROM telemetry""",
    "payload_rows": _with()
    + """
SELECT eventId AS EventId, 'batch-1' AS BatchId, k, CAST(round(value) AS BIGINT) AS Value,
       deviceId AS DeviceId, deviceSequenceNumber AS DeviceSequenceNumber, type AS Type,
       createdAt AS CreatedAt, enqueuedAt AS EnqueuedAt, processedAt AS ProcessedAt,
       PartitionId FROM telemetry""",
    "position_in_batch": _with()
    + """
SELECT event_id // 100 AS batch_id, eventId,
       row_number() OVER (PARTITION BY event_id // 100 ORDER BY enqueuedAt, event_id)
         AS position
FROM telemetry""",
    "iso_times": _with()
    + """
SELECT eventId, strftime(createdAt, '%Y-%m-%dT%H:%M:%S.%gZ') AS createdAt,
       strftime(enqueuedAt, '%Y-%m-%dT%H:%M:%S.%gZ') AS enqueuedAt,
       date_trunc('millisecond', createdAt) AS parsedAt
FROM telemetry""",
    "catalog_export": _with()
    + """
SELECT deviceId, round(value, 6) AS value, createdAt, createdAt AS storedAt, PartitionId AS part
FROM telemetry WHERE PartitionId >= 2""",
    "typed_export": _with()
    + """
SELECT createdAt AS timestamp, deviceId, eventId, deviceSequenceNumber FROM telemetry""",
    "staging_dedup": _with(DUPLICATES)
    + f"""
SELECT {EVENT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY PartitionId, eventId ORDER BY enqueuedAt) AS r
  FROM duplicates) WHERE r = 1""",
    "merge_insert": _with(DUPLICATES, TABLES)
    + f"""
SELECT {EVENT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY PartitionId, eventId ORDER BY enqueuedAt) AS r
  FROM staging) s
WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM target t
  WHERE t.PartitionId = s.PartitionId AND t.eventId = s.eventId)""",
    "merge_result": _with(DUPLICATES, TABLES)
    + f"""
SELECT {EVENT_COLUMNS} FROM target UNION ALL
SELECT {EVENT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY PartitionId, eventId ORDER BY enqueuedAt) AS r
  FROM staging) s
WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM target t
  WHERE t.PartitionId = s.PartitionId AND t.eventId = s.eventId)""",
    "lru_dedup": """
WITH placed AS (
  SELECT event_type AS k, user_id AS id, event_id,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p
  FROM events),
linked AS (
  SELECT *, lag(p) OVER (PARTITION BY k, id ORDER BY p) AS before,
         lead(p) OVER (PARTITION BY k, id ORDER BY p) AS after
  FROM placed),
counted AS (
  SELECT a.k, a.id, a.event_id, a.before, count(b.p) AS others
  FROM linked a LEFT JOIN linked b
    ON a.k = b.k AND b.p > a.before AND b.p < a.p
       AND (b.after IS NULL OR b.after > a.p)
  GROUP BY ALL)
SELECT k, id, event_id FROM counted WHERE before IS NULL OR others >= 20""",
    "upsert_latest": _with(DUPLICATES, TABLES)
    + f"""
SELECT {EVENT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY eventId ORDER BY enqueuedAt DESC) AS r
  FROM (SELECT * FROM target UNION ALL SELECT * FROM staging)) WHERE r = 1""",
    "unique_violations": _with(DUPLICATES)
    + " SELECT eventId, count(*) AS n FROM duplicates GROUP BY 1 HAVING count(*) > 1",
    "remove_members": _with()
    + """
SELECT eventId, deviceId FROM telemetry
WHERE deviceId NOT IN (SELECT deviceId FROM telemetry WHERE event_id % 500 = 0)""",
    "latest_per_device": _with()
    + f"""
SELECT {EVENT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY deviceId ORDER BY deviceSequenceNumber DESC) AS r
  FROM telemetry) WHERE r = 1""",
    "device_status": _with()
    + """
SELECT deviceId, eventId, deviceSequenceNumber, createdAt, round(value, 6) AS value,
       CAST(CAST(k / 1 AS DECIMAL(18, 4)) AS DOUBLE) AS MoreData1,
       CAST(CAST(k / 2 AS DECIMAL(18, 4)) AS DOUBLE) AS MoreData2,
       CAST(NULL AS DOUBLE) AS MoreData3,
       CAST(CAST(k / 4 AS DECIMAL(18, 4)) AS DOUBLE) AS MoreData4,
       CAST(CAST(k / 5 AS DECIMAL(18, 4)) AS DOUBLE) AS MoreData5
FROM (SELECT *, row_number() OVER (PARTITION BY deviceId ORDER BY deviceSequenceNumber DESC)
        AS r FROM telemetry) WHERE r = 1""",
    "top_per_partition": _with()
    + f"""
SELECT {EVENT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY PartitionId ORDER BY storedAt DESC, event_id DESC)
    AS r FROM telemetry)
WHERE r <= 30 ORDER BY storedAt DESC, event_id DESC LIMIT 100""",
    "device_newest": _with()
    + """
SELECT eventId, deviceId, type, round(value, 6) AS value, storedAt, PartitionId
FROM telemetry WHERE deviceId = 'device-000005' AND PartitionId = 1
ORDER BY storedAt DESC, event_id DESC LIMIT 100""",
    "hot_to_cold": _with()
    + """
SELECT eventId, deviceId, processedAt,
       CASE WHEN row_number() OVER (ORDER BY processedAt DESC, event_id DESC) <= 1000
            THEN 'cold' ELSE 'hot' END AS tier
FROM telemetry""",
    "late_drop": _with(LATE)
    + """
SELECT eventId, deviceId, createdAt, enqueuedAt FROM (
  SELECT *, max(createdAt) OVER (ORDER BY enqueuedAt, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS newest FROM late)
WHERE createdAt >= newest - INTERVAL 10 SECOND""",
    "late_adjust": _with(LATE)
    + """
SELECT eventId, deviceId, createdAt, enqueuedAt,
       max(createdAt) OVER (ORDER BY enqueuedAt, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS adjusted_at
FROM late""",
    "pattern_tags": _with()
    + """
, marked AS (
  SELECT *, type = 'TEMP' AND value >= 10 AND value < 30 AS band,
            type = 'CO2' AND value > 20 AS high FROM telemetry),
framed AS (
  SELECT *, count(*) OVER f AS held, count(*) FILTER (WHERE band) OVER f AS bands,
         count(*) FILTER (WHERE high) OVER f AS highs
  FROM marked
  WINDOW f AS (PARTITION BY deviceId ORDER BY enqueuedAt, event_id
               ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT deviceId, createdAt AS trigger_at, eventId AS trigger_id, tag FROM (
  SELECT *, 'FirstTagForThisKey' AS tag FROM framed WHERE held = 1
  UNION ALL SELECT *, CAST(held AS VARCHAR) || 'RecordsForThisKey' FROM framed
            WHERE held > 1 AND held < 10
  UNION ALL SELECT *, 'SeveralTemperaturesIn70s' FROM framed WHERE band AND bands >= 2
  UNION ALL SELECT *, 'HighCO2WithSeveralTemperaturesIn70s' FROM framed
            WHERE bands >= 2 AND highs >= 1)""",
    "silent_devices": _with()
    + """
SELECT deviceId, createdAt AS trigger_at, eventId AS trigger_id,
       'NoNewsForAtLeast86400000ms' AS tag
FROM (SELECT *, lead(enqueuedAt) OVER (PARTITION BY deviceId ORDER BY enqueuedAt, event_id)
        AS following FROM telemetry)
WHERE following IS NULL OR following > createdAt + INTERVAL 1 DAY""",
    "spike_dip": _with()
    + """
, framed AS (
  SELECT *, list({'t': enqueuedAt, 'v': value}) OVER (
     PARTITION BY PartitionId ORDER BY enqueuedAt, event_id
     ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS before FROM telemetry),
recent AS (
  SELECT PartitionId, enqueuedAt, value, list_transform(list_filter(coalesce(before, []),
           lambda p: p.t >= enqueuedAt - INTERVAL 6 HOUR), lambda p: p.v) AS vs FROM framed),
scored AS (
  SELECT *, list_avg(vs) AS m,
         CASE WHEN len(vs) > 1 THEN list_stddev_pop(vs) END AS s FROM recent),
result AS (
  SELECT *, CASE WHEN list_max(vs) > list_min(vs) THEN (value - m) / s
       WHEN len(vs) > 1 AND value <> m THEN sign(value - m) * 'inf'::DOUBLE ELSE 0 END AS z FROM scored)
SELECT PartitionId, enqueuedAt AS time, round(value, 6) AS val, round(z, 4) AS score,
       CAST(abs(z) >= 1.959963984540054 AS BIGINT) AS is_anomaly FROM result""",
    "series_events": _with()
    + f"""
SELECT deviceId, createdAt, eventId, type, round(value, 6) AS value FROM telemetry
WHERE {SPAN} AND user_id BETWEEN 1 AND 5 AND type IN ('TEMP', 'CO2')
ORDER BY createdAt, deviceId, event_id LIMIT 1000""",
    "series_values": _with()
    + f"""
SELECT deviceId, createdAt AS ts,
       round(CASE WHEN type = 'TEMP' THEN value END, 6) AS temperature,
       round(CASE WHEN type = 'CO2' THEN value * 2 END, 6) AS co2
FROM telemetry WHERE {SPAN} AND type IN ('TEMP', 'CO2')""",
    "series_aggregate": _with()
    + f"""
, chosen AS (SELECT * FROM telemetry WHERE {SPAN}),
grid AS (
  SELECT deviceId, TIMESTAMP '2024-01-05 00:00:00' + to_days(CAST(i AS INTEGER)) AS ts
  FROM (SELECT DISTINCT deviceId FROM chosen), range(10) AS r(i)),
found AS (
  SELECT deviceId, date_trunc('day', createdAt) AS ts,
         avg(value) FILTER (WHERE type = 'TEMP') AS temperature,
         max(value) FILTER (WHERE type = 'CO2') AS co2,
         max(value) - min(value) AS spread
  FROM chosen GROUP BY 1, 2)
SELECT g.deviceId, CAST(g.ts AS TIMESTAMP) AS ts, round(temperature, 6) AS temperature,
       round(co2, 6) AS co2, round(spread, 6) AS spread
FROM grid g LEFT JOIN found f ON g.deviceId = f.deviceId AND g.ts = f.ts""",
    "series_categories": _with()
    + """
, states AS (
  SELECT deviceId, CASE WHEN type IN ('TEMP', 'CO2') THEN 'sensor'
                        WHEN type = 'ERROR' THEN 'fault' ELSE 'other' END AS label,
         createdAt, lead(createdAt) OVER (PARTITION BY deviceId ORDER BY createdAt, event_id)
           AS until
  FROM telemetry WHERE createdAt >= TIMESTAMP '2024-01-03 00:00:00'
                   AND createdAt < TIMESTAMP '2024-01-15 00:00:00'),
slots AS (SELECT TIMESTAMP '2024-01-05 00:00:00' + to_hours(6 * i) AS ts FROM range(40) AS r(i)),
parts AS (
  SELECT deviceId, ts, label, createdAt >= ts AND createdAt < ts + INTERVAL 6 HOUR AS here,
    greatest(epoch_us(least(coalesce(until, TIMESTAMP '2024-01-15 00:00:00'),
                            ts + INTERVAL 6 HOUR))
             - epoch_us(greatest(createdAt, ts)), 0) AS us
  FROM states, slots
  WHERE createdAt < ts + INTERVAL 6 HOUR
    AND coalesce(until, TIMESTAMP '2024-01-15 00:00:00') > ts)
SELECT deviceId, ts, label, count(*) FILTER (WHERE here) AS n,
       round(sum(us) / 1e6, 6) AS seconds
FROM parts WHERE here OR us > 0 GROUP BY 1, 2, 3""",
    "series_interpolate": _interpolation(step=False),
    "series_step": _interpolation(step=True),
    "availability": _with()
    + """
SELECT date_trunc('hour', createdAt) AS bin_start, count(*) AS n,
       min(createdAt) AS first_at, max(createdAt) AS last_at
FROM telemetry GROUP BY 1""",
    "availability_range": """
SELECT min(ts) AS first_at, max(ts) AS last_at, count(*) AS n FROM events""",
    "event_schema": f"""
WITH spans AS (SELECT *, ts AS createdAt FROM events),
chosen AS (SELECT * FROM spans WHERE {SPAN})
SELECT DISTINCT u.name AS name, u.type AS type FROM chosen, LATERAL (
  SELECT unnest([
    {{'name': 'eventId', 'type': CASE WHEN event_id IS NOT NULL THEN 'string' END}},
    {{'name': 'value', 'type': CASE WHEN value IS NOT NULL THEN 'double' END}},
    {{'name': 'deviceSequenceNumber', 'type': 'bigint'}},
    {{'name': 'createdAt', 'type': 'timestamp'}},
    {{'name': json_keys(props)[1], 'type':
      CASE json_type(props, '$.k') WHEN 'UBIGINT' THEN 'bigint' ELSE 'other' END}}]) AS u)
WHERE u.type IS NOT NULL""",
    "events_with_model": _instances()
    + """
SELECT typeId, vehicle, month, count(*) AS n, round(avg(value), 6) AS mean_value
FROM telemetry JOIN instances USING (deviceId) GROUP BY 1, 2, 3""",
    "instance_search": _instances()
    + """
, texts AS (SELECT *, lower(deviceId || ' ' || name || ' ' || description) AS t FROM instances)
SELECT deviceId, name, vehicle, month,
       CAST((length(t) - length(replace(t, 'device', ''))) / 6
          + (length(t) - length(replace(t, '1', ''))) AS BIGINT) AS rank
FROM texts WHERE contains(t, 'device') AND contains(t, '1') AND year = 2020 AND month = 3
ORDER BY rank DESC, name, deviceId LIMIT 20""",
    "hierarchy_tree": _instances()
    + """
SELECT path, CAST(level AS INTEGER) AS level, count(*) AS n FROM (
  SELECT 'ManufactureDate' AS path, 1 AS level FROM instances
  UNION ALL SELECT 'ManufactureDate/' || year, 2 FROM instances
  UNION ALL SELECT 'ManufactureDate/' || year || '/' || month, 3 FROM instances
  UNION ALL SELECT 'VehicleType', 1 FROM instances
  UNION ALL SELECT 'VehicleType/' || vehicle, 2 FROM instances)
GROUP BY 1, 2""",
    "instance_suggest": _instances()
    + """
SELECT DISTINCT s AS suggestion FROM (
  SELECT deviceId AS s FROM instances UNION ALL SELECT name FROM instances)
WHERE starts_with(lower(s), 'device-00001') ORDER BY 1 LIMIT 10""",
    "model_upsert": _instances()
    + """
SELECT deviceId, name, CASE WHEN month <= 3 THEN 'Truck' ELSE vehicle END AS vehicle, month
FROM instances WHERE month <> 12""",
    "twin_route": _with()
    + """
SELECT eventId, deviceId, createdAt AS LastUpdate,
       CASE WHEN type = 'TEMP' THEN round(value, 6) END AS Temperature,
       CASE WHEN type = 'TEMP' THEN k END AS temperature_k,
       CASE WHEN type = 'CO2' THEN round(value, 6) END AS CO2,
       CASE WHEN type = 'CO2' THEN k END AS co2_k
FROM telemetry""",
    "twin_state": _with()
    + """
, placed AS (SELECT *, row_number() OVER (PARTITION BY deviceId
                         ORDER BY enqueuedAt, event_id) AS p FROM telemetry)
SELECT deviceId, arg_max(createdAt, p) AS LastUpdate,
       arg_max(deviceSequenceNumber, p) AS deviceSequenceNumber,
       round(arg_max(value, p) FILTER (WHERE type = 'TEMP'), 6) AS Temperature,
       arg_max(k, p) FILTER (WHERE type = 'TEMP') AS temperature_k,
       round(arg_max(value, p) FILTER (WHERE type = 'CO2'), 6) AS CO2,
       arg_max(k, p) FILTER (WHERE type = 'CO2') AS co2_k
FROM placed GROUP BY 1""",
    "patch_flatten": _with()
    + """
SELECT deviceId, eventId, round(value, 6) AS temperature, type, deviceId AS subject
FROM telemetry WHERE event_id % 10 <> 0""",
}

NO_SEQUENCE = EVENT_COLUMNS.replace("deviceSequenceNumber, ", "")

ORACLES |= {
    "stream_ingest": _with()
    + """
SELECT eventId, k, value, type, deviceId, createdAt, enqueuedAt FROM telemetry""",
    "stream_minute_rates": ORACLES["minute_rate_latency"],
    "stream_summary": ORACLES["device_type_summary"],
    "stream_merge": _with(DUPLICATES, TABLES)
    + f"""
SELECT {NO_SEQUENCE} FROM target UNION ALL
SELECT {NO_SEQUENCE} FROM (
  SELECT *, row_number() OVER (PARTITION BY PartitionId, eventId ORDER BY enqueuedAt) AS r
  FROM staging) s
WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM target t
  WHERE t.PartitionId = s.PartitionId AND t.eventId = s.eventId)""",
    "stream_pattern_tags": ORACLES["pattern_tags"],
    "stream_lru_dedup": f"""
SELECT CASE k WHEN 'view' THEN 'TEMP' WHEN 'click' THEN 'CO2' ELSE upper(k) END AS k,
       id, event_id
FROM ({ORACLES["lru_dedup"]})""",
}

ORACLES |= {
    "array_round_trip": _with()
    + """
SELECT eventId, k, value, type, deviceId, date_trunc('millisecond', createdAt) AS createdAt,
       date_trunc('millisecond', enqueuedAt) AS enqueuedAt FROM telemetry""",
    "spike_dip_robust": _with()
    + """
, framed AS (
  SELECT *, list({'t': enqueuedAt, 'v': value}) OVER (
     PARTITION BY PartitionId ORDER BY enqueuedAt, event_id
     ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS before FROM telemetry),
recent AS (
  SELECT PartitionId, enqueuedAt, value, list_transform(list_filter(coalesce(before, []),
           lambda p: p.t >= enqueuedAt - INTERVAL 6 HOUR), lambda p: p.v) AS vs FROM framed),
middle AS (SELECT *, list_median(vs) AS m FROM recent),
spread AS (
  SELECT *, list_median(list_transform(vs, lambda v: abs(v - m))) * 1.4826 AS s FROM middle),
result AS (
  SELECT *, CASE WHEN s > 0 THEN (value - m) / s
       WHEN len(vs) > 1 AND value <> m THEN sign(value - m) * 'inf'::DOUBLE ELSE 0 END AS z FROM spread)
SELECT PartitionId, enqueuedAt AS time, round(value, 6) AS val, round(z, 4) AS score,
       CAST(z >= 2.5758293035489 AS BIGINT) AS is_anomaly FROM result""",
    "stream_upsert": _with(DUPLICATES, TABLES)
    + f"""
SELECT {NO_SEQUENCE} FROM (
  SELECT *, row_number() OVER (PARTITION BY eventId ORDER BY enqueuedAt DESC) AS r
  FROM (SELECT * FROM target UNION ALL SELECT * FROM staging)) WHERE r = 1""",
    "stream_history_and_status": _with()
    + """
SELECT deviceId, arg_max(eventId, event_id) AS eventId,
       arg_max(createdAt, event_id) AS createdAt,
       round(arg_max(value, event_id), 6) AS value,
       arg_max(k, event_id) AS MoreData1, count(*) AS n_stored
FROM telemetry GROUP BY 1""",
    "stream_documents": _with(DUPLICATES)
    + """
, last AS (SELECT *, row_number() OVER (PARTITION BY eventId ORDER BY enqueuedAt DESC) AS r FROM duplicates)
SELECT eventId AS id, eventId, type, deviceId, round(value, 6) AS value,
       strftime(createdAt, '%Y-%m-%dT%H:%M:%S.%gZ') AS createdAt,
       strftime(enqueuedAt, '%Y-%m-%dT%H:%M:%S.%gZ') AS enqueuedAt,
       strftime(enqueuedAt, '%Y-%m-%dT%H:%M:%S.%gZ') AS changed_at
FROM last WHERE r = 1""",
    "stream_twins": ORACLES["twin_state"].replace("arg_max(deviceSequenceNumber, p)", "arg_max(event_id, p)"),
    "stream_unique": _with()
    + " SELECT eventId, deviceId, round(value, 6) AS value, 1::BIGINT AS all_failed FROM telemetry",
    "stream_watermark_dedup": _with() + " SELECT eventId, type, deviceId FROM telemetry",
    "stream_summary_export": _with()
    + """
SELECT deviceId, type, count(*) AS n, date_trunc('millisecond', min(createdAt)) AS first_at,
       date_trunc('millisecond', max(createdAt)) AS last_at
FROM telemetry GROUP BY 1, 2""",
}

ORACLES |= {
    "stream_tag_batches": ORACLES["pattern_tags"],
    "stream_dedup_batches": ORACLES["stream_lru_dedup"],
}

MILLI_FIELDS = (
    "eventId, type, deviceId, round(value, 6) AS value, "
    "date_trunc('millisecond', createdAt) AS createdAt"
)

# The micro-batches of the test streams: four equal spans of the time of arrival.
PARTS = """
borders AS (SELECT min(epoch_us(enqueuedAt)) AS low, max(epoch_us(enqueuedAt)) AS high FROM telemetry),
parts AS (
  SELECT telemetry.*, (epoch_us(enqueuedAt) - low) * 4 // (high - low + 1) AS part FROM telemetry, borders)"""

# A timer goes off in the first batch that begins after it by the arrivals before; who has
# sent nothing until the end of that batch is silent. Batch 4 is the empty one at the end.
SILENT_BATCHES = (
    _with(PARTS)
    + """
, marks AS (SELECT part + 1 AS batch, max(max(epoch_ms(enqueuedAt))) OVER (ORDER BY part) AS mark FROM parts GROUP BY part),
fired AS (
  SELECT deviceId, event_id, createdAt, eventId, min(batch) AS batch
  FROM parts JOIN marks ON mark > epoch_ms(createdAt) + 86400000 AND batch >= part GROUP BY ALL),
follow AS (SELECT event_id, lead(part) OVER (PARTITION BY deviceId ORDER BY enqueuedAt, event_id) AS next_part FROM parts)
SELECT deviceId, createdAt AS trigger_at, eventId AS trigger_id, 'NoNewsForAtLeast86400000ms' AS tag
FROM fired JOIN follow USING (event_id) WHERE next_part IS NULL OR next_part > batch"""
)

ORACLES |= {
    "stream_late_drop": _with(LATE)
    + """
SELECT eventId, createdAt, enqueuedAt FROM (
  SELECT *, max(createdAt) OVER (ORDER BY enqueuedAt, event_id) AS newest FROM late)
WHERE createdAt >= newest - INTERVAL 10 SECOND""",
    "stream_late_adjust": _with(LATE)
    + """
SELECT eventId, createdAt, PartitionId,
       max(createdAt) OVER (PARTITION BY PartitionId ORDER BY enqueuedAt, event_id) AS adjusted_at
FROM late""",
    "stream_spike_dip": ORACLES["spike_dip"],
    "stream_silent_devices": f"""
SELECT * FROM ({ORACLES["pattern_tags"]}) UNION ALL SELECT * FROM ({SILENT_BATCHES})""",
    "stream_summary_increments": _with(PARTS)
    + """
SELECT deviceId, type, count(*) AS n, date_trunc('millisecond', min(createdAt)) AS first_at,
       date_trunc('millisecond', max(createdAt)) AS last_at, count(DISTINCT part) AS exports
FROM parts GROUP BY 1, 2""",
    "stream_metrics": _with(PARTS)
    + """
, timed AS (SELECT *, (epoch_us(processedAt) - epoch_us(enqueuedAt)) / 1e3 AS ms FROM parts)
SELECT count(*) AS n, count(*) FILTER (WHERE type = 'ERROR') AS n_bad, min(ms) AS min_ms, max(ms) AS max_ms,
       round(avg(ms), 6) AS avg_ms FROM timed GROUP BY part""",
    "json_folder_stream": _with()
    + f" SELECT {MILLI_FIELDS} FROM telemetry",
    "capture_read": _with()
    + """
SELECT eventId, deviceId, round(value, 6) AS value, date_trunc('second', enqueuedAt) AS enqueuedAt FROM telemetry""",
    "document_read": _with()
    + """
SELECT eventId, deviceId, date_trunc('millisecond', createdAt) AS createdAt,
       date_trunc('millisecond', enqueuedAt) AS enqueuedAt, date_trunc('second', storedAt) AS storedAt
FROM telemetry""",
    "event_time_only": _with()
    + " SELECT eventId, createdAt, createdAt AS enqueuedAt, createdAt AS storedAt FROM telemetry",
    "delimited_read": _with() + " SELECT eventId, type, round(value, 6) AS value FROM telemetry",
    "sink_json_lines": _with()
    + f" SELECT {MILLI_FIELDS} FROM telemetry",
    "sink_payload": "SELECT count(*) AS events, 1::BIGINT AS ids, 1::BIGINT AS times, 1::BIGINT AS several FROM events",
    "sink_retried": _with() + " SELECT eventId, deviceId FROM telemetry",
    "sink_restarted": _with() + " SELECT eventId, deviceId, 1::BIGINT AS restarted FROM telemetry",
    "clock_columns": """
SELECT count(*) AS events, count(*) AS processed_later, count(*) AS stored_later,
       count(*) AS batch_ids, count(*) AS own_ids FROM events""",
    "events_of_type": _with()
    + """
SELECT CAST(CAST(createdAt AS DATE) AS VARCHAR) AS day, round(avg(value) / 60 * 60, 6) AS per_minute
FROM telemetry WHERE type = 'CO2' GROUP BY 1""",
    "ranked_newest": _with()
    + """
SELECT CAST(row_number() OVER (ORDER BY storedAt DESC, event_id DESC) AS INTEGER) AS place, eventId, storedAt
FROM telemetry QUALIFY place <= 50""",
    "json_scalars": _with()
    + """
SELECT eventId, CAST(json_valid(props) AS BIGINT) AS valid, k, date_trunc('hour', createdAt) AS hour FROM telemetry""",
}

ORACLES |= {
    "hot_cold_move": ORACLES["hot_to_cold"],
    "series_aggregate_interpolated": f"""
WITH between AS ({ORACLES["series_interpolate"]}),
bins AS (
  SELECT DISTINCT 'device-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS deviceId,
         time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') AS ts, event_id, event_type, value
  FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-15'),
means AS (
  SELECT deviceId, ts, avg(value) FILTER (WHERE event_type = 'view') AS mean FROM bins GROUP BY 1, 2),
grid AS (
  SELECT deviceId, ts FROM (SELECT DISTINCT deviceId FROM bins),
         generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-14 12:00:00', INTERVAL 12 HOUR) AS g(ts))
SELECT deviceId, ts, round(coalesce(mean, b.value), 6) AS value
FROM grid LEFT JOIN means USING (deviceId, ts) LEFT JOIN between b USING (deviceId, ts)""",
}

ORACLES["stream_late_side"] = ORACLES["stream_late_drop"].replace(
    "createdAt >= newest", "createdAt < newest"
)
