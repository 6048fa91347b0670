"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local threads. Every
query runs over its whole input twice, and the better time counts. Ingest rates are
events per second of a file stream, for several sizes of its micro-batches.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from fleetlens import fixtures, schema  # noqa: E402
from fleetlens.operators import anomaly, decode, patterns  # noqa: E402
from fleetlens.operators.ordered import Limits  # noqa: E402
from fleetlens.plans.queries import BAND, QUERIES, envelope  # noqa: E402
from fleetlens.session import local_session  # noqa: E402
from fleetlens.sources.files import folder_stream  # noqa: E402
from fleetlens.streaming import batches, newest, runs, sinks, stateful  # noqa: E402

HEADLINE = (
    "minute_rate_latency",
    "quality_report",
    "out_of_sequence",
    "missing_events",
    "device_type_summary",
    "log_throughput",
    "counter_rate",
    "decode_messages",
    "explode_batches",
    "staging_dedup",
    "merge_result",
    "upsert_latest",
    "lru_dedup",
    "latest_per_device",
    "device_status",
    "top_per_partition",
    "hot_to_cold",
    "late_drop",
    "pattern_tags",
    "silent_devices",
    "spike_dip",
    "series_aggregate",
    "series_categories",
    "series_interpolate",
    "hierarchy_tree",
    "twin_state",
    "patch_flatten",
)
FILES = 16
BATCHES = (1, 4, 16)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", "16g")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run(HEADLINE[0])
    queries = {n: round(min(timed(lambda n=n: run(n)) for _ in range(2)), 3) for n in HEADLINE}

    # One log of JSON bodies in several files, then drained with growing micro-batches.
    log = runs.shared_folder(spark, "bench-log")
    bodies = envelope(fixtures.telemetry(spark, sf_dir, False)).drop("_event_id")
    bodies.repartition(FILES).write.parquet(log)
    events = fixtures.events(spark, sf_dir).count()
    source_schema = spark.read.parquet(log).schema
    ingest = {}
    for size in BATCHES:
        out = runs.shared_folder(spark, "bench-ingest")
        stream = folder_stream(spark, log, source_schema, "parquet", max_files=size)
        writer = runs.pipeline(
            stream, [decode.decode_events], runs.shared_folder(spark, "bench-check")
        ).foreachBatch(sinks.append_once(out))
        ingest[f"files_per_batch_{size}"] = round(events / timed(lambda: runs.drain(writer)))

    states = {}
    keyed = {
        "tags": lambda s: stateful.tag_stream(s, BAND, silence_ms=None),
        "memory": lambda s: stateful.lru_stream(s, ["deviceId"], "eventId", ["enqueuedAt"], 100),
    }
    for name, step in keyed.items():
        stream = folder_stream(spark, log, source_schema, "parquet", max_files=4)
        out = runs.shared_folder(spark, "bench-state")
        writer = runs.pipeline(
            stream,
            [lambda df: decode.decode_events(df, schema=schema.EVENT), lambda df: df.drop("complexData"), step],
            runs.shared_folder(spark, "bench-check"),
        ).foreachBatch(sinks.append_once(out))
        found = []
        seconds = timed(lambda: found.append(runs.drain(writer)))
        progress = [p for p in found[0].recentProgress if p["numInputRows"]]
        operator = progress[-1]["stateOperators"][0]
        states[name] = {
            "events_per_second": round(events / seconds),
            "batch_ms": round(
                sum(p["durationMs"]["triggerExecution"] for p in progress) / len(progress)
            ),
            "state_bytes": operator["memoryUsedBytes"],
            "state_rows": operator["numRowsTotal"],
        }

    # Merges and keyed micro-batches, with a third of the events on one device.
    skewed = fixtures.events(spark, sf_dir).withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("user_id"))
    )
    source = runs.shared_folder(spark, "bench-skew")
    fixtures.view(skewed, False).drop("complexData").repartition(FILES).write.parquet(source)
    kind = spark.read.parquet(source).schema
    path = lambda: runs.shared_folder(spark, "bench-out")
    writes = {
        "merge_append": sinks.merge_append(path(), buckets=16),
        "tag_batches": batches.tag_batches(path(), path(), BAND, tie="_event_id", buckets=16),
        "late_batches": batches.late_batches(path(), path(), arrival=("enqueuedAt", "_event_id"), buckets=1),
    }
    micro = {}
    for name, write in writes.items():
        writer = runs.pipeline(folder_stream(spark, source, kind, "parquet", max_files=4), [], path())
        micro[name] = round(events / timed(lambda w=writer, f=write: runs.drain(w.foreachBatch(f))))
    kept = newest.keep_newest(folder_stream(spark, source, kind, "parquet", max_files=4), path(), ("eventId",))
    micro["keep_newest"] = round(events / timed(lambda: runs.drain(kept)))
    few = Limits(max_rows=max(events // 20, 1000), min_rows=100)
    skew = {}
    for name, make in {
        "late_drop": lambda: anomaly.late_drop(spark.read.parquet(source), arrival=("enqueuedAt", "_event_id"), limits=few),
        "pattern_tags": lambda: patterns.pattern_tags(spark.read.parquet(source), ("enqueuedAt", "_event_id"), BAND, few),
    }.items():
        skew[name] = round(timed(lambda m=make: m().write.format("noop").mode("overwrite").save()), 3)

    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "events": events,
                "ingest_events_per_second": ingest,
                "stateful_streams": states,
                "skewed_micro_batches_events_per_second": micro,
                "skewed_cut_seconds": skew,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
