"""Starting, draining and retrying streams."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

Transform = Callable[[DataFrame], DataFrame]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see, below ``spark.checkpoint.dir``.

    A cluster has to name that folder: executors do not share their own disks. A local
    session without one gets a temporary folder, which then holds for the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="fleetlens-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pipeline(
    source: DataFrame, transforms: Iterable[Transform], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    """Source, narrow or stateful steps, and a restartable writer without a sink yet."""
    rows = reduce(lambda df, step: step(df), transforms, source)
    return rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)


def drain(
    writer: DataStreamWriter, timeout_s: float = 300, need_batches: int = 0
) -> StreamingQuery:
    """Process what is there, then stop. ``need_batches`` fails if fewer had rows."""
    return drain_all([writer], timeout_s, need_batches)[0]


def drain_all(
    writers: Iterable[DataStreamWriter], timeout_s: float = 300, need_batches: int = 0
) -> list[StreamingQuery]:
    """The same with several queries at once. If one fails, all are stopped."""
    started: list[StreamingQuery] = []
    until = time.monotonic() + timeout_s
    try:
        for writer in writers:
            started.append(writer.trigger(availableNow=True).start())
        for query in started:
            if not query.awaitTermination(max(until - time.monotonic(), 0.001)):
                raise TimeoutError(f"the stream did not end within {timeout_s} s")
            filled = sum(p["numInputRows"] > 0 for p in query.recentProgress)
            if filled < need_batches:
                raise RuntimeError(f"the stream had {filled} micro-batches with rows")
    finally:
        for query in started:
            if query.isActive:
                query.stop()
    return started


def every(writer: DataStreamWriter, interval: str = "5 minutes") -> StreamingQuery:
    return writer.trigger(processingTime=interval).start()


def retry(
    action: Callable[[], object],
    attempts: int = 6,
    wait: Callable[[float], object] = time.sleep,
) -> object:
    """Run an idempotent write again after a failure, waiting ``2^k - 1`` seconds."""
    for k in range(attempts):
        try:
            return action()
        except Exception:
            if k == attempts - 1:
                raise
            wait(2**k - 1)


def retried(write: Callable[[DataFrame, int], None], **how) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body with :func:`retry` around it."""

    def body(batch: DataFrame, batch_id: int) -> None:
        retry(lambda: write(batch, batch_id), **how)

    return body
