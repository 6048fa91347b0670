"""Figures of each micro-batch, taken on the way by ``observe`` and told by a query listener.

The aggregate runs inside the tasks that process the rows: no pass of its own, no shuffle.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQueryListener

from fleetlens.operators.aggregate import latency_columns, processing_columns

PROCESSING, LATENCY = "processing", "latency"


def observe_processing(
    df: DataFrame, failed: Column, start: str = "enqueuedAt", end: str = "processedAt", name: str = PROCESSING
) -> DataFrame:
    """``df``, with the figures of ``aggregate.processing_stats`` for each micro-batch."""
    return df.observe(name, *processing_columns(failed, start, end))


def observe_latency(df: DataFrame, start: str, end: str, name: str = LATENCY) -> DataFrame:
    """``df``, with the figures of ``aggregate.latency_metric`` for each micro-batch."""
    return df.observe(name, *latency_columns(start, end))


class BatchMetrics(StreamingQueryListener):
    """Hands ``(batch number, figures)`` of one observation to ``tell``, once per micro-batch.

    Add it with ``spark.streams.addListener``. Without ``tell`` the figures are kept in
    ``found``: for streams that end, like those of ``runs.drain``.
    """

    def __init__(self, name: str, tell: Callable[[int, dict], None] | None = None, run_id: str | None = None):
        self.name, self.tell, self.run_id = name, tell, run_id
        self.found: list[tuple[int, dict]] = []
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        if row is None or (self.run_id and str(progress.runId) != self.run_id):
            return
        if self.tell is not None:
            self.tell(progress.batchId, row.asDict())
        else:
            self.found.append((progress.batchId, row.asDict()))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def ended(self, timeout_s: float = 60) -> list[tuple[int, dict]]:
        """What was told until a query of the session ended: listeners run a little behind."""
        if not self._ended.wait(timeout_s):
            raise TimeoutError("no query ended")
        return self.found
