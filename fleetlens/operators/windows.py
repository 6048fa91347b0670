"""Sequence deltas, latest rows and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.operators.ordered import DEFAULT, Limits, Runs, cut, first_rows

SEQUENCE = "deviceSequenceNumber"


def stored_order_delta(
    df: DataFrame, limits: Limits = DEFAULT, runs: Runs | None = None
) -> DataFrame:
    """Step of the sequence number from the row stored before, per device."""
    runs = runs or cut(df, ["deviceId"], ["storedAt", SEQUENCE], limits)
    runs = runs.with_neighbours(before=1)
    step = F.col(SEQUENCE) - F.lag(SEQUENCE).over(runs.window)
    return runs.result(runs.df.withColumn("delta", step))


def middle_delta(
    df: DataFrame,
    low: float = 0.1,
    high: float = 0.9,
    limits: Limits = DEFAULT,
    copies: str | None = None,
    runs: Runs | None = None,
) -> DataFrame:
    """Step of the sequence number in sequence order, in the middle part of each device.

    All rows come back; ``delta`` is null outside ``low..high`` and for the first row
    inside. The kept ranks are contiguous, so the row before in rank is the row before
    among the kept ones, and one window pass is enough. A row may stand for several with
    the same sequence number, counted in the column ``copies``.
    """
    runs = runs or cut(df, ["deviceId"], [SEQUENCE], limits)
    if copies is None:
        runs = runs.with_columns({"_rank": runs.numbered(), "_of": runs.counted()})
    else:
        total = F.sum(copies)
        runs = runs.with_carry("_before", total, F.sum).with_carry(
            "_all_rows", total, F.sum, whole=True
        )
        to_here = total.over(runs.window.rowsBetween(Window.unboundedPreceding, 0))
        earlier = F.coalesce("_before", F.lit(0)) + to_here - F.col(copies)
        runs = runs.with_columns(
            {
                "_rank": earlier + 1,
                "_of": F.coalesce("_all_rows", total.over(runs.whole)),
            }
        )
    runs = runs.with_neighbours(before=1)
    step = F.col(SEQUENCE) - F.lag(SEQUENCE).over(runs.window)
    share = F.col("_rank").cast("double") / F.col("_of")
    share_before = (F.col("_rank") - 1).cast("double") / F.col("_of")
    inside = (share >= low) & (share <= high) & (share_before >= low)
    out = runs.df.withColumn("_step", step)
    return runs.result(out.withColumn("delta", F.when(inside, F.col("_step")))).drop(
        "_rank", "_of", "_step", "_before", "_all_rows"
    )


def latest_per_device(
    df: DataFrame,
    keys: Sequence[str] = ("deviceId",),
    order: Sequence[str] = (SEQUENCE,),
) -> DataFrame:
    """The row with the highest order of each key; one row per key and task is shuffled."""
    return first_rows(df, keys, [F.col(c).desc() for c in order])


def newest(
    df: DataFrame, n: int = 100, order: Sequence[str] = ("storedAt", "eventId")
) -> DataFrame:
    """The ``n`` newest rows, by per-task heaps rather than a full sort."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def newest_of_device(
    df: DataFrame,
    device: str,
    partition: int | None = None,
    n: int = 100,
    order: Sequence[str] = ("storedAt", "eventId"),
) -> DataFrame:
    keep = F.col("deviceId") == device
    if partition is not None:
        keep = keep & (F.col("PartitionId") == partition)
    return newest(df.where(keep), n, order)


def top_per_partition(
    df: DataFrame,
    partition: str = "PartitionId",
    n: int = 100,
    total: int = 100,
    order: Sequence[str] = ("storedAt", "eventId"),
) -> DataFrame:
    """The newest ``n`` rows of every partition present, then the newest ``total``."""
    by = [F.col(c).desc() for c in order]
    return newest(first_rows(df, [partition], by, n), total, order)


def split_newest(
    df: DataFrame,
    n: int = 10_000,
    order: Sequence[str] = ("processedAt", "eventId"),
    name: str = "tier",
) -> DataFrame:
    """Mark the newest ``n`` rows ``cold`` (to be moved) and the others ``hot``.

    The border is one row, found by a top-k of the order columns alone and used as a
    scalar subquery; the rows themselves are neither sorted nor joined. ``order`` must
    be total.
    """
    point = F.struct(*order)
    border = newest(df.select(*order), n, order).agg(F.min(point).alias("border"))
    moved = F.coalesce(point >= border.scalar(), F.lit(False))
    return df.withColumn(name, F.when(moved, "cold").otherwise("hot"))
