"""Keyed stream operators as micro-batches of the batch operators.

State functions (``streaming.stateful``) put all rows of a key into one task. These forms
keep the little that a key remembers in a table, lay it before the rows of the
micro-batch, and run the batch operator, which cuts hot keys.

The memory is one table with all keys, written anew by each micro-batch: batch ``n`` reads
what batch ``n - 1`` left in one of two folders and overwrites the other. So a replay starts
from the same memory and gives the same result, nothing is listed, and nothing piles up.
What that costs follows the number of keys, not the age of the stream; for very many keys
and small micro-batches take the state functions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators.anomaly import late_adjust, late_drop, spike_dip
from fleetlens.operators.dedup import lru_dedup
from fleetlens.operators.ordered import DEFAULT, Limits, first_rows
from fleetlens.operators.patterns import Rules, pattern_tags
from fleetlens.streaming.sinks import Write, append_once, merge_append

ARRIVED = "arrived_batch"


_AS_OF = "as_of_batch"


class Memory:
    """The table of what keys remember, as each micro-batch leaves it."""

    def __init__(self, path: str, keys: Sequence[str], files: int, newest: Callable[[DataFrame, DataFrame], DataFrame]):
        self.path, self.keys, self.files, self.newest = path, list(keys), files, newest

    def before(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """The memory that batch ``batch_id`` starts from, in the columns of ``rows``."""
        spark = rows.sparkSession
        if batch_id == 0:
            return spark.createDataFrame([], rows.schema)
        kind = T.StructType([*rows.schema.fields, T.StructField(_AS_OF, T.LongType())])
        table = spark.read.schema(kind).parquet(self._folder(batch_id - 1))
        return table.where(F.col(_AS_OF) == batch_id - 1).drop(_AS_OF)

    def of(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """That of the keys of ``rows``."""
        return self.before(rows, batch_id).join(rows.select(*self.keys).distinct(), self.keys, "left_semi")

    def keep(self, rows: DataFrame, batch_id: int) -> None:
        """Leave to the next batch what ``newest`` makes of the memory and ``rows``."""
        table = self.newest(self.before(rows, batch_id), rows).select(*rows.columns)
        table = table.withColumn(_AS_OF, F.lit(batch_id).cast("long"))
        table.repartition(self.files, *self.keys).write.mode("overwrite").parquet(self._folder(batch_id))

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/turn={batch_id % 2}"


def tag_batches(
    tags: str,
    memory: str,
    rules: Rules = Rules(),
    arrived: str = "enqueuedAt",
    tie: str = "eventId",
    buckets: int = 64,
    limits: Limits = DEFAULT,
) -> Write:
    """Pattern tags of each micro-batch into the folder ``tags``.

    ``memory`` holds the last ring of each device, in ``buckets`` files. A tag equal to an earlier one is not
    repeated, whenever that was.
    """
    order = (ARRIVED, arrived, tie)
    columns = list(dict.fromkeys(["deviceId", "eventId", "type", "value", "createdAt", arrived, tie]))
    append = merge_append(tags, ("deviceId", "trigger_id", "tag"), ("trigger_at",), buckets)

    def newest(stored: DataFrame, rows: DataFrame) -> DataFrame:
        by = [F.col(c).desc() for c in order]
        return first_rows(stored.unionByName(rows), ["deviceId"], by, rules.ring - 1)

    remember = Memory(memory, ("deviceId",), buckets, newest)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns, F.lit(batch_id).cast("long").alias(ARRIVED)).persist()
        try:
            known = remember.of(rows, batch_id)
            new = F.col(ARRIVED) == batch_id
            append(pattern_tags(known.unionByName(rows), order, rules, limits, new), batch_id)
            remember.keep(rows, batch_id)
        finally:
            rows.unpersist()

    return write


def dedup_batches(
    out: str,
    memory: str,
    keys: Sequence[str] = ("deviceId",),
    id_column: str = "eventId",
    order: Sequence[str] = ("enqueuedAt",),
    size: int = 100,
    buckets: int = 64,
    limits: Limits = DEFAULT,
) -> Write:
    """Events whose id is not among the last ``size`` ids of their key into ``out``."""
    keys, order = list(keys), [ARRIVED, *order]
    append = append_once(out)

    def newest(stored: DataFrame, rows: DataFrame) -> DataFrame:
        met = stored.unionByName(rows).groupBy(*rows.drop(*order).columns)
        last = met.agg(F.max(F.struct(*order)).alias("_met")).select("*", "_met.*")
        return first_rows(last, keys, [F.col("_met").desc()], size).select(*rows.columns)

    remember = Memory(memory, keys, buckets, newest)
    held: list[DataFrame] = []

    def hold(table: DataFrame) -> DataFrame:
        """For the time of a micro-batch: a table written by each one would pile up."""
        held.append(table.persist())
        return held[-1]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(ARRIVED, F.lit(batch_id).cast("long")).persist()
        try:
            ids = rows.select(*dict.fromkeys([*keys, id_column, *order]))
            known = remember.of(ids, batch_id)
            both = rows.unionByName(known, allowMissingColumns=True)
            kept = lru_dedup(both, keys, id_column, order, size, limits, hold)
            append(kept.where(F.col(ARRIVED) == batch_id).drop(ARRIVED), batch_id)
            remember.keep(ids, batch_id)
        finally:
            for table in (rows, *held):
                table.unpersist()
            held.clear()

    return write


def late_batches(
    out: str,
    memory: str,
    time: str = "createdAt",
    arrival: Sequence[str] = ("enqueuedAt", "eventId"),
    tolerance_ms: int = 10_000,
    keys: Sequence[str] = (),
    adjusted: str | None = None,
    buckets: int = 64,
    limits: Limits = DEFAULT,
    side: str | None = None,
) -> Write:
    """Late events of a stream dropped or, if ``adjusted`` names a column, moved up.

    Dropped events go to the folder ``side`` if one is given. ``memory`` holds the newest event time of each key (of all, without keys) so far.
    """
    by = list(keys) or ["_stream"]
    append = append_once(out)

    def newest(stored: DataFrame, rows: DataFrame) -> DataFrame:
        return stored.unionByName(rows).groupBy(*by).agg(F.max("_before").alias("_before"))

    remember = Memory(memory, by, buckets, newest)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if keys else batch.withColumn("_stream", F.lit(0))
        rows = rows.persist()
        try:
            clock = rows.groupBy(*by).agg(F.max(F.unix_micros(time)).alias("_before"))
            known = remember.before(clock, batch_id)
            joined = rows.join(known, by, "left")
            how = (time, arrival, tolerance_ms, keys)
            if adjusted is None:
                kept = late_drop(joined, *how, limits, "_before")
                if side is not None:
                    late = late_drop(joined, *how, limits, "_before", late=True)
                    append_once(side)(late.select(*batch.columns), batch_id)
            else:
                kept = late_adjust(joined, *how, adjusted, limits, "_before")
            append(kept.select(*batch.columns, *([adjusted] if adjusted else [])), batch_id)
            remember.keep(clock, batch_id)
        finally:
            rows.unpersist()

    return write


def spike_batches(
    out: str,
    memory: str,
    keys: Sequence[str] = ("PartitionId",),
    time: str = "enqueuedAt",
    value: str = "value",
    tie: Sequence[str] = ("eventId",),
    history: int = 60,
    buckets: int = 64,
    **how,
) -> Write:
    """Spike and dip scores of a stream; ``memory`` holds the last values of each key."""
    columns = list(dict.fromkeys([*keys, time, value, *tie]))
    append = append_once(out)

    def newest(stored: DataFrame, rows: DataFrame) -> DataFrame:
        by = [F.col(c).desc() for c in (time, *tie)]
        return first_rows(stored.unionByName(rows), keys, by, history)

    remember = Memory(memory, keys, buckets, newest)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns).persist()
        try:
            known = remember.of(rows, batch_id).withColumn("_new", F.lit(False))
            both = rows.withColumn("_new", F.lit(True)).unionByName(known)
            scored = spike_dip(both, keys, time, value, tie, history=history, keep=["_new"], **how)
            append(scored.where("_new").drop("_new"), batch_id)
            remember.keep(rows, batch_id)
        finally:
            rows.unpersist()

    return write
