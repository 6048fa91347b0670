"""Duplicate removal, merges and upserts."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.scalars import partition_of
from fleetlens.operators.ordered import DEFAULT, Limits, cut, first_rows, numbered
from fleetlens.streaming.runs import shared_folder


def staging_dedup(
    df: DataFrame,
    keys: Sequence[str] = ("PartitionId", "eventId"),
    order: Sequence[str] = ("enqueuedAt", "storedAt"),
) -> DataFrame:
    """The earliest row of each key. Copies beyond one per task stay off the network."""
    return first_rows(df, keys, [F.col(c) for c in order])


def not_in(
    df: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    candidates: DataFrame | None = None,
) -> DataFrame:
    """Rows whose key the target does not hold.

    The target is read by key only, and reduced to the keys of ``candidates`` (``df``
    itself, or a cheaper table with the same keys) and to one row each before the anti
    join. So neither a large target nor a hot target key goes over the network if the
    candidates are few enough for Spark to broadcast them.
    """
    mine = (df if candidates is None else candidates).select(*keys).distinct()
    held = target.select(*keys).join(mine, list(keys), "left_semi").distinct()
    return df.join(held, list(keys), "left_anti")


def merge_insert(
    staging: DataFrame,
    target: DataFrame,
    keys: Sequence[str] = ("PartitionId", "eventId"),
    order: Sequence[str] = ("enqueuedAt", "storedAt"),
) -> DataFrame:
    """The rows of the staging table that a merge has to insert into the target."""
    fresh = staging_dedup(staging, keys, order)
    return not_in(fresh, target, keys, candidates=staging)


def merge_result(staging: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The target after the merge."""
    return target.unionByName(merge_insert(staging, target, **how))


def upsert_latest(
    existing: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
) -> DataFrame:
    """The newest row of each key among existing rows and changes, by ``order``.

    Of rows equal in it a change replaces an existing row. One row per key and task is
    shuffled.
    """
    both = existing.withColumn("_change", F.lit(0)).unionByName(
        changes.withColumn("_change", F.lit(1))
    )
    return first_rows(both, keys, [*order, F.col("_change").desc()]).drop("_change")


def remove_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Delete the rows whose key occurs in ``members``."""
    return df.join(members.select(key).distinct(), key, "left_anti")


def unique_violations(df: DataFrame, key: str = "eventId") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, key: str = "eventId") -> DataFrame:
    """Reject the whole batch if a key occurs twice. Runs one aggregate."""
    broken = unique_violations(df, key).limit(1).collect()
    if broken:
        raise ValueError(f"duplicate {key}: {broken[0][key]!r}")
    return df


def assign_partition(
    df: DataFrame, key: str, partitions: int, name: str = "PartitionId"
) -> DataFrame:
    return df.withColumn(name, partition_of(key, partitions))


def within_watermark(
    df: DataFrame, keys: Sequence[str], time: str, delay: str
) -> DataFrame:
    """The time-bounded form for streams; state older than ``delay`` is forgotten."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def recently_seen(
    ids: Iterable, size: int, remembered: Iterable = ()
) -> tuple[list[bool], list]:
    """Bounded memory of ids, least recently met forgotten first; a meeting refreshes.

    Returns which ids were new, and the memory afterwards, oldest first.
    """
    memory = OrderedDict.fromkeys(remembered)
    fresh = []
    for one in ids:
        new = one not in memory
        memory[one] = None
        if new:
            if len(memory) > size:
                memory.popitem(last=False)
        else:
            memory.move_to_end(one)
        fresh.append(new)
    return fresh, list(memory)


#: Rows of a key whose neighbourhoods one task looks through together.
CHUNK = 65_536
#: Blocks that one wider block unites.
WIDER = 16


def lru_dedup(
    df: DataFrame,
    keys: Sequence[str],
    id_column: str,
    order: Sequence[str],
    size: int = 100,
    limits: Limits = DEFAULT,
    hold: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Drop an event if its id is among the ``size`` ids last met for its key.

    That is so if fewer than ``size`` different ids lie between the event and the one with
    the same id before it. The places of a key are parted into blocks of twice ``size``. The
    events back to the begin of the block before settle nearly all cases: an id is met there
    for the first time if it was last met before them. What is left asks further back, in
    blocks that get wider (``_far``), until it has found ``size`` ids or its own one. After
    each step at most ``size`` events of a block still ask, and at most ``size`` of its rows
    can be an answer. So rows and questions get fewer with the width of the blocks, and all
    steps together move a fixed number of rows for each row of ``df``.

    All steps are windows over columns that hot keys are cut by, or over blocks. Events are
    numbered once and held as a table (``hold``: by default written below the shared folder),
    so that events equal in the whole order have one place each. Missing keys or ids are
    values like others.
    """
    keys, hold = list(keys), hold or _written
    if not keys:
        df, keys = df.withColumn("_one", F.lit(0)), ["_one"]
    placed = numbered(df, keys, order, "_place", limits)
    by_id = list(dict.fromkeys([*keys, id_column]))
    runs = cut(placed, by_id, ["_place"], limits).with_neighbours(before=1, after=1)
    ends = {"_before": F.lag("_place").over(runs.window), "_after": F.lead("_place").over(runs.window)}
    linked = runs.result(runs.df.withColumns(ends))
    block = 2 * max(size, 1)
    table = hold(_nearby(linked, keys, size, block, limits))
    columns = [c for c in df.columns if c != "_one"]
    kept = table.where(F.col("_before").isNull() | (F.col("_met") >= size)).select(*columns)
    open_ = table.where((F.col("_met") < size) & (F.col("_before") < F.col("_start")))
    if open_.isEmpty():
        return kept
    far = _far(table, open_, keys, size, block, hold)
    return kept.unionByName(_joined(open_, far, [*keys, "_place"], "left_semi").select(*columns))


def _written(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession, "placed")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _joined(df: DataFrame, other: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on null-safe equality; the columns of ``by`` come from ``df``."""
    names = {c: f"_other_{i}" for i, c in enumerate(by)}
    other = other.withColumnsRenamed(names)
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return df.join(other, reduce(lambda a, b: a & b, same), how).drop(*names.values())


def _nearby(df: DataFrame, keys: list[str], size: int, block: int, limits: Limits) -> DataFrame:
    """Add ``_start``, where the block before the own one begins, and ``_met``: how many ids
    lie after ``_start`` and ``_before``. Null if no more than ``size`` rows could."""
    chunk = max(4 * block, min(CHUNK, limits.max_rows))
    number = F.expr(f"(_place - 1) div {chunk}")
    at_end = F.expr(f"(_place - 1) % {chunk} >= {chunk - 2 * block}")
    chunks = F.when(at_end, F.array(number, number + 1)).otherwise(F.array(number))
    rows = df.withColumns({"_own": number, "_chunk": F.explode(chunks)})
    line = Window.partitionBy(*keys, "_chunk").orderBy("_place").rowsBetween(-2 * block, -1)
    befores = F.collect_list(F.coalesce("_before", F.lit(0))).over(line)
    rows = rows.withColumn("_befores", befores).where("_chunk = _own")
    start = F.expr(f"greatest(1, ((_place - 1) div {block} - 1) * {block} + 1)")
    rows = rows.withColumns({"_start": start.cast("long"), "_gap": F.col("_place") - F.col("_before") - 1})
    rows = rows.withColumn("_near", F.least("_gap", F.col("_place") - F.col("_start")).cast("int"))
    near = F.slice("_befores", F.size("_befores") - F.col("_near") + 1, F.col("_near"))
    met = F.size(F.filter(near, lambda before: before < F.col("_place") - F.col("_near")))
    rows = rows.withColumn("_met", F.when(F.col("_gap") >= size, met))
    return rows.drop("_own", "_chunk", "_befores", "_gap", "_near")


def _far(
    table: DataFrame,
    questions: DataFrame,
    keys: list[str],
    size: int,
    block: int,
    hold: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``keys, _place`` of the questions with ``size`` or more ids after ``_before``.

    ``_met`` of them are known to lie from ``_start`` on, where a block begins. For all that
    comes after a block, its ids are the rows that no row of the block follows with the same
    id; and of those only the last ``size`` matter, as the others lie behind ``size`` ids.
    """
    rows = table.select(*keys, "_place", "_after")
    asked = questions.select(*keys, "_place", "_before", "_start", "_met")
    answers = []
    while not asked.isEmpty():
        number, next_ = F.expr(f"(_place - 1) div {block}"), F.expr(f"(_after - 1) div {block}")
        lasts = rows.withColumn("_block", number).where(F.coalesce(next_ > number, F.lit(True)))
        rows = hold(first_rows(lasts, [*keys, "_block"], [F.col("_place").desc()], size).drop("_block"))
        block *= WIDER
        wider = rows.withColumn("_block", F.expr(f"(_place - 1) div {block}"))
        wider = wider.groupBy(*keys, "_block").agg(F.collect_list(F.struct("_place", "_after")).alias("_lasts"))
        found = _joined(asked.withColumn("_block", F.expr(f"(_start - 2) div {block}")), wider, [*keys, "_block"])

        def met(row):
            still = row["_after"].isNull() | (row["_after"] > F.col("_place"))
            return (row["_place"] > F.col("_before")) & (row["_place"] < F.col("_start")) & still

        found = found.withColumn("_met", F.col("_met") + F.size(F.filter("_lasts", met)))
        found = hold(found.withColumn("_start", F.col("_block") * block + 1).drop("_lasts", "_block"))
        answers.append(found.where(F.col("_met") >= size).select(*keys, "_place"))
        asked = found.where((F.col("_met") < size) & (F.col("_before") < F.col("_start")))
    return reduce(DataFrame.unionByName, answers)
