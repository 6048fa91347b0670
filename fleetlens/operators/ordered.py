"""Ordered per-key work that survives a hot key.

A window partitioned by device puts all rows of a device into one task. When one
device holds a third of the input that task never ends. ``cut`` looks for such keys
with one partially aggregated count, and cuts each of them along its own order into
*runs* of about ``max_rows`` rows. The cut points come from a hash sample of the order
columns, so a repeated task attempt always finds the same runs; they are searched in one
array that all tasks share, so no row carries them. Keys are judged by their rows, never
by the planned size of the input. Windows are then partitioned by ``(keys, run)``; what
crosses the border of two runs is handed over by

* ``numbered`` / ``counted``: run offsets known from the cut table,
* ``with_neighbours``: the few rows before or after a run,
* ``with_carry``: a prefix aggregate over earlier runs.

Without hot keys all of this is the plain window with no further shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN, START, TOTAL, HOT = "_run", "_start", "_total", "_hot"
NEIGHBOUR, ALL = "_neighbour", "_all"
COLD = -1
SAMPLES_PER_RUN = 32


@dataclass(frozen=True)
class Limits:
    """When a key counts as hot, and how finely it is cut."""

    max_rows: int = 1_000_000  # rows of one key that one task may hold
    min_rows: int = 1_000  # no run of a cut key is smaller; bounds ``with_neighbours``
    max_cuts: int = 200_000  # cut points in all, some ten bytes each, sent to all tasks


DEFAULT = Limits()


@dataclass(frozen=True)
class Runs:
    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    is_cut: bool
    limits: Limits
    has_copies: bool = False  # some run stayed large: its rows are equal in ``order``

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, RUN).orderBy(*self.order)

    @property
    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, RUN)

    @property
    def hot_rows(self) -> DataFrame:
        """Rows of cut keys. A filter on the run itself would pull the search into it."""
        return self.df.where(F.col(HOT).isNotNull())

    def numbered(self) -> Column:
        """1-based position of a row in its key. Not after ``with_neighbours``."""
        return F.col(START) + F.row_number().over(self.window)

    def counted(self) -> Column:
        """Number of rows of the key. Not after ``with_neighbours``."""
        return F.coalesce(F.col(TOTAL), F.count(F.lit(1)).over(self.whole))

    def with_columns(self, columns: dict[str, Column]) -> Runs:
        return replace(self, df=self.df.withColumns(columns))

    def with_neighbours(self, before: int = 0, after: int = 0) -> Runs:
        """Copy the last ``before`` rows of a run into the next run, and the first
        ``after`` rows into the previous one, marked in ``_neighbour``."""
        if max(before, after) > self.limits.min_rows:  # asked of every input alike
            raise ValueError(
                f"{max(before, after)} neighbours asked for, but a run may have only "
                f"{self.limits.min_rows} rows; raise Limits.min_rows"
            )
        out = self.df.withColumn(NEIGHBOUR, F.lit(False))
        if not self.is_cut:
            return replace(self, df=out)
        hot = self.hot_rows
        backwards = self.whole.orderBy(*[F.col(c).desc() for c in self.order])
        for size, window, step in ((before, backwards, 1), (after, self.window, -1)):
            if size:
                edge = hot.withColumn("_edge", F.row_number().over(window))
                out = out.unionByName(
                    edge.where(F.col("_edge") <= size)
                    .drop("_edge")
                    .withColumn(RUN, F.col(RUN) + step)
                    .withColumn(NEIGHBOUR, F.lit(True))
                )
        return replace(self, df=out)

    def with_carry(
        self,
        name: str,
        per_run: Column,
        fold: Callable[[Column], Column],
        whole: bool = False,
    ) -> Runs:
        """Add ``fold`` of the ``per_run`` aggregate over all earlier runs of the key,
        or over all its runs if ``whole``. Null in the first run, and for keys that are
        not cut. One row per run, so at most ``max_cuts`` of them."""
        if not self.is_cut:
            kind = self.df.groupBy().agg(per_run.alias(name)).schema[name].dataType
            return replace(self, df=self.df.withColumn(name, F.lit(None).cast(kind)))
        earlier = (
            Window.partitionBy(*self.keys)
            .orderBy(RUN)
            .rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing if whole else -1
            )
        )
        runs = (
            self.hot_rows.groupBy(*self.keys, RUN)
            .agg(per_run.alias(name))
            .withColumn(name, fold(F.col(name)).over(earlier))
        )
        return replace(self, df=_join_small(self.df, runs, [*self.keys, RUN]))

    def result(self, df: DataFrame | None = None) -> DataFrame:
        """Drop the helper columns (and copied neighbours, if any)."""
        df = self.df if df is None else df
        if NEIGHBOUR in df.columns:
            df = df.where(~F.col(NEIGHBOUR))
        return df.drop(RUN, START, TOTAL, HOT, NEIGHBOUR, ALL)


def cut(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    limits: Limits = DEFAULT,
) -> Runs:
    """Cut the hot keys of ``df`` into runs along the ascending ``order``.

    ``order`` should be total: rows equal in all of it stay in the same run, and
    ``has_copies`` tells if such a run is large. In a log ``(enqueuedAt, partition,
    offset)`` is total. With no ``keys`` the whole input is
    one ordered sequence.
    """
    keys, order = tuple(keys), tuple(order)
    if not keys:
        df, keys = df.withColumn(ALL, F.lit(0)), (ALL,)
    found = _cut_table(df, keys, order, limits)
    if found is None:
        df = df.withColumns(
            {
                RUN: F.lit(COLD),
                START: F.lit(0).cast("long"),
                TOTAL: F.lit(None).cast("long"),
            }
        )
        return Runs(df, keys, order, False, limits)
    table, has_copies = found
    return Runs(_assign(df, table), keys, order, True, limits, has_copies)


@dataclass(frozen=True)
class CutTable:
    """The hot keys with their number, and one row with the arrays of all of them."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    numbers: DataFrame  # keys, _hot
    arrays: DataFrame  # cuts, starts, totals: each indexed by _hot
    longest: int


def _cut_table(
    df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], limits: Limits
) -> tuple[CutTable, bool] | None:
    """Cut points, first positions of the runs and row count of each hot key. Also
    whether some run is far too large, which only rows equal in ``order`` can cause."""
    spark = df.sparkSession
    rows_seen = Observation()
    counts = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .observe(rows_seen, F.sum("_n").alias("rows"))
        .where(F.col("_n") > limits.max_rows)
        .collect()  # at most rows / max_rows entries
    )
    if not counts:
        return None
    max_rows = max(limits.max_rows, rows_seen.get["rows"] // limits.max_cuts)
    hot = []
    for row in counts:
        if row["_n"] > max_rows:
            runs = ceil(row["_n"] / max_rows)
            every = max(1, row["_n"] // (runs * SAMPLES_PER_RUN))
            hot.append((*[row[k] for k in keys], every))
    if not hot:
        return None

    key_fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    hot_keys = spark.createDataFrame(
        hot, T.StructType([*key_fields, T.StructField("_every", T.LongType())])
    )
    narrow = df.select(*keys, *[c for c in order if c not in keys])
    sampled = _join_small(narrow, hot_keys, keys, "inner").where(
        F.pmod(F.xxhash64(*order), F.col("_every")) == 0
    )
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    cuts = (
        sampled.withColumn("_nth", nth)
        .where(F.col("_nth") % SAMPLES_PER_RUN == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set(_point(df, order))).alias("_cuts"))
    )
    points = cuts.schema["_cuts"].dataType
    found = {tuple(r[k] for k in keys): r["_cuts"] for r in cuts.collect()}  # ~ max_cuts

    def table(rows: list[tuple[tuple, list, list, int]]) -> CutTable:
        numbers = [(*key, i) for i, (key, _, _, _) in enumerate(rows)]
        arrays = [tuple(list(column) for column in zip(*[r[1:] for r in rows], strict=True))]
        return CutTable(
            keys,
            order,
            spark.createDataFrame(
                numbers, T.StructType([*key_fields, T.StructField(HOT, T.IntegerType())])
            ),
            spark.createDataFrame(
                arrays,
                T.StructType(
                    [
                        T.StructField("cuts", T.ArrayType(points)),
                        T.StructField("starts", T.ArrayType(T.ArrayType(T.LongType()))),
                        T.StructField("totals", T.ArrayType(T.LongType())),
                    ]
                ),
            ),
            max(len(r[1]) for r in rows),
        )

    all_keys = [tuple(row[:-1]) for row in hot]
    draft = table([(key, found.get(key, []), [], 0) for key in all_keys])
    sizes: dict[tuple, dict[int, int]] = {}
    counted = _assign(narrow, draft).where(F.col(HOT).isNotNull()).groupBy(*keys, RUN).count()
    for row in counted.collect():
        sizes.setdefault(tuple(row[k] for k in keys), {})[row[RUN]] = row["count"]

    final, largest = [], 0
    for key in all_keys:
        kept, lengths = _merge_short(found.get(key, []), sizes[key], limits.min_rows)
        starts = [0, *accumulate(lengths)]
        final.append((key, kept, starts[:-1], starts[-1]))
        largest = max(largest, *lengths)
    return table(final), largest > 4 * (max_rows + limits.min_rows)


def _merge_short(
    points: list, sizes: dict[int, int], min_rows: int
) -> tuple[list, list[int]]:
    """Leave out cut points until every run has ``min_rows`` rows."""
    kept, lengths = [], [sizes.get(0, 0)]
    for i, point in enumerate(points, start=1):
        size = sizes.get(i, 0)
        if lengths[-1] >= min_rows:
            kept.append(point)
            lengths.append(size)
        else:
            lengths[-1] += size
    if kept and lengths[-1] < min_rows:
        kept.pop()
        tail = lengths.pop()
        lengths[-1] += tail
    return kept, lengths


def _point(df: DataFrame, order: Sequence[str]) -> Column:
    """The order columns as one comparable value that passes the driver unchanged."""
    return F.struct(
        *[
            (
                F.unix_micros(c)
                if isinstance(df.schema[c].dataType, T.TimestampType)
                else F.col(c)
            ).alias(f"o{i}")
            for i, c in enumerate(order)
        ]
    )


def _assign(df: DataFrame, table: CutTable) -> DataFrame:
    """Find the run of each row by binary search in the cut points of its key.

    The arrays are a scalar subquery, one value for all tasks. Each halving is a column
    of its own, so that the search stays in generated code.
    """
    if table.keys == (ALL,):
        df = df.withColumn(HOT, F.lit(0))
    else:
        df = _join_small(df, table.numbers, table.keys)
    arrays = table.arrays.select(F.struct("*").alias("arrays")).scalar()
    cuts, here = F.get(arrays["cuts"], F.col(HOT)), _point(df, table.order)
    passed = F.lit(0)
    for bit in reversed(range(table.longest.bit_length())):
        name = f"_passed_{bit}"
        next_point = F.get(cuts, passed + F.lit((1 << bit) - 1))
        step = F.when(next_point <= here, 1 << bit).otherwise(0)
        df = df.withColumn(name, passed + step)
        passed = F.col(name)
    start = F.get(F.get(arrays["starts"], F.col(HOT)), passed)
    helpers = [c for c in df.columns if c.startswith("_passed_")]
    return df.withColumns(
        {
            RUN: F.when(F.col(HOT).isNull(), COLD).otherwise(passed),
            START: F.coalesce(start, F.lit(0)),
            TOTAL: F.get(arrays["totals"], F.col(HOT)),
        }
    ).drop(*helpers)


def _join_small(
    df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Broadcast join on null-safe equality; ``small`` is bounded by ``max_cuts``."""
    other = {k: f"_small_{i}" for i, k in enumerate(keys)}
    small = small.withColumnsRenamed(other)
    condition = F.lit(True)
    for k, name in other.items():
        condition = condition & df[k].eqNullSafe(small[name])
    return df.join(F.broadcast(small), condition, how).drop(*other.values())


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, Column],
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Add values of the row before, e.g. ``{"prev": F.col("x")}``."""
    runs = cut(df, keys, order, limits).with_neighbours(before=1)
    return runs.result(
        runs.df.withColumns({n: F.lag(c).over(runs.window) for n, c in columns.items()})
    )


def following(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, Column],
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Add values of the row after."""
    runs = cut(df, keys, order, limits).with_neighbours(after=1)
    return runs.result(
        runs.df.withColumns({n: F.lead(c).over(runs.window) for n, c in columns.items()})
    )


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Add the 1-based position of each row in its key."""
    runs = cut(df, keys, order, limits)
    return runs.result(runs.df.withColumn(name, runs.numbered()))


def running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Add the maximum of ``value`` over the rows up to and including this one."""
    runs = cut(df, keys, order, limits).with_carry("_carry", F.max(value), F.max)
    so_far = F.max(value).over(runs.window.rowsBetween(Window.unboundedPreceding, 0))
    return runs.result(
        runs.df.withColumn(name, F.greatest(F.col("_carry"), so_far)).drop("_carry")
    )


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark keeps only ``n`` rows per key and task *before* the shuffle for this form, so
    a hot key costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", rank).where(F.col("_nth") <= n).drop("_nth")
