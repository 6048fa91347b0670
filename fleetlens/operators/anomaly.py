"""Late-event policies and spike/dip scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from math import log2
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.operators.ordered import DEFAULT, Limits, cut, numbered, running_max

SPIKES, DIPS, BOTH = "spikes", "dips", "spikesanddips"


def _behind(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    arrival: Sequence[str],
    tolerance_ms: int,
    limits: Limits,
    before: str | None,
) -> tuple[DataFrame, Column]:
    """Rows with the highest time seen so far, and the earliest time still accepted.

    ``before`` names a column with the highest time (microseconds) before all these rows.
    """
    rows = running_max(df, keys, arrival, F.unix_micros(time), "_newest", limits)
    if before is not None:
        rows = rows.withColumn("_newest", F.greatest("_newest", before))
    return rows, F.col("_newest") - F.lit(tolerance_ms * 1000)


def late_drop(
    df: DataFrame,
    time: str = "createdAt",
    arrival: Sequence[str] = ("enqueuedAt", "eventId"),
    tolerance_ms: int = 10_000,
    keys: Sequence[str] = (),
    limits: Limits = DEFAULT,
    before: str | None = None,
    late: bool = False,
) -> DataFrame:
    """Drop events older than the newest event time seen so far minus the tolerance; or,
    with ``late``, keep these only.

    ``keys`` gives each of them a clock of its own, e.g. one per source partition.
    """
    rows, accepted = _behind(df, keys, time, arrival, tolerance_ms, limits, before)
    on_time = F.unix_micros(time) >= accepted
    return rows.where(~on_time if late else on_time).drop("_newest")


def late_adjust(
    df: DataFrame,
    time: str = "createdAt",
    arrival: Sequence[str] = ("enqueuedAt", "eventId"),
    tolerance_ms: int = 0,
    keys: Sequence[str] = (),
    name: str = "adjusted_at",
    limits: Limits = DEFAULT,
    before: str | None = None,
) -> DataFrame:
    """Move late event times up to the earliest accepted one."""
    rows, accepted = _behind(df, keys, time, arrival, tolerance_ms, limits, before)
    moved = F.timestamp_micros(F.greatest(F.unix_micros(time), accepted))
    return rows.withColumn(name, moved).drop("_newest")


def spike_dip(
    df: DataFrame,
    keys: Sequence[str] = ("PartitionId",),
    time: str = "enqueuedAt",
    value: str = "value",
    tie: Sequence[str] = ("eventId",),
    confidence: float = 95.0,
    history: int = 60,
    duration_ms: int = 55,
    mode: str = BOTH,
    robust: bool = False,
    limits: Limits = DEFAULT,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Score each value against at most ``history`` values before it that are no older
    than ``duration_ms``.

    The score is the distance from their mean in standard deviations or, if ``robust``,
    from their median in scaled median deviations. A value is anomalous if a normal
    variable stays closer with the given confidence. Off a history without spread (two or
    more equal values) any other value is infinitely far; with less history the score is 0.
    ``keep`` names further columns of the result.
    """
    how = _against_median if robust else _against_mean
    rows = how(df, list(keys), time, value, tie, history, duration_ms * 1000, limits)
    away = F.col(value) - F.col("_middle")
    flat = (F.col("_spread") == 0) & (F.col("_n") > 1) & (away != 0)
    score = (
        F.when(F.col("_spread") > 0, away / F.col("_spread"))
        .when(flat, F.signum(away) * F.lit(float("inf")))
        .otherwise(0.0)
    )
    limit = NormalDist().inv_cdf(0.5 + confidence / 200)
    high, low = F.col("score") >= limit, F.col("score") <= -limit
    found = {SPIKES: high, DIPS: low, BOTH: high | low}[mode]
    return rows.withColumn("score", score).withColumn("is_anomaly", found.cast("long")).select(
        *[k for k in keys if k in df.columns],
        F.col(time).alias("time"),
        F.col(value).alias("val"),
        "score",
        "is_anomaly",
        *keep,
    )


#: Rows of a run whose medians one task finds.
RUN_ROWS = 50_000


def _against_median(
    df: DataFrame, keys: list[str], time: str, value: str, tie: Sequence[str], history: int, age: int, limits: Limits
) -> DataFrame:
    """Add ``_middle``, ``_spread`` and ``_n`` of the recent values before each row.

    The median of the distances from a median that moves with each row has no running form:
    here, and only here, a row carries its at most ``history`` values. As that costs far more
    than to move a row, keys are cut into many short runs. How many values are recent is
    a difference of two row numbers; missing values count as rows, and as the largest.
    """
    short = replace(limits, max_rows=min(limits.max_rows, RUN_ROWS))
    runs = cut(df, keys, [time, *tie], short).with_neighbours(before=history)
    at = F.unix_micros(time)
    line, ages = runs.whole.orderBy("_t", *tie), runs.whole.orderBy("_t")
    rows = runs.df.withColumn("_t", at).withColumns(
        {
            "_line": F.collect_list(F.struct(F.col(value).alias("v"))).over(line.rowsBetween(-history, -1)),
            "_nth": F.row_number().over(line),
            "_old": F.count(F.lit(1)).over(ages.rangeBetween(Window.unboundedPreceding, -age - 1)),
        }
    )
    n = F.least(F.size("_line"), F.col("_nth") - 1 - F.col("_old"))
    # Without a time nothing is recent.
    rows = rows.withColumn("_n", F.when(F.col("_t").isNull(), 0).otherwise(F.greatest(n, F.lit(0))).cast("int"))
    recent = F.slice(F.col("_line")["v"], F.size("_line") - F.col("_n") + 1, F.col("_n"))
    rows = rows.withColumn("_known", F.sort_array(F.array_compact(recent)))
    rows = rows.withColumn("_middle", _median("_known", "_n"))
    rows = rows.withColumn("_far", F.sort_array(F.transform("_known", lambda v: F.abs(v - F.col("_middle")))))
    rows = rows.withColumn("_spread", _median("_far", "_n") * F.lit(1.4826))
    return runs.result(rows.drop("_line", "_known", "_far"))


#: Rows of a key whose running sums are kept together.
BLOCK = 4096


def _against_mean(
    df: DataFrame, keys: list[str], time: str, value: str, tie: Sequence[str], history: int, age: int, limits: Limits
) -> DataFrame:
    """The same with mean and standard deviation, from running sums and without lists.

    The recent values are all before this row but the first ones: those more than
    ``history`` rows back, or those too old, whichever are more. So their sums are
    differences of two running sums, each of which Spark moves along in constant time. A key
    is cut into blocks of ``BLOCK`` rows, each with the last ``history`` rows of the block
    before, which bounds the largest task.

    A difference of long sums of doubles would lose what is left after a spike has passed.
    So the sums are of whole numbers, as decimals: the distance from the mean of the block in
    steps of about 2^-56 of the largest such distance. Whether the recent values are all
    equal is told by the place of the last change. Missing and infinite values count as rows
    but not as values.
    """
    df, keys = (df, keys) if keys else (df.withColumn("_one", F.lit(0)), ["_one"])
    size = max(BLOCK, 4 * history)
    rows = numbered(df, keys, [time, *tie], "_place", limits)
    number, inside = F.floor((F.col("_place") - 1) / size), (F.col("_place") - 1) % size
    blocks = F.when(inside >= size - history, F.array(number, number + 1)).otherwise(F.array(number))
    rows = rows.withColumns({"_own": number, "_t": F.unix_micros(time), "_block": F.explode(blocks)})
    whole = Window.partitionBy(*keys, "_block")
    # The order by time alone needs no sort of its own after this one.
    line, ages = whole.orderBy("_t", "_place"), whole.orderBy("_t")
    first, here = Window.unboundedPreceding, Window.currentRow
    number_ = F.col(value).cast("double")
    rows = rows.withColumn("_v", F.when(F.abs(number_) < float("inf"), number_))
    rows = rows.withColumn("_base", F.avg("_v").over(whole))
    rows = rows.withColumns(
        {
            "_far": F.max(F.abs(F.col("_v") - F.col("_base"))).over(whole),
            "_last": F.last("_v", ignorenulls=True).over(line.rowsBetween(first, -1)),
            "_at": F.count("_v").over(line.rowsBetween(first, here)),
        }
    )
    # As many bits as sums of squares of a block, and squares of sums of a history, leave.
    bits = int(log2(5e37 / max(size + history, history * history)) // 2)
    step = F.when(F.col("_far") > 0, F.pow(F.lit(2.0), F.ceil(F.log2("_far")) - bits)).otherwise(1.0)
    rows = rows.withColumn("_step", step)
    steps = F.round((F.col("_v") - F.col("_base")) / F.col("_step")).cast("long").cast("decimal(19,0)")
    changed = F.when(F.col("_v") != F.col("_last"), F.col("_at"))
    rows = rows.withColumns({"_k": steps, "_change": changed})
    frames = {
        "before": line.rowsBetween(first, -1),
        "beyond": line.rowsBetween(first, -history - 1),
        "old": ages.rangeBetween(first, -age - 1),
    }
    sums = {
        "rows": F.count(F.lit(1)),
        "n": F.count("_k"),
        "s": F.sum("_k"),
        "q": F.sum(F.col("_k") * F.col("_k")),
    }
    rows = rows.withColumns(
        {f"_{f}_{s}": F.coalesce(total.over(w), F.lit(0)) for f, w in frames.items() for s, total in sums.items()}
        | {"_changed": F.max("_change").over(frames["before"])}
    ).where(F.col("_block") == F.col("_own"))
    aged = F.col("_old_rows") >= F.col("_beyond_rows")
    left_out = {s: F.when(aged, F.col(f"_old_{s}")).otherwise(F.col(f"_beyond_{s}")) for s in sums}
    # Without a time nothing is recent.
    n = F.when(F.col("_t").isNull(), 0).otherwise(F.greatest(F.col("_before_n") - left_out["n"], F.lit(0)))
    flat = F.coalesce(F.col("_changed") <= left_out["n"] + 1, F.lit(True))
    rows = rows.withColumns(
        {
            "_n": n.cast("int"),
            "_flat": flat,
            "_s": (F.col("_before_s") - left_out["s"]).cast("decimal(19,0)"),
            "_q": (F.col("_before_q") - left_out["q"]).cast("decimal(38,0)"),
        }
    )
    some = F.col("_n") > 0
    mean = F.col("_base") + F.try_divide(F.col("_s").cast("double"), F.col("_n")) * F.col("_step")
    square = (F.col("_q") * F.col("_n") - F.col("_s") * F.col("_s")).cast("double")
    spread = F.try_divide(F.sqrt(F.greatest(square, F.lit(0.0))), F.col("_n")) * F.col("_step")
    return rows.withColumns(
        {
            "_middle": F.when(some, F.when(F.col("_flat"), F.col("_last")).otherwise(mean)),
            "_spread": F.when(some, F.when(F.col("_flat"), 0.0).otherwise(spread)),
        }
    )


def _median(ordered: str, n: str) -> Column:
    """Of ``n`` values, the present ones of which are given in order; the others come last."""
    high = F.get(ordered, F.shiftright(n, 1))
    low = F.get(ordered, F.shiftright(F.col(n) - 1, 1))
    return F.when(F.col(n) > 0, (high + low) / 2)
