"""Stream quality: throughput, latency, duplicates, order, gaps."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.scalars import is_json
from fleetlens.operators.aggregate import minute_rates, rate_summary
from fleetlens.operators.ordered import DEFAULT, Limits, Runs, cut
from fleetlens.operators.windows import SEQUENCE, middle_delta, stored_order_delta

COPIES = "_copies"


@dataclass(frozen=True)
class Thresholds:
    """Limits of the checks. A check whose limit is ``None`` is left out."""

    events_per_second: float | None = 900.0
    latency_ms: float | None = 15_000.0
    duplicate_fraction: float | None = 0.0
    out_of_sequence_fraction: float | None = 0.0
    missing_fraction: float | None = 0.0


def _fraction(df: DataFrame) -> DataFrame:
    return df.select(
        "n_bad",
        F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
        F.try_divide(F.col("n_bad").cast("double"), F.col("n_rows").cast("double")).alias(
            "fraction"
        ),
    )


def duplicate_fraction(df: DataFrame) -> DataFrame:
    """Event ids met more than once (each counted once) over all rows."""
    ids = df.groupBy("eventId").agg(F.count(F.lit(1)).alias("n"))
    return _fraction(
        ids.agg(F.count_if(F.col("n") > 1).alias("n_bad"), F.sum("n").alias("n_rows"))
    )


def _jumps(df: DataFrame, copies: str | None) -> DataFrame:
    rows = F.count(F.lit(1)) if copies is None else F.sum(copies)
    return _fraction(
        df.agg(F.count_if(F.col("delta") > 1).alias("n_bad"), rows.alias("n_rows"))
    )


def _in_runs(df: DataFrame, order: list[str], limits: Limits) -> tuple[Runs, str | None]:
    """Rows for a sequence check, and the name of their count column, if any.

    Copies have the step 0, so one row can stand for all rows equal in device and
    ``order``. That costs a further shuffle, and is done only if the copies of one event
    are too many for a task.
    """
    rows = df.select("deviceId", *order)
    runs = cut(rows, ["deviceId"], order, limits)
    if not runs.has_copies:
        return runs, None
    rows = rows.groupBy("deviceId", *order).agg(F.count(F.lit(1)).alias(COPIES))
    return cut(rows, ["deviceId"], order, limits), COPIES


def out_of_sequence(df: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """Rows stored after a row whose sequence number is not the one before theirs.

    Only jumps forward count; steps back and repeats do not.
    """
    runs, copies = _in_runs(df, ["storedAt", SEQUENCE], limits)
    return _jumps(stored_order_delta(runs.df, runs=runs), copies)


def missing_events(df: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """Gaps in the sequence of a device, without its first and last tenth."""
    runs, copies = _in_runs(df, [SEQUENCE], limits)
    return _jumps(middle_delta(runs.df, copies=copies, runs=runs), copies)


def quality_report(
    df: DataFrame, limits: Thresholds = Thresholds(), cuts: Limits = DEFAULT
) -> DataFrame:
    """One row per check: ``check_name, expected, actual, passed``.

    An empty input has no fractions, which passes; it has no rate and no latency, which
    fails. The rate and latency checks look at the best minute only.
    """

    def line(name: str, expected: float, actual: Column, ok: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            F.lit(float(expected)).alias("expected"),
            actual.cast("double").alias("actual"),
            ok.alias("passed"),
        )

    def check(source: DataFrame, *lines: Column) -> DataFrame:
        return source.select(F.inline(F.array(*lines)))

    # Both checks of the rates are lines of one summary, so the minutes are built once.
    checks, rates = [], []
    if limits.events_per_second is not None:
        best = F.col("max_events_per_second")
        ok = F.coalesce(best >= limits.events_per_second, F.lit(False))
        rates.append(line("throughput", limits.events_per_second, best, ok))
    if limits.latency_ms is not None:
        best = F.col("min_latency_s") * 1000
        ok = F.coalesce(best <= limits.latency_ms, F.lit(False))
        rates.append(line("latency", limits.latency_ms, best, ok))
    if rates:
        checks.append(check(rate_summary(minute_rates(df)), *rates))
    fractions = (
        ("duplicates", limits.duplicate_fraction, duplicate_fraction, ()),
        ("out_of_sequence", limits.out_of_sequence_fraction, out_of_sequence, (cuts,)),
        ("missing", limits.missing_fraction, missing_events, (cuts,)),
    )
    for name, expected, count, more in fractions:
        if expected is not None:
            found = F.col("fraction")
            ok = F.coalesce(found <= expected, F.lit(True))
            checks.append(check(count(df, *more), line(name, expected, found, ok)))
    if not checks:
        return check(df.limit(0), line("", 0.0, F.lit(0.0), F.lit(True)))
    return reduce(DataFrame.unionByName, checks)


def failed_checks(report: DataFrame) -> DataFrame:
    """One message per failed check; no rows mean that all passed."""
    text = F.concat_ws(
        " ",
        F.concat("check_name", F.lit(":")),
        F.lit("expected"),
        F.col("expected").cast("string"),
        F.lit("got"),
        F.coalesce(F.col("actual").cast("string"), F.lit("nothing")),
    )
    return report.where(~F.col("passed")).select(text.alias("value"))


def json_valid(df: DataFrame, column: str = "complexData") -> DataFrame:
    """How many texts of a column are valid JSON."""
    ok = is_json(column)
    return df.agg(F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_bad"))
