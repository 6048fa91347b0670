"""Time-series queries: raw, computed, aggregated, categorised, interpolated.

A query covers ``[start, end)``. Intervals are aligned to the epoch, and named by their
start. Variables are small objects with Spark column expressions, so that a query over
many variables is still one scan and one shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.operators.ordered import DEFAULT, Limits, following

Event = Callable[[str], Column]

# Fixed lengths of calendar units, page limits of a raw query.
DAYS_PER_MONTH, DAYS_PER_YEAR = 30, 365
DEFAULT_TAKE, MAX_TAKE = 10_000, 250_000
LINEAR, STEP = "linear", "step"

_DURATION = re.compile(
    r"P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?"
)


def duration(text: str | timedelta) -> timedelta:
    """An ISO-8601 duration; a month has 30 days and a year 365."""
    if isinstance(text, timedelta):
        return text
    found = _DURATION.fullmatch(text)
    if not found or not any(found.groups()):
        raise ValueError(f"not an ISO-8601 duration: {text!r}")
    years, months, days, hours, minutes, seconds = (float(g or 0) for g in found.groups())
    return timedelta(
        days=years * DAYS_PER_YEAR + months * DAYS_PER_MONTH + days,
        hours=hours,
        minutes=minutes,
        seconds=seconds,
    )


def micros(value: str | timedelta) -> int:
    return duration(value) // timedelta(microseconds=1)


@dataclass(frozen=True)
class Span:
    """``[start, end)`` in UTC."""

    start: datetime
    end: datetime

    @staticmethod
    def _utc(at: datetime) -> datetime:
        return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at

    def bounds(self) -> tuple[int, int]:
        epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
        one = timedelta(microseconds=1)
        return (self._utc(self.start) - epoch) // one, (self._utc(self.end) - epoch) // one

    def rows(self, df: DataFrame, time: str, before: int = 0, after: int = 0) -> DataFrame:
        """Rows in the span, widened by microseconds; a plain range for the file scan."""
        low, high = self.bounds()
        return df.where(
            (F.col(time) >= F.timestamp_micros(F.lit(low - before)))
            & (F.col(time) < F.timestamp_micros(F.lit(high + after)))
        )

    def intervals(self, step: int) -> tuple[int, int]:
        """Numbers of the first and the last interval that touch the span."""
        low, high = self.bounds()
        return low // step, (high - 1) // step


@dataclass(frozen=True)
class Interpolation:
    kind: str = LINEAR
    boundary: str | timedelta = timedelta(0)


@dataclass(frozen=True)
class NumericVariable:
    """``aggregation`` of a value per event, e.g. ``NumericVariable(e("x"), F.avg)``."""

    value: Column
    aggregation: Callable[[Column], Column] = F.avg
    where: Column | None = None
    interpolation: Interpolation | None = None

    def per_event(self) -> Column:
        return self.value if self.where is None else F.when(self.where, self.value)

    def per_interval(self) -> Column:
        return self.aggregation(self.per_event())


@dataclass(frozen=True)
class AggregateVariable:
    """Any aggregate, e.g. ``lambda e: F.max(e("x")) - F.min(e("x"))``."""

    aggregation: Callable[[Event], Column]
    where: Column | None = None

    def per_interval(self) -> Column:
        def event(name: str) -> Column:
            column = F.col(name)
            return column if self.where is None else F.when(self.where, column)

        return self.aggregation(event)


@dataclass(frozen=True)
class CategoricalVariable:
    """Labels for values: ``{"low": [0, 1], "high": [2]}``, and one for all others."""

    value: Column
    categories: Mapping[str, Sequence] = field(default_factory=dict)
    default: str = "other"
    where: Column | None = None

    def label(self) -> Column:
        column = F.lit(self.default)
        for name, values in reversed(list(self.categories.items())):
            column = F.when(self.value.isin(*values), F.lit(name)).otherwise(column)
        return column if self.where is None else F.when(self.where, column)


def series_events(
    df: DataFrame,
    span: Span,
    ids: Sequence[str] | None = None,
    where: Column | None = None,
    properties: Sequence[str] | None = None,
    take: int = DEFAULT_TAKE,
    key: str = "deviceId",
    time: str = "createdAt",
    tie: Sequence[str] = ("eventId",),
) -> DataFrame:
    """Raw events of the series in the span, oldest first, at most ``take``."""
    if not 0 < take <= MAX_TAKE:
        raise ValueError(f"take must be 1..{MAX_TAKE}")
    rows = _chosen(df, span, ids, where, key, time)
    names = [key, time, *(properties or [c for c in df.columns if c not in (key, time)])]
    ties = [c for c in tie if c not in (key, time)]
    hidden = [c for c in ties if c not in names]
    page = rows.select(*names, *hidden).orderBy(time, key, *ties).limit(take)
    return page.drop(*hidden)


def series_values(
    df: DataFrame,
    span: Span,
    variables: Mapping[str, NumericVariable],
    ids: Sequence[str] | None = None,
    where: Column | None = None,
    overrides: Mapping[str, NumericVariable] | None = None,
    names: Sequence[str] | None = None,
    key: str = "deviceId",
    time: str = "createdAt",
) -> DataFrame:
    """Variables computed per event. Inline ``overrides`` win over model variables."""
    chosen = _pick(variables, overrides, names)
    rows = _chosen(df, span, ids, where, key, time)
    return rows.select(
        key, F.col(time).alias("ts"), *[v.per_event().alias(n) for n, v in chosen.items()]
    )


def series_aggregate(
    df: DataFrame,
    span: Span,
    interval: str | timedelta,
    variables: Mapping[str, NumericVariable | AggregateVariable],
    ids: Sequence[str] | None = None,
    where: Column | None = None,
    overrides: Mapping[str, NumericVariable | AggregateVariable] | None = None,
    names: Sequence[str] | None = None,
    fill: bool = False,
    key: str = "deviceId",
    time: str = "createdAt",
    tie: Sequence[str] = ("eventId",),
) -> DataFrame:
    """Variables aggregated per series and interval.

    ``fill`` adds a row of nulls for each interval without events of a series that has
    some in the span. A numeric variable with an interpolation has, in intervals where it
    has no value of its own, the interpolated one at the start of the interval.
    """
    step = micros(interval)
    chosen = _pick(variables, overrides, names)
    rows = _chosen(df, span, ids, where, key, time)
    found = rows.groupBy(key, interval_of(time, step).alias("_i")).agg(
        *[v.per_interval().alias(n) for n, v in chosen.items()]
    )
    if fill:
        found = interval_grid(found.select(key), key, span, step).join(
            found, [key, "_i"], "left"
        )
    found = found.select(key, interval_start("_i", step).alias("ts"), *chosen)
    for n, v in chosen.items():
        if getattr(v, "interpolation", None) is not None:
            between = series_interpolate(df, span, interval, v, ids, where, key, time, tie, "_between")
            found = found.join(between, [key, "ts"], "left")
            found = found.withColumn(n, F.coalesce(n, "_between")).drop("_between")
    return found


def series_categories(
    df: DataFrame,
    span: Span,
    interval: str | timedelta,
    variable: CategoricalVariable,
    ids: Sequence[str] | None = None,
    where: Column | None = None,
    boundary: str | timedelta = timedelta(0),
    key: str = "deviceId",
    time: str = "createdAt",
    tie: Sequence[str] = ("eventId",),
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Events and seconds per label, series and interval.

    A state lasts until the next event of the series, the last one until the end of the
    span; it is split over the intervals it touches. ``boundary`` looks back for the
    state that holds when the span begins.
    """
    step, back = micros(interval), micros(boundary)
    low, high = span.bounds()
    rows = span.rows(_series(df, ids, where, key), time, before=back).select(
        key, time, *[c for c in tie if c not in (key, time)], variable.label().alias("label")
    )
    rows = rows.where(F.col("label").isNotNull())
    rows = following(rows, [key], [time, *tie], {"_next": F.unix_micros(time)}, limits)
    begin = F.greatest(F.unix_micros(time), F.lit(low))
    end = F.least(F.coalesce("_next", F.lit(high)), F.lit(high))
    states = rows.select(
        key,
        "label",
        F.unix_micros(time).alias("_at"),
        begin.alias("_from"),
        end.alias("_to"),
    ).where((F.col("_to") > F.col("_from")) | (F.col("_at") >= low))
    first = F.floor(F.col("_from") / F.lit(step))
    last = F.greatest(first, F.floor((F.col("_to") - 1) / F.lit(step)))
    parts = states.withColumn("_i", F.explode(F.sequence(first, last)))
    left = F.greatest(F.col("_from"), F.col("_i") * step)
    right = F.least(F.col("_to"), (F.col("_i") + 1) * step)
    here = (F.col("_at") >= low) & (F.floor(F.col("_at") / F.lit(step)) == F.col("_i"))
    return (
        parts.groupBy(key, "_i", "label")
        .agg(
            F.count_if(here).alias("n"),
            (F.sum(F.greatest(right - left, F.lit(0))) / F.lit(1_000_000.0)).alias("seconds"),
        )
        .select(key, interval_start("_i", step).alias("ts"), "label", "n", "seconds")
    )


def series_interpolate(
    df: DataFrame,
    span: Span,
    interval: str | timedelta,
    variable: NumericVariable,
    ids: Sequence[str] | None = None,
    where: Column | None = None,
    key: str = "deviceId",
    time: str = "createdAt",
    tie: Sequence[str] = ("eventId",),
    name: str = "value",
) -> DataFrame:
    """The variable at each interval start, from the samples around it.

    Samples are first reduced to the first and last one of each interval, on the map
    side, so the windows below run over intervals and not over events.
    """
    how = variable.interpolation or Interpolation()
    step, margin = micros(interval), micros(how.boundary)
    rows = span.rows(_series(df, ids, where, key), time, margin, margin)
    at, sample = F.unix_micros(time), variable.per_event()
    point = F.struct(at.alias("t"), *tie, sample.cast("double").alias("v"))
    edges = (
        rows.select(key, interval_of(time, step).alias("_i"), point.alias("_p"))
        .where(F.col("_p.v").isNotNull())
        .groupBy(key, "_i")
        .agg(F.min("_p").alias("_first"), F.max("_p").alias("_last"))
    )
    grid = interval_grid(edges.select(key), key, span, step)
    wanted = F.col("_wanted")
    slots = (
        edges.select(key, "_i", "_first", "_last", F.lit(False).alias("_wanted"))
        .unionByName(
            grid.withColumn("_wanted", F.lit(True)), allowMissingColumns=True
        )
        .groupBy(key, "_i")
        .agg(
            F.max("_first").alias("_first"),
            F.max("_last").alias("_last"),
            F.max(wanted).alias("_wanted"),
        )
    )
    by = Window.partitionBy(key).orderBy("_i")
    before = F.last("_last", ignorenulls=True).over(
        by.rowsBetween(Window.unboundedPreceding, -1)
    )
    # Backwards, so that a frame only grows: from each row to the end it is quadratic.
    back = Window.partitionBy(key).orderBy(F.col("_i").desc())
    after = F.last("_first", ignorenulls=True).over(
        back.rowsBetween(Window.unboundedPreceding, 0)
    )
    start = F.col("_i") * F.lit(step)
    around = slots.withColumns({"_a": before, "_b": after}).where(wanted)
    exact = F.col("_b.t") == start
    if how.kind == STEP:
        value = F.when(exact, F.col("_b.v")).otherwise(F.col("_a.v"))
    elif how.kind == LINEAR:
        share = (start - F.col("_a.t")) / (F.col("_b.t") - F.col("_a.t"))
        line = F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * share
        value = F.when(exact, F.col("_b.v")).otherwise(line)
    else:
        raise ValueError(f"interpolation is {LINEAR} or {STEP}, not {how.kind!r}")
    return around.select(key, interval_start("_i", step).alias("ts"), value.alias(name))


def availability(
    df: DataFrame, interval: str | timedelta, time: str = "createdAt"
) -> DataFrame:
    """Events per interval, with the first and last event time in it."""
    step = micros(interval)
    return (
        df.groupBy(interval_of(time, step).alias("_i"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(time).alias("first_at"),
            F.max(time).alias("last_at"),
        )
        .select(interval_start("_i", step).alias("bin_start"), "n", "first_at", "last_at")
    )


def availability_range(bins: DataFrame) -> DataFrame:
    """First and last event time over all intervals, both inclusive."""
    return bins.agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.sum("n").alias("n"),
    )


def event_schema(
    df: DataFrame, span: Span, json: str | None = None, time: str = "createdAt"
) -> DataFrame:
    """``(name, type)`` of the properties that occur in the span.

    Typed columns count if they are not null anywhere; the properties of a JSON text
    column are listed with the types their values have.
    """
    rows = span.rows(df, time)
    columns = [f for f in rows.schema if f.name != json]
    present = [
        F.when(
            F.col(f.name).isNotNull(),
            F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")),
        )
        for f in columns
    ]
    found = F.array_compact(F.array(*present))
    if json is not None:
        fields = F.from_json(json, "map<string,variant>")
        found = F.concat(
            found,
            F.coalesce(
                F.transform(
                    F.map_entries(fields),
                    lambda e: F.struct(
                        e["key"].alias("name"),
                        F.lower(F.schema_of_variant(e["value"])).alias("type"),
                    ),
                ),
                F.array().cast("array<struct<name:string,type:string>>"),
            ),
        )
    # Whole rows repeat few combinations: unite those before taking them apart.
    return (
        rows.select(found.alias("_found"))
        .distinct()
        .select(F.explode("_found").alias("_f"))
        .select("_f.name", "_f.type")
        .distinct()
    )


def interval_of(time: str, step: int) -> Column:
    """Number of the epoch-aligned interval."""
    at = F.unix_micros(time)
    return ((at - F.pmod(at, F.lit(step))) / F.lit(step)).cast("long")


def interval_start(number: str, step: int) -> Column:
    return F.timestamp_micros(F.col(number) * F.lit(step))


def interval_grid(keys: DataFrame, key: str, span: Span, step: int) -> DataFrame:
    """All intervals of the span that start in it, for each distinct key."""
    low, high = span.bounds()
    first, last = -(-low // step), (high - 1) // step
    if last < first:
        return keys.limit(0).withColumn("_i", F.lit(0).cast("long"))
    numbers = F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))
    return keys.distinct().withColumn("_i", F.explode(numbers))


def _series(
    df: DataFrame, ids: Sequence[str] | None, where: Column | None, key: str
) -> DataFrame:
    if ids is not None:
        df = df.where(F.col(key).isin(*ids))
    return df if where is None else df.where(where)


def _chosen(df, span, ids, where, key, time) -> DataFrame:
    return span.rows(_series(df, ids, where, key), time)


def _pick(model: Mapping, inline: Mapping | None, names: Sequence[str] | None) -> dict:
    variables = {**model, **(inline or {})}
    return {n: variables[n] for n in names} if names is not None else variables
