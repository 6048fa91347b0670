"""What several corpus operators need: written tables, hot-group totals, components."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Runs of characters other than the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors see.

    Where the session names none, a local session gets a temporary one; a cluster
    must name one, because executors do not share their own disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="fleetlens-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: short lineage, true sizes, plain scans.

    A join of two such tables has a shuffle right below either side, so that adaptive
    execution can split a hot key.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first longer form that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def unit(key: Column) -> Column:
    """A signed 64-bit number as its place in [0, 1), in the same order."""
    return F.least((key.cast("double") / F.lit(2.0**64)) + F.lit(0.5), F.lit(1 - 2.0**-40))


def running_before(
    df: DataFrame,
    group: list[str],
    place: Column,
    order: list[str],
    value: str,
    name: str,
    rows: int | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the group.

    ``place`` is a number in [0, 1) that rises with ``order``. A group is cut along it
    into about sqrt(rows) pieces, so that no task sorts more than a piece or the list of
    pieces, however many rows the group has. ``df`` should be a written table: it is read
    twice. Group columns hold no nulls.
    """
    pieces = max(16, math.isqrt(df.count() if rows is None else rows))
    cut = df.withColumn("_piece", F.floor(place * pieces).cast("long"))
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*group, "_piece")
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_start", F.sum("_sum").over(earlier(*group).orderBy("_piece")))
        .drop("_sum")
    )
    inside = F.sum(value).over(earlier(*group, "_piece").orderBy(*order))
    return (
        cut.withColumn("_inside", inside)
        .join(starts, [*group, "_piece"])
        .withColumn(
            name, F.coalesce("_start", F.lit(0)) + F.coalesce("_inside", F.lit(0))
        )
        .drop("_piece", "_start", "_inside")
    )


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """Connected components of ``links(a, b)``: every linked node with its smallest node.

    Alternates two steps until nothing changes: each node ties its larger neighbours to
    its smallest neighbour, then each node ties its smaller neighbours to the smallest.
    The number of rounds is logarithmic. Minima are written before they are joined, so
    that a hub with very many links is split over tasks. Returns ``node, root``.
    """
    edges = written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        name,
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("u").alias("n"), F.col("v").alias("x")).union(
            edges.select(F.col("v").alias("n"), F.col("u").alias("x"))
        )
        least = written(
            both.groupBy("n").agg(F.min("x").alias("m")).select("n", F.least("n", "m").alias("m")),
            name,
        )
        large = written(
            both.join(least, "n")
            .where(F.col("x") > F.col("n"))
            .select(F.col("x").alias("u"), F.col("m").alias("v"))
            .distinct(),
            name,
        )
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), name)
        edges = written(
            large.join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least)
            .distinct(),
            name,
        )
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    code = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(code), F.sum(F.shiftright(code, 20))).first())
