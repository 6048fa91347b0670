"""Batch reads of the stores that the verification checks look at."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.scalars import iso_to_timestamps
from fleetlens.schema import DOCUMENT


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition: str | None = None,
    partitions: int = 1,
    fetch: int = 10_000,
    **more: str,
) -> dict[str, str]:
    """A whole table, read in parallel by its partition number, or a pushed-down query."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {"url": url, "fetchsize": str(fetch), **more}
    if query is not None:
        return {**options, "query": query}
    options["dbtable"] = table
    if partition is not None:
        options |= {
            "partitionColumn": partition,
            "lowerBound": "0",
            "upperBound": str(partitions),
            "numPartitions": str(partitions),
        }
    return options


def relational(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def warehouse_query(table: str, columns: dict[str, str]) -> str:
    """The query that reads a warehouse table, ids as text: ``{"eventId": "EventId"}``."""
    listed = ", ".join(
        f"CAST({source} AS CHAR(36)) AS {name}" if name == "eventId" else f"{source} AS {name}"
        for name, source in columns.items()
    )
    return f"SELECT {listed} FROM {table}"


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents with ISO texts as times, and the store's own time in seconds."""
    rows = spark.read.schema(DOCUMENT).json(path)
    rows = iso_to_timestamps(rows, "createdAt", "enqueuedAt", "processedAt")
    return rows.withColumn("storedAt", F.timestamp_seconds("_ts")).drop("_ts")


def event_time_only(df: DataFrame) -> DataFrame:
    """A store that keeps no arrival times: they are all the creation time."""
    return df.withColumns({"enqueuedAt": F.col("createdAt"), "storedAt": F.col("createdAt")})
