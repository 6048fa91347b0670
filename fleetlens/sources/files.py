"""File sources: drop folders, capture files, typed exports, ad-hoc reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetlens.functions.scalars import strip_type_suffix
from fleetlens.operators.decode import decode_capture
from fleetlens.schema import CAPTURE_FILE, EVENT

# Separators of the delimited formats.
SEPARATORS = {"csv": ",", "tsv": "\t", "psv": "|"}


def folder_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format_: str = "json",
    max_files: int | None = None,
    recursive: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """New files of a folder, found by listing, with a declared schema."""
    reader = spark.readStream.format(format_).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def json_stream(
    spark: SparkSession, path: str, schema: T.StructType = EVENT, **how
) -> DataFrame:
    return folder_stream(spark, path, schema, "json", **how)


def capture_stream(spark: SparkSession, path: str, format_: str = "avro", **how) -> DataFrame:
    """Capture files in nested folders. Only two fields are declared, so no others are
    decoded. Avro needs its connector jar; Parquet files of the same schema do not."""
    how.setdefault("recursive", True)
    return folder_stream(spark, path, CAPTURE_FILE, format_, **how)


def capture_events(
    spark: SparkSession, glob: str, format_: str = "avro", schema: T.StructType = EVENT
) -> DataFrame:
    """Ad-hoc read of the capture files that match a glob, bodies decoded."""
    files = spark.read.format(format_).schema(CAPTURE_FILE).load(glob)
    return decode_capture(files, schema)


def typed_export(spark: SparkSession, base: str) -> DataFrame:
    """Partitioned Parquet with ``name_type`` columns; event time stands for all times."""
    return typed_rows(spark.read.parquet(base))


def typed_rows(exported: DataFrame) -> DataFrame:
    """The same from a table or any rows of that form."""
    rows = strip_type_suffix(exported)
    if "timestamp" in rows.columns:
        rows = rows.withColumnRenamed("timestamp", "createdAt")
    return rows.selectExpr("*", "createdAt AS enqueuedAt", "createdAt AS storedAt")


def external_table(spark: SparkSession, table: str, base: str) -> DataFrame:
    """A table over Parquet that is already there; new partitions are found."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{base}'")
    if spark.catalog.listColumns(table) and any(
        c.isPartition for c in spark.catalog.listColumns(table)
    ):
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def first_of_table(spark: SparkSession, table: str, n: int = 100) -> DataFrame:
    return spark.table(table).limit(n)


def delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    kind: str = "csv",
    header: bool | None = None,
) -> DataFrame:
    """Separated text: csv with a header, tsv and psv without, unless told otherwise."""
    return spark.read.csv(
        path,
        schema=schema,
        sep=SEPARATORS[kind],
        header=kind == "csv" if header is None else header,
    )


def read_any(
    spark: SparkSession, path: str, kind: str, schema: T.StructType | None = None
) -> DataFrame:
    """One of the configured formats by name."""
    if kind in SEPARATORS:
        if schema is None:
            raise ValueError(f"{kind} needs a schema")
        return delimited(spark, path, schema, kind)
    if kind == "sequencefile":
        pairs = spark.sparkContext.sequenceFile(path)
        return pairs.toDF(schema or "key string, value string")
    if kind not in ("parquet", "json", "avro", "orc"):
        raise ValueError(f"unknown format {kind!r}")
    reader = spark.read.format(kind)
    return (reader if schema is None else reader.schema(schema)).load(path)
