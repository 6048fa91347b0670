"""Which keys a table already holds, found again at the cost of a micro-batch.

The keys lie in a folder of their own, parted by a hash of the key: ``bucket=<b>/
batch_id=<n>``. A micro-batch looks up the buckets that its own keys fall into and lists
and reads no others, however many keys there are. It then adds its new keys under its own
number, which a replay overwrites and which no earlier batch sees.

The index is derived data: ``rebuild`` makes it again from the table, as few files.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH, BUCKET = "batch_id", "bucket"
#: The number under which ``rebuild`` files the keys of all batches so far.
REBUILT = -1
#: Tasks that write an index: a fixed number, because united tiny partitions would leave all
#: files of a batch to one task.
WRITERS = 16


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def folder_of(path: str) -> str:
    """The index of the table in ``path``: below it, where readers of the table do not look."""
    return f"{path}/_keys"


def touched(rows: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """The buckets that the keys of ``rows`` fall into: at most ``buckets`` numbers."""
    found = rows.select(bucket_of(keys, buckets).alias(BUCKET)).distinct().collect()
    return sorted(r[0] for r in found)


def held(
    spark: SparkSession, index: str, kind: T.StructType, some: Iterable[int], before: int
) -> DataFrame:
    """Keys of batches before ``before`` in the buckets ``some``; other folders are not listed."""
    numbers = ",".join(map(str, some))
    full = T.StructType([*kind.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.LongType())])
    empty = spark.createDataFrame([], kind)
    if not numbers:
        return empty
    try:
        reader = spark.read.schema(full).option("basePath", index)
        rows = reader.parquet(f"{index}/{BUCKET}={{{numbers}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty  # no such bucket has a key yet
    return rows.where(F.col(BATCH) < before).select(*kind.fieldNames())


def add(rows: DataFrame, index: str, keys: Sequence[str], buckets: int, batch_id: int) -> None:
    """File the keys of ``rows`` under ``batch_id``: one file per bucket."""
    (
        rows.select(*keys)
        .withColumns({BUCKET: bucket_of(keys, buckets), BATCH: F.lit(batch_id).cast("long")})
        .repartition(min(WRITERS, buckets), BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET, BATCH)
        .parquet(index)
    )


def rebuild(table: DataFrame, index: str, keys: Sequence[str], buckets: int) -> None:
    """Make the index again from all rows of a table, with one file per bucket.

    For tables that others have filled, and to unite the files of many batches. Run it
    while no stream writes, into a new ``index``.
    """
    add(table.select(*keys).distinct(), index, keys, buckets, REBUILT)
