"""Sinks. Every ``foreachBatch`` body may run twice for a batch and leaves the same data:
a batch writes its own folder ``batch_id=<n>`` and overwrites it when it is replayed.
Only folders with a ``_SUCCESS`` mark are read."""

from __future__ import annotations

import uuid
from functools import reduce
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from fleetlens.functions.scalars import ISO_MILLIS, now
from fleetlens.operators.decode import record_to_json
from fleetlens.operators.dedup import not_in, staging_dedup
from fleetlens.operators.ordered import first_rows
from fleetlens.operators.windows import split_newest
from fleetlens.sources.logs import producer_options
from fleetlens.streaming import keys as key_index

Write = Callable[[DataFrame, int], None]
BATCH = key_index.BATCH


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def committed(spark: SparkSession, path: str, before: int | None = None) -> list[int]:
    """Numbers of the finished batches in a folder."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BATCH}=*/_SUCCESS")
    files = marks.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [mark.getPath().getParent().getName() for mark in files.globStatus(marks) or []]
    found = sorted(int(name.removeprefix(f"{BATCH}=")) for name in names)
    return [n for n in found if before is None or n < before]


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """All rows of finished batches, with their batch number."""
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    folders = [batch_folder(path, n) for n in committed(spark, path, before)]
    if not folders:
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).option("basePath", path).parquet(*folders)
    return rows.select(*full.fieldNames())


# -- append and merge ----------------------------------------------------------------


def append_once(path: str, format_: str = "parquet", partition_by: Sequence[str] = ()) -> Write:
    """Append each batch exactly once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite").format(format_)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(batch_folder(path, batch_id))

    return write


def payload_append(path: str) -> Write:
    """Append with the time of storing and one id for the whole batch."""
    once = append_once(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        name = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{path}/{batch_id}"))
        once(batch.withColumns({"BatchId": F.lit(name), "StoredAt": now()}), batch_id)

    return write


def merge_append(
    path: str,
    keys: Sequence[str] = ("PartitionId", "eventId"),
    order: Sequence[str] = ("enqueuedAt",),
    buckets: int = 64,
) -> Write:
    """Insert the rows whose key is in no earlier batch, once each.

    Earlier keys come from an index beside the data (``streaming.keys``), and only from the
    buckets that the keys of this batch fall into. ``buckets`` must not change while the
    index lives; take so many that a bucket's keys fit a task.
    """
    return _indexed(path, keys, buckets, lambda rows: staging_dedup(rows, keys, order), reject=False)


def unique_append(path: str, keys: Sequence[str] = ("eventId",), buckets: int = 64) -> Write:
    """Append whole batches under a unique key: a batch fails if it has a key twice, or one
    that an earlier batch has. A failed batch leaves nothing behind."""
    return _indexed(path, keys, buckets, lambda rows: rows, reject=True)


def _indexed(
    path: str, keys: Sequence[str], buckets: int, staged: Callable[[DataFrame], DataFrame], reject: bool
) -> Write:
    index = key_index.folder_of(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            spark, kind = batch.sparkSession, rows.select(*keys).schema
            some = key_index.touched(rows, keys, buckets)
            earlier = key_index.held(spark, index, kind, some, batch_id)
            if reject:
                _reject(rows, earlier, keys)
                fresh = rows
            else:
                fresh = not_in(staged(rows), earlier, keys, rows)
            folder = batch_folder(path, batch_id)
            fresh.write.mode("overwrite").parquet(folder)
            # Read back: what was written is what counts, and its keys are few columns.
            key_index.add(spark.read.schema(rows.schema).parquet(folder), index, keys, buckets, batch_id)
        finally:
            rows.unpersist()

    return write


def _reject(rows: DataFrame, earlier: DataFrame, keys: Sequence[str]) -> None:
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = rows.select(*keys).join(earlier, list(keys), "left_semi")
    broken = twice.union(again).limit(1).collect()
    if broken:
        raise ValueError(f"duplicate key {broken[0].asDict()!r}")


def delta_merge(table: str, keys: Sequence[str], update: bool = False) -> Write:
    """The same on a table format with MERGE. Needs the Delta jar."""

    def write(batch: DataFrame, batch_id: int) -> None:
        staging_dedup(batch, keys, ["enqueuedAt"]).createOrReplaceTempView("_staged")
        batch.sparkSession.sql(merge_statement(table, "_staged", keys, update))

    return write


def merge_statement(table: str, source: str, keys: Sequence[str], update: bool = False) -> str:
    matched = "WHEN MATCHED THEN UPDATE SET * " if update else ""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return (
        f"MERGE INTO {table} t USING {source} s ON {on} "
        f"{matched}WHEN NOT MATCHED THEN INSERT *"
    )


# -- newest rows of appended changes (kept state: ``streaming.newest``) --------------


def newest_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = ("id",),
    order: Sequence[str] = ("enqueuedAt",),
) -> DataFrame:
    """The upserted state of a folder of appended changes: merged when it is read."""
    rows = read_batches(spark, path, schema)
    by = [F.col(c).desc() for c in (*order, BATCH)]
    return first_rows(rows, keys, by).drop(BATCH)


# -- messages and texts --------------------------------------------------------------


def keyed_json(df: DataFrame, key: str = "deviceId") -> DataFrame:
    """``(key, value)`` rows for a log: one JSON record per event."""
    options = {"timestampFormat": ISO_MILLIS, "timeZone": "UTC"}
    record = F.to_json(F.struct(*df.columns), options)
    return df.select(F.col(key).cast("string").alias("key"), record.alias("value"))


def to_log(df: DataFrame, params: Mapping[str, str], key: str = "deviceId") -> DataStreamWriter:
    """A stream of JSON records to a Kafka topic. Needs the Kafka jar."""
    return keyed_json(df, key).writeStream.format("kafka").options(**producer_options(params))


def array_messages(df: DataFrame, size: int = 1000, key: str | None = None) -> DataFrame:
    """JSON-array messages of at most ``size`` events, packed inside each task.

    With ``key`` a message holds events of one key only and comes as ``(key, value)``, so
    that a log can partition by it. Rows are taken as they lie: after a repartition by the
    key the messages are as full as they can be.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict = {}
            keys = batch.column(1).to_pylist() if key else [None] * batch.num_rows
            for k, text in zip(keys, batch.column(0).to_pylist(), strict=True):
                groups.setdefault(k, []).append(text)
            packed = [
                (k, "[" + ",".join(texts[i : i + size]) + "]")
                for k, texts in groups.items()
                for i in range(0, len(texts), size)
            ]
            columns = [pa.array([p[i] for p in packed], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "value"])

    rows = record_to_json(df) if key is None else keyed_records(df, key)
    messages = rows.mapInArrow(pack, "key string, value string")
    return messages if key else messages.select("value")


def keyed_records(df: DataFrame, key: str) -> DataFrame:
    """One JSON record per event, and its key."""
    options = {"timestampFormat": ISO_MILLIS, "timeZone": "UTC", "ignoreNullFields": "false"}
    record = F.to_json(F.struct(*df.columns), options)
    return df.select(record.alias("value"), F.col(key).cast("string").alias("key"))


def json_lines(path: str) -> Write:
    """One folder of JSON-lines files per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        record_to_json(batch).write.mode("overwrite").text(batch_folder(path, batch_id))

    return write


def move_newest(
    df: DataFrame, hot: str, cold: str, batch_id: int, n: int = 10_000, order: Sequence[str] = ("processedAt", "eventId")
) -> None:
    """Move the newest ``n`` rows of ``df`` to the cold folder; the others become the hot one.

    Both parts are written under the number of the move and can be written again; readers
    of the hot folder take its newest finished move.
    """
    marked = split_newest(df, n, order, "_tier")
    for path, tier in ((cold, "cold"), (hot, "hot")):
        rows = marked.where(F.col("_tier") == tier).drop("_tier")
        rows.write.mode("overwrite").parquet(batch_folder(path, batch_id))


def csv_export(path: str, summary: Callable[[DataFrame], DataFrame] | None = None) -> Write:
    """CSV per run, e.g. of a summary; the run number tells repeated exports apart."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if summary is None else summary(batch)
        rows.write.mode("overwrite").csv(batch_folder(path, batch_id), header=True)

    return write


def as_view(df: DataFrame, name: str, shared: bool = False) -> DataFrame:
    """Name a result for the next step of the session, or of all sessions."""
    if shared:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)
    return df


# -- relational ----------------------------------------------------------------------


def jdbc_write_options(url: str, table: str, batch: int = 2500, timeout_s: int = 600) -> dict:
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch),
        "queryTimeout": str(timeout_s),
        "isolationLevel": "READ_COMMITTED",
    }


def jdbc_merge(
    url: str, table: str, keys: Sequence[str], order: Sequence[str] = ("enqueuedAt",)
) -> Write:
    """Insert the rows whose key the table does not hold. Only the keys are read back."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = (
            batch.sparkSession.read.format("jdbc")
            .options(url=url, query=f"SELECT {', '.join(keys)} FROM {table}")
            .load()
        )
        fresh = not_in(staging_dedup(batch, keys, order), held, keys, batch)
        fresh.write.format("jdbc").options(**jdbc_write_options(url, table)).mode(
            "append"
        ).save()

    return write


def split_long_texts(df: DataFrame, limit: int = 4000) -> tuple[DataFrame, DataFrame]:
    """Rows whose texts all fit into ``limit`` characters, and the others."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    long = reduce(
        lambda a, b: a | b, (F.coalesce(F.length(c) > limit, F.lit(False)) for c in texts), F.lit(False)
    )
    return df.where(~long), df.where(long)


def jdbc_move_statements(table: str, staged: str, columns: Sequence[str], batch_id: int) -> list[str]:
    """What moves a staged batch into the table, to be run in one transaction."""
    names = ", ".join(columns)
    return [
        f"DELETE FROM {table} WHERE {BATCH} = {int(batch_id)}",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staged}",
    ]


def jdbc_append_once(
    url: str,
    table: str,
    transact: Callable[[Sequence[str]], None],
    quarantine: Write | None = None,
    text_limit: int = 4000,
) -> Write:
    """Append each batch exactly once, also if a write fails half-way.

    The tasks of a JDBC write commit one by one. So a batch goes to a staging table, which
    is overwritten by a repeated attempt, and ``transact`` runs the statements that move it
    in one transaction of the database. Rows with longer texts than ``text_limit`` are not
    cut: they go to ``quarantine``, or fail the batch if there is none.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            fit, long = split_long_texts(batch, text_limit)
            if quarantine is not None:
                quarantine(long, batch_id)
            elif not long.isEmpty():
                raise ValueError(f"texts of more than {text_limit} characters")
            staged = f"{table}_staged"
            rows = fit.withColumn(BATCH, F.lit(batch_id))
            options = {**jdbc_write_options(url, staged), "truncate": "true"}
            rows.write.format("jdbc").options(**options).mode("overwrite").save()
            transact(jdbc_move_statements(table, staged, rows.columns, batch_id))
        finally:
            batch.unpersist()

    return write
