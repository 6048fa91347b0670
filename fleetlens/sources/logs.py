"""Event logs: option builders for the Kafka source, and the envelope they give.

The Kafka connector is an external jar. Logs with a Kafka endpoint are read the same way.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IN, OUT = "kafka.in.", "kafka.out."


def options_with_prefix(params: Mapping[str, str], prefix: str) -> dict[str, str]:
    """The entries below ``prefix``, without it."""
    return {k.removeprefix(prefix): v for k, v in params.items() if k.startswith(prefix)}


def consumer_options(
    params: Mapping[str, str],
    prefix: str = IN,
    from_start: bool = True,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Source options from ``kafka.in.*`` properties; ``kafka.in.topic`` is required.

    No group id is set unless given: Spark then makes a fresh one for each query.
    """
    given = options_with_prefix(params, prefix)
    topic = given.pop("topic", None)
    if not topic:
        raise ValueError(f"no topic: set {prefix}topic")
    options = {f"kafka.{k}": v for k, v in given.items()}
    options["subscribe"] = topic
    options["startingOffsets"] = "earliest" if from_start else "latest"
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def producer_options(params: Mapping[str, str], prefix: str = OUT) -> dict[str, str]:
    """Sink options from ``kafka.out.*`` properties."""
    given = options_with_prefix(params, prefix)
    topic = given.pop("topic", None)
    if not topic:
        raise ValueError(f"no topic: set {prefix}topic")
    return {"topic": topic, **{f"kafka.{k}": v for k, v in given.items()}}


def sasl_options(connection: str, user: str = "$ConnectionString") -> dict[str, str]:
    """``kafka.in.*`` security properties for a log behind a connection string."""
    login = (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        f'username="{user}" password="{connection}";'
    )
    return {
        f"{IN}security.protocol": "SASL_SSL",
        f"{IN}sasl.mechanism": "PLAIN",
        f"{IN}sasl.jaas.config": login,
    }


def log_stream(spark: SparkSession, params: Mapping[str, str], **how) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**consumer_options(params, **how))
    return log_envelope(reader.load())


def log_batch(spark: SparkSession, params: Mapping[str, str], **how) -> DataFrame:
    options = consumer_options(params, **how)
    options.pop("maxOffsetsPerTrigger", None)
    return log_envelope(spark.read.format("kafka").options(**options).load())


def log_envelope(df: DataFrame) -> DataFrame:
    """Source columns under the envelope names that the decoders expect."""
    return df.select(
        F.col("value").alias("body"),
        F.col("timestamp").alias("enqueuedTime"),
        F.col("partition").alias("logPartition"),
        F.col("offset").alias("logOffset"),
    )
