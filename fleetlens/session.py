"""Session settings shared by the bench, the tests and standalone jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def local_session(
    cpus: str | int = "*", name: str = "fleetlens", memory: str = "8g"
) -> SparkSession:
    """A single-JVM session. On a cluster take the session that is given."""
    shuffle = "8" if cpus == "*" else str(max(int(cpus), 2))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> None:
    """Event times are UTC; every text or zone-less time is read in that zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
