"""Spark session with the settings the rest of the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that change results or plans. Anything about cluster size (memory,
#: executors, shuffle partitions) is left to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Deduplication state may outgrow the heap; it is kept on disk and its changes are what is
    # checkpointed.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "odsflow", master: str | None = None, **extra: str) -> SparkSession:
    """Return the running session, or start one with ``SETTINGS`` and ``extra``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int = 8, app_name: str = "odsflow-local", **extra: str) -> SparkSession:
    """Session for tests and the benchmark: one JVM, one shuffle partition per core."""
    spark = build_session(
        app_name,
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": str(cores),
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.catalogImplementation": "in-memory",
            **extra,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
