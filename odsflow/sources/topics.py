"""Message topics as streams or batches of ``schemas.TOPIC_ROW``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odsflow.schemas import TOPIC_ROW


def read_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = 5000, starting: str = "earliest"
) -> DataFrame:
    """Stream of a Kafka topic from its start; lost data is an error.

    ``max_offsets`` bounds a micro-batch and is to be sized to the cluster; None removes the
    bound. Needs the Kafka connector on the class path.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of topic rows kept as Parquet files, such as an archived topic."""
    reader = spark.readStream.schema(TOPIC_ROW)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def write_topic(messages: DataFrame, servers: str):
    """Writer of ``key``, ``value``, ``topic`` rows to Kafka; batch or stream."""
    writer = messages.writeStream if messages.isStreaming else messages.write
    return writer.format("kafka").option("kafka.bootstrap.servers", servers)
