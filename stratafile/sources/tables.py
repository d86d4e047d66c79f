"""Connections, their state, and messages as tables or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile import schemas


def read_connections(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The connection dimension; tokens are pruned unless a caller selects them."""
    reader = spark.read.format(fmt)
    return (reader.schema(schemas.CONNECTION) if fmt == "json" else reader).load(path)


def read_connection_state(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schemas.CONNECTION_STATE) if fmt == "json" else reader).load(path)


def stream_messages_from_files(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Messages landed as JSON lines ``{topic, key, value, ts, seq}``; ``value`` is the message text."""
    schema = "topic string, key string, value string, ts timestamp, seq bigint"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def stream_messages_from_kafka(
    spark: SparkSession, servers: str, topics: list[str], max_offsets: int = 100_000, starting: str = "latest"
) -> DataFrame:
    """Messages from a log; needs the Kafka connector on the cluster. The query's checkpoint takes the place of
    offset commits."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_offsets)
        .option("includeHeaders", "true")
        .load()
        .select(
            "topic",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "headers",
            F.col("timestamp").alias("ts"),
            F.col("offset").alias("seq"),
        )
    )
