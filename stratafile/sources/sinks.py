"""Sinks for records, errors, state and the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_by_connection(records: DataFrame, key: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """All records of a connection in one partition and in order, as a keyed log needs them.

    Use it only where a consumer relies on the order: a connection that owns a third of the records becomes one large
    (but streamed, spillable) partition. ``write_records`` does not need it.
    """
    shuffled = records.repartition(partitions, key) if partitions else records.repartition(key)
    return shuffled.sortWithinPartitions(key, *order)


def write_records(records: DataFrame, path: str, buckets: int = 256, mode: str = "append") -> None:
    """Records as parquet under a bounded number of key buckets, so many connections make no small files; inside a
    bucket the rows of a hot connection may span several files."""
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))
    records.withColumn("key_bucket", bucket).write.mode(mode).partitionBy("key_bucket").parquet(path)


def write_records_to_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """``key, value, headers`` to a log; the log's own key hashing keeps a connection's order."""
    headers = F.transform(
        F.map_entries("headers"), lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value"))
    )
    (
        records.select("key", "value", headers.alias("headers"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .save()
    )


def write_errors(errors: DataFrame, path: str, mode: str = "append") -> None:
    """Error rows partitioned by type: retriable rows feed the retry queue, terminal rows are the dead letters."""
    errors.write.mode(mode).partitionBy("error_type").parquet(path)


def write_state(state: DataFrame, path: str) -> None:
    """A new version of the state table; readers of the older version are not disturbed if ``path`` is versioned."""
    state.write.mode("overwrite").parquet(path)


def write_blobs(blobs: DataFrame, path: str) -> None:
    """Blob bytes with their storage path; one row per stored blob."""
    blobs.select("storage_path", "content").write.mode("append").parquet(path)


def publish_manifest(manifest: DataFrame, path: str, mock: bool = False) -> bool:
    """Write the manifest as JSON; nothing is written in mock mode or without a path."""
    if mock or not path:
        return False
    manifest.write.mode("overwrite").json(path)
    return True
