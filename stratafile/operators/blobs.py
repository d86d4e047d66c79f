"""Content-addressed blobs and the inline/offload split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafile.functions import scalars as S


def content_refs(content: DataFrame, mock: bool = False) -> DataFrame:
    """Hash, size and storage path of each file's content. Input ``customer_id, file_id, content`` (text or bytes);
    the content itself goes no further."""
    digest = S.sha256_hex(F.col("content"))
    path = S.mock_blob_path if mock else S.blob_path
    return content.select(
        "customer_id",
        "file_id",
        digest.alias("sha256"),
        F.octet_length("content").cast("bigint").alias("size_bytes"),
        path(F.col("customer_id"), digest).alias("storage_path"),
    )


def blob_index(refs: DataFrame) -> DataFrame:
    """One row per stored blob: the same bytes of a customer are stored once. A plain aggregate, combined before the
    shuffle, so a hash that many files share costs one row per task."""
    return refs.groupBy("customer_id", "sha256").agg(
        F.min("storage_path").alias("storage_path"),
        F.max("size_bytes").alias("size_bytes"),
        F.min("file_id").alias("first_file_id"),
        F.count("*").alias("ref_count"),
    )


def blobs_to_store(content: DataFrame, index: DataFrame) -> DataFrame:
    """The bytes to write: content of the first file of each blob only."""
    first = index.select("customer_id", F.col("first_file_id").alias("file_id"), "storage_path")
    return content.join(first, ["customer_id", "file_id"])


def blob_savings(refs: DataFrame) -> DataFrame:
    """Bytes before and after deduplication per customer."""
    return (
        blob_index(refs)
        .groupBy("customer_id")
        .agg(
            F.sum("ref_count").alias("files"),
            F.count("*").alias("blobs"),
            F.sum(F.col("size_bytes") * F.col("ref_count")).alias("bytes_before"),
            F.sum("size_bytes").alias("bytes_after"),
        )
        .withColumn("bytes_saved", F.col("bytes_before") - F.col("bytes_after"))
    )


def offload_split(
    df: DataFrame, payload: str, bucket_url: str, threshold: int = S.OFFLOAD_THRESHOLD
) -> DataFrame:
    """Payloads strictly above the threshold leave ``data`` null and name where they are stored; what to store there is
    in :func:`payloads_to_store`.

    Input ``customer_id, connection_id, message_id`` and the payload column.
    """
    large = S.exceeds_threshold(F.col(payload), threshold)
    key = S.payload_key(F.col("customer_id"), F.col("connection_id"), F.col("message_id"))
    return df.select(
        "customer_id",
        "connection_id",
        "message_id",
        F.when(~large, F.col(payload)).alias("data"),
        F.when(large, F.concat(F.lit(bucket_url.rstrip("/") + "/"), key)).alias("s3_url"),
        F.when(large, S.sha256_hex(F.col(payload))).alias("sha256"),
        F.octet_length(payload).cast("bigint").alias("payload_size_bytes"),
        large.alias("offloaded"),
    )


def payloads_to_store(
    df: DataFrame, payload: str, bucket_url: str, threshold: int = S.OFFLOAD_THRESHOLD
) -> DataFrame:
    """The payloads that :func:`offload_split` takes out of their records: ``storage_path`` and ``content``, as
    ``sinks.write_blobs`` writes them."""
    key = S.payload_key(F.col("customer_id"), F.col("connection_id"), F.col("message_id"))
    return df.where(S.exceeds_threshold(F.col(payload), threshold)).select(
        F.concat(F.lit(bucket_url.rstrip("/") + "/"), key).alias("storage_path"), F.col(payload).alias("content")
    )
