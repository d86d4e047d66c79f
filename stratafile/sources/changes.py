"""Change feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile import schemas
from stratafile.config import DriveConfig
from stratafile.functions.scalars import blank_to_null
from stratafile.operators import quality as Q


def read_change_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed change pages as text; partition columns of the path come along."""
    return spark.read.text(path).withColumnRenamed("value", "page_json")


def stream_change_pages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The same pages as a stream; the checkpoint holds the position in the feed."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files).format("text").load(path).withColumnRenamed(
            "value", "page_json"
        )
    )


def explode_change_pages(pages: DataFrame, keep: tuple[str, ...] = ("connection_id", "page_no")) -> DataFrame:
    """One row per change in feed order (``page_no``, ``seq``), with both tokens of its page."""
    parsed = pages.withColumn("_page", F.from_json("page_json", schemas.CHANGE_PAGE))
    return parsed.select(
        *keep,
        F.col("_page.nextPageToken").alias("next_page_token"),
        F.col("_page.newStartPageToken").alias("new_start_page_token"),
        F.posexplode("_page.changes").alias("_pos", "_change"),
    ).select(
        *keep,
        F.col("_pos").cast("bigint").alias("seq"),
        F.col("_change.file").alias("file"),
        F.col("_change.fileId").alias("file_id"),
        F.coalesce(F.col("_change.removed"), F.lit(False)).alias("removed"),
        F.coalesce(F.col("_change.changeType"), F.lit("file")).alias("change_type"),
        F.col("_change.time").alias("time"),
        "next_page_token",
        "new_start_page_token",
    )


def start_tokens(responses: DataFrame) -> DataFrame:
    """Answers to the question for a start token (``connection_id, token_json``) as ``connection_id, start_token``; the token
    is null where the answer has none, an empty one or is no object."""
    token = F.get_json_object("token_json", "$.startPageToken")
    return responses.select("connection_id", blank_to_null(token).alias("start_token"))


def missing_start_tokens(tokens: DataFrame, cfg: DriveConfig) -> DataFrame:
    """Terminal errors of the connections that got no start token: asking again would not help, so they can't begin."""
    return Q.error_records(
        tokens.where(F.col("start_token").isNull()), cfg, F.lit("TerminalError"), F.lit("the API gave no start token"),
        F.col("connection_id"),
    )


def start_cursors(changes: DataFrame) -> DataFrame:
    """Start of feed per connection: only changes after the newest page are new."""
    return changes.groupBy("connection_id").agg((F.max("page_no") + 1).alias("start_cursor"))
