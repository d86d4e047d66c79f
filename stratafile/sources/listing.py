"""File listings, single files, children and content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile import schemas
from stratafile.functions import scalars as S
from stratafile.operators.filters import all_of


def read_list_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed listing pages as text, one JSON page per line, with ``connection_id`` and ``page_no`` from the path
    layout ``connection_id=.../page_no=...`` where it exists."""
    return spark.read.text(path).withColumnRenamed("value", "page_json")


def explode_list_pages(pages: DataFrame, keep: tuple[str, ...] = ("connection_id", "page_no")) -> DataFrame:
    """One row per file of a page, with its position, the page size and whether it ends the listing.

    The page itself gives the position, so no window and no shuffle is needed.
    """
    parsed = pages.withColumn("_page", F.from_json("page_json", schemas.LIST_PAGE))
    token = F.col("_page.nextPageToken")
    return parsed.select(
        *keep,
        token.alias("next_page_token"),
        F.size("_page.files").alias("_count"),
        F.posexplode("_page.files").alias("_pos", "raw_json"),
    ).select(
        *keep,
        "raw_json",
        F.col("_pos").cast("bigint").alias("batch_sequence"),
        ((F.col("_pos") + 1 == F.col("_count")) & F.col("next_page_token").isNull()).alias("batch_is_last"),
        "next_page_token",
        F.col("_count").cast("bigint").alias("page_files"),
    )


def empty_list_pages(pages: DataFrame, keep: tuple[str, ...] = ("connection_id", "page_no")) -> DataFrame:
    """Pages without any file."""
    parsed = pages.withColumn("_page", F.from_json("page_json", schemas.LIST_PAGE))
    files = F.coalesce(F.size("_page.files"), F.lit(0))
    return parsed.where(files <= 0).select(*keep, F.col("_page.nextPageToken").alias("next_page_token"))


def list_files(files: DataFrame, *conditions: Column | None, include_trashed: bool = False) -> DataFrame:
    """Listing over normalized files: the caller's predicates and, unless asked otherwise, no trashed rows."""
    trashed = None if include_trashed else ~F.coalesce(F.col("trashed"), F.lit(False))
    condition = all_of(*conditions, trashed)
    return files if condition is None else files.where(condition)


def get_file(files: DataFrame, file_id: str) -> DataFrame:
    return files.where(F.col("id") == file_id)


def embedded_permissions(files: DataFrame, raw_json: str = "raw_json") -> DataFrame:
    """The ``permissions`` arrays of a listing as one raw permission per row."""
    permissions = F.from_json(raw_json, "permissions array<string>")["permissions"]
    return files.select("file_id", "connection_id", "customer_id", F.explode(permissions).alias("raw_json"))


def embedded_revisions(files: DataFrame, raw_json: str = "raw_json") -> DataFrame:
    revisions = F.from_json(raw_json, "revisions array<string>")["revisions"]
    return files.select("file_id", "connection_id", "customer_id", F.explode(revisions).alias("raw_json"))


def read_about(spark: SparkSession, path: str) -> DataFrame:
    return parse_about(spark.read.text(path).withColumnRenamed("value", "about_json"))


def parse_about(rows: DataFrame) -> DataFrame:
    """Account rows: user and storage quota; quota values arrive as numeric text."""
    schema = (
        "user struct<displayName: string, emailAddress: string>, "
        "storageQuota struct<limit: string, usage: string, usageInDrive: string>"
    )
    about = F.from_json("about_json", schema)
    keep = [c for c in rows.columns if c != "about_json"]
    return rows.withColumn("_about", about).select(
        *keep,
        F.col("_about.user.emailAddress").alias("email"),
        F.col("_about.user.displayName").alias("display_name"),
        F.col("_about.storageQuota.limit").try_cast("bigint").alias("quota_limit"),
        F.col("_about.storageQuota.usage").try_cast("bigint").alias("quota_usage"),
    )


def read_content(spark: SparkSession, path: str) -> DataFrame:
    """Landed content files as ``file_id`` (file name without its extension), bytes and length."""
    name = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return spark.read.format("binaryFile").load(path).select(name.alias("file_id"), "content", "length")


def revision_page_size(requested: Column) -> Column:
    return S.clamp_page_size(requested, maximum=S.MAX_REVISION_PAGE)
