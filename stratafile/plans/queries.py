"""Registered queries: operators over the derived inputs, flattened to primitive columns."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile.config import DriveConfig
from stratafile.functions import mime as M
from stratafile.functions import scalars as S
from stratafile.functions.presence import compute_once
from stratafile.operators import blobs as B
from stratafile.operators import commands as C
from stratafile.operators import dedup as D
from stratafile.operators import envelope as E
from stratafile.operators import filters as X
from stratafile.operators import joins as J
from stratafile.operators import messages as MSG
from stratafile.operators import metrics as A
from stratafile.operators import normalize as P
from stratafile.operators import quality as Q
from stratafile.operators import retry as RT
from stratafile.operators import state as ST
from stratafile.operators import windows as W
from stratafile.plans import handlers as H
from stratafile.plans import inputs as I
from stratafile.plans import resources as R
from stratafile.session import shared_folder
from stratafile.sources import catalog as CAT
from stratafile.sources import changes as SC
from stratafile.sources import listing as SL
from stratafile.sources import sinks as SK
from stratafile.sources.blob_store import BlobStore
from stratafile.sources.manifest import capability_manifest
from stratafile.sources.state_table import StateTable
from stratafile.streaming import commits as SCM
from stratafile.streaming import loop as SL_
from stratafile.streaming import ordered as SO
from stratafile.streaming import pipeline as SP
from stratafile.streaming import stateful as SS

CFG = DriveConfig()
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Thresholds lowered so that the small test tables reach them.
OFFLOAD_BYTES = 8192
RECORD_BYTES = 1500
QUOTA_LIMIT = 1
TTL_SECONDS = 864_000
PAGE_TTL_SECONDS = 3600
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def big(column: Column) -> Column:
    return column.cast("bigint")


def micros(name: str) -> Column:
    return F.unix_micros(name)


def owners_text(owners: str = "owners") -> Column:
    return F.array_join(
        F.transform(
            owners,
            lambda o: F.concat(
                F.coalesce(o["name"], F.lit("-")), F.lit("<"), F.coalesce(o["email"], F.lit("-")), F.lit(">")
            ),
        ),
        ";",
    )


# --- files -----------------------------------------------------------------------------------------------------


@query("P01_normalize_files")
def normalize_files(spark: SparkSession, sf: str) -> DataFrame:
    files = R.good_files(I.raw_files(spark, sf), CFG)
    return files.select(
        "id", "type", "name", "mime_type", "category", "is_folder", "is_google_workspace", "needs_export",
        "export_format", "file_extension", "size_bytes", "web_view_link", "thumbnail_link",
        F.array_join("parent_ids", ",").alias("parents"),
        owners_text().alias("owners"),
        F.col("last_modified_by.name").alias("modified_by"),
        F.col("capabilities.can_edit").alias("can_edit"),
        F.col("capabilities.can_move").alias("can_move"),
        F.col("capabilities.can_delete").alias("can_delete"),
        "trashed", "starred", "explicitly_trashed", "shared", "viewed_by_me",
        F.col("timestamps.created_at").alias("created_at"),
        F.col("timestamps.modified_at").alias("modified_at"),
        F.col("timestamps.viewed_by_me_at").alias("viewed_by_me_at"),
        F.col("timestamps.shared_with_me_at").alias("shared_with_me_at"),
        F.col("timestamps.trashed_at").alias("trashed_at"),
        "quota_bytes_used", "version", "md5_checksum", "description", "folder_color_rgb",
        F.col("source.connection_id").alias("connection_id"),
        F.col("source.provider").alias("provider"),
        F.col("source.transformed_at").alias("transformed_at"),
        big(F.col("_metadata.original_field_count")).alias("field_count"),
        F.col("_metadata.has_permissions").alias("has_permissions"),
        F.col("_metadata.has_app_properties").alias("has_app_properties"),
        F.col("_metadata.has_properties").alias("has_properties"),
    )


@query("F04_mime_classify")
def mime_classify(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.fact(spark, sf, "files").select("id", F.col("mime_value").alias("mime_type"))
    mime = F.col("mime_type")
    return M.classify_by_dimension(rows).select(
        "id",
        "mime_type",
        M.category(mime).alias("category"),
        F.col("category").alias("category_by_join"),
        M.extension(mime).alias("extension"),
        M.export_format(mime).alias("export_format"),
        M.is_native(mime).alias("is_native"),
        M.needs_export(mime).alias("needs_export"),
        M.native_name(mime).alias("native_name"),
        X.read_mode(mime).alias("read_mode"),
    )


@query("P06_quarantine")
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = P.split_bad_rows(P.normalize_files(I.raw_files(spark, sf), CFG))
    return bad.select("id", "bad_row_reason")


@query("P05_light_normalize")
def light_normalize(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.light_normalize_files(I.raw_files(spark, sf))
    return rows.select(
        "id", "name", "mime_type", "created_at", "modified_at", "size_bytes", "web_view_link",
        F.array_join("parents", ",").alias("parents"), "trashed", "type",
        F.col("owner.email").alias("owner_email"), F.col("owner.name").alias("owner_name"),
        big(F.col("permissions_count")).alias("permissions_count"), "bad_row_reason",
    )


@query("P16_render_text")
def render_text(spark: SparkSession, sf: str) -> DataFrame:
    return R.good_files(I.raw_files(spark, sf), CFG).select("id", E.render_text().alias("text"))


@query("P17_metadata")
def metadata(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.good_files(I.raw_files(spark, sf), CFG).select(E.metadata_struct().alias("m")).select("m.*")
    return rows.withColumn("parent_ids", F.array_join("parent_ids", ",")).withColumn("owners", owners_text())


@query("Q01_fetch_files")
def fetch_files(spark: SparkSession, sf: str) -> DataFrame:
    rows = _fetched(spark, sf)
    p = "header.parameters."
    return rows.select(
        "connection_id",
        F.col("metadata.drive_id").alias("id"),
        "nonce",
        "page_no",
        F.col(p + "batch_sequence").alias("batch_sequence"),
        F.col(p + "batch_is_last").alias("batch_is_last"),
        F.col(p + "batch_page_token").alias("batch_page_token"),
        F.col(p + "space_path").alias("space_path"),
        F.col(p + "batch_id").alias("batch_id"),
        F.get(F.col("header.to_addresses"), F.lit(0))["topic_key"].alias("topic_key"),
        F.length(F.get(F.col("contents"), F.lit(0))["text"]).cast("bigint").alias("text_chars"),
    )


def _fetched(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes of the fetch path; connections that own many files are spread."""
    raw = I.raw_files(spark, sf)
    return R.fetch_files(raw, I.connections(spark, sf), CFG, hot=J.hot_keys(raw, "connection_id"))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """One fetch request per connection."""
    return I.fact(spark, sf, "connections").select(
        F.concat(F.lit("req_"), "connection_id").alias("request_id"),
        "connection_id",
        "customer_id",
        "snowball_id",
        F.lit("files").alias("resource_type"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit("more")).alias("next_page_token"),
        F.lit("2024-01-01T00:00:00Z").cast("timestamp").alias("started_at"),
        F.timestamp_micros(F.lit(1704067200000000) + F.col("c_custkey") * 1500).alias("ended_at"),
    )


@query("X07_missing_space")
def missing_space(spark: SparkSession, sf: str) -> DataFrame:
    return R.missing_space(_requests(spark, sf).drop("snowball_id"), I.connections(spark, sf))


@query("P19_empty_batch")
def empty_batch(spark: SparkSession, sf: str) -> DataFrame:
    files = X.apply_filters(R.good_files(I.raw_files(spark, sf), CFG), X.not_trashed())
    with_files = files.select(F.concat(F.lit("req_"), "connection_id").alias("request_id")).distinct()
    requests = _requests(spark, sf).where(X.has_space())
    return E.empty_batches(requests, with_files, CFG)


@query("S01_list_pages")
def list_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Landed listing pages (at most 100 files each) read back as files with their position."""
    files = I.raw_files(spark, sf).withColumn("page_no", F.floor(F.col("doc_id") / 100).cast("bigint"))
    pages = files.groupBy("connection_id", "page_no").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "raw_json"))).alias("rows")
    )
    token = F.when(F.col("page_no") % 2 == 0, F.concat(F.lit(',"nextPageToken":"n'), F.col("page_no").cast("string"), F.lit('"')))
    body = F.array_join(F.transform("rows", lambda r: r["raw_json"]), ",")
    landed = pages.select(
        "connection_id",
        "page_no",
        F.concat(F.lit('{"files":['), body, F.lit("]"), F.coalesce(token, F.lit("")), F.lit("}")).alias("page_json"),
    )
    return SL.explode_list_pages(landed).select(
        "connection_id", "page_no", F.get_json_object("raw_json", "$.id").alias("id"), "batch_sequence", "batch_is_last",
        "next_page_token", "page_files",
    )


@query("S04_file_lookup")
def file_lookup(spark: SparkSession, sf: str) -> DataFrame:
    files = R.good_files(I.raw_files(spark, sf), CFG).select("id", "name", "type")
    wanted = I.base(spark, sf, "orders").select(F.concat(F.lit("f"), "o_custkey").alias("id"))
    return R.lookup(files, wanted, ["id"])


@query("S04_catalog_lookup")
def catalog_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The same lookup in a catalog laid out for it."""
    files = R.good_files(I.raw_files(spark, sf), CFG).select("id", "name", "type")
    path = f"{shared_folder(spark).rstrip('/')}/catalog-{uuid.uuid4().hex}"
    CAT.write_catalog(files, path)
    return CAT.lookup(spark, path, I.base(spark, sf, "orders").select(F.concat(F.lit("f"), "o_custkey").alias("id")))


@query("Q03_folders")
def folders(spark: SparkSession, sf: str) -> DataFrame:
    files = R.good_files(I.raw_files(spark, sf), CFG)
    contents = R.folder_contents(X.apply_filters(files, X.not_trashed())).withColumnRenamed("parent_id", "id")
    return (
        R.folders(files)
        .select("id", "name", F.array_join("parent_ids", ",").alias("parents"))
        .join(contents, "id", "left")
    )


@query("X21_file_filters")
def file_filters(spark: SparkSession, sf: str) -> DataFrame:
    files = R.good_files(I.raw_files(spark, sf), CFG)
    in_folder = SL.list_files(files, X.in_folder("f26"))
    by_type = SL.list_files(files, X.of_mime("text/plain"), include_trashed=True)
    folder_only = SL.list_files(files, X.wanted_type(F.col("is_folder"), F.lit(False), F.lit(True)))
    nothing = SL.list_files(files, X.wanted_type(F.col("is_folder"), F.lit(False), F.lit(False)))
    parts = [("folder", in_folder), ("mime", by_type), ("folders_only", folder_only), ("nothing", nothing)]
    return E.union_paths(*[df.select(F.lit(name).alias("filter"), "id") for name, df in parts])


@query("X23_predicates")
def predicates(spark: SparkSession, sf: str) -> DataFrame:
    files = R.good_files(I.raw_files(spark, sf), CFG).withColumn("modified_at", F.col("timestamps.modified_at"))
    combined = X.all_of(
        X.modified_after("2024-02-10T10:00:00Z"), F.col("category") == "document", X.not_trashed()
    )
    return files.where(combined | X.owned_by("c7@example.com")).select("id", "mime_type", owners_text().alias("owners"))


@query("X11_content_eligibility")
def content_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    files = R.good_files(I.raw_files(spark, sf), CFG).select("customer_id", "id", "mime_type", "size_bytes")
    declared = compute_once(
        files.withColumnRenamed("id", "file_id"), declared=X.skip_reason(F.col("mime_type"), F.col("size_bytes"))
    )
    refs = B.content_refs(I.content(spark, sf)).select("file_id", F.col("size_bytes").alias("content_bytes"), "sha256")
    both = J.with_content(declared, refs, F.col("declared").isNull()).withColumnRenamed("file_id", "id")
    reason = X.skip_reason(F.col("mime_type"), F.col("size_bytes"), F.col("content_bytes"), 52_428_800)
    return both.select(
        "id", reason.alias("skip_reason"), X.read_mode(F.col("mime_type")).alias("read_mode"), "content_bytes", "sha256"
    )


@query("A15_inventory")
def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return A.inventory(R.good_files(I.raw_files(spark, sf), CFG))


@query("A05_page_sizes")
def page_sizes(spark: SparkSession, sf: str) -> DataFrame:
    files = X.apply_filters(R.good_files(I.raw_files(spark, sf), CFG), X.not_trashed()).select("connection_id", "id")
    paged = W.assign_pages(files, ["connection_id"], ["id"], 20)
    return paged.groupBy("connection_id", "page_no").agg(
        F.count("*").alias("files"), F.max("next_page_token").alias("next_page_token")
    )


# --- children --------------------------------------------------------------------------------------------------


@query("P02_revisions")
def revisions(spark: SparkSession, sf: str) -> DataFrame:
    files = R.good_files(I.raw_files(spark, sf), CFG).select(F.col("id").alias("file_id"), F.col("name").alias("file_name"))
    keep = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = R.revisions(I.raw_revisions(spark, sf), files, CFG, keep=keep)
    return rows.select(
        "file_id", "id", "file_name", "keep_forever", "published", "publish_auto", "size_bytes",
        F.col("last_modified_by.name").alias("user_name"), F.col("last_modified_by.email").alias("user_email"),
        F.col("timestamps.modified_at").alias("modified_at"),
        big(F.coalesce(F.size("export_links"), F.lit(0))).alias("links"),
        F.try_element_at("export_links", F.lit("application/pdf")).alias("pdf_link"),
        big(F.col("l_partkey")).alias("part"),
    )


@query("N06_last_revisions")
def last_revisions(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.fact(spark, sf, "revisions")
    order = [
        F.col("l_shipdate").desc(), F.col("revision_no").desc(), F.col("l_partkey"), F.col("l_suppkey"),
        F.col("l_extendedprice"),
    ]
    return W.last_n(rows, ["file_id"], order, 3).select(
        "file_id", "revision_no", "l_partkey", "l_suppkey", big(F.col("rank")).alias("rank")
    )


@query("P03_permissions")
def permissions(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.normalize_permissions(I.raw_permissions(spark, sf), CFG)

    def details(name: str, kind: str) -> Column:
        return F.array_join(
            F.transform(
                name,
                lambda d: F.concat(d[kind], F.lit("/"), d["role"], F.lit("/"), d["inherited"].cast("string")),
            ),
            ";",
        ).alias(name)

    return rows.select(
        "file_id", "id", "permission_type", "role", "display_name", "email_address", "domain", "allow_file_discovery",
        "deleted", "pending_owner", "expiration_time", details("permission_details", "permission_type"),
        details("team_drive_permission_details", "team_drive_permission_type"), "bad_row_reason",
    )


@query("Q05_permissions")
def file_permissions(spark: SparkSession, sf: str) -> DataFrame:
    """Permission rows of existing files."""
    files = R.good_files(I.raw_files(spark, sf), CFG).select(F.col("id").alias("file_id"), F.col("name").alias("file_name"))
    return R.permissions(I.raw_permissions(spark, sf), files, CFG).select("file_id", "id", "file_name", "permission_type", "role")


@query("Q06_permission")
def permission_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Single permissions by file and id, for every key that the write commands name."""
    good, _ = P.split_bad_rows(P.normalize_permissions(I.raw_permissions(spark, sf), CFG))
    wanted = I.write_commands(spark, sf).select(F.col("payload.file_id").alias("file_id"), F.col("payload.permission_id").alias("id"))
    wanted = wanted.where("file_id is not null and id is not null")
    return R.lookup(good.select("file_id", "id", "role"), wanted, ["file_id", "id"])


@query("Q08_revision")
def revision_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Single revisions by file and id: the first two of every file in the catalog."""
    files = D.stored_once(R.good_files(I.raw_files(spark, sf), CFG).select(F.col("id").alias("file_id")))
    # revisions of other files are not parsed
    asked = I.raw_revisions(spark, sf).join(files, "file_id", "left_semi")
    good, _ = P.split_bad_rows(P.normalize_revisions(asked, CFG))
    wanted = files.select("file_id", F.explode(F.array(F.lit("1"), F.lit("2"))).alias("id"))
    return R.lookup(good.select("file_id", "id", "keep_forever"), wanted, ["file_id", "id"])


@query("Q04_folder")
def folder_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Single folders by id, for every parent that a file names."""
    files = R.good_files(I.raw_files(spark, sf), CFG)
    wanted = files.select(F.explode("parent_ids").alias("id"))
    return R.lookup(R.folders(files, include_trashed=True).select("id", "name"), wanted, ["id"])


@query("Q05_permission_counts")
def permission_counts(spark: SparkSession, sf: str) -> DataFrame:
    files = R.good_files(I.raw_files(spark, sf), CFG).select(F.col("id").alias("file_id"))
    return R.permission_counts(I.raw_permissions(spark, sf), files, CFG)


@query("S06_embedded_permissions")
def embedded_permissions(spark: SparkSession, sf: str) -> DataFrame:
    raw = SL.embedded_permissions(I.raw_files(spark, sf))
    return P.normalize_permissions(raw, CFG).select("file_id", "id", "permission_type", "role", "display_name")


@query("P04_comments")
def comments(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.normalize_comments(I.raw_comments(spark, sf), CFG)
    replies = F.array_join(
        F.transform(
            "replies",
            lambda r: F.concat_ws(
                "/", r["id"], F.md5(r["content"]), r["deleted"].cast("string"), r["author"]["name"],
                r["timestamps"]["created_at"],
            ),
        ),
        ";",
    )
    return rows.select(
        "id", "file_id", F.md5("content").alias("content_md5"), "resolved", "deleted",
        F.col("author.name").alias("author_name"), F.col("author.email").alias("author_email"),
        F.col("timestamps.created_at").alias("created_at"), replies.alias("replies"),
        big(F.col("reply_count")).alias("reply_count"),
    )


@query("A12_reply_counts")
def reply_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.reply_counts(I.fact(spark, sf, "comments"))
    return rows.select("comment_id", "reply_count", big(F.col("reply_chars")).alias("reply_chars"), "last_reply_author")


@query("A12_assembled_replies")
def assembled_replies(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.assemble_replies(I.fact(spark, sf, "comments"), chunk=3)
    text = F.array_join(F.transform("replies", lambda r: F.concat(r["author"], F.lit(":"), F.md5(r["content"]))), ";")
    return rows.select("comment_id", "chunk", text.alias("replies"), big(F.col("reply_count")).alias("reply_count"))


@query("P15_reply_rows")
def reply_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.comment_reply_rows(I.fact(spark, sf, "comments"))
    return rows.select("comment_id", "reply_no", "author", F.md5("content").alias("content_md5"))


# --- change feed -----------------------------------------------------------------------------------------------


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    return I.changes(spark, sf).withColumn("page_token", F.concat(F.lit("p/"), F.col("page_no").cast("string")))


def _change_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Landed change pages: the feed's own pages (at most 100 changes) as JSON text."""
    rows = I.change_rows(spark, sf)
    item = F.struct(
        "seq",
        F.struct(
            F.col("file_id").alias("fileId"), "removed", F.col("change_type").alias("changeType"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
            F.when(F.col("file_state") == "file", F.struct(F.col("file_id").alias("id"))).alias("file"),
        ).alias("c"),
    )
    pages = rows.groupBy("connection_id", "page_no").agg(F.sort_array(F.collect_list(item)).alias("items"))
    page = F.struct(
        F.transform("items", lambda i: i["c"]).alias("changes"),
        F.concat(F.lit("p/"), (F.col("page_no") + 1).cast("string")).alias("nextPageToken"),
        F.concat(F.lit("s/"), F.col("page_no").cast("string")).alias("newStartPageToken"),
    )
    return pages.select("connection_id", "page_no", F.to_json(page).alias("page_json"))


@query("S02_change_feed")
def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    return SC.explode_change_pages(_change_pages(spark, sf)).select(
        "connection_id", "page_no", "seq", "file_id", "removed", "change_type", "time",
        F.get_json_object("file", "$.id").alias("embedded_id"), "next_page_token", "new_start_page_token",
    )


@query("S03_start_cursors")
def start_cursors(spark: SparkSession, sf: str) -> DataFrame:
    return SC.start_cursors(I.change_rows(spark, sf))


@query("S03_start_tokens")
def start_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Start tokens, and the terminal errors of connections that got none."""
    tokens = SC.start_tokens(I.start_token_responses(spark, sf))
    errors = SC.missing_start_tokens(tokens, CFG).select("connection_id", "error_type", "error_code", "error_category", "error_message")
    return tokens.where("start_token IS NOT NULL").unionByName(errors, allowMissingColumns=True)


@query("N05_cursors")
def cursors(spark: SparkSession, sf: str) -> DataFrame:
    pages = (
        I.change_rows(spark, sf)
        .groupBy("connection_id", "page_no")
        .agg(F.concat(F.lit("s/"), F.max("seq").cast("string")).alias("new_start_page_token"))
    )
    return R.new_cursors(pages, CFG).select("connection_id", "key", "value", F.col("seq").alias("last_page"))


@query("Q09_changes")
def changes(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.changes(
        I.change_rows(spark, sf), _cursors(spark, sf), SC.start_cursors(I.change_rows(spark, sf)),
        include_removed=False, restrict_to_my_drive=True,
    )
    return rows.select("connection_id", "page_no", "seq", "file_id", "change_type", "shared_drive")


def _cursors(spark: SparkSession, sf: str) -> DataFrame:
    state = I.state_rows(spark, sf)
    none = state.limit(0)
    return ST.cursors(ST.upsert_state(state, none), CFG)


@query("X15_webhook_outcomes")
def webhook_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.webhook_outcomes(I.webhook_messages(spark, sf), I.connections(spark, sf), CFG)
    return rows.select(
        "message_id", "outcome", "error", "resolution_error", "page_token", "email", "message_connection_id",
        F.when(F.col("error").isNull(), F.col("connection_id")).alias("connection_id"),
        F.when(F.col("error").isNull(), F.col("customer_id")).alias("customer_id"),
    )


@query("T11_resolution_as_of")
def resolution_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Notifications resolved by the connections as they were when each one came."""
    parsed = MSG.parse_webhooks(I.webhook_messages(spark, sf)).where("error IS NULL")
    asked = parsed.select("seq", "ts", "message_id", "message_connection_id", "message_customer_id", "email")
    rows = J.resolve_connections_as_of(asked, I.connection_versions(spark, sf))
    return rows.select(
        "seq", "message_id", "message_connection_id", "email", "connection_id", "customer_id", "snowball_id",
        F.col("settings.sync_files").alias("sync_files"), "resolution_error", "version_seq",
    )


@query("Q13_webhook_changes")
def webhook_changes(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.webhook_changes(I.webhook_messages(spark, sf), I.connections(spark, sf), _feed(spark, sf), CFG)
    p = "header.parameters."
    return rows.select(
        "connection_id", "seq", "nonce", F.col(p + "batch_sequence").alias("batch_sequence"),
        F.col(p + "batch_is_last").alias("batch_is_last"), F.col(p + "batch_page_token").alias("page_token"),
        F.col(p + "customer_id").alias("customer_id"), F.col(p + "space_path").alias("space_path"),
        F.col(p + "source").alias("source"), F.col(p + "change_type").alias("change_type"),
        F.col(p + "batch_id").alias("batch_id"),
    )


@query("A03_change_summary")
def change_summary(spark: SparkSession, sf: str) -> DataFrame:
    outcomes = R.webhook_outcomes(I.webhook_messages(spark, sf), I.connections(spark, sf), CFG)
    rows = R.webhook_page_rows(R.page_requests(outcomes), _feed(spark, sf), CFG)
    return A.change_batch_summary(rows, ["connection_id", "page_token", "notifications"], F.col("yielded"))


@query("Q11_full_sync")
def full_sync(spark: SparkSession, sf: str) -> DataFrame:
    sizes = B.content_refs(I.content(spark, sf)).select("file_id", "size_bytes")
    files = I.raw_files(spark, sf).withColumn("shared_drive", F.col("doc_id") % 6 == 1)
    return _flat_sync(R.full_sync(files, I.connections(spark, sf), CFG, sizes))


def _flat_sync(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(
        *keep, "integration_connection_id", "customer_id", "resource_type", "resource_id", "idempotency_key",
        F.col("data.name").alias("name"), F.col("data.size_bytes").alias("size_bytes"),
        F.col("data.owner.email").alias("owner_email"),
        F.col("metadata.trigger_type").alias("trigger_type"), F.col("metadata.change_type").alias("change_type"),
        F.col("metadata.has_content").alias("has_content"),
        F.col("metadata.content_size_bytes").alias("content_size_bytes"),
    )


@query("Q12_incremental")
def incremental(spark: SparkSession, sf: str) -> DataFrame:
    sizes = B.content_refs(I.content(spark, sf)).select("file_id", "size_bytes")
    hot = J.hot_keys(I.change_rows(spark, sf), "connection_id", share=0.2, fraction=0.2)
    starts = SC.start_cursors(I.change_rows(spark, sf))
    rows = R.incremental_sync(_feed(spark, sf), I.connections(spark, sf), _cursors(spark, sf), starts, CFG, sizes, hot=hot)
    return _flat_sync(rows, "page_no", "seq")


@query("A04_sync_progress")
def sync_progress(spark: SparkSession, sf: str) -> DataFrame:
    return R.sync_progress(I.change_rows(spark, sf))


@query("N08_latest_change")
def latest_change(spark: SparkSession, sf: str) -> DataFrame:
    return W.latest_by(
        I.change_rows(spark, sf), ["file_id"], ["page_no", "seq"],
        ["seq", "page_no", "removed", "change_type", "connection_id"],
    )


@query("J09_live_files")
def live_files(spark: SparkSession, sf: str) -> DataFrame:
    latest = W.latest_by(I.change_rows(spark, sf), ["file_id"], ["page_no", "seq"], ["removed"])
    files = R.good_files(I.raw_files(spark, sf), CFG)
    return J.live_files(files, latest).select("id", "name", "category")


@query("J09_tombstones")
def tombstones(spark: SparkSession, sf: str) -> DataFrame:
    return J.tombstones(W.latest_by(I.change_rows(spark, sf), ["file_id"], ["page_no", "seq"], ["removed"]))


# --- messages --------------------------------------------------------------------------------------------------


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    parsed = MSG.parse_messages(I.command_messages(spark, sf))
    return parsed.withColumn("message_id", F.coalesce("msg.message_id", "msg.id"))


@query("X13_validate_fetch")
def validate_fetch(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select(
        "message_id",
        MSG.fetch_error(CFG).alias("error_field"),
        F.coalesce(S.blank_to_null(MSG.param("resource_type")), F.lit("files")).alias("resource_type"),
        big(S.clamp_page_size(F.col("msg.params.pagination.max_results"))).alias("page_size"),
    )


@query("X14_validate_trigger")
def validate_trigger(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select("message_id", MSG.trigger_error().alias("error"))


@query("X16_validate_write")
def validate_write(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select("message_id", MSG.write_error(CFG).alias("error_field"))


@query("X17_validate_lifecycle")
def validate_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select(
        "message_id",
        MSG.lifecycle_error(CFG, "init").alias("init_error"),
        MSG.lifecycle_error(CFG, "teardown").alias("teardown_error"),
    )


@query("T01_routes")
def routes(spark: SparkSession, sf: str) -> DataFrame:
    rows = MSG.route_messages(I.command_messages(spark, sf), CFG)
    return rows.select("message_id", "route", "connection_id", "provider", "error_field")


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    rows = MSG.route_messages(I.command_messages(spark, sf), CFG)
    outcome = (
        F.when(F.col("route").isNull() | (F.col("route") == "skipped"), F.lit("skipped"))
        .when(F.col("error_field").isNotNull(), F.lit("terminal"))
        .otherwise(F.lit("ok"))
    )
    return rows.select(
        "route",
        outcome.alias("outcome"),
        F.when(outcome == "ok", F.lit(1)).otherwise(0).cast("bigint").alias("records"),
        F.lit(0).cast("bigint").alias("duplicates"),
        (F.col("seq") % 10 == 0).cast("bigint").alias("offloaded"),
        (F.col("seq") % 1000).alias("duration_ms"),
    )


@query("A01_worker_counters")
def worker_counters(spark: SparkSession, sf: str) -> DataFrame:
    rows = _outcomes(spark, sf).withColumn("route", F.coalesce("route", F.lit("none")))
    return A.worker_counters(rows, ["route"])


@query("J01_connection_enrich")
def connection_enrich(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col
    messages = _parsed(spark, sf).select(
        "message_id",
        MSG.connection_id_of().alias("connection_id"),
        MSG.customer_id_of().alias("message_customer_id"),
        m("msg.params.metadata.snowball_id").alias("msg_snowball_id"),
        m("msg.params.metadata.external_id").alias("msg_external_id"),
        m("msg.params.metadata.connection_config").alias("msg_connection_config"),
        m("msg.params.credentials.access_token").alias("msg_token"),
    )
    stored = I.connections(spark, sf).drop("settings", "display_name").withColumn(
        "connection_config", F.lit(None).cast("string")
    )
    joined = J.merge_init_metadata(J.with_connection(messages, stored))
    return joined.select(
        "message_id",
        "connection_id",
        "snowball_id",
        "external_id",
        "user_id",
        F.coalesce(S.blank_to_null(m("customer_id")), m("message_customer_id")).alias("customer_id"),
        J.teardown_credentials(m("msg_token"), m("access_token")).alias("access_token"),
    )


@query("K02_validation_errors")
def validation_errors(spark: SparkSession, sf: str) -> DataFrame:
    rows = MSG.route_messages(I.command_messages(spark, sf), CFG)
    return Q.validation_errors(rows, CFG, "error_field").select(
        "source_message_id", "connection_id", "customer_id", "error_type", "error_code", "error_category", "details"
    )


@query("K02_api_errors")
def api_errors(spark: SparkSession, sf: str) -> DataFrame:
    rows = Q.api_errors(I.calls(spark, sf), CFG, keep=("event_id",))
    return rows.select(
        "event_id", "connection_id", "error_type", "error_code", "error_category", "error_message", "details",
        big(F.col("retry_after")).alias("retry_after"),
    )


# --- dedup and blobs -------------------------------------------------------------------------------------------


def _nonce_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Records of the feed with their nonce; every 37th has none."""
    nonce = S.idempotency_key(CFG.provider, F.col("connection_id"), F.lit("file"), F.col("file_id"))
    return I.change_rows(spark, sf).select(
        "seq", "ts", "connection_id", F.when(F.col("seq") % 37 == 0, F.lit("")).otherwise(nonce).alias("nonce")
    )


@query("N07_dedup")
def dedup(spark: SparkSession, sf: str) -> DataFrame:
    """First record of each nonce; a blank nonce is none (U03 lets those rows pass)."""
    rows = _nonce_rows(spark, sf).where(F.col("nonce") != "")
    return D.first_by_key(rows, ["nonce"], ["seq"]).select("nonce", "seq")


@query("U03_dedup_blank")
def dedup_blank(spark: SparkSession, sf: str) -> DataFrame:
    return D.dedup_by_nonce(_nonce_rows(spark, sf), ["seq"]).select("nonce", "seq")


@query("A13_dedup_stats")
def dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    return D.dedup_stats(_nonce_rows(spark, sf), ["connection_id"])


@query("T02_ttl_dedup")
def ttl_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.change_rows(spark, sf).select("file_id", "ts", "seq")
    return D.ttl_dedup(rows, "file_id", "ts", "seq", TTL_SECONDS).select("file_id", "seq", micros("ts").alias("at_us"))


@query("T02_page_requests")
def page_requests(spark: SparkSession, sf: str) -> DataFrame:
    """The pages that notifications have fetched, again after each TTL."""
    outcomes = R.webhook_outcomes(I.webhook_messages(spark, sf), I.connections(spark, sf), CFG)
    return R.page_requests_within(outcomes, PAGE_TTL_SECONDS).select(
        "connection_id", "page_token", "notifications", micros("requested_at").alias("at_us"), "request_seq", "message_id",
        "customer_id", "snowball_id",
    )


@query("K03_blob_index")
def blob_index(spark: SparkSession, sf: str) -> DataFrame:
    return B.blob_index(B.content_refs(I.content(spark, sf)))


@query("K03_blob_runs")
def blob_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The blob index after two runs that share a third of the files, with how often each blob's bytes are stored."""
    store = BlobStore(spark, f"{shared_folder(spark).rstrip('/')}/blobs-{uuid.uuid4().hex}")
    content = I.content(spark, sf).select("customer_id", "file_id", "content")
    part = F.pmod(F.xxhash64("file_id"), F.lit(3))
    store.store(content.where(part < 2))
    store.store(content.where(part > 0))
    copies = store.blobs().groupBy("storage_path").agg(F.count("*").alias("copies"))
    return store.index().join(copies, "storage_path", "left")


@query("A14_blob_savings")
def blob_savings(spark: SparkSession, sf: str) -> DataFrame:
    return B.blob_savings(B.content_refs(I.content(spark, sf)))


@query("J07_file_content")
def file_content(spark: SparkSession, sf: str) -> DataFrame:
    """Files with the blob their content is stored in; blobs are shared by equal content of a customer."""
    files = R.good_files(I.raw_files(spark, sf), CFG).select("id", "mime_type", "size_bytes")
    eligible = X.skip_reason(F.col("mime_type"), F.col("size_bytes")).isNull()
    wanted = compute_once(files.select(F.col("id").alias("file_id"), "mime_type", "size_bytes"), eligible=eligible)
    refs = B.content_refs(I.content(spark, sf)).select("file_id", "sha256", "storage_path", "size_bytes")
    joined = J.with_content(wanted.drop("mime_type", "size_bytes"), refs, F.col("eligible"))
    return joined.select(
        "file_id", F.col("sha256").isNotNull().alias("has_content"), "sha256", "storage_path", "size_bytes"
    )


@query("K04_offload_split")
def offload_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.content(spark, sf).select(
        "customer_id", "connection_id", F.col("file_id").alias("message_id"), F.col("content").alias("payload")
    )
    split = B.offload_split(rows, "payload", "s3://bucket", OFFLOAD_BYTES)
    return split.select(
        "message_id", F.md5("data").alias("data_md5"), "s3_url", "sha256", "payload_size_bytes", "offloaded"
    )


@query("K04_offloaded_payloads")
def offloaded_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """What the offload writes to storage: written by the sink and read back."""
    rows = I.content(spark, sf).select(
        "customer_id", "connection_id", F.col("file_id").alias("message_id"), F.col("content").alias("payload")
    )
    path = f"{shared_folder(spark).rstrip('/')}/payloads-{uuid.uuid4().hex}"
    SK.write_blobs(B.payloads_to_store(rows, "payload", "s3://bucket", OFFLOAD_BYTES), path)
    stored = spark.read.schema("storage_path string, content string").parquet(path)
    return stored.select("storage_path", F.md5("content").alias("content_md5"))


@query("K01_outbound_records")
def outbound_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records of the fetch path as they go on the wire, with their size; every nineteenth file's record lacks the
    protocol's version, every twenty-third has another one, and both are rejected."""
    envelopes = _fetched(spark, sf)
    rendered = E.to_record(envelopes.withColumn("file_id", F.col("metadata.drive_id")), keep=("file_id",))
    number = F.substring("file_id", 2, 20).cast("bigint")
    rows = rendered.withColumn("jsonrpc", F.when(number % 19 == 0, None).when(number % 23 == 0, "1.0").otherwise(F.col("jsonrpc")))
    accepted, rejected = E.outbound_records(rows, CFG)
    large = S.exceeds_threshold(F.col("value"), RECORD_BYTES).alias("offloaded")
    what = ["key", F.md5("value").alias("value_md5"), F.octet_length("value").cast("bigint").alias("record_bytes"), large]
    return E.union_paths(
        accepted.select(
            *what, F.lit("record").alias("output"), F.col("headers")["source"].alias("source"), F.col("headers")["nonce"].alias("nonce")
        ),
        rejected.select(*what, F.col("error_type").alias("output")),
    )


@query("U01_union_paths")
def union_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Backfill and real-time records of one shape, deduplicated together: a file seen by both counts once."""
    backfill = _fetched(spark, sf).select(
        "connection_id", "nonce", F.lit("backfill").alias("path"), F.lit(0).alias("path_order")
    )
    realtime = R.webhook_changes(
        I.webhook_messages(spark, sf), I.connections(spark, sf), _feed(spark, sf), CFG
    ).select("connection_id", "nonce", F.lit("webhook").alias("path"), F.lit(1).alias("path_order"), "seq")
    both = E.union_paths(backfill, realtime).withColumn("seq", F.coalesce("seq", F.lit(0)))
    first = D.dedup_by_nonce(both, ["path_order", "seq"])
    return first.groupBy("connection_id", "path").agg(F.count("*").alias("records"))


# --- metrics ---------------------------------------------------------------------------------------------------


@query("A07_api_errors")
def api_call_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.api_calls_by_code(I.calls(spark, sf))
    return rows.withColumn("status_code", big(F.col("status_code")))


@query("A08_latency")
def latency(spark: SparkSession, sf: str) -> DataFrame:
    return A.latency_percentiles(I.calls(spark, sf), [0.5, 0.95, 0.99])


@query("A09_alerts")
def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return A.alerts(I.calls(spark, sf), p95_ms=100.0).drop("p95")


@query("A10_request_cost")
def request_cost(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.fact(spark, sf, "commands").select(
        "connection_id",
        F.when(F.col("verb") == "init", "init").when(F.col("verb") == "fetch", "fetch").otherwise("write").alias("action"),
        F.when(F.col("verb") == "init", "initialize")
        .when(F.col("verb") == "fetch", F.coalesce("resource_type", F.lit("files")))
        .otherwise(C.canonical_operation(F.col("operation")))
        .alias("operation"),
    )
    return A.request_cost(rows, capability_manifest(spark))


@query("N09_failure_streaks")
def failure_streaks(spark: SparkSession, sf: str) -> DataFrame:
    calls = I.calls(spark, sf)
    failed = S.error_class(F.col("status_code")).isNotNull()
    rows = W.failure_streaks(calls, "endpoint", ["ts", "event_id"], failed)
    return rows.select(
        "endpoint", "failures", micros("started_at").alias("started_us"), micros("ended_at").alias("ended_us")
    )


@query("T08_quota")
def quota(spark: SparkSession, sf: str) -> DataFrame:
    return A.quota_windows(I.calls(spark, sf), ["connection_id"], QUOTA_LIMIT)


@query("T08_project_quota")
def project_quota(spark: SparkSession, sf: str) -> DataFrame:
    """The project's own quota; windows from 80 % of a lowered limit on."""
    return A.quota_windows(I.calls(spark, sf), [], 2, alert_share=0.8)


@query("A09_dead_letters")
def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    commands_ = Q.validation_errors(MSG.route_messages(I.command_messages(spark, sf), CFG), CFG, "error_field")
    calls = Q.api_errors(I.calls(spark, sf), CFG)
    return A.dead_letter_alerts(E.union_paths(commands_, calls), 5)


@query("A09_consumer_lag")
def consumer_lag(spark: SparkSession, sf: str) -> DataFrame:
    """Four log partitions; two of them were read up to their last failed order."""
    rows = I.fact(spark, sf, "commands").select(
        (F.col("seq") % 4).alias("partition"), F.floor(F.col("seq") / 4).cast("bigint").alias("offset"), "o_orderstatus"
    )
    read = rows.where((F.col("o_orderstatus") == "F") & (F.col("partition") < 2))
    committed = read.groupBy("partition").agg((F.max("offset") + 1).alias("committed"))
    return A.consumer_lag(rows, committed)


@query("T10_throughput")
def throughput(spark: SparkSession, sf: str) -> DataFrame:
    return A.throughput(I.base(spark, sf, "events").select("event_type", "ts"), "event_type", 3600, 0)


@query("T07_retry_schedule")
def retry_schedule(spark: SparkSession, sf: str) -> DataFrame:
    errors = Q.api_errors(I.calls(spark, sf), CFG, keep=("event_id", "ts"))
    failures = errors.select(
        "event_id",
        F.col("ts").alias("failed_at"),
        (F.col("event_id") % 4 + 1).cast("int").alias("attempt"),
        F.when(F.col("error_code") == "RATELIMITERROR", "RateLimitError")
        .when(F.col("error_code") == "RETRIABLEERROR", "RetriableError")
        .otherwise("TerminalError")
        .alias("error_class"),
        "retry_after",
    )
    at = DriveConfig(run_ts="2024-01-15T00:00:00Z")
    return RT.schedule(failures, at).select(
        "event_id", big(F.col("attempt")).alias("attempt"), "wait_seconds",
        micros("next_attempt_at").alias("next_attempt_us"), "disposition",
    )


# --- state and lifecycle ---------------------------------------------------------------------------------------


def _state(spark: SparkSession, sf: str) -> DataFrame:
    """Current state: half of the writes, upserted by the other half."""
    rows = I.state_rows(spark, sf)
    return ST.upsert_state(rows.where(F.col("seq") % 2 == 0), rows.where(F.col("seq") % 2 == 1))


@query("K05_state_upsert")
def state_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _state(spark, sf).select("connection_id", "key", "value", "seq", micros("updated_at").alias("updated_us"))


@query("K05_state_table")
def state_table(spark: SparkSession, sf: str) -> DataFrame:
    """The state table after two writes, a compaction between them and the teardowns: as K05 and K06 say, but each step
    writes the buckets of its connections only."""
    table = StateTable(spark, f"{shared_folder(spark).rstrip('/')}/state-{uuid.uuid4().hex}")
    rows = I.state_rows(spark, sf)
    table.upsert(rows.where(F.col("seq") % 2 == 0))
    table.compact()
    table.upsert(rows.where(F.col("seq") % 2 == 1))
    table.teardown(R.valid_lifecycle(I.command_messages(spark, sf), CFG, "teardown"))
    return table.read().select("connection_id", "key", "value", "seq", micros("updated_at").alias("updated_us"))


@query("K06_teardown")
def teardown(spark: SparkSession, sf: str) -> DataFrame:
    return R.teardown(I.command_messages(spark, sf), _state(spark, sf), CFG).select("connection_id", "key", "value")


@query("T12_expired_cursors")
def expired_cursors(spark: SparkSession, sf: str) -> DataFrame:
    """The feed retains the last sixteenth of its pages here, so that cursors before it have expired."""
    feed = I.change_rows(spark, sf).select("connection_id", "page_no")
    newest = feed.agg(F.max("page_no")).first()[0]
    return ST.expired_cursors(_cursors(spark, sf), feed.where(16 * F.col("page_no") >= F.lit(newest) * 15))


@query("T09_renewal_due")
def renewal_due(spark: SparkSession, sf: str) -> DataFrame:
    return ST.renewal_due(_state(spark, sf), CFG)


def _inits(spark: SparkSession, sf: str) -> DataFrame:
    return R.init_connections(
        I.command_messages(spark, sf),
        I.connections(spark, sf),
        SL.parse_about(I.about(spark, sf)),
        SC.start_cursors(I.change_rows(spark, sf)),
        CFG,
    )


@query("K08_ready_events")
def ready_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = ST.ready_events(_inits(spark, sf), CFG)
    return rows.select(
        "connection_id", "customer_id", F.col("profile.email_address").alias("email"),
        F.col("profile.display_name").alias("display_name"), F.col("state.channel_id").alias("channel_id"),
        F.col("state.channel_expiration").alias("channel_expiration"), F.col("state.page_token").alias("page_token"),
        F.col("capabilities.max_results_per_page").cast("bigint").alias("max_results"),
    )


@query("Q14_channel_state")
def channel_state(spark: SparkSession, sf: str) -> DataFrame:
    new = ST.channel_state(_inits(spark, sf), CFG)
    return ST.upsert_state(_state(spark, sf), new).select("connection_id", "key", "value", "seq")


@query("Q10_about")
def about(spark: SparkSession, sf: str) -> DataFrame:
    return R.about(SL.parse_about(I.about(spark, sf)))


# --- write commands --------------------------------------------------------------------------------------------


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    return R.good_files(I.raw_files(spark, sf), CFG).select(
        "id", "name", "description", "mime_type", "parent_ids", "trashed"
    )


@query("W01_file_snapshot")
def file_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.apply_file_commands(_catalog(spark, sf), I.write_commands(spark, sf))
    return rows.withColumn("parent_ids", F.array_join("parent_ids", ","))


@query("W09_permission_snapshot")
def permission_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    current = I.fact(spark, sf, "permissions").select(
        "file_id", "permission_id", "role", F.col("kind").alias("permission_type"), F.col("email").alias("email_address")
    )
    return C.apply_permission_commands(current, I.write_commands(spark, sf))


@query("W12_rejected_commands")
def rejected_commands(spark: SparkSession, sf: str) -> DataFrame:
    return C.rejected_commands(_catalog(spark, sf), I.write_commands(spark, sf))


# --- streaming -------------------------------------------------------------------------------------------------


class Landing(str):
    """A folder of landed files, and how many of them arrive at a time."""

    per_batch: int


def _landing(spark: SparkSession, df: DataFrame, order: str, batches: int = 4) -> tuple[Landing, str]:
    """Land ``df`` as JSON files that arrive in ``order``, in about so many batches; returns landing and work paths.

    One partitioned write: each file holds a range of ``order``, and the files' times are set in that sequence, since a
    stream takes files by their times.
    """
    root = f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    files = max(batches, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.repartitionByRange(files, order).write.option("timestampFormat", MICROS).json(root + "/landing")
    return _arriving(spark, root + "/landing", batches), root


def _arriving(spark: SparkSession, path: str, batches: int) -> Landing:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(f.getPath().toString() for f in system.listStatus(hadoop) if f.getPath().getName().startswith("part-"))
    for k, name in enumerate(names):
        system.setTimes(spark._jvm.org.apache.hadoop.fs.Path(name), 1_700_000_000_000 + 1000 * k, -1)
    landing = Landing(path)
    landing.per_batch = max(1, -(-len(names) // batches))
    return landing


def _json_stream(spark: SparkSession, path: Landing, schema: str) -> DataFrame:
    reader = spark.readStream.schema(schema).option("timestampFormat", MICROS)
    return reader.option("maxFilesPerTrigger", path.per_batch).json(path)


def _drain_to_parquet(df: DataFrame, root: str, mode: str = "append") -> DataFrame:
    query_ = (
        df.writeStream.format("parquet")
        .option("path", root + "/out")
        .option("checkpointLocation", root + "/checkpoint")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(root + "/out")


@query("stream_changes")
def stream_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The change feed as a stream of landed pages; must equal S02_change_feed."""
    landing, root = _landing(spark, _change_pages(spark, sf), "page_no")
    pages = _json_stream(spark, landing, "connection_id string, page_no bigint, page_json string")
    rows = SC.explode_change_pages(pages).select(
        "connection_id", "page_no", "seq", "file_id", "removed", "change_type", "new_start_page_token"
    )
    return _drain_to_parquet(rows, root)


@query("stream_dedup")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Records accepted by the TTL memory over several micro-batches, late ones judged by their own time; blank nonces
    all pass."""
    rows = _nonce_rows(spark, sf)
    landing, root = _landing(spark, rows, "seq", 3)
    stream = _json_stream(spark, landing, "seq bigint, ts timestamp, connection_id string, nonce string")
    blank = F.col("nonce") == ""
    known = SS.ttl_dedup_stream(stream.where(~blank), "nonce", "ts", "seq", TTL_SECONDS, expires=False)
    passed = stream.where(blank).select(F.col("nonce").alias("key"), F.unix_micros("ts").alias("at"), "seq")
    return _drain_to_parquet(known.unionByName(passed), root).select(F.col("key").alias("nonce"), "seq", F.col("at").alias("at_us"))


@query("stream_cursors")
def stream_cursors(spark: SparkSession, sf: str) -> DataFrame:
    """Cursors of the change feed as a stream that starts from the state table, stops halfway and goes on from its
    checkpoint; a connection without a cursor starts at the feed's end as it was then."""
    pages = I.change_rows(spark, sf).groupBy("connection_id", "page_no").agg(F.concat(F.lit("s/"), F.max("seq").cast("string")).alias("token"))
    low, high = pages.agg(F.min("page_no"), F.max("page_no")).first()
    half = F.col("page_no") < (low + high) // 2
    known = SS.stored_cursors(_cursors(spark, sf), SC.start_cursors(I.change_rows(spark, sf).where(half)))
    _, root = _landing(spark, pages.where(half), "page_no", 2)
    known = _stored(known, root + "/known")
    for part in (None, pages.where(~half)):
        if part is not None:
            part.write.mode("append").json(root + "/landing")
        stream = _json_stream(spark, _arriving(spark, root + "/landing", 2), SS.CURSOR)
        moved = SS.cursor_stream(stream, known).writeStream.foreachBatch(
            lambda df, n: SCM.write_together(spark, root + "/out", n, {"cursors": df}, "cursors")
        )
        moved.option("checkpointLocation", root + "/checkpoint").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    moves = SCM.committed(spark, root + "/out", "cursors", SS.CURSOR)
    newest = W.latest_by(moves, ["connection_id"], ["batch_id"], ["page_no", "token"])
    return known.select("connection_id", F.col("page_no").alias("_start")).join(newest, "connection_id", "full").select(
        "connection_id", F.coalesce("page_no", "_start").alias("page_no"), "token"
    )


@query("stream_numbered")
def stream_numbered(spark: SparkSession, sf: str) -> DataFrame:
    """The feed's records numbered per connection, over several micro-batches."""
    landing, root = _landing(spark, I.change_rows(spark, sf).select("connection_id", "seq", "file_id"), "seq", 2)
    stream = _json_stream(spark, landing, "connection_id string, seq bigint, file_id string")
    SO.numbered_stream(stream, "connection_id", ["seq"], root + "/out", root + "/checkpoint")
    rows = SCM.committed(spark, root + "/out", "records", "connection_id string, seq bigint, file_id string, number bigint")
    return rows.select("connection_id", "seq", "file_id", "number")


@query("stream_ttl_dedup")
def stream_ttl_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Exact TTL memory as keyed state; must equal T02_ttl_dedup."""
    landing, root = _landing(spark, I.change_rows(spark, sf).select("file_id", "ts", "seq"), "seq", 2)
    stream = _json_stream(spark, landing, "file_id string, ts timestamp, seq bigint")
    rows = SS.ttl_dedup_stream(stream, "file_id", "ts", "seq", TTL_SECONDS, expires=False)
    return _drain_to_parquet(rows, root).select(
        F.col("key").alias("file_id"), "seq", F.col("at").alias("at_us")
    )


@query("stream_commands")
def stream_commands(spark: SparkSession, sf: str) -> DataFrame:
    """The message loop: records per route and validation errors, read back as counts."""
    landing, root = _landing(spark, I.command_messages(spark, sf), "seq", 2)
    stream = _json_stream(spark, landing, "seq bigint, ts timestamp, value string")

    def handled(df: DataFrame, cfg: DriveConfig) -> DataFrame:
        return df.select("connection_id", "route")

    names = ["init", "fetch", "write", "teardown", "capability"]
    SP.command_stream(stream, CFG, {name: handled for name in names}, root + "/out", root + "/checkpoint")
    parts = [
        spark.read.schema("connection_id string, route string").parquet(f"{root}/out/{name}").groupBy("route").agg(
            F.count("*").alias("n")
        )
        for name in names
    ]
    errors = spark.read.schema("error_code string").parquet(f"{root}/out/errors")
    parts.append(errors.groupBy(F.lower("error_code").alias("route")).agg(F.count("*").alias("n")))
    return E.union_paths(*parts)


@query("stream_message_loop")
def stream_message_loop(spark: SparkSession, sf: str) -> DataFrame:
    """The message loop with a handler for each route, row by row: where each message that isn't skipped went."""
    landing, root = _landing(spark, I.command_messages(spark, sf), "seq", 2)
    stream = _json_stream(spark, landing, "seq bigint, ts timestamp, value string")

    def handled(df: DataFrame, cfg: DriveConfig) -> DataFrame:
        return df.select("message_id", "route", "connection_id")

    names = ["init", "fetch", "write", "teardown", "capability", "webhook"]
    SP.command_stream(
        stream, CFG, {name: handled for name in names}, root + "/out", root + "/checkpoint", keep=("message_id", "route")
    )
    schema = "message_id string, route string, connection_id string"
    outputs = {**{name: "record" for name in names}, "unhandled": "unhandled", "retry": "retry", "dead_letters": "dead_letter"}
    return E.union_paths(*[
        spark.read.schema(schema).parquet(f"{root}/out/{name}").select(
            "message_id", "route", "connection_id", F.lit(output).alias("output")
        )
        for name, output in outputs.items()
    ])


#: Added to the numbers of notifications, which share the loop with the commands.
WEBHOOK_SEQ = 1_000_000_000_000


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _loop_tables(spark: SparkSession, sf: str, root: str) -> H.Tables:
    files = R.good_files(I.raw_files(spark, sf), CFG)
    starts = SC.start_cursors(I.change_rows(spark, sf))
    return H.Tables(
        I.connections(spark, sf), SL.parse_about(I.about(spark, sf)), starts, _stored(H.first_pages(files, CFG), root + "/pages"),
        _stored(_feed(spark, sf), root + "/feed"), files.select("id"), capability_manifest(spark),
    )


def _answers(spark: SparkSession, sf: str, root: str) -> Callable[[DataFrame], DataFrame]:
    """The API's answer to an attempt is a call of the log, by the message's number and the attempt's."""
    log = _stored(I.fact(spark, sf, "responses").select("response_key", "status_code", "retry_after", "body"), root + "/responses")
    n = log.count()

    def answer(asked: DataFrame) -> DataFrame:
        needs = F.when(F.col("route") != "capability", F.pmod(F.col("seq") * 7 + F.col("attempt"), F.lit(n)))
        # hashed, so that the messages, wide rows, are not sorted for it
        answered = asked.withColumn("response_key", needs).join(log.hint("shuffle_hash"), "response_key", "left")
        return answered.withColumn("status_code", F.when(F.col("route") == "capability", 200).otherwise(F.col("status_code"))).drop("response_key")

    return answer


@query("stream_retry_loop")
def stream_retry_loop(spark: SparkSession, sf: str) -> DataFrame:
    """Commands and notifications through the handlers, failed ones again when they are due: what became of each message,
    after which attempt and when, and how many records it gave."""
    notifications = I.webhook_messages(spark, sf).withColumn("seq", F.col("seq") + WEBHOOK_SEQ)
    messages = I.command_messages(spark, sf).unionByName(notifications)
    landing, root = _landing(spark, messages, "seq", 1)
    stream = _json_stream(spark, landing, "seq bigint, ts timestamp, value string")
    handlers = H.all_handlers(_loop_tables(spark, sf, root))
    base = root + "/out"
    query_ = SL_.start_loop(stream, CFG, handlers, base, root + "/checkpoint", _answers(spark, sf, root))
    SL_.drain(spark, query_, base, dt.datetime.fromisoformat(CFG.run_ts))
    settled = SCM.committed(spark, base, "settled", SL_.SETTLED)
    records = SCM.committed(spark, base, "records", SL_.RECORDS).groupBy("seq").agg(F.count("*").alias("records"))
    return settled.join(records, "seq", "left").select(
        "message_id", "route", "outcome", "attempt", "error_code", F.unix_micros("settled_at").alias("settled_us"), F.coalesce("records", F.lit(0)).alias("records")
    )


@query("stream_webhooks")
def stream_webhooks(spark: SparkSession, sf: str) -> DataFrame:
    """Notifications as a stream joined with the connection table of each micro-batch: records and errors."""
    landing, root = _landing(spark, I.webhook_messages(spark, sf), "seq", 2)
    stream = _json_stream(spark, landing, "seq bigint, ts timestamp, value string")

    def records(df: DataFrame, cfg: DriveConfig) -> DataFrame:
        ready = df.where(X.not_stop(F.col("kind")) & F.col("page_token").isNotNull())
        return ready.select("message_id", "connection_id", "customer_id", "page_token")

    SP.webhook_stream(
        stream, CFG, lambda: I.connections(spark, sf), records, root + "/out", root + "/checkpoint"
    )
    schema = "message_id string, connection_id string, customer_id string, page_token string"
    served = spark.read.schema(schema).parquet(root + "/out/records").select(*[c.split()[0] for c in schema.split(", ")])
    failed = spark.read.schema("message_id string, reason string").parquet(root + "/out/errors").select("message_id", "reason")
    return E.union_paths(served.withColumn("reason", F.lit(None).cast("string")), failed)


def _quota_report(spark: SparkSession, sf: str) -> DataFrame:
    landing, root = _landing(spark, I.calls(spark, sf).select("ts", "connection_id", "event_id"), "event_id", 2)
    stream = _json_stream(spark, landing, "ts timestamp, connection_id string, event_id bigint")
    SP.quota_counts_stream(stream, "connection_id", root + "/out", root + "/checkpoint")
    return SP.quota_report(spark, root + "/out", "connection_id", QUOTA_LIMIT)


@query("stream_quota")
def stream_quota(spark: SparkSession, sf: str) -> DataFrame:
    """Closed quota windows of the call stream, with calls that came late."""
    return _quota_report(spark, sf).where(~F.col("open")).select("connection_id", "window_start", "n")


@query("stream_quota_all")
def stream_quota_all(spark: SparkSession, sf: str) -> DataFrame:
    """All quota windows of the call stream, those still open included; must equal T08_quota."""
    return _quota_report(spark, sf).select("connection_id", "window_start", "n", "open")
