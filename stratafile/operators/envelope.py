"""Text rendering, metadata and the outgoing envelopes."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile.config import DriveConfig
from stratafile.functions import mime as M
from stratafile.functions import scalars as S

# Fixed value.
ENVELOPE_ENERGY = 5


def _truthy(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def render_text(prefix: str = "") -> Column:
    """Text lines of a normalized file; ``concat_ws`` leaves out the lines that do not apply."""

    def col(name: str) -> Column:
        return F.col(prefix + name)

    kind = (
        F.when(col("is_folder"), F.lit("Type: Folder"))
        .when(
            col("is_google_workspace"),
            F.concat(F.lit("Type: "), M.native_name(col("mime_type")), F.lit(" ("), col("category"), F.lit(")")),
        )
        .otherwise(F.concat(F.lit("Type: "), col("category")))
    )
    flags = S.status_flags(col("trashed"), col("starred"), col("shared"))
    created, modified = col("timestamps.created_at"), col("timestamps.modified_at")
    return F.concat_ws(
        "\n",
        F.concat(F.lit("File: "), F.coalesce(col("name"), F.lit("None"))),
        kind,
        F.concat(F.lit("Size: "), S.size_text(col("size_bytes"))),
        F.when(_truthy(col("web_view_link")), F.concat(F.lit("Link: "), col("web_view_link"))),
        F.when(F.size(col("parent_ids")) > 0, F.concat(F.lit("Parent folders: "), F.size(col("parent_ids")))),
        F.when(F.size(col("owners")) > 0, F.concat(F.lit("Owners: "), S.owner_names(col("owners")))),
        F.when(_truthy(created), F.concat(F.lit("Created: "), created)),
        F.when(_truthy(modified), F.concat(F.lit("Modified: "), modified)),
        F.when(flags != "", F.concat(F.lit("Status: "), flags)),
    )


def metadata_struct(has_content: Column | None = None, kind: Column | None = None) -> Column:
    """Structured metadata of a normalized file; optional fields are null where they do not apply."""
    resource = [] if kind is None else [kind.alias("resource_type"), F.col("id").alias("resource_id")]
    fields = [
        *resource,
        F.col("id").alias("drive_id"),
        F.col("name"),
        F.col("mime_type"),
        F.col("category"),
        F.col("is_folder"),
        F.col("is_google_workspace"),
        F.col("trashed"),
        F.col("starred"),
        S.blank_to_null(F.col("web_view_link")).alias("source_document_url"),
        F.coalesce(S.blank_to_null(F.col("name")), F.lit(S.UNTITLED)).alias("source_document_title"),
        F.col("export_format"),
        F.col("size_bytes"),
        S.blank_to_null(F.col("web_view_link")).alias("web_view_link"),
        S.blank_to_null(F.col("thumbnail_link")).alias("thumbnail_link"),
        F.when(F.size("parent_ids") > 0, F.col("parent_ids")).alias("parent_ids"),
        F.when(F.size("owners") > 0, F.col("owners")).alias("owners"),
        F.col("shared"),
        S.blank_to_null(F.col("timestamps.created_at")).alias("created_at"),
        S.blank_to_null(F.col("timestamps.modified_at")).alias("modified_at"),
    ]
    if has_content is not None:
        fields.append(has_content.alias("has_content"))
    return F.struct(*fields)


def routing_header(
    cfg: DriveConfig,
    customer_id: Column,
    connection_id: Column,
    space: Column,
    correlation_id: Column,
    batch_id: Column,
    batch_sequence: Column,
    batch_is_last: Column,
    batch_page_token: Column,
    extra: dict[str, Column] | None = None,
) -> Column:
    return F.struct(
        F.array(F.struct(F.array(F.lit(cfg.output_topic)).alias("topics"), connection_id.alias("topic_key"))).alias(
            "to_addresses"
        ),
        F.array().cast("array<string>").alias("return_addresses"),
        F.array().cast("array<string>").alias("message_call_stack"),
        F.struct(
            customer_id.alias("customer_id"),
            F.lit(cfg.provider).alias("integration_provider_name"),
            connection_id.alias("integration_connection_id"),
            space.alias(cfg.envelope_space_key),
            correlation_id.alias("correlation_id"),
            F.lit(ENVELOPE_ENERGY).alias("energy"),
            batch_id.alias("batch_id"),
            batch_sequence.alias("batch_sequence"),
            batch_is_last.alias("batch_is_last"),
            batch_page_token.alias("batch_page_token"),
            *[value.alias(name) for name, value in (extra or {}).items()],
        ).alias("parameters"),
    )


def text_item(text: Column) -> Column:
    return F.struct(
        F.lit("text").alias("type"),
        text.alias("text"),
        *[
            F.lit(None).cast(kind).alias(name)
            for name, kind in [
                ("filename", "string"),
                ("mime_type", "string"),
                ("size", "bigint"),
                ("storage_path", "string"),
                ("upload_id", "string"),
            ]
        ],
    )


def file_item(filename: Column, mime_type: Column, size: Column, storage_path: Column, upload_id: Column) -> Column:
    return F.struct(
        F.lit("file").alias("type"),
        F.lit(None).cast("string").alias("text"),
        filename.alias("filename"),
        mime_type.alias("mime_type"),
        size.cast("bigint").alias("size"),
        storage_path.alias("storage_path"),
        upload_id.alias("upload_id"),
    )


def ingest_envelopes(
    df: DataFrame,
    cfg: DriveConfig,
    content: bool = False,
    extra: dict[str, str] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One JSON-RPC record per normalized file.

    Input: the normalized columns plus ``connection_id, customer_id, snowball_id, batch_id, batch_sequence,
    batch_is_last, batch_page_token`` and, with ``content``, ``storage_path, content_mime_type, content_bytes`` (null
    without content). Output: ``connection_id, nonce, jsonrpc, method, id, header, contents, metadata`` with ``keep``.
    """
    kind = S.resource_type(F.col("is_folder"))
    nonce = S.idempotency_key(cfg.provider, F.col("connection_id"), kind, F.col("id"))
    space = S.space_path(F.col("customer_id"), F.col("snowball_id"))
    items = [text_item(render_text())]
    has_content = F.lit(False)
    if content:
        has_content = F.col("storage_path").isNotNull()
        items.append(
            F.when(
                has_content,
                file_item(
                    F.col("name"),
                    F.col("content_mime_type"),
                    F.col("content_bytes"),
                    F.col("storage_path"),
                    S.deterministic_id(F.lit("upload"), nonce, F.col("storage_path")),
                ),
            )
        )
    header = routing_header(
        cfg,
        F.col("customer_id"),
        F.col("connection_id"),
        space,
        nonce,
        F.col("batch_id"),
        F.col("batch_sequence"),
        F.col("batch_is_last"),
        F.col("batch_page_token"),
        {name: F.col(column) for name, column in (extra or {}).items()},
    )
    kept = [F.col(c).alias(c) for c in keep]
    return df.select(
        *kept,
        F.col("connection_id"),
        nonce.alias("nonce"),
        F.lit("2.0").alias("jsonrpc"),
        F.lit(cfg.ingest_method).alias("method"),
        S.deterministic_id(F.col("batch_id"), F.col("id")).alias("id"),
        header.alias("header"),
        F.array_compact(F.array(*items)).alias("contents"),
        metadata_struct(has_content, kind).alias("metadata"),
    )


def file_bodies(df: DataFrame, cfg: DriveConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    """What all records of a normalized file have in common, rendered once: ``nonce``, and ``body``, the JSON text of contents,
    metadata and nonce without its opening brace. :func:`body_records` makes the records of the files' requests from it.

    Input: the normalized columns plus ``connection_id``. Output: ``connection_id, id, nonce, body`` with ``keep``.
    """
    kind = S.resource_type(F.col("is_folder"))
    nonce = S.idempotency_key(cfg.provider, F.col("connection_id"), kind, F.col("id")).alias("nonce")
    contents = F.array(text_item(render_text())).alias("contents")
    text = F.to_json(F.struct(contents, metadata_struct(F.lit(False), kind).alias("metadata"), nonce))
    return df.select(*keep, "connection_id", "id", nonce, F.substring(text, 2, 2**31 - 1).alias("body"))


def body_records(df: DataFrame, cfg: DriveConfig, extra: dict[str, str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, nonce, jsonrpc, value`` as :func:`to_record` renders them from :func:`ingest_envelopes`, with a body that
    :func:`file_bodies` has rendered. Input: its columns plus ``customer_id, snowball_id, batch_id, batch_sequence, batch_is_last,
    batch_page_token``."""
    c = F.col
    header = routing_header(
        cfg, c("customer_id"), c("connection_id"), S.space_path(c("customer_id"), c("snowball_id")), c("nonce"), c("batch_id"),
        c("batch_sequence"), c("batch_is_last"), c("batch_page_token"), {name: c(column) for name, column in (extra or {}).items()},
    )
    rest = f'","jsonrpc":"2.0","method":{json.dumps(cfg.ingest_method)},"params":{{"header":'
    record_id = S.deterministic_id(c("batch_id"), c("id"))  # a hash: nothing to escape, never null
    value = F.concat(F.lit('{"id":"'), record_id, F.lit(rest), F.to_json(header), F.lit(","), c("body"), F.lit("}"))
    return df.select(*keep, c("connection_id").alias("key"), "nonce", F.lit("2.0").alias("jsonrpc"), value.alias("value"))


def to_record(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Render envelopes as ``key, nonce, value``; ``value`` is the JSON text of the record."""
    params = F.struct("header", "contents", "metadata", "nonce")
    return df.select(
        *keep,
        F.col("connection_id").alias("key"),
        "nonce",
        "jsonrpc",
        F.to_json(F.struct("id", "jsonrpc", "method", params.alias("params"))).alias("value"),
    )


def empty_batches(requests: DataFrame, pages_with_files: DataFrame, cfg: DriveConfig) -> DataFrame:
    """One marker row per request whose page holds no file.

    ``requests``: ``request_id, connection_id, customer_id, snowball_id, resource_type, next_page_token, started_at,
    ended_at``; ``pages_with_files`` needs ``request_id``.
    """
    batch_id = S.deterministic_id(F.lit("empty"), F.col("request_id"))
    empty = requests.join(pages_with_files.select("request_id"), "request_id", "left_anti")
    return empty.select(
        "request_id",
        "connection_id",
        batch_id.alias("batch_id"),
        S.empty_batch_key(cfg.provider, F.col("connection_id"), F.col("resource_type"), batch_id).alias(
            "correlation_id"
        ),
        F.concat(F.lit("empty_batch_"), F.col("resource_type")).alias("resource_type"),
        S.space_path(F.col("customer_id"), F.col("snowball_id")).alias("space_path"),
        F.to_json(F.struct(F.lit(True).alias("empty"), F.col("resource_type").alias("resource_type"))).alias("text"),
        S.duration_ms(F.col("started_at"), F.col("ended_at")).alias("processing_duration_ms"),
        F.col("next_page_token"),
        F.col("next_page_token").isNotNull().alias("has_more"),
        F.lit(0).cast("bigint").alias("batch_sequence"),
        F.col("next_page_token").isNull().alias("batch_is_last"),
    )


def sync_envelopes(
    df: DataFrame, cfg: DriveConfig, trigger_type: str, change_type: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The sync path's envelope over lightly normalized files; ``content_bytes`` is null without content."""
    kind = F.col("type")
    return df.select(
        *keep,
        F.col("connection_id").alias("integration_connection_id"),
        F.lit(cfg.provider).alias("integration_id"),
        F.col("customer_id"),
        kind.alias("resource_type"),
        F.col("id").alias("resource_id"),
        S.idempotency_key(cfg.provider, F.col("connection_id"), kind, F.col("id")).alias("idempotency_key"),
        F.struct(
            "id", "name", "mime_type", "created_at", "modified_at", "size_bytes", "web_view_link", "parents",
            "trashed", "type", "owner", "permissions_count",
        ).alias("data"),
        F.struct(
            F.lit(trigger_type).alias("trigger_type"),
            (F.col(change_type) if change_type else F.lit(None).cast("string")).alias("change_type"),
            F.lit(cfg.source_format).alias("source_format"),
            F.lit(cfg.transformation_version).alias("transformation_version"),
            F.col("content_bytes").isNotNull().alias("has_content"),
            F.coalesce(F.col("content_bytes"), F.lit(0)).cast("bigint").alias("content_size_bytes"),
        ).alias("metadata"),
    )


def outbound_records(records: DataFrame, cfg: DriveConfig) -> tuple[DataFrame, DataFrame]:
    """Keyed records ready for a log sink, and the rows rejected because they are not JSON-RPC 2.0.

    Input ``key, nonce, jsonrpc, value``.
    """
    valid = F.col("jsonrpc").eqNullSafe(F.lit("2.0"))
    headers = F.create_map(
        F.lit("source"), F.lit(cfg.service_name),
        F.lit("produced_at"), F.lit(cfg.run_ts),
        F.lit("nonce"), F.coalesce(F.col("nonce"), F.lit("")),
    )
    accepted = records.where(valid).select("key", "value", headers.alias("headers"))
    rejected = records.where(~valid).withColumn("error_type", F.lit("terminal"))
    return accepted, rejected


def union_paths(*paths: DataFrame) -> DataFrame:
    """Backfill and real-time envelopes share one shape; columns of one path only are null in the others."""
    result = paths[0]
    for path in paths[1:]:
        result = result.unionByName(path, allowMissingColumns=True)
    return result
