"""Normalization of raw files, revisions, permissions and comments.

Each function takes a DataFrame with one JSON text per row and returns flat or nested columns in the same row: no
shuffle, no UDF. A row that cannot be normalized carries a ``bad_row_reason`` instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile import schemas
from stratafile.config import DriveConfig
from stratafile.functions import mime as M
from stratafile.functions import scalars as S
from stratafile.functions.presence import JsonRecord, map_get, parse_json_records

CAPABILITY_FLAGS = {
    "canEdit": "can_edit",
    "canComment": "can_comment",
    "canShare": "can_share",
    "canCopy": "can_copy",
    "canDownload": "can_download",
    "canDelete": "can_delete",
    "canRename": "can_rename",
    "canMoveItemWithinDrive": "can_move",
    "canAddChildren": "can_add_children",
}


def user_struct(user: Column) -> Column:
    """``{name, email, photo_link}`` of a user object, null for an absent object."""
    return F.when(
        user.isNotNull(),
        F.struct(
            map_get(user, "displayName", "Unknown").alias("name"),
            map_get(user, "emailAddress").alias("email"),
            map_get(user, "photoLink").alias("photo_link"),
        ),
    )


def owners_array(owners: Column) -> Column:
    return F.coalesce(
        F.transform(owners, user_struct), F.array().cast("array<struct<name:string,email:string,photo_link:string>>")
    )


def capabilities_struct(capabilities: Column) -> Column:
    return F.when(
        capabilities.isNotNull(),
        F.struct(*[map_get(capabilities, raw, False).alias(name) for raw, name in CAPABILITY_FLAGS.items()]),
    )


def lineage_struct(cfg: DriveConfig, connection_id: Column, customer_id: Column, **ids: Column) -> Column:
    return F.struct(
        F.lit(cfg.provider).alias("provider"),
        *[value.alias(name) for name, value in ids.items()],
        connection_id.alias("connection_id"),
        customer_id.alias("customer_id"),
        F.lit(cfg.transformation_version).alias("transformation_version"),
        F.lit(cfg.run_ts).alias("transformed_at"),
    )


def _timestamps(rec: JsonRecord, fields: dict[str, str]) -> Column:
    return F.struct(*[S.utc_suffix(rec[raw]).alias(name) for raw, name in fields.items()])


def _first_reason(*rules: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(condition, F.lit(reason)) for condition, reason in rules])


def file_bad_row_reason(rec: JsonRecord) -> Column:
    """Why a raw file cannot be normalized; null for a good row."""
    return _first_reason(
        (rec.keys.isNull(), "not a JSON object"),
        (rec.null_valued("mimeType"), "mimeType is null"),
        (rec.null_valued("owners"), "owners is null"),
        (F.exists(rec["owners"], lambda o: o.isNull()), "owner is null"),
        (rec.null_valued("lastModifyingUser"), "lastModifyingUser is null"),
        (rec.null_valued("capabilities"), "capabilities is null"),
    )


def normalize_files(
    df: DataFrame,
    cfg: DriveConfig,
    raw_json: str = "raw_json",
    connection_id: str = "connection_id",
    customer_id: str = "customer_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Full normalization of raw files, one ``select`` over one parse."""
    parsed, rec = parse_json_records(df, raw_json, schemas.RAW_FILE)
    parsed = parsed.withColumn("_mime", rec.get("mimeType", M.DEFAULT_MIME)).withColumn(
        "_id", rec.get("id", "")
    )
    mime, file_id = F.col("_mime"), F.col("_id")
    folder, native = M.is_folder(mime), M.is_native(mime)
    return parsed.select(
        *keep,
        file_id.alias("id"),
        S.resource_type(folder).alias("type"),
        rec.get("name", "Unnamed").alias("name"),
        mime.alias("mime_type"),
        M.category(mime).alias("category"),
        folder.alias("is_folder"),
        native.alias("is_google_workspace"),
        M.needs_export(mime).alias("needs_export"),
        F.when(native, M.export_format(mime)).alias("export_format"),
        M.extension(mime).alias("file_extension"),
        S.parse_integer(rec["size"]).alias("size_bytes"),
        rec["webViewLink"].alias("web_view_link"),
        rec["webContentLink"].alias("web_content_link"),
        rec["thumbnailLink"].alias("thumbnail_link"),
        rec.get("parents", F.array().cast("array<string>")).alias("parent_ids"),
        owners_array(rec["owners"]).alias("owners"),
        user_struct(rec["lastModifyingUser"]).alias("last_modified_by"),
        capabilities_struct(rec["capabilities"]).alias("capabilities"),
        rec.get("trashed", False).alias("trashed"),
        rec.get("starred", False).alias("starred"),
        rec.get("explicitlyTrashed", False).alias("explicitly_trashed"),
        rec.get("shared", False).alias("shared"),
        rec.get("viewedByMe", False).alias("viewed_by_me"),
        _timestamps(
            rec,
            {
                "createdTime": "created_at",
                "modifiedTime": "modified_at",
                "viewedByMeTime": "viewed_by_me_at",
                "sharedWithMeTime": "shared_with_me_at",
                "trashedTime": "trashed_at",
            },
        ).alias("timestamps"),
        S.parse_integer(rec["quotaBytesUsed"]).alias("quota_bytes_used"),
        rec["version"].alias("version"),
        rec["md5Checksum"].alias("md5_checksum"),
        rec["sha1Checksum"].alias("sha1_checksum"),
        rec["sha256Checksum"].alias("sha256_checksum"),
        rec["description"].alias("description"),
        F.when(folder, rec["folderColorRgb"]).alias("folder_color_rgb"),
        lineage_struct(cfg, F.col(connection_id), F.col(customer_id), file_id=file_id).alias("source"),
        F.struct(
            F.size(rec.keys).alias("original_field_count"),
            rec.has("permissions").alias("has_permissions"),
            rec.has("appProperties").alias("has_app_properties"),
            rec.has("properties").alias("has_properties"),
        ).alias("_metadata"),
        file_bad_row_reason(rec).alias("bad_row_reason"),
    )


def light_normalize_files(
    df: DataFrame, raw_json: str = "raw_json", keep: tuple[str, ...] = (), fail_on_bad_size: bool = False
) -> DataFrame:
    """The sync path's short form: first owner only, permission count only if there are any.

    A size that is no integer aborts the whole sync in strict mode and is marked in ``bad_row_reason`` otherwise.
    """
    parsed, rec = parse_json_records(df, raw_json, schemas.RAW_FILE)
    size_text = F.try_variant_get(rec["size"], "$", "string")
    number_zero = F.schema_of_variant(rec["size"]).isin("STRING", "VOID") == F.lit(False)
    falsy = F.coalesce(size_text, F.lit("")).isin("", "false") | (
        number_zero & (F.try_variant_get(rec["size"], "$", "double") == 0)
    )
    size = F.when(~falsy, F.try_variant_get(rec["size"], "$", "bigint"))
    bad_size = ~falsy & size.isNull()
    if fail_on_bad_size:
        size = F.when(bad_size, F.raise_error(F.lit("size is not an integer")).cast("bigint")).otherwise(size)
    first_owner = F.get(rec["owners"], F.lit(0))
    count = F.size(rec["permissions"])
    return parsed.select(
        *keep,
        rec["id"].alias("id"),
        rec["name"].alias("name"),
        rec["mimeType"].alias("mime_type"),
        rec["createdTime"].alias("created_at"),
        rec["modifiedTime"].alias("modified_at"),
        size.alias("size_bytes"),
        rec["webViewLink"].alias("web_view_link"),
        rec.get("parents", F.array().cast("array<string>")).alias("parents"),
        rec.get("trashed", False).alias("trashed"),
        S.resource_type(F.coalesce(M.is_folder(rec["mimeType"]), F.lit(False))).alias("type"),
        F.when(
            F.size(rec["owners"]) > 0,
            F.struct(
                map_get(first_owner, "emailAddress").alias("email"),
                map_get(first_owner, "displayName").alias("name"),
            ),
        ).alias("owner"),
        F.when(count > 0, count).alias("permissions_count"),
        _first_reason(
            (rec.keys.isNull(), "not a JSON object"), (bad_size, "size is not an integer")
        ).alias("bad_row_reason"),
    )


def normalize_revisions(
    df: DataFrame, cfg: DriveConfig, raw_json: str = "raw_json", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Revisions; ``file_id``, ``connection_id`` and ``customer_id`` are columns of the input."""
    parsed, rec = parse_json_records(df, raw_json, schemas.RAW_REVISION)
    revision_id = rec.get("id", "")
    return parsed.select(
        *keep,
        revision_id.alias("id"),
        F.col("file_id"),
        F.lit("revision").alias("type"),
        rec.get("keepForever", False).alias("keep_forever"),
        rec.get("published", False).alias("published"),
        rec.get("publishAuto", False).alias("publish_auto"),
        rec.get("publishedOutsideDomain", False).alias("published_outside_domain"),
        rec["mimeType"].alias("mime_type"),
        S.parse_integer(rec["size"]).alias("size_bytes"),
        rec["md5Checksum"].alias("md5_checksum"),
        user_struct(rec["lastModifyingUser"]).alias("last_modified_by"),
        _timestamps(rec, {"modifiedTime": "modified_at"}).alias("timestamps"),
        rec["exportLinks"].alias("export_links"),
        lineage_struct(
            cfg, F.col("connection_id"), F.col("customer_id"), file_id=F.col("file_id"), revision_id=revision_id
        ).alias("source"),
        _first_reason(
            (rec.keys.isNull(), "not a JSON object"),
            (rec.null_valued("lastModifyingUser"), "lastModifyingUser is null"),
        ).alias("bad_row_reason"),
    )


def _permission_details(details: Column, type_key: str, type_name: str) -> Column:
    return F.transform(
        details,
        lambda d: F.struct(
            map_get(d, type_key).alias(type_name),
            map_get(d, "role").alias("role"),
            map_get(d, "inheritedFrom").alias("inherited_from"),
            F.when(F.map_contains_key(d, "inherited"), map_get(d, "inherited").try_cast("boolean"))
            .otherwise(F.lit(False))
            .alias("inherited"),
        ),
    )


def normalize_permissions(
    df: DataFrame, cfg: DriveConfig, raw_json: str = "raw_json", keep: tuple[str, ...] = ()
) -> DataFrame:
    parsed, rec = parse_json_records(df, raw_json, schemas.RAW_PERMISSION)
    permission_id = rec.get("id", "")
    return parsed.select(
        *keep,
        permission_id.alias("id"),
        F.col("file_id"),
        F.lit("permission").alias("type"),
        rec.get("type", "").alias("permission_type"),
        rec.get("role", "").alias("role"),
        rec.get("displayName", "").alias("display_name"),
        rec["emailAddress"].alias("email_address"),
        rec["domain"].alias("domain"),
        rec.get("allowFileDiscovery", False).alias("allow_file_discovery"),
        rec.get("deleted", False).alias("deleted"),
        rec.get("pendingOwner", False).alias("pending_owner"),
        rec["photoLink"].alias("photo_link"),
        S.utc_suffix(rec["expirationTime"]).alias("expiration_time"),
        _permission_details(rec["permissionDetails"], "permissionType", "permission_type").alias(
            "permission_details"
        ),
        _permission_details(
            rec["teamDrivePermissionDetails"], "teamDrivePermissionType", "team_drive_permission_type"
        ).alias("team_drive_permission_details"),
        lineage_struct(
            cfg, F.col("connection_id"), F.col("customer_id"), file_id=F.col("file_id"), permission_id=permission_id
        ).alias("source"),
        _first_reason(
            (rec.keys.isNull(), "not a JSON object"),
            (rec.null_valued("permissionDetails"), "permissionDetails is null"),
            (rec.null_valued("teamDrivePermissionDetails"), "teamDrivePermissionDetails is null"),
        ).alias("bad_row_reason"),
    )


def _reply_struct(raw: Column) -> Column:
    keys, reply = F.json_object_keys(raw), F.from_json(raw, schemas.RAW_REPLY)
    rec = JsonRecord(reply, keys)
    return F.struct(
        rec.get("id", "").alias("id"),
        rec.get("content", "").alias("content"),
        rec.get("deleted", False).alias("deleted"),
        user_struct(rec["author"]).alias("author"),
        _timestamps(rec, {"createdTime": "created_at", "modifiedTime": "modified_at"}).alias("timestamps"),
    )


def normalize_comments(
    df: DataFrame, cfg: DriveConfig, raw_json: str = "raw_json", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Comments with their embedded replies; ``reply_count`` counts deleted replies too and is null without a
    ``replies`` key."""
    parsed, rec = parse_json_records(df, raw_json, schemas.RAW_COMMENT)
    comment_id = rec.get("id", "")
    return parsed.select(
        *keep,
        comment_id.alias("id"),
        F.col("file_id"),
        F.lit("comment").alias("type"),
        rec.get("content", "").alias("content"),
        rec.get("resolved", False).alias("resolved"),
        rec.get("deleted", False).alias("deleted"),
        user_struct(rec["author"]).alias("author"),
        _timestamps(rec, {"createdTime": "created_at", "modifiedTime": "modified_at"}).alias("timestamps"),
        F.transform(rec["replies"], _reply_struct).alias("replies"),
        F.when(rec.has("replies"), F.size(rec["replies"])).alias("reply_count"),
        lineage_struct(
            cfg, F.col("connection_id"), F.col("customer_id"), file_id=F.col("file_id"), comment_id=comment_id
        ).alias("source"),
        _first_reason(
            (rec.keys.isNull(), "not a JSON object"),
            (rec.null_valued("author"), "author is null"),
            (rec.null_valued("replies"), "replies is null"),
        ).alias("bad_row_reason"),
    )


def comment_reply_rows(messages: DataFrame) -> DataFrame:
    """Relational form of the replies: one row per reply, positions kept, nothing gathered into one group.

    Input columns ``comment_id, turn, author, content``; turn 0 is the comment itself.
    """
    return messages.where(F.col("turn") > 0).select(
        "comment_id", (F.col("turn") - 1).alias("reply_no"), "author", "content"
    )


def reply_counts(messages: DataFrame) -> DataFrame:
    """Reply statistics per comment from reply rows, partially aggregated before the shuffle."""
    reply = F.col("turn") > 0
    return messages.groupBy("comment_id").agg(
        F.count_if(reply).alias("reply_count"),
        F.sum(F.when(reply, F.length("content")).otherwise(0)).alias("reply_chars"),
        F.max(F.when(reply, F.struct("turn", "author")))["author"].alias("last_reply_author"),
    )


def assemble_replies(messages: DataFrame, chunk: int = 1000) -> DataFrame:
    """Replies of each comment as arrays in turn order, at most ``chunk`` replies each.

    A thread with more replies gives several rows, numbered by ``chunk``, so no group grows with the thread. Each row
    has the comment's whole ``reply_count``.
    """
    replies = messages.where(F.col("turn") > 0)
    counts = reply_counts(messages).select("comment_id", "reply_count")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "author", "content")))
    return (
        replies.groupBy("comment_id", F.floor((F.col("turn") - 1) / F.lit(chunk)).cast("bigint").alias("chunk"))
        .agg(ordered.alias("replies"))
        .join(counts, "comment_id")
    )


def split_bad_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the marker, and the quarantined rows with it."""
    good = df.where(F.col("bad_row_reason").isNull()).drop("bad_row_reason")
    return good, df.where(F.col("bad_row_reason").isNotNull())
