"""The derived inputs as Spark DataFrames, in the shapes the operators read (JSON text, structs, columns)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile.plans import facts
from stratafile.session import shared_folder


#: Rows of a landed file at most.
LANDED_ROWS = 20_000
_LANDED: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived input written once per session to the shared folder and then read as a table, as a landed feed is."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = f"{shared_folder(spark).rstrip('/')}/landed-{uuid.uuid4().hex}/{name}"
        # Files of bounded size, as a feed lands them; the input's partitions decide how many tasks write.
        build().write.option("maxRecordsPerFile", LANDED_ROWS).parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in zoneless})


def fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {t: base(spark, sf_dir, t) for t in facts.used_tables(name)}
    return spark.sql(facts.TABLES[name].strip(), **tables)


def _text(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def _bool(value: Column) -> Column:
    return F.when(value, F.lit("true")).otherwise(F.lit("false"))


def _pair(name: str, json_value: Column) -> Column:
    """``"name":value``; a null value leaves the key out."""
    return F.concat(F.lit(f'"{name}":'), json_value)


def _object(*pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def _state(state: str, **values: Column) -> Column:
    """JSON value by state; ``null`` writes an explicit null, a state without a value leaves the key out."""
    col = F.when(F.col(state) == "null", F.lit("null"))
    for name, value in values.items():
        col = col.when(F.col(state) == name, value)
    return col


def raw_file_json() -> Column:
    """The raw file object of a ``files`` fact row."""
    c = F.col
    owner = _object(
        F.when(~c("owner_unnamed"), _pair("displayName", _text(c("owner_name")))),
        _pair("emailAddress", _text(c("owner_email"))),
        F.when(c("owner_key") % 2 == 0, _pair("photoLink", _text(F.lit("https://img.example/p")))),
    )
    second = _object(_pair("displayName", _text(F.lit("Second Owner"))), _pair("emailAddress", _text(c("second_email"))))
    suffix = c("suffix")
    permission = F.transform(
        F.sequence(F.lit(0), c("permission_rows").cast("int") - 1),
        lambda i: _object(
            _pair("id", _text(F.concat(F.lit("ep"), i.cast("string")))),
            _pair("type", _text(F.lit("user"))),
            _pair("role", _text(F.when(i == 0, F.lit("owner")).otherwise(F.lit("reader")))),
        ),
    )
    return _object(
        _pair("id", _text(c("id"))),
        _pair("name", _state("name_state", value=_text(c("name_value")))),
        _pair("mimeType", _state("mime_state", value=_text(c("mime_value")))),
        _pair(
            "size",
            _state(
                "size_state",
                text=_text(c("size_value").cast("string")),
                bad=_text(F.lit("not_a_number")),
                number=F.concat(c("n_chars").cast("string"), F.lit(".7")),
            ),
        ),
        _pair(
            "quotaBytesUsed",
            _state("quota_state", text=_text(c("n_chars").cast("string")), bad=_text(F.lit("n/a"))),
        ),
        _pair("createdTime", _text(F.concat("created_base", suffix))),
        _pair("modifiedTime", F.when(~c("explicitly"), _text(F.concat("modified_base", suffix)))),
        _pair("viewedByMeTime", F.when(c("viewed"), _text(F.concat("modified_base", suffix)))),
        _pair("sharedWithMeTime", F.when(c("shared"), _text(F.concat("created_base", suffix)))),
        _pair("trashedTime", F.when(c("trashed_state") == "true", _text(F.concat("modified_base", suffix)))),
        _pair("webViewLink", F.when(c("has_link"), _text(F.concat(F.lit("https://drive.example/"), c("id"))))),
        _pair("thumbnailLink", F.when(c("has_thumbnail"), _text(F.concat(F.lit("https://img.example/"), c("id"))))),
        _pair("version", F.when(c("has_version"), _text(c("doc_id").cast("string")))),
        _pair("md5Checksum", F.when(c("has_md5"), _text(c("md5_value")))),
        _pair("description", F.when(c("doc_id") % 5 == 0, _text(F.concat(c("lang"), F.lit(" document"))))),
        _pair("folderColorRgb", F.when(c("has_color"), _text(F.lit("#8f8f8f")))),
        _pair("parents", _state("parents_state", value=F.concat(F.lit("["), _text(c("parent_id")), F.lit("]")))),
        _pair(
            "owners",
            _state(
                "owners_state",
                one=F.concat(F.lit("["), owner, F.lit("]")),
                two=F.concat(F.lit("["), owner, F.lit(","), second, F.lit("]")),
            ),
        ),
        _pair("lastModifyingUser", _state("user_state", value=owner)),
        _pair(
            "capabilities",
            _state(
                "caps_state",
                value=_object(
                    _pair("canEdit", _bool(c("can_edit"))),
                    _pair("canShare", _bool(c("can_share"))),
                    _pair("canMoveItemWithinDrive", _bool(c("can_move"))),
                ),
            ),
        ),
        _pair("trashed", _state("trashed_state", true=F.lit("true"), false=F.lit("false"))),
        _pair("starred", _bool(c("starred"))),
        _pair("explicitlyTrashed", F.when(c("explicitly"), F.lit("true"))),
        _pair("shared", _bool(c("shared"))),
        _pair("viewedByMe", F.when(c("viewed"), F.lit("true"))),
        _pair(
            "permissions",
            F.when(c("permission_rows") == 0, F.lit("[]")).when(
                c("permission_rows") > 0, F.concat(F.lit("["), F.concat_ws(",", permission), F.lit("]"))
            ),
        ),
        _pair("appProperties", F.when(c("has_app_properties"), F.lit('{"a":"1"}'))),
        _pair("properties", F.when(c("has_properties"), F.lit('{"b":"2"}'))),
        _pair("unknownField", F.when(c("doc_id") % 15 == 0, F.lit("1"))),
    )


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, file_id, connection_id, customer_id, raw_json``."""

    facts_table = landed(spark, sf_dir, "files", lambda: fact(spark, sf_dir, "files").drop("text"))

    def build() -> DataFrame:
        return facts_table.select(
            "doc_id", F.col("id").alias("file_id"), "connection_id", "customer_id", raw_file_json().alias("raw_json")
        )

    return landed(spark, sf_dir, "raw_files", build)


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed content per file: the whole text of the document."""
    return fact(spark, sf_dir, "files").select("customer_id", "connection_id", F.col("id").alias("file_id"), F.col("text").alias("content"))


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir, "connections").select(
        "connection_id",
        "customer_id",
        "snowball_id",
        "external_id",
        F.col("external_id").alias("user_id"),
        F.concat(F.lit("stored-"), "connection_id").alias("access_token"),
        F.struct("sync_files", "sync_folders", "sync_shared_drives").alias("settings"),
        "display_name",
    )


def connection_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The connections over time, one row per version."""
    return landed(spark, sf_dir, "connection_versions", lambda: fact(spark, sf_dir, "connection_versions")).select(
        "connection_id", "valid_from", "version_seq", "active", "customer_id", "snowball_id", "external_id",
        F.struct("sync_files", "sync_folders", "sync_shared_drives").alias("settings"),
    )


def start_token_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to the question for a start token; some hold none, an empty one, or no JSON."""
    key = F.col("c_custkey")
    answer = F.when(key % 13 == 0, F.lit("{}")).when(key % 17 == 0, F.lit('{"startPageToken":""}')).when(key % 19 == 0, F.lit("gone"))
    return fact(spark, sf_dir, "connections").select(
        "connection_id", F.coalesce(answer, _object(_pair("startPageToken", _text(key.cast("string"))))).alias("token_json")
    )


def about(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account rows as JSON text; every fifth account has no email."""
    key = F.col("c_custkey")
    user = _object(
        _pair("displayName", _text(F.col("display_name"))),
        F.when(key % 5 != 0, _pair("emailAddress", _text(F.col("external_id")))),
    )
    quota = _object(
        _pair("limit", F.when(key % 3 != 0, _text(F.lit("16106127360")))),
        _pair("usage", _text(F.floor(F.abs("c_acctbal") * 100).cast("string"))),
    )
    return fact(spark, sf_dir, "connections").select(
        "connection_id", _object(_pair("user", user), _pair("storageQuota", quota)).alias("about_json")
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows; ``file`` is the raw file object as text, null or empty where the change carries none."""
    rows = fact(spark, sf_dir, "changes")
    files = raw_files(spark, sf_dir).select("doc_id", F.col("raw_json").alias("_file"))
    return (
        rows.join(files, "doc_id", "left")
        .withColumn("file", F.when(F.col("file_state") == "file", F.col("_file")).when(F.col("file_state") == "empty", F.lit("{}")))
        .withColumn("change_type", F.coalesce("raw_change_type", F.lit("file")))
        .drop("_file", "raw_change_type", "file_state")
    )


def change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed without file bodies."""
    return (
        fact(spark, sf_dir, "changes")
        .withColumn("change_type", F.coalesce("raw_change_type", F.lit("file")))
        .drop("raw_change_type")
    )


def _webhook_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notifications as message text, half of them in JSON-RPC form."""
    c = F.col
    uri = F.when(c("tokenless"), F.lit("https://api.example/changes?alt=json")).otherwise(
        F.concat(F.lit("https://api.example/changes?alt=json&pageToken=p%2F"), c("page_no").cast("string"))
    )
    payload = F.when(c("payload_is_text"), F.lit('"opaque"')).otherwise(
        _object(
            _pair("kind", _text(c("kind"))),
            F.when(c("has_channel"), _pair("id", _text(F.lit("channel")))),
            F.when(c("has_uri"), _pair("resourceUri", _text(uri))),
            _pair("emailAddress", _text(c("email"))),
        )
    )
    customer = F.when(~c("no_customer"), F.lit('"cust_message"'))
    root = _object(
        _pair("message_id", _text(c("message_id"))),
        _pair("customer_id", customer),
        _pair("integration_id", _text(F.lit("drive"))),
        _pair("integration_connection_id", _text(c("message_connection_id"))),
        _pair("action", _text(F.lit("webhook"))),
        _pair("payload", payload),
    )
    parameters = _object(
        _pair("customer_id", customer),
        _pair("integration_provider_name", _text(F.lit("drive"))),
        _pair("integration_connection_id", _text(c("message_connection_id"))),
    )
    rpc = _object(
        _pair("id", _text(c("message_id"))),
        _pair("jsonrpc", _text(F.lit("2.0"))),
        _pair("method", _text(F.lit("metadata.integration.webhook.notify"))),
        _pair("params", _object(_pair("header", _object(_pair("parameters", parameters))), _pair("payload", payload))),
    )
    rows = landed(spark, sf_dir, "webhooks", lambda: fact(spark, sf_dir, "webhooks"))
    return rows.select(
        "seq", "ts", F.when(c("as_jsonrpc"), rpc).otherwise(root).alias("value")
    )


def _command_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Command messages as text; legacy and JSON-RPC form alternate."""
    c = F.col
    verb = c("verb")
    method = F.concat(
        F.lit("metadata.integration."),
        F.when(c("wrong_action"), F.lit("unknown.call"))
        .when(verb == "fetch", F.lit("content.fetch"))
        .when(verb == "write", F.lit("content.dispatch"))
        .when(verb == "init", F.lit("connection.initialize"))
        .when(verb == "teardown", F.lit("connection.teardown"))
        .when(verb == "webhook", F.lit("webhook.notify"))
        .otherwise(F.lit("capability.describe")),
    )
    connection = F.when(c("connection_state") == "value", _text(c("connection_id"))).when(
        c("connection_state") == "blank", F.lit('""')
    )
    customer = F.when(c("has_customer"), _text(c("customer_id")))
    shared = [
        _pair("resource_type", _text(c("resource_type"))),
        _pair("operation", _text(c("operation"))),
        _pair("payload", F.when(c("seq") % 43 != 0, F.lit('{"file_id":"f1"}'))),
        _pair("trigger_type", _text(c("trigger_type"))),
    ]
    metadata = _object(
        _pair("snowball_id", _text(c("msg_snowball_id"))), _pair("external_id", _text(c("msg_external_id")))
    )
    credentials = F.when(c("msg_token").isNotNull(), _object(_pair("access_token", _text(c("msg_token")))))
    pagination = F.when(c("max_results").isNotNull(), _object(_pair("max_results", c("max_results").cast("string"))))
    url = F.when(c("has_webhook_url"), _text(F.lit("https://hooks.example/drive")))
    config = _object(_pair("setup_webhook", _bool(c("seq") % 5 != 0)), _pair("webhook_url", url))
    parameters = _object(
        _pair("customer_id", customer),
        F.when(c("seq") % 31 != 0, _pair("integration_provider_name", _text(c("provider")))),
        _pair("integration_connection_id", connection),
    )
    rpc = _object(
        _pair("id", _text(c("message_id"))),
        _pair("jsonrpc", _text(F.lit("2.0"))),
        _pair("method", _text(method)),
        _pair(
            "params",
            _object(
                _pair("header", _object(_pair("parameters", parameters))),
                *shared,
                _pair("metadata", metadata),
                _pair("credentials", credentials),
                _pair("pagination", pagination),
                _pair("config", config),
            ),
        ),
    )
    legacy = _object(
        _pair("message_id", _text(c("message_id"))),
        _pair("customer_id", customer),
        _pair("integration_id", _text(c("provider"))),
        _pair("integration_connection_id", connection),
        _pair("action", _text(F.when(c("wrong_action"), F.lit("sing")).otherwise(verb))),
        *shared,
    )
    rows = landed(spark, sf_dir, "commands", lambda: fact(spark, sf_dir, "commands"))
    return rows.select(
        "seq", "ts", F.when(c("as_jsonrpc"), rpc).otherwise(legacy).alias("value")
    )


def _raw_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    user = _object(_pair("emailAddress", _text(c("user_email"))))
    raw = _object(
        _pair("id", _text(c("revision_no").cast("string"))),
        _pair("modifiedTime", _text(F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00+00:00")))),
        _pair("size", _state("size_state", text=_text(c("size_value").cast("string")), bad=_text(F.lit("big")))),
        F.when(c("keep_forever"), _pair("keepForever", F.lit("true"))),
        F.when(c("has_published"), _pair("published", _bool(c("published")))),
        _pair("lastModifyingUser", _state("user_state", value=user)),
        F.when(
            c("has_links"), F.lit('"exportLinks":{"application/pdf":"https://x.example/pdf","text/plain":"https://x.example/txt"}')
        ),
    )
    return fact(spark, sf_dir, "revisions").select(
        "file_id", "connection_id", "customer_id", "revision_no", "l_shipdate", "l_partkey", "l_suppkey",
        "l_extendedprice", raw.alias("raw_json"),
    )


def _raw_permissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    detail = F.lit('[{"permissionType":"file","role":"writer"},{"permissionType":"member","role":"reader","inherited":true,"inheritedFrom":"f2"}]')
    drive_detail = F.lit('[{"teamDrivePermissionType":"member","role":"organizer"}]')
    raw = _object(
        _pair("id", _text(c("permission_id"))),
        _pair("type", _text(c("kind"))),
        _pair("role", _text(c("role"))),
        _pair("displayName", _text(c("display_name"))),
        _pair("emailAddress", F.when(c("kind").isin("user", "group"), _text(c("email")))),
        _pair("domain", F.when(c("kind") == "domain", F.lit('"example.com"'))),
        _pair("allowFileDiscovery", F.when(c("discoverable"), F.lit("true"))),
        _pair("deleted", _bool(c("deleted"))),
        _pair("expirationTime", F.when(c("expires"), F.lit('"2025-01-01T00:00:00+00:00"'))),
        _pair("permissionDetails", F.when(c("detail_kind") == 1, detail).when(c("detail_kind") == 2, F.lit("null"))),
        _pair("teamDrivePermissionDetails", F.when(c("detail_kind") == 3, drive_detail)),
    )
    return fact(spark, sf_dir, "permissions").select(
        "file_id", "connection_id", "customer_id", "permission_id", raw.alias("raw_json")
    )


def _raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments with embedded replies as JSON text; one conversation is one comment thread."""
    rows = fact(spark, sf_dir, "comments")
    reply = F.struct(
        F.col("turn"),
        F.to_json(
            F.struct(
                F.concat(F.lit("r"), F.col("turn").cast("string")).alias("id"),
                F.col("content"),
                F.when(F.col("deleted"), F.lit(True)).alias("deleted"),
                F.create_map(F.lit("displayName"), F.col("author")).alias("author"),
                F.col("created_raw").alias("createdTime"),
            )
        ).alias("json"),
    )
    head = F.when(F.col("turn") == 0, F.struct("content", "author", "created_raw", "resolved"))
    grouped = rows.groupBy("comment_id", "file_id", "connection_id", "customer_id").agg(
        F.max(head).alias("head"), F.sort_array(F.collect_list(F.when(F.col("turn") > 0, reply))).alias("replies")
    )
    body = F.to_json(
        F.struct(
            F.col("comment_id").alias("id"),
            F.col("head.content").alias("content"),
            F.col("head.created_raw").alias("createdTime"),
            F.when(F.col("head.resolved"), F.lit(True)).alias("resolved"),
            F.create_map(F.lit("emailAddress"), F.concat("head.author", F.lit("@example.com"))).alias("author"),
        )
    )
    replies = F.concat(F.lit(',"replies":['), F.array_join(F.transform("replies", lambda r: r["json"]), ","), F.lit("]}"))
    raw = F.when(F.size("replies") > 0, F.concat(F.expr("left(_body, length(_body) - 1)"), replies)).otherwise(F.col("_body"))
    return grouped.withColumn("_body", body).select(
        "comment_id", "file_id", "connection_id", "customer_id", raw.alias("raw_json")
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir, "calls")


def state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir, "state")


def _write_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write commands with their payload as a struct."""
    payload = F.struct(
        "file_id", "name", "description", "mime_type", "parent_folder_id", "new_parent_folder_id",
        F.when(F.col("remove_parent").isNotNull(), F.array("remove_parent")).alias("remove_parents"),
        "role", "type", "permission_id", "email_address",
    )
    return fact(spark, sf_dir, "writes").select("seq", "command_id", "operation", payload.alias("payload"))


def webhook_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "webhook_messages", lambda: _webhook_messages(spark, sf_dir))


def command_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "command_messages", lambda: _command_messages(spark, sf_dir))


def raw_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "raw_revisions", lambda: _raw_revisions(spark, sf_dir))


def raw_permissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "raw_permissions", lambda: _raw_permissions(spark, sf_dir))


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "raw_comments", lambda: _raw_comments(spark, sf_dir))


def write_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "write_commands", lambda: _write_commands(spark, sf_dir))
