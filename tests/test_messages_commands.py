import json

import pytest
from pyspark.sql import functions as F

from stratafile.operators import commands as C
from stratafile.operators import envelope as E
from stratafile.operators import joins as J
from stratafile.operators import messages as MSG
from stratafile.operators import quality as Q
from stratafile.operators import state as ST
from stratafile.sources.manifest import capability_manifest
from stratafile.sources.sinks import ordered_by_connection, publish_manifest
from stratafile.sources import listing as SL
from stratafile.streaming import pipeline as SP

LEGACY = {"message_id": "m", "customer_id": "c", "integration_id": "drive", "integration_connection_id": "conn", "action": "fetch"}


def parsed(spark, *messages):
    rows = [(i, json.dumps(m)) for i, m in enumerate(messages)]
    return MSG.parse_messages(spark.createDataFrame(rows, "i int, value string"))


def rpc(method, params=None, **parameters):
    return {"id": "r", "jsonrpc": "2.0", "method": f"metadata.integration.{method}",
            "params": {"header": {"parameters": parameters}, **(params or {})}}


def values(df, column):
    return [r.v for r in df.orderBy("i").select(column.alias("v")).collect()]


def test_ids(spark):
    df = parsed(spark, LEGACY, rpc("content.fetch", integration_connection_id="x", integration_provider_name="p"),
                rpc("content.fetch", integration_connection_id=""), {"integration_connection_id": None}, {},
                {"jsonrpc": "2.0", "params": {"header": {"parameters": {"integration_connection_id": "y"}}}})
    assert values(df, MSG.connection_id_of()) == ["conn", "x", "unknown", None, "unknown", "y"]
    assert values(df, MSG.provider_of()) == ["drive", "p", None, None, None, None]


def test_fetch_validation(spark, cfg):
    df = parsed(
        spark, LEGACY, {k: v for k, v in LEGACY.items() if k != "customer_id"}, {**LEGACY, "action": "write"},
        {**LEGACY, "resource_type": "songs"}, rpc("content.fetch", customer_id="c", integration_connection_id="x"),
        rpc("content.fetch", integration_connection_id="x"), rpc("content.fetch", {"resource_type": "songs"}, customer_id="c", integration_connection_id="x"),
        rpc("other", customer_id="c", integration_connection_id="x"), {**LEGACY, "customer_id": None},
    )
    assert values(df, MSG.fetch_error(cfg)) == [None, "customer_id", "action", "resource_type", None, "customer_id", "resource_type", "method", None]


def test_trigger_validation_lists_all_missing(spark):
    df = parsed(spark, {"message_id": "m", "trigger_type": "poll"}, {**LEGACY, "trigger_type": "weekly"}, {**LEGACY, "trigger_type": "poll"})
    assert values(df, MSG.trigger_error()) == [
        "absent: customer_id, integration_id, integration_connection_id",
        "unknown trigger weekly (known: full_sync, incremental, poll)", None]


def test_routes(spark, cfg):
    df = parsed(spark, LEGACY, {**LEGACY, "integration_id": "mail"}, {**LEGACY, "action": "sing"}, rpc("connection.teardown"),
                rpc("capability.describe"), rpc("content.dispatch", integration_provider_name="mail"), rpc("webhook.notify", integration_provider_name=""))
    assert values(df, MSG.route(cfg)) == ["fetch", "skipped", None, "teardown", "capability", "skipped", "webhook"]


def test_webhook_rules(spark):
    base = {"message_id": "m", "customer_id": "c", "integration_connection_id": "conn"}
    messages = [
        {**base, "payload": {"id": "ch", "resourceUri": "https://x?pageToken=1"}},
        {**base, "payload": {"id": "ch", "kind": "drive#stop"}},
        {**base, "payload": {"id": "ch"}}, {**base, "payload": {}}, {**base, "payload": "text"}, {**base, "payload": None}, {},
    ]
    rows = spark.createDataFrame([(i, json.dumps(m)) for i, m in enumerate(messages)], "i int, value string")
    assert [r.error for r in MSG.parse_webhooks(rows).orderBy("i").collect()] == [
        None, None, "payload names no resource", "payload names no channel",
        "payload is no object", "absent in notification: payload",
        "absent in notification: message_id, customer_id, integration_connection_id, payload"]


def test_resolution(spark):
    connections = spark.createDataFrame([("c2", "cu2", "s2", "a@x", None), ("c1", "cu1", "s1", "a@x", None), ("c3", "cu3", "s3", None, None)],
                                        "connection_id string, customer_id string, snowball_id string, external_id string, settings struct<sync_files: boolean>")
    hooks = spark.createDataFrame([("m1", "unknown", "mc", "a@x"), ("m2", "pending_lookup", "mc", "z@x"), ("m3", "", "mc", None), ("m4", "c3", "mc", "a@x")],
                                  "message_id string, message_connection_id string, message_customer_id string, email string")
    rows = {r.message_id: r for r in J.resolve_connections(hooks, connections).collect()}
    assert (rows["m1"].connection_id, rows["m1"].customer_id, rows["m1"].resolution_error) == ("c1", "cu1", None)
    assert rows["m2"].resolution_error == "CONNECTION_NOT_FOUND"
    assert rows["m3"].resolution_error == "EXTERNAL_ID_EXTRACTION_FAILED"
    assert (rows["m4"].connection_id, rows["m4"].customer_id, rows["m4"].snowball_id) == ("c3", "mc", "s3")


def test_outbound_rejects_other_formats(spark, cfg):
    df = spark.createDataFrame([("k", "n", "2.0", "{}"), ("k", None, "1.0", "{}"), ("k", "", None, "{}")], "key string, nonce string, jsonrpc string, value string")
    accepted, rejected = E.outbound_records(df, cfg)
    assert accepted.count() == 1 and rejected.count() == 2
    assert accepted.first().headers == {"source": "drive-worker", "produced_at": cfg.run_ts, "nonce": "n"}


PAYLOAD = "struct<file_id: string, name: string, description: string, mime_type: string, parent_folder_id: string, new_parent_folder_id: string, remove_parents: array<string>, role: string, type: string, permission_id: string, email_address: string>"


def commands(spark, *items):
    names = ["file_id", "name", "description", "mime_type", "parent_folder_id", "new_parent_folder_id", "remove_parents", "role", "type", "permission_id", "email_address"]
    rows = [(i, f"cmd{i}", op, tuple(payload.get(n) for n in names)) for i, (op, payload) in enumerate(items)]
    return spark.createDataFrame(rows, f"seq bigint, command_id string, operation string, payload {PAYLOAD}")


def catalog(spark):
    return spark.createDataFrame([(f, f"name {f}", None, "text/plain", ["p"], False) for f in "abcde"],
                                 "id string, name string, description string, mime_type string, parent_ids array<string>, trashed boolean")


def test_file_commands(spark):
    df = commands(spark, ("update_file", {"file_id": "a", "name": "first"}), ("update_metadata", {"file_id": "a", "name": "last"}),
                  ("trash_file", {"file_id": "b"}), ("untrash_file", {"file_id": "b"}), ("trash_file", {"file_id": "c"}),
                  ("delete_file", {"file_id": "d"}), ("move_file", {"file_id": "e", "new_parent_folder_id": "q", "remove_parents": ["p"]}),
                  ("create_folder", {"name": "new"}), ("copy_file", {"file_id": "a", "parent_folder_id": "z"}), ("upload_file", {}))
    rows = C.apply_file_commands(catalog(spark), df).collect()
    by_id = {r.id: r for r in rows}
    assert by_id["a"].name == "last" and not by_id["b"].trashed and by_id["c"].trashed and "d" not in by_id
    assert by_id["e"].parent_ids == ["q"]
    extra = sorted((r.name, r.mime_type, tuple(r.parent_ids)) for r in rows if r.id.startswith("new_"))
    assert extra == [("Copy of name a", "text/plain", ("z",)), ("new", "application/vnd.google-apps.folder", ())]
    assert [(r.command_id, r.error) for r in C.rejected_commands(catalog(spark), df).collect()] == [("cmd9", "name")]


@pytest.mark.parametrize("op,payload,error", [
    ("paint_file", {}, "operation"), (None, {}, "operation"), ("delete_file", {}, "file_id"), ("move_file", {"file_id": "a"}, "new_parent_folder_id"),
    ("share_file", {"file_id": "a", "role": "king", "type": "user"}, "role"), ("share_file", {"file_id": "a", "role": "reader", "type": "robot"}, "type"),
    ("update_permission", {"file_id": "a", "permission_id": "p", "role": "reader"}, None), ("unshare_file", {"file_id": "a"}, "permission_id"),
    ("share_file", {"role": "reader", "type": "user"}, "file_id"), ("create_permission", {"file_id": "a", "role": "reader"}, "type"),
])
def test_command_errors(spark, op, payload, error):
    assert C.check_commands(commands(spark, (op, payload))).first().error == error


def test_state(spark, cfg):
    schema = "connection_id string, key string, value string, updated_at timestamp, seq bigint"
    now = cfg.now
    old = spark.createDataFrame([("c", "drive_page_token", "1", None, 1)], schema).withColumn("updated_at", now)
    new = spark.createDataFrame([("c", "drive_page_token", "9", None, 2), ("d", "drive_page_token", "", None, 3)], schema).withColumn("updated_at", now)
    state = ST.upsert_state(old, new)
    assert sorted((r.connection_id, r.value) for r in state.collect()) == [("c", "9"), ("d", "")]
    assert [(r.connection_id, r.cursor) for r in ST.cursors(state, cfg).collect()] == [("c", 9)]
    assert ST.upsert_state(state, new).exceptAll(state).count() == 0
    gone = spark.createDataFrame([("c",)], "connection_id string")
    assert [r.connection_id for r in ST.delete_state(state, gone).collect()] == ["d"]


def test_manifest(spark, tmp_path):
    manifest = capability_manifest(spark)
    assert manifest.count() == 24 and manifest.select("action").distinct().count() == 5
    assert not publish_manifest(manifest, str(tmp_path / "m"), mock=True) and not publish_manifest(manifest, "")
    assert publish_manifest(manifest, str(tmp_path / "m")) and spark.read.json(str(tmp_path / "m")).count() == 24


def test_ordered_sink_keeps_a_connection_together(spark):
    df = spark.range(300).select((F.col("id") % 7).cast("string").alias("key"), (300 - F.col("id")).alias("seq"))
    out = ordered_by_connection(df, "key", ["seq"], 4).withColumn("p", F.spark_partition_id()).collect()
    assert all(len({r.p for r in out if r.key == k}) == 1 for k in {r.key for r in out})
    for k in {r.key for r in out}:
        seqs = [r.seq for r in out if r.key == k]
        assert seqs == sorted(seqs)


def test_error_split(spark, cfg):
    calls = spark.createDataFrame([(429, "7", None), (503, None, None), (404, None, "gone"), (200, None, None), (None, None, None)],
                                  "status_code int, retry_after string, body string").withColumn("connection_id", F.lit("c"))
    errors = Q.api_errors(calls, cfg)
    retriable, terminal = SP.split_retriable(errors)
    assert retriable.count() == 3 and [r.error_message for r in terminal.collect()] == ["request refused, status 404 - gone"]
    assert sorted(r.retry_after for r in retriable.collect() if r.retry_after) == [7]


def test_empty_and_full_list_pages(spark):
    pages = spark.createDataFrame([("c", 0, '{"files":[{"id":"1"},{"id":"2"}],"nextPageToken":"t"}'), ("c", 1, '{"files":[{"id":"3"}]}'), ("c", 2, '{"files":[]}'), ("d", 0, "{}")],
                                  "connection_id string, page_no bigint, page_json string")
    rows = SL.explode_list_pages(pages).orderBy("page_no", "batch_sequence").collect()
    assert [(r.raw_json, r.batch_sequence, r.batch_is_last) for r in rows] == [('{"id":"1"}', 0, False), ('{"id":"2"}', 1, False), ('{"id":"3"}', 0, True)]
    assert sorted((r.connection_id, r.page_no) for r in SL.empty_list_pages(pages).collect()) == [("c", 2), ("d", 0)]


def test_content_read(spark, tmp_path):
    (tmp_path / "f1.txt").write_bytes(b"abc")
    (tmp_path / "f2").write_bytes(b"abcd")
    rows = SL.read_content(spark, str(tmp_path)).orderBy("file_id").collect()
    assert [(r.file_id, r.length) for r in rows] == [("f1", 3), ("f2", 4)]


def test_counters_observed_during_another_action(spark):
    from stratafile.operators.metrics import observed

    df, seen = observed(spark.createDataFrame([("ok",), ("terminal",), ("retriable",)], "outcome string"), "batch")
    assert len(df.collect()) == 3
    assert seen.get == {"rows": 3, "failed": 2}


def test_offload_and_blobs(spark):
    from stratafile.operators import blobs as B

    rows = [("c", "conn", "m1", "x" * 10), ("c", "conn", "m2", "x" * 11), ("c", "conn", "m3", "x" * 10), ("d", "conn", "m4", "x" * 10)]
    df = spark.createDataFrame(rows, "customer_id string, connection_id string, message_id string, payload string")
    split = {r.message_id: r for r in B.offload_split(df, "payload", "s3://b/", 10).collect()}
    assert split["m1"].data == "x" * 10 and split["m1"].s3_url is None
    assert split["m2"].data is None and split["m2"].s3_url == "s3://b/payloads/c/conn/m2.json" and split["m2"].payload_size_bytes == 11
    content = df.select("customer_id", F.col("message_id").alias("file_id"), F.col("payload").alias("content"))
    index = B.blob_index(B.content_refs(content))
    assert sorted((r.customer_id, r.first_file_id, r.ref_count) for r in index.collect()) == [("c", "m1", 2), ("c", "m2", 1), ("d", "m4", 1)]
    assert B.blobs_to_store(content, index).count() == 3


def test_retry_schedule(spark, cfg):
    from stratafile.operators import retry as RT

    rows = [(1, "RetriableError", None), (2, "RetriableError", None), (2, "RateLimitError", 30), (3, "RetriableError", None), (1, "TerminalError", None)]
    df = spark.createDataFrame(rows, "attempt int, error_class string, retry_after int").withColumn("failed_at", cfg.now - F.expr("INTERVAL 10 SECONDS"))
    out = [(r.wait_seconds, r.disposition) for r in RT.schedule(df, cfg).collect()]
    assert out == [(2.0, "due"), (4.0, "due"), (30.0, "waiting"), (None, "dead_letter"), (None, "dead_letter")]
