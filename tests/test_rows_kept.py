"""Nulls, repeats, missing ids, blank nonces and late rows: what goes in comes out, or is named as an error."""

import datetime as dt
import json

from pyspark.sql import functions as F

from stratafile.operators import blobs as B
from stratafile.operators import commands as C
from stratafile.operators import dedup as D
from stratafile.operators import filters as X
from stratafile.operators import joins as J
from stratafile.operators import messages as MSG
from stratafile.operators import metrics as A
from stratafile.operators import normalize as P
from stratafile.operators import windows as W
from stratafile.plans import resources as R
from stratafile.streaming import pipeline as SP
from stratafile.streaming import stateful as SS

DAY = dt.datetime(2024, 1, 1)


def test_pages_keep_files_without_or_with_the_same_id(spark):
    rows = [("c", "", k) for k in range(5)] + [("c", "a", 5), ("c", "a", 5), ("c", None, 6), (None, "b", 7), (None, None, 8)]
    paged = R.list_pages(spark.createDataFrame(rows, "connection_id string, id string, n int"), 3)
    got = paged.collect()
    assert sorted((r.connection_id, r.id, r.n) for r in got if r.connection_id and r.id) == [r for r in sorted(r for r in rows if r[0] and r[1])]
    assert len(got) == len(rows)
    places = [(r.page_no, r.batch_sequence) for r in got if r.connection_id == "c"]
    assert sorted(places) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0), (2, 1)]
    assert sum(r.batch_is_last for r in got) == 2


def test_running_total_over_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    assert sorted(r.total for r in W.running_total(df, ["k"], ["v"], F.col("v"), "total").collect()) == [1, 2, 5]


def test_ttl_dedup_passes_null_keys_and_names_untimed(spark):
    hour = dt.timedelta(hours=1)
    rows = [(None, DAY, 1), (None, DAY, 2), (None, DAY + 30 * hour, 3), ("a", DAY, 4), ("a", DAY + hour, 5), ("a", DAY + 25 * hour, 6), ("a", None, 7), ("b", None, 8)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, seq long")
    assert sorted(r.seq for r in D.ttl_dedup(df, "k", "ts", "seq", 86_400).collect()) == [1, 2, 3, 4, 6]
    assert sorted(r.seq for r in D.untimed(df, "ts").collect()) == [7, 8]


def test_offloaded_payloads_are_all_stored(spark):
    rows = [("c", "k", str(n), "x" * n) for n in (0, 9, 10, 11, 500)] + [("c", "k", "null", None)]
    df = spark.createDataFrame(rows, "customer_id string, connection_id string, message_id string, payload string")
    split = B.offload_split(df, "payload", "s3://b/", 10).collect()
    stored = {r.storage_path: r.content for r in B.payloads_to_store(df, "payload", "s3://b/", 10).collect()}
    inline = {r.message_id: r.data for r in split if not r.offloaded}
    assert {r.s3_url for r in split if r.offloaded} == set(stored)
    assert sorted(map(len, stored.values())) == [11, 500] and inline["10"] == "x" * 10


PAYLOAD = "name:string,description:string,mime_type:string,file_id:string,parent_folder_id:string,new_parent_folder_id:string,remove_parents:array<string>,permission_id:string,role:string,type:string,email_address:string"


def commands(spark, rows):
    full = [(f"c{seq}", seq, op, {**dict.fromkeys(x.split(":")[0] for x in PAYLOAD.split(",")), **payload}) for seq, op, payload in rows]
    return spark.createDataFrame(full, f"command_id string, seq long, operation string, payload struct<{PAYLOAD}>")


def test_partial_updates_and_moves_add_up(spark):
    catalog = spark.createDataFrame([("f", "old", "text", "m", ["p", "q"], False)], "id string, name string, description string, mime_type string, parent_ids array<string>, trashed boolean")
    cmds = commands(spark, [
        (1, "update_file", {"file_id": "f", "name": "new"}), (2, "update_file", {"file_id": "f", "description": "d"}),
        (3, "move_file", {"file_id": "f", "new_parent_folder_id": "x", "remove_parents": ["p"]}),
        (4, "move_file", {"file_id": "f", "new_parent_folder_id": "y", "remove_parents": ["x"]}),
        (5, "move_file", {"file_id": "f", "new_parent_folder_id": "p"}), (6, "trash_file", {"file_id": "f"}),
    ])
    row = C.apply_file_commands(catalog, cmds).first()
    assert (row.name, row.description, row.mime_type, row.trashed) == ("new", "d", "m", True)
    assert row.parent_ids == ["q", "y", "p"]


def test_connections_without_a_cursor_start_at_the_newest_token(spark):
    feed = spark.createDataFrame([("a", n) for n in range(3)] + [("b", n) for n in range(3)] + [("c", 0)], "connection_id string, page_no long")
    cursors = spark.createDataFrame([("a", 1)], "connection_id string, cursor long")
    starts = spark.createDataFrame([("a", 3), ("b", 2)], "connection_id string, start_cursor long")
    got = J.changes_after_cursor(feed, cursors, starts).collect()
    assert sorted((r.connection_id, r.page_no) for r in got) == [("a", 1), ("a", 2), ("b", 2)]


def test_shared_drives_follow_the_setting(spark):
    rows = [(s, w) for s in (None, False, True) for w in (None, False, True)]
    df = spark.createDataFrame(rows, "shared boolean, setting boolean")
    kept = {(r.shared, r.setting) for r in df.where(X.wanted_drive(F.col("shared"), F.col("setting"))).collect()}
    assert kept == {r for r in rows if r != (True, False)}


def test_network_errors_count(spark):
    calls = spark.createDataFrame([("e", None), ("e", 200), ("e", 404)], "endpoint string, status_code int")
    assert {r.status_code: r.errors for r in A.api_calls_by_code(calls).collect()} == {None: 1, 200: 0, 404: 1}


def test_long_threads_keep_their_count(spark):
    rows = [("c", t, "a", "x") for t in range(8)]
    got = P.assemble_replies(spark.createDataFrame(rows, "comment_id string, turn long, author string, content string"), chunk=3).collect()
    assert sorted((r.chunk, len(r.replies), r.reply_count) for r in got) == [(0, 3, 7), (1, 3, 7), (2, 1, 7)]


def notification(k, provider="drive", connection="c1", **payload):
    body = {"id": "ch", "resourceUri": "https://x.example/changes?pageToken=p%2F1", **payload}
    return json.dumps({"message_id": f"m{k}", "customer_id": "cust", "integration_id": provider, "integration_connection_id": connection, "payload": body})


def test_webhook_stream_names_every_notification(spark, cfg, tmp_path):
    values = [notification(1, cfg.provider), notification(2, "other"), notification(3, cfg.provider, "unknown"), json.dumps({"message_id": "m4", "integration_id": cfg.provider, "payload": {}}), notification(5, cfg.provider)]
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.json(f"{tmp_path}/in")
    connections = spark.createDataFrame([("c1", "cust", "s", None, None)], "connection_id string, customer_id string, snowball_id string, external_id string, settings string")
    stream = spark.readStream.schema("value string").json(f"{tmp_path}/in")
    SP.webhook_stream(stream, cfg, lambda: connections, lambda df, _: df.select("message_id"), f"{tmp_path}/out", f"{tmp_path}/check")
    records = {r.message_id for r in spark.read.parquet(f"{tmp_path}/out/records").collect()}
    errors = {r.message_id: r.reason for r in spark.read.parquet(f"{tmp_path}/out/errors").collect()}
    assert records == {"m1", "m5"} and set(errors) == {"m3", "m4"} and all(errors.values())
    outcomes = {r.message_id: r.outcome for r in R.webhook_outcomes(spark.createDataFrame([(v,) for v in values], "value string"), connections, cfg).collect()}
    assert outcomes == {"m1": "fetch", "m2": "skipped", "m3": "unresolved", "m4": "invalid", "m5": "fetch"}
    assert MSG.UNRESOLVED_IDS


def test_stream_dedup_passes_blanks_and_judges_late_rows_by_their_time(spark, tmp_path):
    hour = dt.timedelta(hours=1)
    first = [("a", DAY + 50 * hour, 1), ("a", DAY + 51 * hour, 2), ("", DAY, 3), (None, DAY, 4), ("", DAY, 5)]
    late = [("a", DAY, 6), ("b", DAY, 7), ("a", DAY + 49 * hour, 8)]
    schema = "nonce string, ts timestamp, seq long"
    for k, rows in enumerate((first, late)):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{tmp_path}/in{k}")
    stream = spark.readStream.schema(schema).json(f"{tmp_path}/in0")

    def drain(df, name):
        df.writeStream.format("parquet").option("path", f"{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/{name}-c").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}").collect()

    assert sorted(r.seq for r in drain(SS.dedup_within_ttl(stream), "water")) == [1, 3, 4, 5]
    both = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.json").json(f"{tmp_path}/in[01]")
    got = drain(SS.ttl_dedup_stream(both.where("nonce <> ''"), "nonce", "ts", "seq", 86_400, expires=False), "exact")
    assert {r.seq for r in got} >= {6, 7} and len({r.seq for r in got} & {1, 2, 8}) == 1
