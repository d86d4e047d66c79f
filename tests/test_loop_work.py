"""What the message loop does once: tables of a batch are kept in files, and a file's record is rendered once for all requests."""

import datetime as dt
import json
from pathlib import Path

from pyspark.sql import functions as F

from stratafile.operators import envelope as E
from stratafile.operators import normalize as P
from stratafile.plans import handlers as H
from stratafile.plans import resources as R
from stratafile.streaming import commits as C
from stratafile.streaming import loop as L

NOW = dt.datetime(2024, 3, 1, tzinfo=dt.UTC)
FOLDER = "application/vnd.google-apps.folder"
SETTINGS = "struct<sync_files: boolean, sync_folders: boolean>"


def land(spark, bodies, path):
    rows = [(k, dt.datetime(2024, 1, 1, 0, 0, k, tzinfo=dt.UTC), json.dumps(body)) for k, body in enumerate(bodies, 1)]
    spark.createDataFrame(rows, "seq long, ts timestamp, value string").coalesce(1).write.json(path)
    return spark.readStream.schema("seq bigint, ts timestamp, value string").json(path)


def command(k):
    return {"message_id": f"m{k}", "customer_id": "c", "integration_id": "drive", "integration_connection_id": "k", "action": "fetch"}


def plan(df, which="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def test_outputs_are_planned_from_files(spark, cfg, tmp_path):
    """Neither a handler's rows nor what is read of the errors leads back to the stream, its state or the parse."""
    seen, kept = [], []
    base = f"{tmp_path}/out"

    def handle(df, _):
        seen.append(plan(df))
        kept.extend(p.name for p in Path(f"{base}/work").glob("batch-*/*"))
        return {"records": df.select(*L.CARRY[4:], "seq", F.col("connection_id").alias("key"), F.lit("n").alias("nonce"), "value")}

    def answer(asked):
        return asked.withColumns({"status_code": F.when(F.col("attempt") == 1, 503).otherwise(200), "retry_after": F.lit(None).cast("string"), "body": F.lit("")})

    query = L.start_loop(land(spark, [command(k) for k in range(5)], f"{tmp_path}/in"), cfg, {"fetch": handle}, base, f"{tmp_path}/check", answer)
    L.drain(spark, query, base, NOW)
    assert len(seen) > 1 and not any(word in text for text in seen for word in ("InMemoryRelation", "from_json", "TransformWithState"))
    assert {"routed", "answered"} <= set(kept) and not list(Path(f"{base}/work").glob("*"))  # gone with the batch
    settled = C.committed(spark, base, "settled", L.SETTLED).collect()
    assert sorted((r.seq, r.outcome, r.attempt) for r in settled) == [(k, "done", 2) for k in range(1, 6)]


def test_a_first_step_runs_once_for_all_outputs(spark, cfg, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def called(text):
        calls.add(1)
        return text

    def prepare(df, _):
        return df.select(*L.CARRY, "connection_id", F.udf(called, "string")("connection_id").alias("key"))

    def make(df, _):
        out = df.select("seq", "message_id", "route", "key", F.lit("n").alias("nonce"), "value")
        state = df.select("connection_id", "key", "value", F.col("ts").alias("updated_at"), "seq")
        return {"records": out, "state": state}

    base = f"{tmp_path}/out"
    stream = land(spark, [command(k) for k in range(7)], f"{tmp_path}/in")
    L.drain(spark, L.start_loop(stream, cfg, {"fetch": L.Steps(prepare, make)}, base, f"{tmp_path}/check"), base, NOW)
    assert calls.value == 7 and C.committed(spark, base, "state", L.STATE).count() == 7


def files(spark):
    """Names that JSON escapes, files and folders, a bad row, missing fields."""
    raw = [
        {"id": "a", "name": 'say "hi"\n\\ ü', "mimeType": "text/plain", "size": "12", "owners": [{"displayName": "Al"}]},
        {"id": "b", "name": None, "mimeType": FOLDER, "parents": ["p"], "trashed": True},
        {"id": "c", "mimeType": None}, {}, {"id": "d", "mimeType": "application/pdf", "webViewLink": "https://l"}, {"id": "e", "mimeType": FOLDER},
    ]
    return [json.dumps(r) for r in raw]


def test_body_records_are_the_rendered_envelopes(spark, cfg):
    rows = spark.createDataFrame([(t, "k", "cust") for t in files(spark)], "raw_json string, connection_id string, customer_id string")
    normal = P.normalize_files(rows, cfg, keep=("connection_id", "customer_id"))
    batch = {
        "snowball_id": F.lit("s"), "batch_id": F.concat(F.lit('b"'), "id"), "batch_sequence": F.lit(3).cast("bigint"), "batch_is_last": F.lit(True),
        "batch_page_token": F.when(F.col("id") != "a", F.lit('t"1')), "origin": F.lit("webhook"),
    }
    whole = E.to_record(E.ingest_envelopes(normal.withColumns(batch), cfg, extra={"source": "origin"}))
    parts = E.body_records(E.file_bodies(normal, cfg, keep=("customer_id",)).withColumns(batch), cfg, extra={"source": "origin"})
    assert whole.columns == parts.columns and sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def feed(spark):
    texts = [*files(spark), *files(spark)]
    rows = [(k, f"k{k % 2}", f"p/{k // 6}", k % 7 == 3, "file", text) for k, text in enumerate(texts)] + [(90, "k0", "p/0", False, "file", None)]
    return spark.createDataFrame(rows, "seq long, connection_id string, page_token string, removed boolean, change_type string, file string")


def test_pages_that_many_requests_name(spark, cfg):
    """The records of the change by change form, whatever types a connection wants; a request that is there twice has all
    places once."""
    wants = [(True, True), (None, None), (True, False), (False, True), (None, False), (False, False)]
    rows = [(i, f"m{i}", f"k{i % 2}", f"p/{i // 2 % 2}", "cust", None if i == 5 else "s", wants[i % 6]) for i in range(24)]
    requests = spark.createDataFrame(rows, f"request_seq long, message_id string, connection_id string, page_token string, customer_id string, snowball_id string, settings {SETTINGS}")
    changes = feed(spark)
    page = R.webhook_page_rows(requests.withColumn("notifications", F.lit(1)), changes.where("file IS NOT NULL AND NOT removed"), cfg, keep=("request_seq",))
    old = E.to_record(R.webhook_records(page, cfg, keep=("request_seq", "message_id"), page=("request_seq",)), keep=("request_seq", "message_id"))
    new = R.webhook_page_records(requests, changes, cfg)
    expected = sorted(map(tuple, old.select(*new.columns).collect()))
    assert len(expected) > 30 and sorted(map(tuple, new.collect())) == expected
    twice = R.webhook_page_records(requests.unionByName(requests), changes, cfg).collect()
    places = {}
    for r in twice:
        places.setdefault(r.request_seq, []).append(json.loads(r.value)["params"]["header"]["parameters"]["batch_sequence"])
    assert len(twice) == 2 * len(expected) and all(sorted(p) == list(range(len(p))) for p in places.values())


def test_the_webhook_handler_parses_a_change_before_the_join(spark, cfg):
    body = {**command(1), "action": "webhook", "payload": {"id": "ch", "resourceUri": "https://x.example/changes?pageToken=p%2F0"}}
    rows = [(k, NOW, json.dumps({**body, "message_id": f"m{k}", "integration_connection_id": "k0"}), 1) for k in range(50)]
    routed = R.MSG.route_messages(spark.createDataFrame(rows, "seq long, ts timestamp, value string, attempt long"), cfg)
    connections = spark.createDataFrame([("k0", "cust", "s", "e@x", (True, True))], f"connection_id string, customer_id string, snowball_id string, external_id string, settings {SETTINGS}")
    tables = H.Tables(connections, None, None, None, feed(spark), None, None)
    records = H.webhook_handler(tables)(routed, cfg)["records"]
    assert records.count() == 50 * 2
    text = plan(records)
    assert text.index("struct(_r_keys") > text.index("Join Inner")  # the parse lies below it: once a change, not once a request


def test_no_side_that_grows_is_collected_in_the_driver(spark, cfg, tmp_path):
    """Requests, pages, bodies and the catalog are merged, however small Spark takes their files for."""

    def stored(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    bodies = [json.dumps({**command(1), "action": action, "operation": "delete_file", "payload": {"file_id": "a"}}) for action in ("fetch", "write", "webhook")]
    messages = spark.createDataFrame([(k, NOW, body, 1) for k, body in enumerate(bodies)], "seq long, ts timestamp, value string, attempt long")
    routed = stored(R.MSG.route_messages(messages, cfg), "routed")
    connections = spark.createDataFrame([("k", "cust", "s", "e@x", (True, True))], f"connection_id string, customer_id string, snowball_id string, external_id string, settings {SETTINGS}")
    raw = spark.createDataFrame([(t, "k", "cust") for t in files(spark)], "raw_json string, connection_id string, customer_id string")
    pages = stored(H.first_pages(R.good_files(raw, cfg), cfg), "pages")
    tables = H.Tables(connections, None, None, pages, stored(feed(spark), "feed"), pages.select("id"), None)
    for handler in (H.fetch_handler, H.write_handler, H.webhook_handler):
        for name, output in handler(tables)(routed, cfg).items():
            text = plan(output, "sparkPlan")
            assert "BroadcastHashJoin" not in text and "Join" in text.replace("BroadcastNestedLoopJoin", ""), (handler, name)
