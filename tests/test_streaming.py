import json
import uuid

from pyspark.sql import functions as F

from stratafile.operators.quality import error_records
from stratafile.streaming import pipeline as SP
from stratafile.streaming import stateful as SS


def fresh(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def land(path, name, rows):
    import os
    import time

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in rows)
    time.sleep(0.05)


def drain(df, root, mode="append"):
    query = (
        df.writeStream.format("memory").queryName("q" + uuid.uuid4().hex).option("checkpointLocation", root)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return [tuple(r) for r in df.sparkSession.table(query.name).collect()]


def test_foreach_batch_replay_replaces_its_output(spark, cfg, tmp_path):
    source, out = fresh(tmp_path), fresh(tmp_path)
    message = {"message_id": "m", "customer_id": "c", "integration_id": "drive", "integration_connection_id": "k", "action": "fetch"}
    land(source, "a", [{"seq": 1, "value": json.dumps(message)}, {"seq": 2, "value": json.dumps({**message, "resource_type": "songs"})}])

    def run(checkpoint):
        stream = spark.readStream.schema("seq bigint, value string").json(source)
        handlers = {"fetch": lambda df, c: df.select("connection_id")}
        SP.command_stream(stream, cfg, handlers, out, checkpoint)
        return spark.read.parquet(out + "/fetch").count(), spark.read.parquet(out + "/errors").count()

    first = run(fresh(tmp_path))
    assert first == (1, 1)
    assert run(fresh(tmp_path)) == first  # a lost checkpoint replays batch 0 over its own output


def test_message_loop_loses_no_message(spark, cfg, tmp_path):
    source, out = fresh(tmp_path), fresh(tmp_path)
    message = {"customer_id": "c", "integration_id": "drive", "integration_connection_id": "k"}
    sent = [("f", "fetch", {}), ("w", "webhook", {}), ("n", "noise", {}), ("bad", "fetch", {"resource_type": "songs"}),
            ("t", "teardown", {}), ("s", "fetch", {"integration_id": "mail"})]
    land(source, "a", [{"seq": k, "value": json.dumps({**message, "message_id": i, "action": a, **more})} for k, (i, a, more) in enumerate(sent)])

    def fails(df, c):
        rows = df.select("message_id", F.lit("RateLimitError").alias("name"), "connection_id")
        return df.select("connection_id").where("false"), error_records(
            rows, c, F.col("name"), F.lit("slow down"), F.col("connection_id"), source_message_id=F.col("message_id")
        )

    stream = spark.readStream.schema("seq bigint, value string").json(source)
    handlers = {"fetch": lambda df, c: df.select("message_id"), "teardown": fails}
    SP.command_stream(stream, cfg, handlers, out, fresh(tmp_path))

    def ids(name, column="source_message_id"):
        return sorted(r[0] for r in spark.read.parquet(f"{out}/{name}").select(column).collect())

    assert ids("fetch", "message_id") == ["f"]
    assert ids("unhandled", "message_id") == ["n", "w"]
    assert (ids("errors"), ids("retry"), ids("dead_letters")) == (["bad", "t"], ["t"], ["bad"])


def test_cursor_state(spark, tmp_path):
    source = fresh(tmp_path)
    land(source, "a", [{"connection_id": "c", "page_no": 2, "token": "t2"}, {"connection_id": "c", "page_no": 1, "token": "t1"}])
    land(source, "b", [{"connection_id": "c", "page_no": 0, "token": "t0"}, {"connection_id": "d", "page_no": 5, "token": "t5"}])
    pages = spark.readStream.schema("connection_id string, page_no bigint, token string").option("maxFilesPerTrigger", 1).json(source)
    rows = drain(SS.cursor_stream(pages), fresh(tmp_path), "update")
    assert set(rows) == {("c", 2, "t2"), ("d", 5, "t5")}


def test_renewal_timer(spark, tmp_path):
    source = fresh(tmp_path)
    hour = 3_600_000
    base = 1_704_067_200_000
    land(source, "a", [{"connection_id": "c", "expiration": base + 2 * hour, "ts": "2024-01-01T00:00:00Z"},
                       {"connection_id": "d", "expiration": base + 90 * hour, "ts": "2024-01-01T00:00:00Z"}])
    land(source, "b", [{"connection_id": "e", "expiration": base + 99 * hour, "ts": "2024-01-01T03:00:00Z"}])
    land(source, "c", [{"connection_id": "f", "expiration": base + 99 * hour, "ts": "2024-01-01T03:00:01Z"}])
    stream = spark.readStream.schema("connection_id string, expiration bigint, ts timestamp").option("maxFilesPerTrigger", 1).json(source)
    assert drain(SS.renewal_stream(stream), fresh(tmp_path)) == [("c", base + 2 * hour)]


def test_quota_windows_close_after_the_watermark(spark, tmp_path):
    source = fresh(tmp_path)
    land(source, "a", [{"ts": "2024-01-01T00:00:05Z", "user": "u"}, {"ts": "2024-01-01T00:00:50Z", "user": "u"}, {"ts": "2024-01-01T00:00:50Z", "user": "v"}])
    land(source, "b", [{"ts": "2024-01-01T01:00:00Z", "user": "u"}])
    stream = spark.readStream.schema("ts timestamp, user string").option("maxFilesPerTrigger", 1).json(source)
    assert drain(SS.quota_stream(stream, "user", limit=1), fresh(tmp_path)) == [("u", 1704067200, 2)]


def test_quota_counts_open_windows_and_late_calls(spark, tmp_path):
    source, out = fresh(tmp_path), fresh(tmp_path)
    land(source, "a", [{"ts": "2024-01-01T01:00:05Z", "user": "u"}, {"ts": "2024-01-01T01:00:07Z", "user": "u"}])
    land(source, "b", [{"ts": "2024-01-01T00:00:05Z", "user": "v"}, {"ts": "2024-01-01T00:00:50Z", "user": "v"}])
    land(source, "c", [{"ts": "2024-01-01T01:00:08Z", "user": "u"}, {"ts": "2024-01-01T01:00:50Z", "user": "w"}])
    stream = spark.readStream.schema("ts timestamp, user string").option("maxFilesPerTrigger", 1).json(source)
    SP.quota_counts_stream(stream, "user", out, fresh(tmp_path))
    got = [tuple(r) for r in SP.quota_report(spark, out, "user", limit=1).collect()]
    assert sorted(got) == [("u", 1704070800, 3, 0, True), ("v", 1704067200, 2, 2, False)]
    assert "u" not in [r[0] for r in drain(SS.quota_stream(stream, "user", limit=1), fresh(tmp_path))]  # closed windows only


def test_dedup_within_ttl(spark, tmp_path):
    source = fresh(tmp_path)
    land(source, "a", [{"nonce": "n", "ts": "2024-01-01T00:00:00Z"}, {"nonce": "m", "ts": "2024-01-01T00:00:01Z"}])
    land(source, "b", [{"nonce": "n", "ts": "2024-01-01T05:00:00Z"}])
    stream = spark.readStream.schema("nonce string, ts timestamp").option("maxFilesPerTrigger", 1).json(source)
    assert sorted(r[0] for r in drain(SS.dedup_within_ttl(stream).select("nonce"), fresh(tmp_path))) == ["m", "n"]
