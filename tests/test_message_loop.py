"""The message loop: attempts, waiting times, dead letters, and outputs that become visible together."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from stratafile.streaming import commits as C
from stratafile.streaming import loop as L
from stratafile.streaming import ordered as O

NOW = dt.datetime(2024, 3, 1, tzinfo=dt.UTC)


def message(k, action="fetch", **more):
    body = {"message_id": f"m{k}", "customer_id": "c", "integration_id": "drive", "integration_connection_id": f"k{k % 3}", "action": action, **more}
    return (k, dt.datetime(2024, 1, 1, 0, 0, k % 60, tzinfo=dt.UTC), json.dumps(body))


def land(spark, rows, path):
    spark.createDataFrame(rows, "seq long, ts timestamp, value string").coalesce(1).write.mode("append").json(path)


def read(spark, path):
    return spark.readStream.schema("seq bigint, ts timestamp, value string").option("maxFilesPerTrigger", 1).json(path)


def echo(df, cfg):
    """One record per message, with the attempt that made it."""
    return {"records": df.select(*L.CARRY[4:], "seq", F.col("connection_id").alias("key"), F.lit("n").alias("nonce"), F.col("attempt").cast("string").alias("value"))}


def answers(table):
    """Status of each (seq, attempt); 200 where the table says nothing."""

    def answer(asked):
        known = asked.sparkSession.createDataFrame([(s, a, *r) for (s, a), r in table.items()], "seq long, attempt long, status_code int, retry_after string")
        both = asked.join(known.withColumn("known", F.lit(True)), ["seq", "attempt"], "left")
        return both.withColumn("status_code", F.when(F.col("known"), F.col("status_code")).otherwise(200)).withColumn("body", F.lit("no")).drop("known")

    return answer


def settled(spark, base):
    rows = C.committed(spark, base, "settled", L.SETTLED).collect()
    return sorted((r.seq, r.outcome, r.attempt, r.error_code, r.settled_at.astimezone(dt.UTC).strftime("%H:%M:%S")) for r in rows)


def test_three_attempts_then_dead_letter(spark, cfg, tmp_path):
    """Each failure waits as long as the schedule says and runs again; attempts and times are those of a plain loop."""
    source, base = f"{tmp_path}/in", f"{tmp_path}/out"
    land(spark, [message(k) for k in range(1, 6)] + [message(6, "noise"), message(7, resource_type="songs"), message(8, integration_id="mail")], source)
    land(spark, [message(k) for k in (9, 10)], source)
    table = {
        (2, 1): (503, None), (3, 1): (503, None), (3, 2): (429, "30"), (4, 1): (None, None), (4, 2): (503, None), (4, 3): (503, None),
        (5, 1): (404, None), (9, 1): (429, "soon"), (9, 2): (401, None),
    }
    query = L.start_loop(read(spark, source), cfg, {"fetch": echo}, base, f"{tmp_path}/check", answers(table))
    L.drain(spark, query, base, NOW)
    assert settled(spark, base) == [
        (1, "done", 1, None, "00:00:01"), (2, "done", 2, None, "00:00:04"), (3, "done", 3, None, "00:00:35"),
        (4, "dead_letter", 3, "RETRIABLEERROR", "00:00:10"), (5, "dead_letter", 1, "TERMINALERROR", "00:00:05"),
        (6, "unhandled", 1, None, "00:00:06"), (7, "dead_letter", 1, "VALIDATIONERROR", "00:00:07"),
        (9, "dead_letter", 2, "AUTHENTICATIONERROR", "00:01:09"), (10, "done", 1, None, "00:00:10"),
    ]
    records = C.committed(spark, base, "records", L.RECORDS).collect()
    assert sorted((r.seq, r.value) for r in records) == [(1, "1"), (2, "2"), (3, "3"), (10, "1")]
    assert L.waiting(spark, base).count() == 0
    clocks = [r.clock for r in C.commits(spark, base).orderBy("clock").collect()]
    assert len(set(clocks)) == len(clocks)


def test_messages_wait_for_their_time(spark, cfg, tmp_path):
    """Without a later message the clock stands still; a held message is neither lost nor settled."""
    source, base = f"{tmp_path}/in", f"{tmp_path}/out"
    land(spark, [message(1)], source)
    query = L.start_loop(read(spark, source), cfg, {"fetch": echo}, base, f"{tmp_path}/check", answers({(1, 1): (503, None)}))
    try:
        query.processAllAvailable()
        assert settled(spark, base) == [] and [(r.seq, r.attempt) for r in L.waiting(spark, base).collect()] == [(1, 2)]
    finally:
        query.stop()
    query = L.start_loop(read(spark, source), cfg, {"fetch": echo}, base, f"{tmp_path}/check", answers({}))  # goes on from its checkpoint
    L.drain(spark, query, base, NOW)
    assert settled(spark, base) == [(1, "done", 2, None, "00:00:03")]


def test_nothing_of_a_failed_batch_is_visible(spark, cfg, tmp_path):
    """A failure between two outputs shows no row; the batch runs again and every row is there once."""
    source, base = f"{tmp_path}/in", f"{tmp_path}/out"
    land(spark, [message(k) for k in range(1, 4)], source)
    broken = {"left": 1}

    def fails(df, cfg):
        rows = echo(df, cfg)
        if broken["left"]:
            broken["left"] -= 1
            trouble = F.udf(lambda x: 1 // 0, "string")  # fails when the state is written, after the records
            rows["state"] = df.select("connection_id", trouble("route").alias("key"), F.lit("v").alias("value"), F.col("ts").alias("updated_at"), "seq")
        return rows

    query = L.start_loop(read(spark, source), cfg, {"fetch": fails}, base, f"{tmp_path}/check")
    with pytest.raises(Exception, match="(?s).*"):
        L.drain(spark, query, base, NOW)
    assert spark.read.parquet(f"{base}/records").count() == 3  # written, but of no committed batch
    assert C.committed(spark, base, "records", L.RECORDS).count() == 0 and C.commits(spark, base).where("batch_id >= 0").count() == 0
    query = L.start_loop(read(spark, source), cfg, {"fetch": fails}, base, f"{tmp_path}/check")
    L.drain(spark, query, base, NOW)
    assert sorted(r.seq for r in C.committed(spark, base, "records", L.RECORDS).collect()) == [1, 2, 3]


def test_a_committed_batch_is_not_written_twice(spark, tmp_path):
    base = f"{tmp_path}/out"
    rows = spark.createDataFrame([(1,), (2,)], "n int")
    assert C.committed(spark, base, "a", "n int").count() == 0 and C.last_clock(spark, base) == 0
    assert C.write_together(spark, base, 0, {"a": rows, "b": rows}, "q", 5)
    assert not C.write_together(spark, base, 0, {"a": rows.limit(0)}, "q", 6)
    assert C.write_together(spark, base, 1, {"a": rows}, "q", 7)
    assert C.committed(spark, base, "a", "n int").count() == 4 and C.last_clock(spark, base) == 7
    rows.write.parquet(C.batch_folder(base, "a", 2))  # a batch without its record
    assert C.committed(spark, base, "a", "n int").count() == 4
    assert C.write_together(spark, base, 1, {"a": rows.limit(1)}, "another query", 7)  # a lost checkpoint replaces its batch
    assert C.committed(spark, base, "a", "n int").where("batch_id = 1").count() == 1


def test_numbers_have_no_gap_over_batches(spark, tmp_path, monkeypatch):
    """A connection with half of all rows, null connections, ties, several batches, a snapshot of the counters between."""
    monkeypatch.setattr(O, "SNAPSHOT_EVERY", 2)
    source, base = f"{tmp_path}/in", f"{tmp_path}/out"
    rows = [(["hot", "hot", "a", None][k % 4], k // 2, k) for k in range(400)]
    for part in range(4):
        spark.createDataFrame(rows[part * 100 : part * 100 + 100], "c string, o long, k long").coalesce(1).write.mode("append").json(source)
    stream = spark.readStream.schema("c string, o long, k long").option("maxFilesPerTrigger", 1).json(source)
    O.numbered_stream(stream, "c", ["o", "k"], base, f"{tmp_path}/check")
    got = C.committed(spark, base, "records", "c string, o long, k long, number long").collect()
    assert len(got) == 400 and {r.batch_id for r in got} == {0, 1, 2, 3}
    for key in ("hot", "a", None):
        own = sorted((r for r in got if r.c == key), key=lambda r: (r.batch_id, r.o, r.k))
        assert [r.number for r in own] == list(range(1, len(own) + 1))
    assert {r.c: r["last"] for r in O.counters(spark, base, "c").collect()} == {"hot": 200, "a": 100, None: 100}


def test_cursor_stream_starts_from_the_table_and_goes_on(spark, tmp_path):
    from stratafile.streaming import stateful as SS

    source, name = f"{tmp_path}/in", uuid.uuid4().hex
    stored = SS.stored_cursors(
        spark.createDataFrame([("a", 5), ("b", 9)], "connection_id string, cursor long"),
        spark.createDataFrame([("a", 1), ("c", 4)], "connection_id string, start_cursor long"),
    )
    assert {(r.connection_id, r.page_no) for r in stored.collect()} == {("a", 5), ("b", 9), ("c", 4)}
    seen: dict = {}

    def take(df, n):
        for r in df.collect():
            seen[r.connection_id] = (r.page_no, r.token)

    def run(rows):
        spark.createDataFrame(rows, SS.CURSOR).coalesce(1).write.mode("append").json(source)
        pages = spark.readStream.schema(SS.CURSOR).json(source)
        query = SS.cursor_stream(pages, stored).writeStream.foreachBatch(take).outputMode("update").queryName("c" + name)
        query.option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()

    run([("a", 4, "t4"), ("a", 6, "t6"), ("b", 3, "t3"), ("c", 3, "t3"), ("d", 0, "t0")])
    assert seen == {"a": (6, "t6"), "b": (9, None), "c": (4, None), "d": (0, "t0")}
    run([("a", 5, "t5"), ("b", 10, "t10"), ("c", 4, "t4")])
    assert seen == {"a": (6, "t6"), "b": (10, "t10"), "c": (4, "t4"), "d": (0, "t0")}


def test_a_failed_batch_of_numbers_runs_again(spark, tmp_path, monkeypatch):
    """The counters of a batch that failed before its commit are neither read nor in the way of the second try."""
    source, base = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "c string, o long"
    write = C.batch_folder
    left = {"n": 1}

    def breaks(base, name, batch_id):
        if name == C.COMMITS and batch_id == 1 and left["n"]:
            left["n"] = 0
            raise RuntimeError("no commit")
        return write(base, name, batch_id)

    monkeypatch.setattr(C, "batch_folder", breaks)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(source)
        O.numbered_stream(stream, "c", ["o"], base, f"{tmp_path}/check")

    for part in range(3):
        spark.createDataFrame([("a", 10 * part + k) for k in range(5)], schema).coalesce(1).write.mode("append").json(source)
    with pytest.raises(Exception, match="(?s).*"):
        run()
    assert spark.read.parquet(f"{base}/counters").count() == 2 and O.counters(spark, base, "c").first()["last"] == 5
    run()
    got = C.committed(spark, base, "records", f"{schema}, number long").orderBy("o").collect()
    assert [r.number for r in got] == list(range(1, 16))
