"""Keys that share a stored state: results of the plain rules, and calls to the state store that don't grow with the keys."""

import random
from datetime import UTC, datetime
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from stratafile.operators import dedup as D
from stratafile.streaming import stateful as SS


class Store:
    """Stands for Spark's handle, with one value state; counts the calls."""

    def __init__(self):
        self.value, self.calls, self.timers = None, 0, set()

    def getValueState(self, name, schema, ttl=None):
        return self

    def _called(self, result=None):
        self.calls += 1
        return result

    def exists(self):
        return self._called(self.value is not None)

    def get(self):
        return self._called(self.value)

    def update(self, value):
        self.value = self._called(value)

    def clear(self):
        self.value = self._called()

    def registerTimer(self, at):
        self.timers.add(self._called(at))

    def deleteTimer(self, at):
        self.timers.remove(self._called(at))


def clock(now=0):
    return SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now, getCurrentWatermarkInMs=lambda: now)


def started(processor):
    store = Store()
    processor.init(store)
    return processor, store


def taken(processor, rows, now=0, chunks=2):
    table = pd.DataFrame(rows, columns=["key", "at", "seq"])
    parts = [table.iloc[k::chunks] for k in range(chunks)]
    return {row for out in processor.handleInputRows((7,), iter(parts), clock(now)) for row in out.itertuples(index=False, name=None)}


def plain(last, rows, ttl):
    """What one key's memory accepts of a batch, and its newest accepted instant."""
    instants, out, late, free = {}, [], None, None if last is None else last + ttl
    for at, seq in rows:
        instants[at] = min(seq, instants.get(at, seq))
    for at in sorted(instants):
        if last is not None and at <= last - ttl:
            if late is None or at >= late:
                out.append((at, instants[at]))
                late = at + ttl
        elif free is None or at >= free:
            out.append((at, instants[at]))
            free = at + ttl
    return out, max([a for a, _ in out] + ([] if last is None else [last]), default=None)


def test_ttl_memory_of_many_keys():
    rnd, ttl, last = random.Random(3), 40, {}
    memory, store = started(SS.TtlMemory(ttl, False))
    for batch in range(6):
        store.calls = 0
        rows = [(rnd.choice([None, *(f"k{i}" for i in range(300))]), rnd.randrange(60 * batch, 60 * batch + 200) - rnd.choice([0, 0, 150]), 1000 * batch + k) for k in range(2000)]
        expected = set()
        for key in {r[0] for r in rows}:
            out, last[key] = plain(last.get(key), [(at, seq) for k, at, seq in rows if k == key], ttl)
            expected |= {(key, at, seq) for at, seq in out}
        assert taken(memory, rows) == expected
        assert store.calls <= 3
    assert taken(memory, [("k1", None, 1), ("k2", None, 2)]) == set()  # without a time


def test_ttl_memory_forgets_single_keys():
    memory, _ = started(SS.TtlMemory(1_000_000, True))  # forgotten after 2000 ms
    assert taken(memory, [("a", 5, 1), ("b", 5, 2)], now=10_000) == {("a", 5, 1), ("b", 5, 2)}
    assert taken(memory, [("b", 2_000_005, 3)], now=11_000) == {("b", 2_000_005, 3)}
    assert taken(memory, [("a", 6, 4), ("b", 2_000_006, 5)], now=12_500) == {("a", 6, 4)}


def test_held_messages_share_a_state_and_a_timer():
    held, store = started(SS.HeldMessages())

    def fail(rows):
        table = pd.DataFrame(rows, columns=["seq", "due_us", "value", "attempt"])
        assert not list(held.handleInputRows((3,), iter([table]), clock()))

    def fire(now):
        at = min(store.timers)
        store.timers.discard(at)
        info = SimpleNamespace(getExpiryTimeInMs=lambda: at)
        return sorted(row for out in held.handleExpiredTimer((3,), clock(now), info) for row in out.itertuples(index=False, name=None))

    fail([(-1, None, None, None)])
    assert store.calls == 0 and not store.timers
    store.calls = 0
    fail([(k, 1_000_001 + 1000 * k, f"v{k}", 2.0) for k in range(500)])
    assert store.calls <= 3 and store.timers == {1001}
    fail([(3, 9_000_000, "again", 3), (900, 500_000, "early", 2)])
    assert store.timers == {500}
    store.calls = 0
    assert [m[0] for m in fire(1010)] == [*[k for k in range(10) if k != 3], 900]  # due by then, the newer attempt not yet
    assert store.calls <= 4 and store.timers == {1011}
    assert len(fire(8_999)) == 490 and store.timers == {9000}
    assert fire(9_000) == [(3, 9_000_000, "again", 3)] and not store.timers and store.value is None


def test_ttl_stream_stores_buckets_and_not_keys(spark, tmp_path, monkeypatch):
    """Stored states, each some calls to the store a micro-batch, are as many as the buckets, with the rows of the batch form."""
    monkeypatch.setattr(SS, "BUCKETS", 8)
    rnd, schema = random.Random(5), "k string, ts timestamp, seq long"
    times = sorted(rnd.randrange(2000) for _ in range(1500))  # seconds, in the order in which the files arrive
    rows = [(f"k{rnd.randrange(200)}", datetime.fromtimestamp(1_700_000_000 + at, UTC), seq) for seq, at in enumerate(times)]
    for k in range(2):
        spark.createDataFrame([r for r in rows if (r[2] >= 750) == bool(k)], schema).coalesce(1).write.json(f"{tmp_path}/in{k}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in[01]")
    known = SS.ttl_dedup_stream(stream, "k", "ts", "seq", 300, expires=False)
    query = known.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start()
    query.awaitTermination()

    states = [operator["numRowsTotal"] for batch in query.recentProgress for operator in batch["stateOperators"]]
    assert len(states) >= 2 and 0 < max(states) <= 8
    got = sorted((r.key, r.at, r.seq) for r in spark.read.schema(known.schema).parquet(f"{tmp_path}/out").collect())
    expected = D.ttl_dedup(spark.createDataFrame(rows, schema), "k", "ts", "seq", 300).select("k", F.unix_micros("ts"), "seq").collect()
    assert got == sorted(map(tuple, expected)) and len(got) > 200
