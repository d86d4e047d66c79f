"""Streaming state: TTL deduplication, quota and throughput windows, cursors, renewal timers."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from stratafile.operators.metrics import QUOTA_SECONDS, USER_QUOTA

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# State processors travel by value, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _with_keyed_state(stream: DataFrame) -> DataFrame:
    """Keyed state processors need the RocksDB state store; queries started later in the session use it as well."""
    spark = stream.sparkSession
    if not spark.conf.get(STATE_STORE, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKSDB)
    return stream


def dedup_within_ttl(stream: DataFrame, nonce: str = "nonce", ts: str = "ts", ttl: str = "24 hours") -> DataFrame:
    """Drop repeats of a nonce that arrive within the TTL; Spark forgets a nonce once the watermark passes it.

    Records with a blank nonce all pass. Records later than the TTL are dropped by the watermark; where late records
    must not be lost, use :func:`ttl_dedup_stream`, which judges them by their own time.
    """
    blank = F.coalesce(F.col(nonce), F.lit("")) == ""
    timed = stream.withWatermark(ts, ttl)
    return timed.where(~blank).dropDuplicatesWithinWatermark([nonce]).unionByName(timed.where(blank))


#: Groups that share a stored state. A call to the state store costs about a millisecond, so keys are stored together: calls
#: grow with the groups and not with the keys. The number holds for the life of a checkpoint.
BUCKETS = 4096


#: The same for held messages: a batch with many failures reaches all of them, and each is some calls and a timer.
MESSAGE_BUCKETS = 1024


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(state) -> pa.Table | None:
    """The rows of a bucket's value state, None before the first ones."""
    held = state.get()
    return None if held is None else pa.ipc.open_stream(held[0]).read_all()


class TtlMemory(StatefulProcessor):
    """Exact TTL memory: a key is blocked for ``ttl_us`` from its last accepted record.

    A record older than the last accepted one is accepted as well if it lies a TTL or more before it. With ``expires``
    a key is forgotten when nothing of it has been accepted for twice the TTL. The keys of a bucket share one state.
    """

    def __init__(self, ttl_us: int, expires: bool):
        self.ttl_us = ttl_us
        self.expires = expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = StructType([StructField("rows", BinaryType())])
        self.memory = handle.getValueState("memory", schema, 2 * self.ttl_us // 1000 if self.expires else None)

    def _known(self, now: int) -> dict:
        """Last accepted instant of each key, and when it was accepted."""
        rows = _unpacked(self.memory)
        if rows is None:
            return {}
        held = zip(*(rows.column(c).to_pylist() for c in ("key", "last", "touched")), strict=True)
        return {key: (last, touched) for key, last, touched in held if not self.expires or touched + 2 * self.ttl_us // 1000 > now}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Each Arrow chunk shrinks to one row per key and instant as it comes; a group is bounded by the micro-batch.
        def instants(chunk: pd.DataFrame) -> pd.DataFrame:
            return chunk.groupby(["key", "at"], dropna=False, as_index=False)["seq"].min()

        parts = [instants(chunk.loc[chunk["at"].notna(), ["key", "at", "seq"]].astype({"at": "int64"})) for chunk in rows]
        parts = [part for part in parts if len(part)]
        if not parts:
            return
        first = instants(pd.concat(parts)) if len(parts) > 1 else parts[0]  # sorted by key and instant
        keys = first["key"].astype(object).where(first["key"].notna(), None).tolist()

        now = timerValues.getCurrentProcessingTimeInMs() if self.expires else 0
        known, ttl = self._known(now), self.ttl_us
        accepted: list[int] = []
        newest: dict = {}
        current, last, late, free = object(), None, None, None
        for place, (name, at) in enumerate(zip(keys, first["at"].tolist(), strict=True)):
            if name != current:
                current = name
                last = known[name][0] if name in known else None
                late, free = None, None if last is None else last + ttl
            if last is not None and at <= last - ttl:
                if late is None or at >= late:
                    accepted.append(place)
                    late = at + ttl
                    newest[name] = last
            elif free is None or at >= free:
                accepted.append(place)
                free = at + ttl
                newest[name] = at
        if accepted:
            known.update((name, (at, now)) for name, at in newest.items())
            held = {"key": pa.array(known, pa.string()), "last": pa.array([v[0] for v in known.values()], pa.int64()), "touched": pa.array([v[1] for v in known.values()], pa.int64())}
            self.memory.update((_packed(pa.table(held)),))
            yield first.iloc[accepted].assign(key=[keys[place] for place in accepted])[["key", "at", "seq"]]

    def close(self) -> None:
        pass


def ttl_dedup_stream(
    stream: DataFrame, key: str, ts: str, order: str, ttl_seconds: int, expires: bool = True
) -> DataFrame:
    """Accepted records of a stream whose files arrive in time order.

    ``expires`` bounds the state by processing time, for streams that run on; a query that only drains what is there
    must turn it off, since Spark goes on with empty batches while state can expire.
    """
    rows = _with_keyed_state(stream).select(
        F.col(key).cast("string").alias("key"), F.unix_micros(ts).alias("at"), F.col(order).cast("bigint").alias("seq")
    )
    schema = StructType(
        [StructField("key", StringType()), StructField("at", LongType()), StructField("seq", LongType())]
    )
    return rows.select("*", _bucket("key", BUCKETS)).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=TtlMemory(ttl_seconds * 1_000_000, expires),
        outputStructType=schema,
        outputMode="Append",
        timeMode="ProcessingTime" if expires else "None",
    )


class CursorMemory(StatefulProcessor):
    """Largest page read and the token of that page, per connection. Pages before the stored cursor were read earlier."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cursor = handle.getValueState(
            "cursor", StructType([StructField("page_no", LongType()), StructField("token", StringType())])
        )

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for page_no, token in initialState[["page_no", "token"]].itertuples(index=False):
            self.cursor.update((int(page_no), token))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best = self.cursor.get() if self.cursor.exists() else None
        for chunk in rows:
            top = chunk.loc[chunk["page_no"].idxmax()]
            if best is None or int(top["page_no"]) >= best[0]:
                best = (int(top["page_no"]), top["token"])
        self.cursor.update(best)
        yield pd.DataFrame([(key[0], best[0], best[1])], columns=["connection_id", "page_no", "token"])

    def close(self) -> None:
        pass


CURSOR = "connection_id string, page_no bigint, token string"


def stored_cursors(cursors: DataFrame, starts: DataFrame) -> DataFrame:
    """Where each connection goes on: its stored cursor, else its start token. ``cursors``: ``connection_id, cursor``;
    ``starts``: ``connection_id, start_cursor``."""
    both = cursors.select("connection_id", "cursor").join(starts.select("connection_id", "start_cursor"), "connection_id", "full")
    page_no = F.coalesce("cursor", "start_cursor").cast("bigint")
    return both.where(page_no.isNotNull()).select("connection_id", page_no.alias("page_no"), F.lit(None).cast("string").alias("token"))


def cursor_stream(pages: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Cursor per connection after each micro-batch; input ``connection_id, page_no, token``, one row per page.

    ``stored`` (the columns of ``CURSOR``, one row per connection) is where a query without a checkpoint starts; one that
    goes on from its checkpoint has its own memory and doesn't read it again.
    """
    keyed = _with_keyed_state(pages).select("connection_id", F.col("page_no").cast("bigint").alias("page_no"), "token")
    return keyed.groupBy("connection_id").transformWithStateInPandas(
        statefulProcessor=CursorMemory(), outputStructType=CURSOR, outputMode="Update", timeMode="None",
        initialState=stored.groupBy("connection_id") if stored is not None else None,
    )


class RenewalTimer(StatefulProcessor):
    """Fires once per channel, a lead time before it expires; a newer expiry replaces the older timer."""

    def __init__(self, lead_ms: int):
        self.lead_ms = lead_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.expiry = handle.getValueState("expiry", StructType([StructField("at", LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(chunk["expiration"].max()) for chunk in rows)
        if self.expiry.exists():
            current = self.expiry.get()[0]
            if newest <= current:
                return
            self.handle.deleteTimer(current - self.lead_ms)
        self.expiry.update((newest,))
        self.handle.registerTimer(newest - self.lead_ms)
        return
        yield  # a generator without rows

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = self.expiry.get()[0]
        self.expiry.clear()
        yield pd.DataFrame([(key[0], at)], columns=["connection_id", "expiration"])

    def close(self) -> None:
        pass


def renewal_stream(channels: DataFrame, lead_minutes: int = 60, lateness: str = "1 minute") -> DataFrame:
    """Channels whose renewal is due, driven by event time; input ``connection_id, expiration, ts``."""
    schema = StructType([StructField("connection_id", StringType()), StructField("expiration", LongType())])
    return (
        _with_keyed_state(channels).withWatermark("ts", lateness)
        .groupBy("connection_id")
        .transformWithStateInPandas(
            statefulProcessor=RenewalTimer(lead_minutes * 60_000),
            outputStructType=schema,
            outputMode="Append",
            timeMode="EventTime",
        )
    )


class HeldMessages(StatefulProcessor):
    """Failed messages with the number of their next attempt; each is given back when it is due.

    The messages of a bucket share one state and one timer, that of the message due first. A newer attempt of a message
    replaces the older one.
    """

    COLUMNS = {"seq": pa.int64(), "due_us": pa.int64(), "value": pa.string(), "attempt": pa.int64()}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.messages = handle.getValueState("messages", StructType([StructField("rows", BinaryType())]))

    def _held(self) -> dict:
        rows = _unpacked(self.messages)
        return {} if rows is None else {m[0]: m for m in zip(*(rows.column(c).to_pylist() for c in self.COLUMNS), strict=True)}

    def _hold(self, messages: dict) -> None:
        if not messages:
            self.messages.clear()
            return
        columns = zip(*messages.values(), strict=True)
        self.messages.update((_packed(pa.table({name: pa.array(values, kind) for (name, kind), values in zip(self.COLUMNS.items(), columns, strict=True)})),))

    @staticmethod
    def _due_ms(message: tuple) -> int:
        return -(-message[1] // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        failed = {}
        for chunk in rows:
            chunk = chunk[chunk["seq"] >= 0]  # the others are clock rows: the watermark has them
            for seq, due_us, value, attempt in chunk[list(self.COLUMNS)].itertuples(index=False):
                failed[int(seq)] = (int(seq), int(due_us), value, int(attempt))
        if failed:
            held = self._held()
            if held:
                self.handle.deleteTimer(min(map(self._due_ms, held.values())))
            held.update(failed)
            self._hold(held)
            self.handle.registerTimer(min(map(self._due_ms, held.values())))
        return
        yield  # a generator without rows

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        held = self._held()
        due = [message for message in held.values() if self._due_ms(message) <= now]
        left = {seq: message for seq, message in held.items() if self._due_ms(message) > now}
        self._hold(left)
        if left:
            self.handle.registerTimer(min(map(self._due_ms, left.values())))
        if due:
            yield pd.DataFrame(due, columns=list(self.COLUMNS))

    def close(self) -> None:
        pass


def held_messages(failures: DataFrame) -> DataFrame:
    """``seq, due_us, value, attempt`` of failed messages, each once its time has come.

    Input ``seq, due_us, value, attempt, clock``. The clock of the failures is the time: a message is due when a clock
    beyond its ``due_us`` has been seen. Clocks must rise from batch to batch, since rows behind the watermark are dropped;
    rows with a negative ``seq`` carry nothing but a clock.
    """
    schema = StructType([
        StructField("seq", LongType()), StructField("due_us", LongType()), StructField("value", StringType()),
        StructField("attempt", LongType()),
    ])
    return (
        _with_keyed_state(failures).withWatermark("clock", "0 seconds").select("*", _bucket("seq", MESSAGE_BUCKETS))
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=HeldMessages(), outputStructType=schema, outputMode="Append", timeMode="EventTime"
        )
    )


def window_counts(stream: DataFrame, by: str, seconds: int, lateness: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Tumbling counts; a window is emitted once, after the watermark has passed it. Windows open at the end and later
    rows give nothing; where they must not be lost, use ``pipeline.quota_counts_stream``."""
    return (
        stream.withWatermark(ts, lateness)
        .groupBy(F.window(ts, f"{seconds} seconds"), by)
        .agg(F.count("*").alias("n"))
        .select(by, F.unix_seconds("window.start").alias("window_start"), "n")
    )


def quota_stream(stream: DataFrame, by: str, limit: int = USER_QUOTA, seconds: int = QUOTA_SECONDS) -> DataFrame:
    return window_counts(stream, by, seconds).where(F.col("n") > limit)
