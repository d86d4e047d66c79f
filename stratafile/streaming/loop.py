"""The message loop: messages in, records, state, errors and settled messages out, and failed messages in again.

Each micro-batch routes and validates its messages, asks the API once per message (``answer``) and runs the handler of each
route on what was answered. A retriable failure goes to ``retry`` until its attempts are used up, every other one is a dead
letter. The loop reads its own ``retry`` folder: a message held there (``stateful.HeldMessages``) comes back as a message
of the batch that follows its waiting time, with the number of its attempt.

All outputs of a batch become visible with its commit record (``commits``); ``settled`` takes the place of an offset commit
for single messages: one row per message when it is done, dead or unhandled.

What several outputs of a batch read (routed and answered messages, errors) is written to the batch's folder under ``work``
and read from there, so that each output is planned from files and not once more from the stream; the folder goes with the batch.

Time is that of the messages: the loop's clock is the newest time seen, and rises with every batch. A feed without new
messages stands still; :func:`advance` moves the clock on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratafile.config import DriveConfig
from stratafile.functions import scalars as S
from stratafile.operators import quality as Q
from stratafile.operators import retry as RT
from stratafile.operators.envelope import union_paths
from stratafile.operators.joins import not_sent
from stratafile.operators.messages import route_messages
from stratafile.session import path_exists, remove_path
from stratafile.streaming import commits as C
from stratafile.streaming.stateful import held_messages

#: A handler's outputs by name, each optional: ``records`` (``CARRY`` columns, key, nonce, value), ``errors`` (columns of
#: ``quality.error_records`` and ``CARRY``), ``state`` (connection_id, key, value, updated_at, seq; a null key deletes the
#: connection's state).
Handler = Callable[[DataFrame, DriveConfig], dict[str, DataFrame]]



@dataclass(frozen=True)
class Steps:
    """A handler whose outputs share a first step: ``prepare`` runs once a batch and is kept, ``make`` gives the outputs from it."""

    prepare: Callable[[DataFrame, DriveConfig], DataFrame]
    make: Handler

    def __call__(self, rows: DataFrame, cfg: DriveConfig) -> dict[str, DataFrame]:
        return self.make(self.prepare(rows, cfg), cfg)


#: What is known of a message wherever it goes.
CARRY = ("seq", "ts", "value", "attempt", "message_id", "route")
RECORDS = "seq bigint, message_id string, route string, key string, nonce string, value string"
SETTLED = "seq bigint, message_id string, route string, attempt bigint, outcome string, error_code string, settled_at timestamp"
STATE = "connection_id string, key string, value string, updated_at timestamp, seq bigint"
HELD = "seq bigint, due_us bigint, value string, attempt bigint, clock timestamp"
#: Adds a table of the batch, by a name, to its work folder; gives it back as read from there.
Keep = Callable[[str, DataFrame], DataFrame]
#: The retry folder's own batch, so that the folder is there before the first batch.
FIRST = -1
WORK = "work"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def settle(
    routed: DataFrame, cfg: DriveConfig, handlers: dict[str, Handler], keep: Keep,
    answer: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The outputs of routed messages.

    ``routed``: ``route_messages`` over rows with ``seq`` (unique), ``ts``, ``value`` and ``attempt`` (from 1). ``answer``
    adds ``status_code``, ``retry_after`` and ``body`` of the API's answer to each message; without it all succeed.
    """
    valid = routed.where(F.col("error_field").isNull())
    known = F.coalesce(F.col("route").isin(list(handlers)), F.lit(False))
    asked = valid.where(known)
    if answer is None:
        answered = asked.withColumns({"status_code": F.lit(200), "retry_after": F.lit(None).cast("string"), "body": F.lit("")})
    else:
        answered = answer(asked)
    answered = keep("answered", answered)
    good = answered.where(S.error_class(F.col("status_code")).isNull())
    made = []
    for name, handler in handlers.items():
        rows = good.where(F.col("route") == name)
        steps = isinstance(handler, Steps)
        made.append(handler.make(keep(f"prepared-{name}", handler.prepare(rows, cfg)), cfg) if steps else handler(rows, cfg))

    errors = union_paths(
        Q.validation_errors(routed, cfg, "error_field", keep=CARRY),
        Q.api_errors(answered, cfg, keep=CARRY),
        *[m["errors"] for m in made if "errors" in m],
    )
    named = errors.withColumn("error_class", F.when(F.col("error_type") == "retriable", "RetriableError").otherwise("TerminalError"))
    errors = keep("errors", RT.schedule(named.withColumn("failed_at", F.col("ts")), cfg).drop("error_class", "failed_at", "wait_seconds"))
    dead = F.col("disposition") == "dead_letter"

    settled = union_paths(
        errors.where(dead).select("seq", "message_id", "route", "attempt", F.lit("dead_letter").alias("outcome"), "error_code", F.col("ts").alias("settled_at")),
        asked.join(not_sent(errors.select("seq")), "seq", "left_anti").select("seq", "message_id", "route", "attempt", F.lit("done").alias("outcome"), F.col("ts").alias("settled_at")),
        valid.where(~known & ~F.col("route").eqNullSafe(F.lit("skipped"))).select(
            "seq", "message_id", "route", "attempt", F.lit("unhandled").alias("outcome"), F.col("ts").alias("settled_at")
        ),
    )
    spark = routed.sparkSession
    return {
        "records": union_paths(spark.createDataFrame([], RECORDS), *[m["records"].select(*_names(RECORDS)) for m in made if "records" in m]),
        "state": union_paths(spark.createDataFrame([], STATE), *[m["state"].select(*_names(STATE)) for m in made if "state" in m]),
        "errors": errors,
        "settled": settled.select(*_names(SETTLED)),
    }


def _retry_rows(errors: DataFrame, clock_ms: int) -> DataFrame:
    """What is held until its next attempt, and the clock."""
    clock = F.timestamp_millis(F.lit(clock_ms)).alias("clock")
    held = errors.where(F.col("disposition") != "dead_letter").select(
        "seq", F.unix_micros("next_attempt_at").alias("due_us"), "value", (F.col("attempt") + 1).alias("attempt"), clock
    )
    return held.unionByName(_clock_row(errors.sparkSession, clock_ms))


def _clock_row(spark: SparkSession, clock_ms: int) -> DataFrame:
    row = spark.createDataFrame([(-1, None, None, None)], "seq bigint, due_us bigint, value string, attempt bigint")
    return row.withColumn("clock", F.timestamp_millis(F.lit(clock_ms)))


def start_loop(
    messages: DataFrame, cfg: DriveConfig, handlers: dict[str, Handler], base: str, checkpoint: str,
    answer: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start the loop over a stream of ``seq, ts, value``; it goes on until it is stopped (:func:`drain` waits for it)."""
    spark = messages.sparkSession
    if not path_exists(spark, f"{base}/retry"):
        _clock_row(spark, 0).write.parquet(C.batch_folder(base, "retry", FIRST))
    failures = spark.readStream.schema(HELD).option("recursiveFileLookup", "true").parquet(f"{base}/retry")
    again = held_messages(failures).select("seq", F.timestamp_micros("due_us").alias("ts"), "value", "attempt")
    fresh = messages.select("seq", "ts", "value", F.lit(1).cast("bigint").alias("attempt"))

    def on_batch(df: DataFrame, batch_id: int) -> None:
        work = f"{base}/{WORK}/batch-{batch_id}"

        def keep(name: str, table: DataFrame) -> DataFrame:
            C.write_parquet(table, f"{work}/{name}")
            return spark.read.schema(table.schema).parquet(f"{work}/{name}")

        try:
            routed = keep("routed", route_messages(df, cfg))  # the only pass over the stream: the state operator runs once
            newest = {r["route"]: r["newest"] for r in routed.groupBy("route").agg(F.max(F.unix_millis("ts")).alias("newest")).collect()}
            if not newest:  # a clock alone
                return
            clock = max([C.last_clock(spark, base) + 1, *(at for at in newest.values() if at is not None)])
            outputs = settle(routed, cfg, {name: handler for name, handler in handlers.items() if name in newest}, keep, answer)
            outputs["retry"] = _retry_rows(outputs["errors"], clock)
            C.write_together(spark, base, batch_id, outputs, C.query_id(spark, checkpoint), clock)
        finally:
            remove_path(spark, work)

    return fresh.unionByName(again).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).start()


def advance(spark: SparkSession, base: str, now: dt.datetime) -> None:
    """Tell the loop the time, so that messages due by then come back although no new message arrives."""
    clock = max(C.last_clock(spark, base) + 1, int(now.timestamp() * 1000))
    # a batch of its own, outside the stream's numbers; committed, so that the clocks after it are later ones
    C.write_together(spark, base, -clock, {"retry": _clock_row(spark, clock)}, "advance", clock)


def drain(spark: SparkSession, query: StreamingQuery, base: str, now: dt.datetime) -> None:
    """Wait until all messages that are there have been taken, and those that are due by ``now`` once more; then stop."""
    try:
        query.processAllAvailable()
        advance(spark, base, now)
        query.processAllAvailable()
    finally:
        query.stop()


def waiting(spark: SparkSession, base: str) -> DataFrame:
    """Messages held for an attempt that hasn't been made: ``seq, attempt, due_us``."""
    held = C.committed(spark, base, "retry", HELD).where(F.col("seq") >= 0)
    errors = C.committed(spark, base, "errors", "seq bigint, attempt bigint").select("seq", "attempt")
    settled = C.committed(spark, base, "settled", SETTLED).select("seq", "attempt")
    return held.select("seq", "attempt", "due_us").join(errors.unionByName(settled), ["seq", "attempt"], "left_anti")
