"""Structured Streaming wiring of the batch operators.

Each micro-batch runs the same functions as the batch path. ``foreachBatch`` writes under the batch id in overwrite
mode, so a batch that is replayed after a failure replaces its own output instead of adding to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratafile.config import DriveConfig
from stratafile.operators import messages as MSG
from stratafile.operators.filters import for_provider
from stratafile.operators.joins import hot_lookups, resolve_connections
from stratafile.operators.messages import route_messages
from stratafile.operators.metrics import QUOTA_SECONDS, USER_QUOTA
from stratafile.operators.quality import validation_errors
from stratafile.streaming.commits import batch_folder

#: Records of a route's messages; or records and error rows (columns of ``quality.error_records``).
Handler = Callable[[DataFrame, DriveConfig], DataFrame | tuple[DataFrame, DataFrame]]


def write_batch(outputs: dict[str, DataFrame], base: str, batch_id: int) -> None:
    for name, df in outputs.items():
        df.write.mode("overwrite").parquet(batch_folder(base, name, batch_id))


def run_to_end(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Drain what is available, one ``on_batch`` call per micro-batch."""
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def handle_messages(
    routed: DataFrame, cfg: DriveConfig, handlers: dict[str, Handler], keep: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    """Run the registered handler of each route on its valid messages.

    ``routed`` comes from ``route_messages``. Returns one output per route plus ``errors`` (validation failures and the
    handlers' errors) and ``unhandled`` (ids of valid messages without a route or with a route that has no handler).
    Only messages of another provider (route ``skipped``) are in no output.
    """
    valid = routed.where(F.col("error_field").isNull())
    outputs, errors = {}, validation_errors(routed, cfg, "error_field", keep=keep)
    for name, handler in handlers.items():
        made = handler(valid.where(F.col("route") == name), cfg)
        outputs[name], failed = made if isinstance(made, tuple) else (made, None)
        errors = errors if failed is None else errors.unionByName(failed, allowMissingColumns=True)
    taken = F.coalesce(F.col("route").isin("skipped", *handlers), F.lit(False))
    ids = dict.fromkeys(("message_id", "route", "connection_id", "provider", *keep))
    return {**outputs, "errors": errors, "unhandled": valid.where(~taken).select(*ids)}


def command_stream(
    stream: DataFrame, cfg: DriveConfig, handlers: dict[str, Handler], base: str, checkpoint: str,
    keep: tuple[str, ...] = (),
) -> StreamingQuery:
    """Message loop: route, validate, handle and write records, errors and unhandled messages of each micro-batch, and
    the errors once more as ``retry`` (retriable ones) and ``dead_letters`` (terminal ones).

    The routed batch is persisted while its branches run, so parsing and routing happen once per message.
    """

    def on_batch(df: DataFrame, batch_id: int) -> None:
        routed = route_messages(df, cfg).persist()
        outputs = handle_messages(routed, cfg, handlers, keep)
        errors = outputs["errors"].persist()
        retry, dead_letters = split_retriable(errors)
        try:
            write_batch({**outputs, "errors": errors, "retry": retry, "dead_letters": dead_letters}, base, batch_id)
        finally:
            errors.unpersist()
            routed.unpersist()

    return run_to_end(stream, on_batch, checkpoint)


def split_retriable(errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Retriable rows for the retry table and terminal rows for the dead letters; the message itself is committed in
    both cases, since a stream cannot hold back single rows."""
    retriable = F.col("error_type") == "retriable"
    return errors.where(retriable), errors.where(~retriable)


def webhook_stream(
    stream: DataFrame,
    cfg: DriveConfig,
    read_connections: Callable[[], DataFrame],
    to_records: Callable[[DataFrame, DriveConfig], DataFrame],
    base: str,
    checkpoint: str,
) -> StreamingQuery:
    """Notifications to records; invalid and unresolved ones to errors with their reason, those of another provider to
    neither. The connection dimension is read again for every micro-batch, which takes the place of a resolution cache
    with a short life. Connections that many notifications name are found in a sample of the batch and spread.

    The parsed message, several times as large as its text, does not go through the joins: a handler finds the text in
    ``value``.
    """

    def on_batch(df: DataFrame, batch_id: int) -> None:
        own = MSG.parse_webhooks(df).where(for_provider(MSG.provider_of(), cfg.provider)).drop(*MSG.PARSED)
        hot = hot_lookups(MSG.parse_webhooks(df.sample(0.01, seed=7)))
        resolved = resolve_connections(own, read_connections(), hot).persist()
        reason = F.coalesce("error", "resolution_error")
        try:
            outputs = {
                "records": to_records(resolved.where(reason.isNull()), cfg),
                "errors": resolved.where(reason.isNotNull()).select("message_id", reason.alias("reason")),
            }
            write_batch(outputs, base, batch_id)
        finally:
            resolved.unpersist()

    return run_to_end(stream, on_batch, checkpoint)


def quota_counts_stream(
    stream: DataFrame, by: str, base: str, checkpoint: str, seconds: int = QUOTA_SECONDS, ts: str = "ts"
) -> StreamingQuery:
    """Counts per key and tumbling window of each micro-batch. No state and no watermark, so that calls of any age and of
    windows still open are counted; :func:`quota_report` adds the batches up."""

    def on_batch(df: DataFrame, batch_id: int) -> None:
        counts = df.groupBy(by, F.window(ts, f"{seconds} seconds")).agg(F.count("*").alias("n"), F.max(ts).alias("last_ts"))
        counts = counts.select(by, F.unix_seconds("window.start").alias("window_start"), "n", "last_ts")
        write_batch({"counts": counts}, base, batch_id)

    return run_to_end(stream, on_batch, checkpoint)


def quota_report(
    spark: SparkSession, base: str, by: str, limit: int = USER_QUOTA, seconds: int = QUOTA_SECONDS,
    lateness_seconds: int = 600,
) -> DataFrame:
    """Windows over the limit, as of the last batch of :func:`quota_counts_stream`: ``n`` calls, of which ``n_late`` came
    in a batch that began when the newest call was ``lateness_seconds`` past the window's end; ``open`` while it isn't."""
    schema = f"{by} string, window_start bigint, n bigint, last_ts timestamp, batch_id bigint"
    counts = spark.read.schema(schema).parquet(f"{base}/counts")
    in_order = Window.orderBy("batch_id")  # of one row per batch
    newest = F.max(F.unix_micros("last_ts"))
    marks = counts.groupBy("batch_id").agg(newest.alias("newest")).select(
        "batch_id",
        F.max("newest").over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.max("newest").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("newest"),
    )
    passed = (F.col("window_start") + seconds + lateness_seconds) * 1_000_000
    late = F.when(passed <= F.col("before"), F.col("n")).otherwise(F.lit(0))
    windows = (
        counts.join(marks, "batch_id")
        .groupBy(by, "window_start")
        .agg(F.sum("n").alias("n"), F.sum(late).alias("n_late"), F.max("newest").alias("newest"))
        .where(F.col("n") > limit)
    )
    return windows.select(by, "window_start", "n", "n_late", (passed > F.col("newest")).alias("open"))
