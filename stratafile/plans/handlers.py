"""The handlers of the message loop, over tables that stand for what the drive API and the control plane know."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile.config import DriveConfig
from stratafile.functions import scalars as S
from stratafile.operators import commands as C
from stratafile.operators import envelope as E
from stratafile.operators import filters as X
from stratafile.operators import joins as J
from stratafile.operators import messages as MSG
from stratafile.operators import quality as Q
from stratafile.operators import state as ST
from stratafile.operators import windows as W
from stratafile.plans import resources as R
from stratafile.streaming.loop import CARRY, Handler, Steps

#: Listings that the fetch handler serves, with the files they hold.
LISTINGS = {"files": None, "folders": "is_folder"}


def first_pages(files: DataFrame, cfg: DriveConfig) -> DataFrame:
    """What any first page can hold: each connection's files in order of their ids, as far as the largest page goes.

    ``files``: good normalized files with ``connection_id, customer_id``. Adds ``listing``, ``position`` (from 1) and
    ``listed`` (files of the whole listing). The rank is cut in each map task before the shuffle.
    """
    parts = []
    for name, condition in LISTINGS.items():
        rows = X.apply_filters(files, X.not_trashed(), F.col(condition) if condition else None).withColumn("listing", F.lit(name))
        ranked = W.last_n(rows, ["connection_id"], [F.col("id")], S.MAX_PAGE_SIZE, "position")
        totals = rows.groupBy("connection_id").agg(F.count("*").alias("listed"))
        parts.append(ranked.join(totals, "connection_id"))
    return E.union_paths(*parts)


@dataclass(frozen=True)
class Tables:
    """``pages``: see :func:`first_pages`; ``feed``: changes with ``page_token`` and ``file``; ``catalog``: ids."""

    connections: DataFrame
    accounts: DataFrame
    start_cursors: DataFrame
    pages: DataFrame
    feed: DataFrame
    catalog: DataFrame
    manifest: DataFrame


def _carried(prefix: str = "") -> list[Column]:
    return [F.col(prefix + c) for c in CARRY]


def _validation(rows: DataFrame, cfg: DriveConfig, field: Column) -> DataFrame:
    return Q.error_records(
        rows, cfg, F.when(field.isNotNull(), F.lit("ValidationError")), F.concat(F.lit("Invalid or missing field: "), field),
        F.col("connection_id"), source_message_id=F.col("message_id"), details=F.to_json(F.struct(field.alias("field"))), keep=CARRY,
    )


def _rpc(cfg: DriveConfig, method: str, message_id: Column, params: Column) -> Column:
    return F.to_json(F.struct(message_id.alias("id"), F.lit("2.0").alias("jsonrpc"), F.lit(cfg.method(method)).alias("method"), params.alias("params")))


def init_handler(tables: Tables) -> Handler:
    """A ready event per init, and the state of its channel."""

    def handle(rows: DataFrame, cfg: DriveConfig) -> dict[str, DataFrame]:
        inits = R.enriched_inits(rows, tables.connections, tables.accounts, tables.start_cursors)
        events = ST.ready_events(inits, cfg, keep=("seq", "message_id"))
        names = [c for c in events.columns if c not in ("seq", "message_id")]
        records = events.select(
            "seq", "message_id", F.lit("init").alias("route"), F.col("connection_id").alias("key"),
            S.deterministic_id(F.lit("ready"), F.col("message_id")).alias("nonce"),
            _rpc(cfg, "connection.ready", F.col("message_id"), F.struct(*names)).alias("value"),
        )
        return {"records": records, "state": ST.channel_state(inits, cfg)}

    return handle


def fetch_handler(tables: Tables) -> Handler:
    """The first page of the listing that a request asks for, a record per file; an empty page gives one marker record.

    A connection without a space is a validation error. Requests for other resources name no file here and give no record.
    Each request gives a whole page, so the requests of connections that many of them name are spread over tasks.
    """

    def listings(rows: DataFrame, cfg: DriveConfig) -> DataFrame:
        kind = F.coalesce(S.blank_to_null(MSG.param("resource_type")), F.lit("files"))
        size = F.when(F.col("is_jsonrpc"), F.col("msg.params.pagination.max_results"))
        asked = rows.select(*CARRY, "connection_id", MSG.customer_id_of().alias("customer_id"), kind.alias("listing"), S.clamp_page_size(size).alias("page_size"))
        return asked.where(F.col("listing").isin(list(LISTINGS)))

    def handle(asked: DataFrame, cfg: DriveConfig) -> dict[str, DataFrame]:
        hot = J.hot_keys(asked, "connection_id")
        asked = J.with_connection(J.not_sent(asked), tables.connections.select("connection_id", "snowball_id"), hot=hot, spread="seq")
        errors = _validation(asked, cfg, F.when(~X.has_space(), F.lit("snowball_id")))
        ready = asked.where(X.has_space())

        requests = ready.select(*CARRY, "connection_id", "listing", "snowball_id", F.col("page_size").cast("bigint").alias("page_size"))
        # bodies are rendered once, of the files that some page of the batch holds
        longest = requests.groupBy("connection_id", "listing").agg(F.max("page_size").alias("_longest"))
        held = tables.pages.join(J.not_sent(longest), ["connection_id", "listing"]).where(F.col("position") <= F.col("_longest"))
        bodies = E.file_bodies(held, cfg, keep=("customer_id", "listing", "position", "listed"))
        tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pages = J.lookup_join(requests, J.not_sent(bodies), "connection_id", hot, "seq", how="inner", also=("listing",), tasks=tasks)
        page = pages.where(F.col("position") <= F.col("page_size"))
        more = F.col("listed") > F.col("page_size")
        full = E.body_records(
            page.withColumns({
                "batch_id": S.deterministic_id(F.lit("fetch"), F.col("message_id")),
                "batch_sequence": F.col("position").cast("bigint") - 1,
                "batch_is_last": ~more & (F.col("position") == F.col("listed")),
                "batch_page_token": F.when(more, F.lit("1")),
            }),
            cfg, keep=("seq", "message_id", "route"),
        )

        first = J.not_sent(tables.pages.where("position = 1").select("connection_id", "listing"))
        empty = ready.join(first, ["connection_id", "listing"], "left_anti")
        markers = E.empty_batches(
            empty.select(
                F.col("seq").cast("string").alias("request_id"), "connection_id", "customer_id", "snowball_id", F.col("listing").alias("resource_type"),
                F.lit(None).cast("string").alias("next_page_token"), F.col("ts").alias("started_at"), F.col("ts").alias("ended_at"),
            ),
            asked.select(F.lit(None).cast("string").alias("request_id")).limit(0), cfg,
        )
        none = markers.select(
            F.col("request_id").cast("bigint").alias("seq"), F.col("connection_id").alias("key"), F.col("correlation_id").alias("nonce"),
            _rpc(cfg, "content.ingest", F.col("batch_id"), F.struct("batch_id", "correlation_id", "resource_type", "space_path", "text", "has_more", "batch_is_last")).alias("value"),
        ).join(J.not_sent(empty.select("seq", "message_id", "route")), "seq")
        return {"records": E.union_paths(full.drop("jsonrpc"), none), "errors": errors}

    return Steps(listings, handle)


def write_handler(tables: Tables) -> Handler:
    """Commands are checked against their payload rules and the catalog; an accepted one is silent."""

    def checks(rows: DataFrame, cfg: DriveConfig) -> DataFrame:
        fields = sorted({f for required in C.REQUIRED_PAYLOAD.values() for f in required} | {"file_id"})
        text = F.coalesce(F.get_json_object("value", "$.params.payload"), F.get_json_object("value", "$.payload"), F.lit("{}"))
        payload = F.from_json(text, ", ".join(f"{f} string" for f in fields))
        named = rows.select(*CARRY, "connection_id", MSG.param("operation").alias("operation"), payload.alias("payload"))
        return C.check_commands(named.withColumn("command_id", F.col("message_id")))

    def handle(checked: DataFrame, cfg: DriveConfig) -> dict[str, DataFrame]:
        invalid = _validation(checked, cfg, F.col("error"))
        targets = checked.where(F.col("error").isNull() & ~F.col("kind").isin("create_file", "create_folder")).withColumn("id", F.col("payload.file_id"))
        gone = targets.join(J.not_sent(tables.catalog.select("id")), "id", "left_anti")
        missing = Q.error_records(
            gone, cfg, F.lit("ResourceNotFoundError"), F.concat(F.lit("no file "), F.col("id")), F.col("connection_id"),
            source_message_id=F.col("message_id"), keep=CARRY,
        )
        return {"errors": E.union_paths(invalid, missing)}

    return Steps(checks, handle)


def teardown_handler(tables: Tables) -> Handler:
    """The connection's state goes; no record."""

    def handle(rows: DataFrame, cfg: DriveConfig) -> dict[str, DataFrame]:
        nothing = F.lit(None).cast("string")
        return {"state": rows.select("connection_id", nothing.alias("key"), nothing.alias("value"), F.col("ts").alias("updated_at"), "seq")}

    return handle


def capability_handler(tables: Tables) -> Handler:
    """What the provider can do, in answer to each request."""

    def handle(rows: DataFrame, cfg: DriveConfig) -> dict[str, DataFrame]:
        operations = tables.manifest.agg(F.sort_array(F.collect_list(F.struct("action", "operation"))).alias("operations"))  # a fixed list
        records = rows.join(F.broadcast(operations)).select(
            "seq", "message_id", "route", F.col("connection_id").alias("key"), S.deterministic_id(F.lit("capability"), F.col("message_id")).alias("nonce"),
            _rpc(cfg, "capability.describe", F.col("message_id"), F.struct("operations")).alias("value"),
        )
        return {"records": records}

    return handle


def webhook_handler(tables: Tables) -> Handler:
    """The changes of the page that a notification names, for the connection it resolves to."""

    def resolved(rows: DataFrame, cfg: DriveConfig) -> DataFrame:
        hot = J.hot_lookups(MSG.parse_webhooks(rows.select("value", *MSG.PARSE).sample(0.01, seed=7)))
        outcomes = R.webhook_outcomes(rows.select("seq", "ts", "value", "attempt", "route", *MSG.PARSE), tables.connections, cfg, hot, parsed=False)
        return outcomes.select(
            *CARRY, "outcome", "error", "resolution_error", "message_connection_id", "connection_id", "page_token", "customer_id", "snowball_id",
            "settings",
        )

    def handle(outcomes: DataFrame, cfg: DriveConfig) -> dict[str, DataFrame]:
        invalid = _validation(outcomes.where(F.col("outcome") == "invalid"), cfg, F.col("error"))
        unresolved = Q.error_records(
            outcomes.where(F.col("outcome") == "unresolved"), cfg, F.lit("ConfigurationError"), F.col("resolution_error"),
            F.col("message_connection_id"), source_message_id=F.col("message_id"), keep=CARRY,
        )
        requests = outcomes.where(F.col("outcome") == "fetch").select(
            "connection_id", "page_token", "message_id", "customer_id", "snowball_id", "settings", F.col("seq").alias("request_seq")
        )
        records = R.webhook_page_records(requests, tables.feed, cfg).select(
            F.col("request_seq").alias("seq"), "message_id", F.lit("webhook").alias("route"), "key", "nonce", "value"
        )
        return {"records": records, "errors": E.union_paths(invalid, unresolved)}

    return Steps(resolved, handle)


def all_handlers(tables: Tables) -> dict[str, Handler]:
    return {
        "init": init_handler(tables), "fetch": fetch_handler(tables), "write": write_handler(tables),
        "teardown": teardown_handler(tables), "capability": capability_handler(tables), "webhook": webhook_handler(tables),
    }
