"""The resource queries and sync flows, composed from the operators. One function per resource or flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile.config import DriveConfig
from stratafile.functions import mime as M
from stratafile.functions import scalars as S
from stratafile.operators import dedup as D
from stratafile.operators import envelope as E
from stratafile.operators import filters as X
from stratafile.operators import joins as J
from stratafile.operators import messages as MSG
from stratafile.operators import metrics as A
from stratafile.operators import normalize as P
from stratafile.operators import state as ST
from stratafile.operators import windows as W
from stratafile.sources.manifest import capability_manifest


def good_files(raw_files: DataFrame, cfg: DriveConfig, keep: tuple[str, ...] = ("connection_id", "customer_id")) -> DataFrame:
    return P.split_bad_rows(P.normalize_files(raw_files, cfg, keep=keep))[0]


# --- fetch -----------------------------------------------------------------------------------------------------


def list_pages(files: DataFrame, page_size: int = S.DEFAULT_PAGE_SIZE) -> DataFrame:
    """Normalized files with their page, by id. The rows themselves are ranked, so files without an id or with the same
    one keep a place each; a hash of the row spreads them where very many share an id."""
    size = min(max(page_size, 1), S.MAX_PAGE_SIZE)
    plain = [f.name for f in files.schema.fields if "map<" not in f.dataType.simpleString()]
    ranked = files.withColumn("_tie", F.xxhash64(*plain))
    return W.assign_pages(ranked, ["connection_id"], ["id", "_tie"], size).drop("_tie")


def with_spaces(files: DataFrame, connections: DataFrame, hot: list[str] | None = None) -> DataFrame:
    return J.with_connection(files, connections.select("connection_id", "snowball_id"), hot=hot, spread="id")


def fetch_files(
    raw_files: DataFrame,
    connections: DataFrame,
    cfg: DriveConfig,
    *conditions: Column | None,
    page_size: int = S.DEFAULT_PAGE_SIZE,
    include_trashed: bool = False,
    hot: list[str] | None = None,
) -> DataFrame:
    """Envelopes of a paged listing. Connections without a space are errors (``missing_space``) and emit nothing."""
    files = X.apply_filters(good_files(raw_files, cfg), X.not_trashed(include_trashed), *conditions)
    ready = with_spaces(files, connections, hot).where(X.has_space())
    paged = list_pages(ready, page_size)
    batches = paged.withColumn(
        "batch_id", S.deterministic_id(F.lit("fetch"), F.col("connection_id"), F.col("page_no"))
    ).withColumn("batch_page_token", F.col("next_page_token"))
    return E.ingest_envelopes(batches, cfg, keep=("page_no",))


def missing_space(requests: DataFrame, connections: DataFrame) -> DataFrame:
    """Fetch requests whose connection has no space: a validation error each."""
    joined = J.with_connection(requests, connections.select("connection_id", "snowball_id"))
    return joined.where(~X.has_space()).select(
        "request_id", "connection_id", F.lit("ValidationError").alias("error_class"), F.lit("snowball_id").alias("field")
    )


def lookup(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """Requested rows by id with ``found``; each distinct request is looked up once."""
    marked = rows.withColumn("found", F.lit(True))
    return wanted.select(*on).distinct().join(marked, on, "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def folders(files: DataFrame, parent: str | None = None, include_trashed: bool = False) -> DataFrame:
    return X.apply_filters(
        files, F.col("is_folder"), X.not_trashed(include_trashed), X.in_folder(parent) if parent else None
    )


def folder_contents(files: DataFrame) -> DataFrame:
    """Children of every folder, counted: one row per parent id, pre-aggregated."""
    children = files.select("is_folder", "size_bytes", F.explode("parent_ids").alias("parent_id"))
    return children.groupBy("parent_id").agg(
        F.count("*").alias("children"),
        F.count_if("is_folder").alias("subfolders"),
        F.sum(F.coalesce("size_bytes", F.lit(0))).alias("bytes"),
    )


def permissions(raw_permissions: DataFrame, files: DataFrame, cfg: DriveConfig) -> DataFrame:
    """Permissions of existing files; ``files`` holds one row per ``file_id``."""
    good, _ = P.split_bad_rows(P.normalize_permissions(raw_permissions, cfg))
    return J.children_of(good, files)


def permission_counts(raw_permissions: DataFrame, files: DataFrame, cfg: DriveConfig) -> DataFrame:
    """Permission counts of existing files; counted before the join, so a file with very many permissions joins as one
    row."""
    good, _ = P.split_bad_rows(P.normalize_permissions(raw_permissions, cfg))
    return J.children_of(A.permission_counts(good), files)


def revisions(raw_revisions: DataFrame, files: DataFrame, cfg: DriveConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    good, _ = P.split_bad_rows(P.normalize_revisions(raw_revisions, cfg, keep=keep))
    return J.children_of(good, files)


def changes(
    feed: DataFrame, cursors: DataFrame, starts: DataFrame, include_removed: bool = True,
    restrict_to_my_drive: bool = False,
) -> DataFrame:
    """Changes from each connection's page token on, with the advertised filters."""
    return X.apply_filters(
        J.changes_after_cursor(feed, cursors, starts), X.change_filters(include_removed, restrict_to_my_drive)
    )


def about(account_rows: DataFrame) -> DataFrame:
    share = F.col("quota_usage") / F.col("quota_limit")
    return account_rows.withColumn("quota_share", F.round(share, 6))


def capabilities(spark: SparkSession) -> DataFrame:
    return capability_manifest(spark)


# --- sync ------------------------------------------------------------------------------------------------------


def _selected(rows: DataFrame, connections: DataFrame, hot: list[str] | None, *carry: str) -> DataFrame:
    """Rows the connection's settings want, with further columns of the connection. Rows that say whether they lie in a
    shared drive (``shared_drive``) are held against that setting too."""
    has_drives = "sync_shared_drives" in connections.schema["settings"].dataType.fieldNames()
    settings = connections.select(
        "connection_id", *carry, F.col("settings.sync_files").alias("_files"), F.col("settings.sync_folders").alias("_folders"),
        (F.col("settings.sync_shared_drives") if has_drives else F.lit(None).cast("boolean")).alias("_drives"),
    )
    wanted = X.wanted_type(F.col("type") == "folder", F.col("_files"), F.col("_folders"))
    if "shared_drive" in rows.columns:
        wanted = wanted & X.wanted_drive(F.col("shared_drive"), F.col("_drives"))
    joined = J.with_connection(rows, settings, hot=hot, spread="id")
    return joined.where(wanted).drop("_files", "_folders", "_drives")


def _with_export_size(rows: DataFrame, content_sizes: DataFrame | None) -> DataFrame:
    """Only exportable native types carry content on the sync path."""
    if content_sizes is None:
        return rows.withColumn("content_bytes", F.lit(None).cast("bigint"))
    joined = J.with_content(
        rows.withColumn("file_id", F.col("id")), content_sizes.select("file_id", F.col("size_bytes").alias("_bytes"))
    )
    return joined.withColumn(
        "content_bytes", F.when(M.needs_export(F.col("mime_type")), F.col("_bytes"))
    ).drop("_bytes", "file_id")


def full_sync(
    raw_files: DataFrame,
    connections: DataFrame,
    cfg: DriveConfig,
    content_sizes: DataFrame | None = None,
    hot: list[str] | None = None,
) -> DataFrame:
    """All wanted files that are not trashed; where the listing says which ones lie in a shared drive (``shared_drive``),
    those come only if the connection syncs shared drives."""
    drive = ("shared_drive",) if "shared_drive" in raw_files.columns else ()
    light, _ = P.split_bad_rows(P.light_normalize_files(raw_files, keep=("connection_id", "customer_id", *drive)))
    live = X.apply_filters(light, X.not_trashed())
    return E.sync_envelopes(_with_export_size(_selected(live, connections, hot), content_sizes), cfg, "full_sync")


def incremental_sync(
    feed: DataFrame,
    connections: DataFrame,
    cursors: DataFrame,
    starts: DataFrame,
    cfg: DriveConfig,
    content_sizes: DataFrame | None = None,
    keep: tuple[str, ...] = ("page_no", "seq"),
    hot: list[str] | None = None,
) -> DataFrame:
    """Changed files after each connection's cursor (its start token, if it has none), over all pages; ``hot`` names
    connections to spread."""
    wanted = J.changes_after_cursor(feed.where(X.not_removed()), cursors, starts, hot=hot, spread="seq")
    live = wanted.where(X.has_file("file"))
    drive = ("shared_drive",) if "shared_drive" in live.columns else ()
    light, _ = P.split_bad_rows(
        P.light_normalize_files(live, raw_json="file", keep=("connection_id", "change_type", *drive, *keep))
    )
    rows = _selected(light, connections, hot, "customer_id")
    return E.sync_envelopes(_with_export_size(rows, content_sizes), cfg, "incremental", "change_type", keep=keep)


def new_cursors(pages: DataFrame, cfg: DriveConfig) -> DataFrame:
    """State rows that move each connection's cursor to the token of its last page."""
    return W.last_token(pages, ["connection_id"]).where(F.col("cursor").isNotNull()).select(
        "connection_id",
        F.lit(cfg.state_key("page_token")).alias("key"),
        F.col("cursor").alias("value"),
        cfg.now.alias("updated_at"),
        F.col("last_page").alias("seq"),
    )


def sync_progress(feed: DataFrame) -> DataFrame:
    """Changes processed so far after each page, per connection. Pages are counted first; the running total then
    works over pages, split over range partitions."""
    pages = feed.groupBy("connection_id", "page_no").agg(F.count("*").alias("page_changes"))
    total = W.running_total(pages, ["connection_id"], ["page_no"], F.col("page_changes"), "changes_processed", "_all")
    return total.withColumn("has_more", F.col("changes_processed") < F.col("_all")).drop("_all")


# --- webhooks --------------------------------------------------------------------------------------------------


def webhook_outcomes(
    webhooks: DataFrame, connections: DataFrame, cfg: DriveConfig, hot: tuple[list[str], list[str]] | None = None,
    parsed: bool = True,
) -> DataFrame:
    """Parsed notifications with their connection and what becomes of them; another provider's are skipped. ``hot``: see
    ``joins.hot_lookups``. Without ``parsed`` the message itself, several times as large as its text, goes through no join."""
    rows = MSG.parse_webhooks(webhooks).withColumn("_own", X.for_provider(MSG.provider_of(), cfg.provider))
    resolved = J.resolve_connections(rows if parsed else rows.drop(*MSG.PARSED), connections, hot)
    return resolved.withColumn(
        "outcome",
        F.when(~F.col("_own"), F.lit("skipped"))
        .when(F.col("error").isNotNull(), F.lit("invalid"))
        .when(F.col("resolution_error").isNotNull(), F.lit("unresolved"))
        .when(~X.not_stop(F.col("kind")), F.lit("stop"))
        .when(F.col("page_token").isNull(), F.lit("no_token"))
        .otherwise(F.lit("fetch")),
    ).drop("_own")


def page_requests(outcomes: DataFrame) -> DataFrame:
    """Notifications to serve, one row per page: repeats of a notification would emit the same records, which the
    nonce removes again, so only the first one fetches. ``notifications`` counts them."""
    first = F.min(F.struct("seq", "message_id", "customer_id", "snowball_id", "settings"))
    return (
        outcomes.where(F.col("outcome") == "fetch")
        .groupBy("connection_id", "page_token")
        .agg(first.alias("_first"), F.count("*").alias("notifications"))
        .select("connection_id", "page_token", "notifications", "_first.*")
        .withColumnRenamed("seq", "request_seq")
    )


def page_requests_within(outcomes: DataFrame, ttl_seconds: int, ts: str = "ts") -> DataFrame:
    """Notifications to serve, one row per page and TTL: a repeat is served again once the TTL has passed since the page was
    last served.

    ``notifications`` counts those that a fetch stands for, itself included. Notifications of a page that have no time can't
    be judged and are served together, once. The accepted instants come from the TTL memory, and each notification finds its
    own by an as-of join; neither gathers a page with many notifications in one task.
    """
    fetch = outcomes.where(F.col("outcome") == "fetch").select(
        "connection_id", "page_token", "seq", "message_id", "customer_id", "snowball_id", "settings", F.col(ts).alias("_ts"),
        F.to_json(F.array("connection_id", "page_token")).alias("_page"),
    )
    fetch = D.stored_once(fetch)  # read by both, parsed once
    accepted = D.ttl_dedup(fetch, "_page", "_ts", "seq", ttl_seconds).select("_page", F.col("_ts").alias("_since"), "seq")
    served = J.as_of_join(fetch, accepted, "_page", "_ts", "_page", ["_since", "seq"], "_served")
    first = F.min(F.struct("_ts", "seq", "message_id", "customer_id", "snowball_id", "settings"))
    return (
        served.groupBy("connection_id", "page_token", F.col("_served._since").alias("requested_at"))
        .agg(first.alias("_first"), F.count("*").alias("notifications"))
        .select(
            "connection_id", "page_token", "notifications", "requested_at", F.col("_first.seq").alias("request_seq"),
            *[f"_first.{c}" for c in ("message_id", "customer_id", "snowball_id", "settings")],
        )
    )


def webhook_page_rows(requests: DataFrame, feed: DataFrame, cfg: DriveConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    """Changes of the requested pages (only the page named by the notification), normalized, with ``yielded``."""
    rows = feed.join(requests, ["connection_id", "page_token"])
    normalized = P.normalize_files(
        rows,
        cfg,
        raw_json="file",
        keep=(
            "connection_id", "customer_id", "snowball_id", "settings", "page_token", "message_id", "notifications", "seq",
            "change_type", "removed", "file", *keep,
        ),
    )
    wanted = X.wanted_type(F.col("is_folder"), F.col("settings.sync_files"), F.col("settings.sync_folders"))
    yielded = (
        X.not_removed() & X.has_file("file") & wanted & X.has_space() & F.col("bad_row_reason").isNull()
    )
    return normalized.withColumn("yielded", F.coalesce(yielded, F.lit(False)))


def webhook_records(
    page_rows: DataFrame, cfg: DriveConfig, keep: tuple[str, ...] = ("seq",), page: tuple[str, ...] = ("connection_id", "page_token")
) -> DataFrame:
    """Envelopes of the yielded changes; positions count yielded rows of a ``page`` only, and each row has a batch of its
    own."""
    positioned = W.position_in_page(page_rows.where("yielded"), list(page), ["seq"])
    batches = (
        positioned.withColumn("batch_id", S.deterministic_id(F.col("message_id"), F.col("page_token"), F.col("seq")))
        .withColumn("batch_page_token", F.col("page_token"))
        .withColumn("origin", F.lit("webhook"))
    )
    return E.ingest_envelopes(batches, cfg, extra={"source": "origin", "change_type": "change_type"}, keep=keep)


def webhook_page_records(
    requests: DataFrame, feed: DataFrame, cfg: DriveConfig, keep: tuple[str, ...] = ("request_seq", "message_id")
) -> DataFrame:
    """The rendered records (``key, nonce, value`` with ``keep``) of requests of which many may name one page: each with all
    yielded changes of its page, as :func:`webhook_page_rows` and :func:`webhook_records` have them.

    ``requests``: ``request_seq, message_id, connection_id, page_token, customer_id, snowball_id, settings``. A change is
    normalized, rendered and given its place once, before the join, however many requests name its page: its place among all
    changes of the page for who wants them all, and among those of its type for who wants only these. A request that comes
    several times (by a connection that is there several times) has its rows numbered through, each change's side by side.
    """
    page = ["connection_id", "page_token"]
    named = feed.where(X.not_removed() & X.has_file("file")).join(J.not_sent(requests.select(*page).distinct()), page, "left_semi")
    normalized = P.normalize_files(
        named.withColumn("customer_id", F.lit(None).cast("string")), cfg, raw_json="file", keep=(*page, "seq", "change_type")
    )
    placed = W.position_in_page(P.split_bad_rows(normalized)[0], page, ["seq"]).withColumnRenamed("batch_sequence", "_of_all")
    placed = W.position_in_page(placed, [*page, "is_folder"], ["seq"]).withColumnRenamed("batch_sequence", "_of_type")
    bodies = E.file_bodies(placed, cfg, keep=("page_token", "seq", "change_type", "is_folder", "_of_all", "_of_type"))
    files, folders = F.col("settings.sync_files"), F.col("settings.sync_folders")
    ready = W.numbered_copies(requests.where(X.has_space()), "request_seq", page)
    rows = ready.join(J.not_sent(bodies), page).where(X.wanted_type(F.col("is_folder"), files, folders))
    place = F.when(F.coalesce(files, F.lit(True)) & F.coalesce(folders, F.lit(True)), F.col("_of_all")).otherwise(F.col("_of_type"))
    batches = rows.withColumns({
        "batch_id": S.deterministic_id(F.col("message_id"), F.col("page_token"), F.col("seq")),
        "batch_sequence": place * F.col("_copies") + F.col("_copy"),
        "batch_is_last": F.lit(False),
        "batch_page_token": F.col("page_token"),
        "origin": F.lit("webhook"),
    })
    return E.body_records(batches, cfg, extra={"source": "origin", "change_type": "change_type"}, keep=keep)


def webhook_changes(webhooks: DataFrame, connections: DataFrame, feed: DataFrame, cfg: DriveConfig) -> DataFrame:
    requests = page_requests(webhook_outcomes(webhooks, connections, cfg))
    carried = feed.where(X.not_removed() & F.col("file").isNotNull())
    return webhook_records(webhook_page_rows(requests, carried, cfg), cfg)


# --- lifecycle -------------------------------------------------------------------------------------------------


def valid_lifecycle(messages: DataFrame, cfg: DriveConfig, action: str) -> DataFrame:
    """Valid init or teardown messages; both forms are unified before ids are read."""
    routed = MSG.route_messages(messages, cfg)
    return routed.where((F.col("route") == action) & F.col("error_field").isNull())


def init_connections(
    messages: DataFrame, connections: DataFrame, accounts: DataFrame, start_cursors: DataFrame, cfg: DriveConfig
) -> DataFrame:
    """Successful inits with account, start token and whether a channel is opened (asked for, and with a URL)."""
    return enriched_inits(valid_lifecycle(messages, cfg, "init"), connections, accounts, start_cursors)


def enriched_inits(inits: DataFrame, connections: DataFrame, accounts: DataFrame, start_cursors: DataFrame) -> DataFrame:
    """Valid routed init messages with what :func:`init_connections` says."""
    setup = F.coalesce(F.col("msg.params.config.setup_webhook"), F.lit(True))
    url = F.coalesce(F.col("msg.params.config.webhook_url"), F.lit(""))
    inits = inits.select(
        "seq",
        "message_id",
        "connection_id",
        MSG.customer_id_of().alias("message_customer_id"),
        (setup & (url != "")).alias("webhook_enabled"),
    )
    stored = connections.select("connection_id", F.col("customer_id").alias("_customer"))
    tokens = start_cursors.select("connection_id", F.col("start_cursor").cast("string").alias("_token"))
    return (
        J.with_connection(inits, stored)
        .join(accounts.select("connection_id", "email", "display_name"), "connection_id", "left")
        .join(tokens, "connection_id", "left")
        .withColumn("customer_id", F.coalesce(S.blank_to_null(F.col("_customer")), F.col("message_customer_id")))
        .withColumn("page_token", F.when(F.col("webhook_enabled"), F.coalesce("_token", F.lit("0"))))
        .drop("_customer", "_token", "message_customer_id")
    )


def teardown(messages: DataFrame, state: DataFrame, cfg: DriveConfig) -> DataFrame:
    """State left after the teardowns of a batch; no record is emitted for them."""
    gone = valid_lifecycle(messages, cfg, "teardown").select("connection_id").distinct()
    return ST.delete_state(state, gone)
