"""Connection state, cursors, channel renewal, init and teardown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile.config import DriveConfig
from stratafile.functions import scalars as S
from stratafile.operators.windows import latest_by

# What a connection can do, published with its ready event.
CONNECTION_CAPABILITIES = {
    "supports_backfill": True,
    "supports_incremental_sync": True,
    "supports_webhooks": True,
    "default_resource_type": "files",
    "supported_resource_types": ["files", "file", "folders", "folder"],
    "max_results_per_page": 1000,
    "webhook_expiration_hours": 24,
    "requires_polling": True,
}
# End of fixed values.


def upsert_state(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Last write wins per (connection, key) by ``updated_at``, then ``seq``."""
    return latest_by(
        current.unionByName(updates), ["connection_id", "key"], ["updated_at", "seq"], ["value", "updated_at", "seq"]
    )


def delete_state(state: DataFrame, teardowns: DataFrame) -> DataFrame:
    """State without the connections that were torn down."""
    return state.join(teardowns.select("connection_id"), "connection_id", "left_anti")


def state_value(state: DataFrame, cfg: DriveConfig, name: str, out: str) -> DataFrame:
    """``connection_id`` and the value of one key."""
    return state.where(F.col("key") == cfg.state_key(name)).select("connection_id", F.col("value").alias(out))


def cursors(state: DataFrame, cfg: DriveConfig) -> DataFrame:
    """Stored change-feed cursors as numbers; a blank value counts as none."""
    return (
        state_value(state, cfg, "page_token", "cursor")
        .withColumn("cursor", S.blank_to_null(F.col("cursor")).try_cast("bigint"))
        .where(F.col("cursor").isNotNull())
    )


def expired_cursors(cursor_rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Connections whose cursor lies before the oldest retained page of their feed and so need a full sync."""
    retained = changes.groupBy("connection_id").agg(F.min("page_no").alias("oldest_page"))
    return cursor_rows.join(retained, "connection_id").where(F.col("cursor") < F.col("oldest_page")).select(
        "connection_id",
        "cursor",
        "oldest_page",
        F.lit("ChangeTokenExpiredError").alias("error_class"),
        F.lit(True).alias("requires_backfill"),
    )


def renewal_due(state: DataFrame, cfg: DriveConfig, lead_minutes: int = 60) -> DataFrame:
    """Channels that expire within the lead time; the expiry is stored as epoch milliseconds in text form."""
    expiry = state_value(state, cfg, "channel_expiration", "expiration").withColumn(
        "expiration", F.col("expiration").try_cast("bigint")
    )
    due = F.col("expiration") - F.lit(lead_minutes * 60_000) <= F.unix_millis(cfg.now)
    return expiry.where(due).select(
        "connection_id", "expiration", (F.col("expiration") <= F.unix_millis(cfg.now)).alias("already_expired")
    )


def channel_state(inits: DataFrame, cfg: DriveConfig) -> DataFrame:
    """State rows of successful inits that opened a channel.

    Input ``connection_id, message_id, page_token, webhook_enabled``. Five rows each; ids derive from the message.
    """
    channel = S.deterministic_id(F.lit("channel"), F.col("message_id"))
    entries = {
        "page_token": F.col("page_token"),
        "channel_id": channel,
        "resource_id": S.deterministic_id(F.lit("resource"), F.col("message_id")),
        "channel_expiration": S.channel_expiry_ms(cfg.now).cast("string"),
        "channel_token": S.deterministic_id(F.lit("token"), F.col("message_id")),
    }
    items = F.array(
        *[F.struct(F.lit(cfg.state_key(name)).alias("key"), value.alias("value")) for name, value in entries.items()]
    )
    return (
        inits.where("webhook_enabled")
        .select("connection_id", "seq", F.explode(items).alias("_item"))
        .select("connection_id", "_item.*", cfg.now.alias("updated_at"), "seq")
    )


def _capability_struct() -> Column:
    return F.struct(
        *[
            (F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)).alias(name)
            for name, value in CONNECTION_CAPABILITIES.items()
        ]
    )


def ready_events(inits: DataFrame, cfg: DriveConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    """One ready event per successful init; profile and state are null when there is nothing to report.

    Input ``connection_id, customer_id, message_id, email, display_name, page_token, webhook_enabled``.
    """
    enabled = F.col("webhook_enabled")
    return inits.select(
        *keep,
        "connection_id",
        "customer_id",
        F.lit(cfg.provider).alias("integration_provider_name"),
        F.when(
            F.coalesce(F.col("email"), F.lit("")) != "",
            F.struct(F.col("email").alias("email_address"), F.col("display_name")),
        ).alias("profile"),
        F.when(
            enabled,
            F.struct(
                S.deterministic_id(F.lit("channel"), F.col("message_id")).alias("channel_id"),
                S.channel_expiry_ms(cfg.now).alias("channel_expiration"),
                F.col("page_token"),
            ),
        ).alias("state"),
        _capability_struct().alias("capabilities"),
    )
