"""Equi-joins by key lookup.

No join forces a broadcast: Spark broadcasts a side only below its size threshold and otherwise sorts and merges.
Dimension sides hold one row per key. For a dimension too large to broadcast, ``hot_keys`` names the keys that own a
large share of the rows and ``lookup_join`` spreads those keys, and only those, over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile.functions.scalars import blank_to_null
from stratafile.operators import windows as W
from stratafile.operators.messages import UNRESOLVED_IDS


def hot_keys(df: DataFrame, key: str, share: float = 0.02, fraction: float = 0.01) -> list[str]:
    """Keys that own at least ``share`` of a sample; at most ``1 / share`` of them exist, so the list stays short.

    The list only steers how work is spread. A key missing from it, or one too many, changes no result.
    """
    counts = df.sample(fraction, seed=7).groupBy(key).agg(F.count("*").alias("n"))
    sampled = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where((F.col("n") >= sampled * share) & F.col(key).isNotNull()).limit(int(1 / share)).collect()
    return sorted(row[key] for row in rows)


def not_sent(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the data. Spark takes packed files, and texts made on the way, for much smaller than
    they are, and would collect such a side in the driver to send it to all tasks."""
    return side.hint("merge")


def lookup_join(
    facts: DataFrame, dimension: DataFrame, key: str, hot: list[str] | None = None, spread: str | None = None,
    salts: int = 64, how: str = "left", also: tuple[str, ...] = (), tasks: int | None = None,
) -> DataFrame:
    """Left join with a dimension of one row per key; or, by ``how`` and with ``also`` as further keys, with some rows per key.

    Rows of the ``hot`` keys get a salt from a hash of their ``spread`` column; the dimension rows of those few keys are
    repeated once per salt. Every other key joins as usual. Where a key has very many rows, a few bytes of facts give very
    many rows out; ``tasks`` keeps adaptive execution from putting such facts together in fewer tasks.
    """
    if not hot or spread is None:
        return facts.join(dimension, [key, *also], how)
    is_hot = F.col(key).isin(hot)
    zero = F.lit(0)
    salted = facts.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(zero)
    )
    repeated = dimension.withColumn(
        "_salt", F.explode(F.when(is_hot, F.sequence(zero, F.lit(salts - 1))).otherwise(F.array(zero)))
    )
    if tasks:
        salted = salted.repartition(tasks, key, *also, "_salt")
    return salted.join(repeated, [key, *also, "_salt"], how).drop("_salt")


def with_connection(
    messages: DataFrame, connections: DataFrame, on: str = "connection_id", hot: list[str] | None = None,
    spread: str | None = None,
) -> DataFrame:
    """Message with its connection row; a message without one keeps nulls."""
    return lookup_join(messages, connections, on, hot, spread)


def merge_init_metadata(df: DataFrame) -> DataFrame:
    """Values of an init message override the stored ones only if truthy; ``external_id`` also sets ``user_id``.

    Columns: ``msg_snowball_id, msg_external_id, msg_connection_config`` and their stored counterparts.
    """
    external = blank_to_null(F.col("msg_external_id"))
    return (
        df.withColumn("snowball_id", F.coalesce(blank_to_null(F.col("msg_snowball_id")), F.col("snowball_id")))
        .withColumn("user_id", F.coalesce(external, F.col("user_id")))
        .withColumn("external_id", F.coalesce(external, F.col("external_id")))
        .withColumn(
            "connection_config",
            F.coalesce(blank_to_null(F.col("msg_connection_config")), F.col("connection_config")),
        )
        .drop("msg_snowball_id", "msg_external_id", "msg_connection_config")
    )


def teardown_credentials(message_token: Column, stored_token: Column) -> Column:
    """Credentials in the teardown message win over the stored ones."""
    return F.coalesce(blank_to_null(message_token), stored_token)


def _is_unresolved() -> Column:
    return F.coalesce(F.col("message_connection_id").isin(UNRESOLVED_IDS), F.lit(False))


def hot_lookups(webhooks: DataFrame) -> tuple[list[str], list[str]]:
    """Connection ids and account emails that many of some sampled notifications look up; see :func:`hot_keys`."""
    unresolved = _is_unresolved()
    looked = F.when(unresolved, F.concat(F.lit("e"), "email")).otherwise(F.concat(F.lit("i"), "message_connection_id"))
    hot = hot_keys(webhooks.select(looked.alias("_looked")), "_looked", fraction=1.0)
    return [key[1:] for key in hot if key[0] == "i"], [key[1:] for key in hot if key[0] == "e"]


def resolve_connections(
    webhooks: DataFrame, connections: DataFrame, hot: tuple[list[str], list[str]] | None = None
) -> DataFrame:
    """Find the connection of notifications whose id is not known yet by account email; others keep theirs.

    Adds ``connection_id, customer_id, snowball_id, settings`` and ``resolution_error``
    (``EXTERNAL_ID_EXTRACTION_FAILED`` without an email, ``CONNECTION_NOT_FOUND`` without a match). Resolved values
    override the message's. In either join, rows that it doesn't concern get a key of their own that matches nothing, so
    that they spread over all partitions instead of meeting under one null or "unknown" key. ``hot`` (:func:`hot_lookups`)
    names ids and emails whose notifications are spread as well.
    """
    hot_ids, hot_emails = hot or ([], [])
    by_id = connections.select(
        F.col("connection_id").alias("_by_id"),
        F.col("snowball_id").alias("_id_snowball"),
        F.col("settings").alias("_id_settings"),
    )
    # One connection per account; the smallest id stands for an account that has several.
    by_email = (
        connections.where(F.col("external_id").isNotNull())
        .groupBy(F.col("external_id").alias("_lookup"))
        .agg(
            F.min(F.struct("connection_id", "customer_id", "snowball_id", "settings")).alias("_by_email")
        )
    )
    keyed = (
        webhooks.withColumn("_unresolved", _is_unresolved())
        .withColumn(
            "_lookup",
            F.coalesce(
                F.when(F.col("_unresolved"), F.col("email")), F.concat(F.lit("\u0000"), F.col("message_id"))
            ),
        )
        .withColumn(
            "_by_id",
            F.when(F.col("_unresolved"), F.concat(F.lit("\u0000"), F.col("message_id"))).otherwise(F.col("message_connection_id")),
        )
    )
    joined = lookup_join(lookup_join(keyed, by_id, "_by_id", hot_ids, "message_id"), by_email, "_lookup", hot_emails, "message_id")
    resolved = F.col("_by_email")
    return (
        joined.withColumn(
            "connection_id", F.when(F.col("_unresolved"), resolved["connection_id"]).otherwise(F.col("message_connection_id"))
        )
        .withColumn(
            "customer_id",
            F.when(F.col("_unresolved"), resolved["customer_id"]).otherwise(F.col("message_customer_id")),
        )
        .withColumn("snowball_id", F.when(F.col("_unresolved"), resolved["snowball_id"]).otherwise(F.col("_id_snowball")))
        .withColumn("settings", F.when(F.col("_unresolved"), resolved["settings"]).otherwise(F.col("_id_settings")))
        .withColumn(
            "resolution_error",
            F.when(F.col("_unresolved") & F.col("email").isNull(), F.lit("EXTERNAL_ID_EXTRACTION_FAILED")).when(
                F.col("_unresolved") & resolved.isNull(), F.lit("CONNECTION_NOT_FOUND")
            ),
        )
        .drop("_unresolved", "_lookup", "_by_id", "_by_email", "_id_snowball", "_id_settings")
    )


def as_of_join(
    facts: DataFrame, versions: DataFrame, fact_key: str, fact_time: str, version_key: str, version_order: list[str], out: str
) -> DataFrame:
    """Left join of each fact with the version of its key that is valid at the fact's time, as the struct ``out``.

    ``version_order`` is the start of a version, then what decides among equal starts. A version holds from its start
    (inclusive; null: from the beginning) until the next one of its key. A fact without a key, or before the first version,
    gets null; a fact without a time sees only versions without a start. Versions without a key match nothing. Every fact
    gives one row. Facts and versions are sorted together by range (:func:`windows.last_so_far`), so neither a key with a
    third of all facts nor one with a third of all versions meets in one task, and no fact is paired with more than one
    version.
    """
    start, *ties = version_order
    kinds = {f.name: f.dataType for f in versions.schema.fields}
    version = F.struct(*versions.columns)
    held = versions.where(F.col(version_key).isNotNull()).select(
        F.col(version_key).alias("_key"), F.col(start).alias("_time"), F.lit(0).alias("_kind"),
        *[F.col(t).alias(f"_tie{i}") for i, t in enumerate(ties)],
        version.alias(out),
    )
    row = F.struct(*facts.columns)
    asked = facts.select(
        F.col(fact_key).alias("_key"), F.col(fact_time).alias("_time"), F.lit(1).alias("_kind"),
        *[F.lit(None).cast(kinds[t]).alias(f"_tie{i}") for i, t in enumerate(ties)],
        row.alias("_fact"),
    )
    # A hash of the fact (maps have none) spreads facts of one key and instant; versions are told apart by their ties.
    hashed = [f"_fact.{f.name}" for f in facts.schema.fields if "map<" not in f.dataType.simpleString()]
    both = held.withColumn("_spread", F.lit(0).cast("bigint")).unionByName(
        asked.withColumn("_spread", F.xxhash64(*hashed)), allowMissingColumns=True
    )
    order = ["_time", "_kind", *[f"_tie{i}" for i in range(len(ties))], "_spread"]
    return W.last_so_far(both, ["_key"], order, out, "_valid").where(F.col("_kind") == 1).select(
        "_fact.*", F.col("_valid").alias(out)
    )


def resolve_connections_as_of(webhooks: DataFrame, versions: DataFrame, time: str = "ts") -> DataFrame:
    """:func:`resolve_connections` by the connections as they were when each notification came.

    ``versions``: ``connection_id, valid_from, version_seq, active, customer_id, snowball_id, external_id, settings``; the
    first one of a connection may have no ``valid_from``. An account email belongs to the connection whose version named it
    last, as long as that connection is active and still names it. A known id keeps its connection and takes ``snowball_id``
    and ``settings`` of the version valid then, none if that one is inactive. A replayed batch resolves as it did at first.
    Adds the columns of ``resolve_connections`` and ``version_seq``, the version used.
    """
    order = ["valid_from", "version_seq"]
    unresolved = F.coalesce(F.col("message_connection_id").isin(UNRESOLVED_IDS), F.lit(False))
    claims = versions.where("active").select("external_id", *order, "connection_id")
    asked = webhooks.withColumn("_unresolved", unresolved).withColumn("_email", F.when(unresolved, F.col("email")))
    claimed = as_of_join(asked, claims, "_email", time, "external_id", order, "_claim")
    target = F.when(F.col("_unresolved"), F.col("_claim.connection_id")).otherwise(F.col("message_connection_id"))
    held = as_of_join(claimed.withColumn("_target", target), versions, "_target", time, "connection_id", order, "_version")
    valid = F.when(
        F.col("_version.active") & (~F.col("_unresolved") | (F.col("_version.external_id") == F.col("_email"))), F.col("_version")
    )
    found = held.withColumn("_valid", valid)
    return found.select(
        *webhooks.columns,
        F.when(F.col("_unresolved"), F.col("_valid.connection_id")).otherwise(F.col("message_connection_id")).alias("connection_id"),
        F.when(F.col("_unresolved"), F.col("_valid.customer_id")).otherwise(F.col("message_customer_id")).alias("customer_id"),
        F.col("_valid.snowball_id").alias("snowball_id"),
        F.col("_valid.settings").alias("settings"),
        F.when(F.col("_unresolved") & F.col("email").isNull(), F.lit("EXTERNAL_ID_EXTRACTION_FAILED"))
        .when(F.col("_unresolved") & F.col("_valid").isNull(), F.lit("CONNECTION_NOT_FOUND"))
        .alias("resolution_error"),
        F.col("_valid.version_seq").alias("version_seq"),
    )


def changes_after_cursor(
    changes: DataFrame, cursors: DataFrame, starts: DataFrame, hot: list[str] | None = None, spread: str | None = None
) -> DataFrame:
    """Changes at or after the stored cursor of their connection.

    A connection without one starts at its newest token (``starts``: ``connection_id, start_cursor``), so it sees only
    what changes from then on; one that has neither gets nothing.
    """
    first = starts.select("connection_id", F.col("start_cursor").alias("_start"))
    stored = first.join(cursors.select("connection_id", F.col("cursor").alias("_cursor")), "connection_id", "full")
    joined = lookup_join(changes, stored, "connection_id", hot, spread)
    return joined.where(F.col("page_no") >= F.coalesce("_cursor", "_start")).drop("_cursor", "_start")


def live_files(catalog: DataFrame, latest_changes: DataFrame, file_id: str = "id") -> DataFrame:
    """Catalog rows whose newest change is not a removal."""
    removed = latest_changes.where(F.coalesce(F.col("removed"), F.lit(False))).select(
        F.col("file_id").alias(file_id)
    )
    return catalog.join(removed, file_id, "left_anti")


def tombstones(latest_changes: DataFrame) -> DataFrame:
    """Optional removal rows; the default paths emit none."""
    return latest_changes.where(F.coalesce(F.col("removed"), F.lit(False))).select(
        "file_id", F.lit(True).alias("deleted")
    )


def with_content(files: DataFrame, content: DataFrame, eligible: Column | None = None) -> DataFrame:
    """Files with the reference to their stored content; a file without content keeps its metadata.

    Files that are not ``eligible`` match nothing. ``content`` carries references, not the bytes.
    """
    if eligible is None:
        return files.join(content, "file_id", "left")
    refs = content.withColumnRenamed("file_id", "_content_id")
    return files.join(refs, (F.col("file_id") == F.col("_content_id")) & eligible, "left").drop("_content_id")


def children_of(children: DataFrame, files: DataFrame, how: str = "inner") -> DataFrame:
    """Revisions, permissions or comments with their file; ``files`` holds one row per ``file_id``."""
    return children.join(files, "file_id", how)
