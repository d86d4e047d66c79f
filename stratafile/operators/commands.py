"""Write commands applied to a catalog: commands in, the next snapshot and the rejected commands out.

Per file and field the last command that sets the field wins; moves add up in their order. All commands of a file are
first reduced to one row (aggregates that combine before the shuffle), so a file with very many commands costs one row
per task, and the snapshot needs one join with the catalog.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile.functions import mime as M
from stratafile.functions.presence import compute_once
from stratafile.functions.scalars import deterministic_id

# Operation names (both spellings), required payload fields and enumerations.
OPERATION_NAMES = {
    "create_file": "create_file",
    "upload_file": "create_file",
    "update_file": "update_file",
    "update_metadata": "update_file",
    "delete_file": "delete_file",
    "trash_file": "trash_file",
    "untrash_file": "untrash_file",
    "create_folder": "create_folder",
    "copy_file": "copy_file",
    "move_file": "move_file",
    "create_permission": "create_permission",
    "share_file": "create_permission",
    "update_permission": "update_permission",
    "delete_permission": "delete_permission",
    "unshare_file": "delete_permission",
}
REQUIRED_PAYLOAD = {
    "create_file": ["name"],
    "update_file": ["file_id"],
    "delete_file": ["file_id"],
    "trash_file": ["file_id"],
    "untrash_file": ["file_id"],
    "create_folder": ["name"],
    "copy_file": ["file_id"],
    "move_file": ["file_id", "new_parent_folder_id"],
    "create_permission": ["file_id", "role", "type"],
    "update_permission": ["file_id", "permission_id", "role"],
    "delete_permission": ["file_id", "permission_id"],
}
ROLES = ["owner", "organizer", "fileOrganizer", "writer", "commenter", "reader"]
PERMISSION_TYPES = ["user", "group", "domain", "anyone"]
# End of fixed values.


def canonical_operation(operation: Column) -> Column:
    table = F.create_map(*[F.lit(item) for pair in OPERATION_NAMES.items() for item in pair])
    return F.try_element_at(table, operation)


def command_error(kind: Column) -> Column:
    """First reason a command is invalid: unknown operation, missing payload field, value outside its enumeration."""
    required_fields = F.create_map(
        *[item for name, fields in REQUIRED_PAYLOAD.items() for item in (F.lit(name), F.array(*map(F.lit, fields)))]
    )
    names = sorted({field for fields in REQUIRED_PAYLOAD.values() for field in fields})
    payload = F.create_map(*[item for name in names for item in (F.lit(name), F.col(f"payload.{name}"))])
    missing = F.filter(
        F.try_element_at(required_fields, kind), lambda field: F.coalesce(payload[field], F.lit("")) == ""
    )
    bad_role = kind.isin("create_permission", "update_permission") & ~F.col("payload.role").isin(ROLES)
    bad_type = (kind == "create_permission") & ~F.col("payload.type").isin(PERMISSION_TYPES)
    return F.when(kind.isNull(), F.lit("operation")).otherwise(
        F.coalesce(F.get(missing, F.lit(0)), F.when(bad_role, F.lit("role")), F.when(bad_type, F.lit("type")))
    )


def check_commands(commands: DataFrame) -> DataFrame:
    """Add ``kind`` and ``error``. Input ``command_id, seq, operation, payload`` (struct of text fields)."""
    known = compute_once(commands, kind=canonical_operation(F.col("operation")))
    return compute_once(known, error=command_error(F.col("kind")))


def _last(kinds: list[str], value: Column) -> Column:
    """Last value that a command of the given kinds sets, null if none does."""
    sets = F.col("kind").isin(kinds) & value.isNotNull()
    return F.max(F.when(sets, F.struct(F.col("seq"), value.alias("v"))))["v"]


def per_file(commands: DataFrame) -> DataFrame:
    """One row per file: the last value of each field, and whether the file is trashed or deleted."""
    targets = ["update_file", "delete_file", "trash_file", "untrash_file"]
    fields = ["name", "description", "mime_type"]
    return (
        commands.where(F.col("kind").isin(targets))
        .groupBy(F.col("payload.file_id").alias("id"))
        .agg(
            *[_last(["update_file"], F.col(f"payload.{field}")).alias(f"_{field}") for field in fields],
            _last(["trash_file", "untrash_file"], F.col("kind") == "trash_file").alias("_trashed"),
            F.count_if(F.col("kind") == "delete_file").alias("_deletes"),
        )
    )


def parent_moves(commands: DataFrame) -> DataFrame:
    """What all moves of a file do to its parents: ``_gone`` parents leave it, ``_added`` ones come, in their order.

    A parent is judged by the last move that names it; a move removes before it adds. Reduced per (file, parent) first,
    so the arrays hold each parent once.
    """
    moves = commands.where(F.col("kind") == "move_file").select(
        F.col("payload.file_id").alias("id"), "seq", "payload.new_parent_folder_id", "payload.remove_parents"
    )
    empty = F.array().cast("array<string>")
    removed = moves.select("id", "seq", F.explode(F.coalesce("remove_parents", empty)).alias("parent"), F.lit(0).alias("adds"))
    added = moves.select("id", "seq", F.col("new_parent_folder_id").alias("parent"), F.lit(1).alias("adds"))
    per_parent = removed.unionByName(added).groupBy("id", "parent").agg(
        F.max(F.struct("seq", "adds")).alias("last"), F.max(F.when(F.col("adds") == 0, F.col("seq"))).alias("removed_at"),
        F.min(F.when(F.col("adds") == 1, F.col("seq"))).alias("first_added"),
    )
    at = F.when(F.col("removed_at").isNull(), F.col("first_added")).otherwise(F.col("last.seq"))
    place = F.when(F.col("last.adds") == 1, F.struct(at.alias("at"), F.col("parent")))
    return per_parent.groupBy("id").agg(
        F.collect_list(F.when(F.col("removed_at").isNotNull(), F.col("parent"))).alias("_gone"),
        F.transform(F.sort_array(F.collect_list(place)), lambda x: x["parent"]).alias("_added"),
    )


def moved_parents(parents: Column, gone: Column, added: Column) -> Column:
    """Parents without those that were removed at some time, then those that were added."""
    empty = F.array().cast("array<string>")
    return F.array_union(F.array_except(F.coalesce(parents, empty), F.coalesce(gone, empty)), F.coalesce(added, empty))


def apply_file_commands(catalog: DataFrame, commands: DataFrame) -> DataFrame:
    """Next snapshot of the catalog.

    ``catalog``: ``id, name, description, mime_type, parent_ids, trashed``. Copies take the catalog row as it was
    before the batch; deletes win over other changes of the same file.
    """
    valid = check_commands(commands).where(F.col("error").isNull())
    changes = per_file(valid).join(parent_moves(valid), "id", "full")
    no_parents = F.array().cast("array<string>")
    current = (
        catalog.join(changes, "id", "left")
        .where(F.coalesce("_deletes", F.lit(0)) == 0)
        .select(
            "id",
            F.coalesce("_name", "name").alias("name"),
            F.coalesce("_description", "description").alias("description"),
            F.coalesce("_mime_type", "mime_type").alias("mime_type"),
            F.when(
                F.col("_added").isNotNull(), moved_parents(F.col("parent_ids"), F.col("_gone"), F.col("_added"))
            )
            .otherwise(F.col("parent_ids"))
            .alias("parent_ids"),
            F.coalesce("_trashed", "trashed").alias("trashed"),
        )
    )
    parent = F.col("payload.parent_folder_id")
    parents = F.when(parent.isNotNull(), F.array(parent)).otherwise(no_parents)
    created = valid.where(F.col("kind").isin("create_file", "create_folder")).select(
        new_id().alias("id"),
        F.col("payload.name").alias("name"),
        F.col("payload.description").alias("description"),
        F.when(F.col("kind") == "create_folder", F.lit(M.FOLDER))
        .otherwise(F.coalesce("payload.mime_type", F.lit(M.DEFAULT_MIME)))
        .alias("mime_type"),
        parents.alias("parent_ids"),
        F.lit(False).alias("trashed"),
    )
    copies = (
        valid.where(F.col("kind") == "copy_file")
        .select(
            new_id().alias("_new_id"),
            F.col("payload.file_id").alias("id"),
            F.col("payload.name").alias("_name"),
            parent.alias("_parent"),
        )
        .join(catalog, "id")
        .select(
            F.col("_new_id").alias("id"),
            F.coalesce("_name", F.concat(F.lit("Copy of "), F.col("name"))).alias("name"),
            "description",
            "mime_type",
            F.when(F.col("_parent").isNotNull(), F.array("_parent")).otherwise(F.col("parent_ids")).alias("parent_ids"),
            F.lit(False).alias("trashed"),
        )
    )
    return current.unionByName(created).unionByName(copies)


def new_id() -> Column:
    return F.concat(F.lit("new_"), F.left(deterministic_id(F.lit("create"), F.col("command_id")), F.lit(16)))


def apply_permission_commands(permissions: DataFrame, commands: DataFrame) -> DataFrame:
    """Next snapshot of the permissions. ``permissions``: ``file_id, permission_id, role, permission_type,
    email_address``."""
    valid = check_commands(commands).where(F.col("error").isNull())
    changes = (
        valid.where(F.col("kind").isin("update_permission", "delete_permission"))
        .groupBy(F.col("payload.file_id").alias("file_id"), F.col("payload.permission_id").alias("permission_id"))
        .agg(
            _last(["update_permission"], F.col("payload.role")).alias("_role"),
            F.count_if(F.col("kind") == "delete_permission").alias("_deletes"),
        )
    )
    current = (
        permissions.join(changes, ["file_id", "permission_id"], "left")
        .where(F.coalesce("_deletes", F.lit(0)) == 0)
        .select("file_id", "permission_id", F.coalesce("_role", "role").alias("role"), "permission_type", "email_address")
    )
    created = valid.where(F.col("kind") == "create_permission").select(
        F.col("payload.file_id").alias("file_id"),
        new_id().alias("permission_id"),
        F.col("payload.role").alias("role"),
        F.col("payload.type").alias("permission_type"),
        F.col("payload.email_address").alias("email_address"),
    )
    return current.unionByName(created)


def rejected_commands(catalog: DataFrame, commands: DataFrame) -> DataFrame:
    """Invalid commands with the failing field, and valid ones whose file does not exist. The file is looked up once
    per distinct target."""
    checked = check_commands(commands)
    invalid = checked.where(F.col("error").isNotNull()).select("command_id", "operation", "error")
    target = F.col("payload.file_id")
    needs_file = checked.where(F.col("error").isNull() & ~F.col("kind").isin("create_file", "create_folder"))
    unknown = (
        needs_file.withColumn("id", target)
        .join(catalog.select("id"), "id", "left_anti")
        .select("command_id", "operation", F.lit("not_found").alias("error"))
    )
    return invalid.unionByName(unknown)
