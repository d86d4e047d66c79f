"""Predicates over raw, normalized and change rows as Column builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile.functions import mime as M
from stratafile.functions import scalars as S


def all_of(*conditions: Column | None) -> Column | None:
    """AND of the given parts; no part means no filter."""
    parts = [c for c in conditions if c is not None]
    return reduce(lambda a, b: a & b, parts) if parts else None


def apply_filters(df: DataFrame, *conditions: Column | None) -> DataFrame:
    condition = all_of(*conditions)
    return df if condition is None else df.where(condition)


def not_trashed(include_trashed: bool = False, trashed: str = "trashed") -> Column | None:
    """Trashed rows are left out unless asked for."""
    return None if include_trashed else ~F.coalesce(F.col(trashed), F.lit(False))


def wanted_type(is_folder: Column, sync_files: Column, sync_folders: Column) -> Column:
    """Folder and file selection by settings; both off keep nothing, an absent setting counts as on."""
    files = F.coalesce(sync_files, F.lit(True))
    folders = F.coalesce(sync_folders, F.lit(True))
    return (is_folder & folders) | (~is_folder & files)


def wanted_drive(shared_drive: Column, sync_shared_drives: Column) -> Column:
    """Items of shared drives by settings; an absent setting counts as on, an absent mark as an own item."""
    return ~F.coalesce(shared_drive, F.lit(False)) | F.coalesce(sync_shared_drives, F.lit(True))


def not_removed(removed: str = "removed") -> Column:
    return ~F.coalesce(F.col(removed), F.lit(False))


def has_file(file_json: str = "file") -> Column:
    """A change carries a file; a missing and an empty object both count as none."""
    return F.coalesce(F.size(F.json_object_keys(file_json)), F.lit(0)) > 0


def has_space(snowball_id: str = "snowball_id") -> Column:
    return F.coalesce(F.col(snowball_id), F.lit("")) != ""


def for_provider(provider: Column, wanted: str) -> Column:
    """Messages of another provider are skipped; a missing or empty one passes."""
    return F.coalesce(provider, F.lit("")).isin("", wanted)


def not_stop(kind: Column) -> Column:
    return ~kind.eqNullSafe(F.lit("drive#stop"))


def skip_reason(
    mime_type: Column, declared_size: Column, actual_size: Column | None = None, max_bytes: int = S.MAX_FILE_BYTES
) -> Column:
    """Why a file's content is not read; null means it is eligible. A size that does not parse is no reason."""
    reason = (
        F.when(M.is_folder(mime_type), F.lit("folder"))
        .when(mime_type.isin(M.NOT_EXPORTABLE_TYPES), F.lit("not_exportable"))
        .when(declared_size > max_bytes, F.lit("declared_too_large"))
    )
    return reason if actual_size is None else reason.when(actual_size > max_bytes, F.lit("content_too_large"))


def read_mode(mime_type: Column) -> Column:
    return F.when(M.needs_export(mime_type), F.lit("export")).otherwise(F.lit("download"))


def in_folder(folder_id: str | Column, parents: str = "parent_ids") -> Column:
    return F.array_contains(F.col(parents), folder_id)


def of_mime(mime_type: str) -> Column:
    return F.col("mime_type") == mime_type


def modified_after(instant: str, column: str = "modified_at") -> Column:
    """Compares instants, not texts: suffixes and fraction digits may differ."""
    return F.col(column).try_cast("timestamp") > F.to_timestamp(F.lit(instant))


def owned_by(email: str, owners: str = "owners") -> Column:
    return F.exists(F.col(owners), lambda o: o["email"] == F.lit(email))


def change_filters(
    include_removed: bool = True, restrict_to_my_drive: bool = False, shared_drive: str = "shared_drive"
) -> Column | None:
    """The advertised change filters."""
    return all_of(
        None if include_removed else not_removed(),
        ~F.coalesce(F.col(shared_drive), F.lit(False)) if restrict_to_my_drive else None,
    )
