"""Parse a JSON text column once into a struct plus its key set, so that absent and null stay apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile.functions.scalars import present_or


class JsonRecord:
    """Access to a parsed record: ``rec[field]`` is the value, ``rec.has(field)`` whether the key is there."""

    def __init__(self, raw: Column, keys: Column):
        self._raw = raw
        self._keys = keys

    def __getitem__(self, field: str) -> Column:
        return self._raw[field]

    def has(self, field: str) -> Column:
        return F.array_contains(self._keys, field)

    def null_valued(self, field: str) -> Column:
        """Key present, value null (or of a type the field cannot hold)."""
        return self.has(field) & self._raw[field].isNull()

    def get(self, field: str, default) -> Column:
        return present_or(self.has(field), self._raw[field], default)

    @property
    def keys(self) -> Column:
        return self._keys


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read but never recompute.

    A filter on an ordinary column is pushed below the projection that makes it, and then repeats the column's
    expression once per use; for a JSON parse that means many parses per row. ``inline`` over a one-element array keeps
    the expression in its own step of the same stage.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def parse_json_records(df: DataFrame, json_col: str, schema: str, prefix: str = "_r") -> tuple[DataFrame, JsonRecord]:
    """Add ``<prefix>_raw`` and ``<prefix>_keys``; a text that is no JSON object has null keys."""
    raw, keys = f"{prefix}_raw", f"{prefix}_keys"
    parsed = compute_once(df, **{keys: F.json_object_keys(json_col), raw: F.from_json(json_col, schema)})
    return parsed, JsonRecord(F.col(raw), F.col(keys))


def map_has(mapping: Column, key: str) -> Column:
    return F.map_contains_key(mapping, key)


def map_get(mapping: Column, key: str, default=None) -> Column:
    """Value of a key; the default only where the key is absent."""
    value = F.try_element_at(mapping, F.lit(key))
    if default is None:
        return value
    return present_or(map_has(mapping, key), value, default)
