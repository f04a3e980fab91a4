"""Columns by exact name, and keys for grouping wide values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_list(names) -> list:
    return [names] if isinstance(names, str) else list(names)


def quoted(name: str) -> Column:
    """Column by its exact name, dots included (``a.b`` is a name that flattened structs get)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.ArrayType):
        return _has_map(dt.elementType)
    return isinstance(dt, T.StructType) and any(_has_map(f.dataType) for f in dt.fields)


def _plain(df: DataFrame, name: str) -> Column:
    """The column in a form that can be hashed and compared: maps become their sorted entries (a map
    inside another type: its JSON text)."""
    dt = df.schema[name].dataType
    if isinstance(dt, T.MapType) and not _has_map(dt.keyType) and not _has_map(dt.valueType):
        return F.array_sort(F.map_entries(quoted(name)))
    return F.to_json(F.struct(quoted(name))) if _has_map(dt) else quoted(name)


def group_key(df: DataFrame, name: str) -> Column:
    """What a column is grouped by: a narrow value that is equal exactly where the column is. Fixed-width
    values stand for themselves, text and binary for their SHA-256 digest, nested values for the digest
    of their JSON text. Null stays null."""
    dt = df.schema[name].dataType
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.unhex(F.sha2(quoted(name), 256))
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
        return F.when(quoted(name).isNotNull(), F.unhex(F.sha2(F.to_json(F.struct(_plain(df, name))), 256)))
    return quoted(name)


def row_hash(df: DataFrame, names=None) -> Column:
    """A 64-bit hash of whole rows, to order rows that are otherwise tied."""
    cols = [_plain(df, c) for c in (df.columns if names is None else names)]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("long")
