"""B1-B8 projections. Names only change on the driver (plan metadata); no data moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import FOLD_FROM, FOLD_TO, MULTI_CHAR_FOLDS, _is_mark
from .names import quoted


def rename_columns(df: DataFrame, mapping: dict) -> DataFrame:
    """B1: rename by map; names not in the frame are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def fold_name(name: str) -> str:
    """ASCII-fold and lower-case one column name (driver side, plan metadata only)."""
    for a, b in MULTI_CHAR_FOLDS:
        name = name.replace(a, b)
    return "".join(ch for ch in name if not _is_mark(ch)).translate(str.maketrans(FOLD_FROM, FOLD_TO)).lower()


def standardize_columns(df: DataFrame) -> DataFrame:
    """B2: unaccented, lower-case column names."""
    return df.toDF(*[fold_name(c) for c in df.columns])


def select_columns(df: DataFrame, cols) -> DataFrame:
    """Configured subset in the configured order."""
    return df.select(*[quoted(c) for c in cols])


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop, ignoring missing names."""
    return df.drop(*[c for c in cols if c in df.columns])


def combine_columns(df: DataFrame, groups: dict, as_text: bool = False, drop: bool = True) -> DataFrame:
    """Several columns -> one struct (or a ``(a, b, c)`` text) per name."""
    out = df
    for name, cols in groups.items():
        if as_text:
            col = F.concat(F.lit("("), F.concat_ws(", ", *[quoted(c).cast("string") for c in cols]), F.lit(")"))
        else:
            col = F.struct(*[quoted(c).alias(c) for c in cols])
        out = out.withColumn(name, col)
        if drop:
            out = out.drop(*[c for c in cols if c != name])
    return out


def convert_types(df: DataFrame, type_map: dict, date_formats=None) -> DataFrame:
    """Coerce types; failures become null; names not in the frame are skipped.

    ``type_map`` values: 'datetime', 'int', 'float' or any Spark type name.
    """
    from ..functions.text import DATE_FORMATS
    fmts = date_formats or DATE_FORMATS
    cols = {}
    for c, t in type_map.items():
        if c not in df.columns:
            continue
        if t == "datetime":
            src = quoted(c).cast("string")
            if date_formats is None:
                from ..functions.text import parse_created_at
                cols[c] = parse_created_at(src)
            else:
                cols[c] = F.coalesce(*[F.try_to_timestamp(src, F.lit(f)) for f in fmts])
        elif t == "int":
            cols[c] = quoted(c).try_cast("bigint")
        elif t == "float":
            cols[c] = quoted(c).try_cast("double")
        else:
            cols[c] = quoted(c).try_cast(t)
    return df.withColumns(cols)


def add_features(df: DataFrame, features: dict) -> DataFrame:
    """Add derived columns on the same rows (never a join)."""
    return df.withColumns(features)


def assign_ids(df: DataFrame, order, start: int = 0, name: str = "id") -> DataFrame:
    """Consecutive ids from ``start`` in ``order`` (F6 plus an offset)."""
    from .sequence import with_row_index
    return with_row_index(df, order, name=name, start=start)
