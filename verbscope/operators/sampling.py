"""G1-G5 sort, limit and sample. Every limit has an explicit, unique order.

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps its own
top n and only those reach the final merge, so no full sort is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .names import quoted


def _order(cols, descending):
    cols = [cols] if isinstance(cols, str) else list(cols)
    if isinstance(descending, bool):
        descending = [descending] * len(cols)
    return [quoted(c).desc() if d else quoted(c).asc() for c, d in zip(cols, descending)]


def head(df: DataFrame, n: int, order, descending=False) -> DataFrame:
    """G1: first ``n`` rows in ``order``."""
    return df.orderBy(*_order(order, descending)).limit(n)


def tail(df: DataFrame, n: int, order) -> DataFrame:
    """Last ``n`` rows in ``order`` (top-n of the reversed order)."""
    return head(df, n, order, descending=True)


def top_k(df: DataFrame, k: int, order, descending=True) -> DataFrame:
    """The ``k`` first rows by ``order`` (e.g. counts descending, then value)."""
    return head(df, k, order, descending)


def row_at(df: DataFrame, position: int, order) -> DataFrame:
    """Row at 0-based ``position`` in ``order``; no row past the end."""
    cols = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*_order(cols, False)).offset(position).limit(1) if position >= 0 else df.limit(0)


def _hash_key(key, seed: int):
    """First 52 bits of an MD5 of the key columns and the seed."""
    cols = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[quoted(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def sample_fraction(df: DataFrame, fraction: float, key, seed: int = 1) -> DataFrame:
    """Seeded fraction chosen by a hash of the key -- the same rows whatever the
    partitioning or the number of executors (``df.sample`` is not stable that way)."""
    return df.where(_hash_key(key, seed) < F.lit(fraction * 2.0 ** 52))


def sample_n(df: DataFrame, n: int, key, seed: int = 1) -> DataFrame:
    """Seeded exact ``n`` rows: the ``n`` smallest (hash, key) -- a top-k, no full sort."""
    cols = [key] if isinstance(key, str) else list(key)
    return (df.withColumn("_h", _hash_key(key, seed)).orderBy("_h", *[quoted(c) for c in cols]).limit(n).drop("_h"))
