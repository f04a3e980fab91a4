"""C1, C3 (text form), C6, C8 row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import letters_only
from .joins import anti_join, semi_join
from .setops import split_by_flag  # noqa: F401  (C8, re-exported here)


def drop_null_text(df: DataFrame, cols="text") -> DataFrame:
    """Keep rows whose text column(s) are present."""
    return df.na.drop(subset=[cols] if isinstance(cols, str) else list(cols))


def has_dependency(dep_text, label: str = "ccomp") -> Column:
    """C3 on the ``dep_text`` form (`` word[dep]``): the label occurs; null text gives null."""
    c = F.col(dep_text) if isinstance(dep_text, str) else dep_text
    return c.contains(label)


def filter_known_verbs(df: DataFrame, verb_col: str, verbs: DataFrame, clean: bool = True):
    """(rows whose verb is in the dimension, rows whose verb is not).

    With ``clean`` the label is reduced to word characters first (I11). Both sides
    are a semi / anti join on the (broadcast, size-checked) dimension -- the
    dimension is never collected.
    """
    d = df.withColumn(verb_col, letters_only(verb_col)) if clean else df
    dim = verbs.select(F.col("verb").alias(verb_col))
    return semi_join(d, dim, verb_col, broadcast_other=True), anti_join(d, dim, verb_col)
