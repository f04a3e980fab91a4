"""E1-E9 aggregations.

All are single ``groupBy``/``agg`` plans: Spark computes a partial aggregate per map
task before the shuffle, so a hot group costs one row per task on the wire.
Counts are ``bigint``, ratios ``double`` rounded to 6 places.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import small_side
from .names import as_list, group_key, quoted


def _keys(k):
    if k is None:
        return []
    return [k] if isinstance(k, str) else list(k)


def flag_rate(df: DataFrame, flag: str, by=None, n_name: str = "n", true_name: str = "n_true",
              rate_name: str = "rate", digits: int = 6) -> DataFrame:
    """Rows, rows where ``flag`` is true, and their ratio, per group.

    A null flag counts in ``n`` but not in ``n_true`` (as ``sum`` skips null).
    """
    by = _keys(by)
    agg = [F.count(F.lit(1)).alias(n_name),
           F.coalesce(F.sum(F.col(flag).cast("long")), F.lit(0)).cast("long").alias(true_name)]
    g = df.groupBy(*by).agg(*agg) if by else df.agg(*agg)
    return g.withColumn(rate_name, F.round(F.col(true_name) / F.col(n_name), digits))


def flag_split_counts(df: DataFrame, flag: str, by=None) -> DataFrame:
    """E3 complement: true / false / null counts of a boolean."""
    by = _keys(by)
    agg = [F.count(F.when(F.col(flag), 1)).alias("n_true"),
           F.count(F.when(~F.col(flag), 1)).alias("n_false"),
           F.count(F.when(F.col(flag).isNull(), 1)).alias("n_null")]
    return df.groupBy(*by).agg(*agg) if by else df.agg(*agg)


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Frequency of ``col``, nulls dropped, most frequent first (ties by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), F.asc(col)))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """E5: unique values of a column (null kept once, as ``unique()`` does)."""
    return df.select(col).distinct()


def null_profile(df: DataFrame, cols=None) -> DataFrame:
    """One row per column: ``col_name``, ``nulls``, ``non_nulls``.

    One pass: a single aggregate holding two counts per column, then unpivoted.
    """
    cols = list(cols) if cols else df.columns
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"n{i}"))
        aggs.append(F.count(F.col(f"`{c}`")).alias(f"v{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(f"n{i}").alias("nulls"),
                              F.col(f"v{i}").alias("non_nulls")) for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def table_profile(df: DataFrame) -> DataFrame:
    """``info()``: column, position, type, non-null count, null count, total rows.

    The column metadata comes from the schema (driver side, no data); the counts are
    one aggregate pass (E4)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    prof = null_profile(df)
    pos = F.create_map(*[x for i, c in enumerate(df.columns) for x in (F.lit(c), F.lit(i))])
    typ = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return prof.select("col_name", pos[F.col("col_name")].alias("position"), typ[F.col("col_name")].alias("dtype"),
                       "non_nulls", "nulls", (F.col("nulls") + F.col("non_nulls")).alias("rows"))


def table_shape(df: DataFrame) -> DataFrame:
    """Row and column count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


def duplicate_report(df: DataFrame, keys, by=None, total: str | None = None) -> DataFrame:
    """Rows in and duplicates by ``keys`` per group ``by``.

    ``dups = rows - distinct keys``; a null key counts as one value (``duplicated`` treats nulls as
    equal). Wide keys are counted by their digests. Two aggregation steps (rows per group and key,
    then per group) are both combined map-side. With ``total`` the report ends with one more row for
    the whole table, in which keys are compared across groups; ``by`` then holds ``total``.
    """
    keys, by = as_list(keys), as_list(by or [])
    on = {f"_key{i}": group_key(df, k) for i, k in enumerate(keys)}
    per_key = df.select(*[quoted(c) for c in by], *[c.alias(n) for n, c in on.items()]).groupBy(
        *[quoted(c) for c in by], *on).agg(F.count(F.lit(1)).alias("_c"))
    agg = [F.sum("_c").cast("long").alias("original"),
           (F.sum("_c") - F.count(F.lit(1))).cast("long").alias("dups")]
    report = per_key.groupBy(*[quoted(c) for c in by]).agg(*agg) if by else per_key.agg(*agg)
    if total is None or not by:
        return report
    whole = per_key.groupBy(*on).agg(F.sum("_c").alias("_c")).agg(*agg)
    return report.union(whole.select(*[F.lit(total if c == by[0] else None).cast("string").alias(c) for c in by], "original", "dups"))


def verb_type_counts(df: DataFrame, id_col: str, verbs_col: str, verbs: DataFrame) -> DataFrame:
    """Documents per verb class; a document with verbs of two classes counts in both."""
    e = df.select(quoted(id_col).alias("_id"), F.explode(F.array_distinct(quoted(verbs_col))).alias("verb"))
    j = e.join(small_side(verbs.select("verb", "verb_type")), "verb")
    return (j.select("_id", "verb_type").distinct().groupBy("verb_type")
            .agg(F.count(F.lit(1)).alias("n_docs")))


def merge_report(tables: dict) -> DataFrame:
    """Per table, rows read, rows kept, duplicates and new rows.

    ``tables`` maps a name to ``(new, previous, keys)``; one aggregate per table, then
    a union of the one-row results.
    """
    from .setops import merge_counts
    parts = [merge_counts(n, p, k).select(F.lit(name).alias("table_name"), "*")
             for name, (n, p, k) in tables.items()]
    return reduce(DataFrame.unionByName, parts)
