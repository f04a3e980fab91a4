"""H1-H7 set operations and the incremental merge of successive pulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_first
from .joins import anti_join
from .names import as_list, group_key, quoted


def append(*frames: DataFrame) -> DataFrame:
    """H1: union all by name; a column missing on one side becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append_pages(pages: list, tables=None) -> dict:
    """H2: table-wise append of several exploded pages (dicts of frames), every table
    that a page has unless ``tables`` names some.

    ``meta`` keeps only the row of the latest page (largest ``page``).
    """
    out = {}
    for name in tables or dict.fromkeys(n for p in pages for n in p):
        parts = [p[name] for p in pages if name in p]
        if not parts:
            continue
        merged = append(*parts)
        if name == "meta" and "page" in merged.columns:
            latest = merged.agg(F.max_by(F.struct(*[quoted(c) for c in merged.columns]), F.col("page")).alias("_m"))
            merged = latest.select("_m.*")
        out[name] = merged
    return out


def id_union(existing: DataFrame, new: DataFrame) -> DataFrame:
    """H3: existing ids united with new ids (distinct)."""
    return existing.select(quoted(existing.columns[0]).alias("id")).union(
        new.select(quoted(new.columns[0]).alias("id"))).distinct()


def id_intersect(existing: DataFrame, new: DataFrame) -> DataFrame:
    """H4: ids already seen."""
    return existing.select(quoted(existing.columns[0]).alias("id")).intersect(
        new.select(quoted(new.columns[0]).alias("id")))


def id_difference(new: DataFrame, existing: DataFrame) -> DataFrame:
    """H5: ids not seen before (distinct)."""
    n = new.select(quoted(new.columns[0]).alias("id"))
    e = existing.select(quoted(existing.columns[0]).alias("id"))
    return anti_join(n, e, "id").distinct()


def split_by_flag(df: DataFrame, flag: str):
    """(rows where flag is true, rows where it is false); null flags go to neither."""
    return df.where(quoted(flag)), df.where(~quoted(flag))


def merge_pull(new: DataFrame, previous: DataFrame, keys, order) -> DataFrame:
    """H6: union(new, previous) -> keep the first row per key, new rows winning ->
    ``is_new`` is true for keys absent from the previous pull.

    The winners come from F1 with the pull as first order column; the previous pull's distinct keys,
    as digests, are joined to them on the partitioning that F1 leaves behind.
    """
    keys, order, cols = as_list(keys), as_list(order), new.columns
    both = append(new.withColumn("_src", F.lit(0)), previous.withColumn("_src", F.lit(1)))
    first = dedup_first(both, keys, ["_src", *order])
    on = [f"_key{i}" for i in range(len(keys))]
    first = first.withColumns({n: group_key(first, k) for n, k in zip(on, keys)})
    seen = both.where("_src = 1").select(*[group_key(both, k).alias(f"_prev{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_prev{i}")) for i, n in enumerate(on)])
    joined = first.join(seen.withColumn("_seen", F.lit(True)), same, "left")
    return joined.select(*[quoted(c) for c in cols], F.col("_seen").isNull().alias("is_new"))


def merge_counts(new: DataFrame, previous: DataFrame, keys) -> DataFrame:
    """E8 for one table: rows read (new + previous), rows kept (one per key),
    duplicates, and kept keys that are new (absent from the previous pull)."""
    keys = as_list(keys)

    def narrow(df: DataFrame, src: int) -> DataFrame:
        return df.select(*[group_key(df, k).alias(f"_key{i}") for i, k in enumerate(keys)], F.lit(src).alias("_src"))

    u = narrow(new, 0).union(narrow(previous, 1))
    per_key = u.groupBy(*[f"_key{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("_rows"), F.max("_src").alias("_maxsrc"),
                                   F.min("_src").alias("_minsrc"))
    return per_key.agg(F.sum("_rows").cast("long").alias("rows"),
                       F.count(F.lit(1)).alias("kept"),
                       (F.sum("_rows") - F.count(F.lit(1))).cast("long").alias("dups"),
                       F.count(F.when(F.col("_maxsrc") == 0, 1)).alias("new"))


def merge_tables(frames: dict, keys: dict, order: dict) -> dict:
    """H7: combine all folders of a pull (already unioned per table) and keep the
    first row per key in each table."""
    return {name: dedup_first(df, keys[name], order[name]) for name, df in frames.items()}


def merge_tables_report(tables: dict, copies: int = 2) -> DataFrame:
    """H7 on ``copies`` folder copies of each table: rows read and rows kept per table.

    ``tables`` maps name -> (frame, key, order).
    """
    parts = []
    for name, (df, key, order) in tables.items():
        folders = append(*[df.withColumn("_folder", F.lit(i)) for i in range(copies)])
        # dedup_first keeps exactly one row per key, so rows kept = keys; rows read and
        # keys both come from one partial aggregate per key (no row is shuffled whole)
        per_key = folders.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(per_key.agg(F.sum("_n").cast("long").alias("rows"), F.count(F.lit(1)).alias("kept"))
                     .select(F.lit(name).alias("table_name"), "rows", "kept"))
    return reduce(DataFrame.unionByName, parts)
