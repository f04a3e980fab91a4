"""D1-D9 joins.

Whether a side is broadcast is a matter of bytes, not rows, and no job runs while a plan is
built: a dimension whose planned size is proven small gets the hint (``small_side``); any other join
is left to the planner and to AQE, which turns it into a broadcast or splits skewed
partitions by the sizes it sees at run time. Big tables are never collected: membership tests
are semi / anti joins, not ``isin(list)``; a substring test is an equi-join on anchors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import as_list, quoted

# Planned bytes up to which a dimension side gets the broadcast hint.
BROADCAST_MAX_BYTES = 32 << 20
# Code points of a term that are looked up among a text's grams.
ANCHOR = 4
# Code points of a text whose grams are listed at a time.
CHUNK = 4096


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; a frame of unknown origin counts as endless. No job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(dim: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``dim`` with a broadcast hint if its planned size is at most ``max_bytes``, else as it is."""
    return F.broadcast(dim) if planned_bytes(dim) <= max_bytes else dim


def _renamed(df: DataFrame, names, prefix: str) -> tuple[DataFrame, list]:
    new = [f"{prefix}{i}" for i in range(len(names))]
    return df.select(*[quoted(k).alias(n) for k, n in zip(names, new)]), new


def _match(left_keys, right_keys, null_safe: bool) -> Column:
    conds = [quoted(a).eqNullSafe(quoted(b)) if null_safe else quoted(a) == quoted(b) for a, b in zip(left_keys, right_keys)]
    return reduce(lambda a, b: a & b, conds)


def left_join(df: DataFrame, dim: DataFrame, on, how: str = "left",
              null_safe: bool = False, broadcast_dim: bool = True) -> DataFrame:
    """Equi-join keeping every row of ``df``.

    ``null_safe=True`` matches null keys with null keys (pandas ``merge``); the
    default is SQL equality.
    """
    keys = as_list(on)
    if how not in ("left", "inner", "leftouter", "left_outer"):
        return df.join(dim, keys, how)  # the key of a row may come from either side
    right = small_side(dim) if broadcast_dim else dim
    new = {k: f"_r{i}" for i, k in enumerate(keys)}
    r = right.select(*[quoted(k).alias(n) for k, n in new.items()], *[quoted(c) for c in right.columns if c not in new])
    return df.join(r, _match(keys, new.values(), null_safe), how).select(
        *[quoted(k) for k in keys], *[quoted(c) for c in df.columns if c not in new], *[quoted(c) for c in right.columns if c not in new])


def mark_join(df: DataFrame, df_col: str, values: DataFrame, values_col: str,
              flag: str = "flagged") -> DataFrame:
    """D3: ``flag = df_col IN values.values_col`` as a column, all rows kept.

    A left join on the distinct values; null ``df_col`` gives false.
    """
    v = (values.select(quoted(values_col).alias("_mark_v")).where(F.col("_mark_v").isNotNull())
         .distinct().withColumn("_mark_hit", F.lit(True)))
    out = df.join(small_side(v), quoted(df_col) == F.col("_mark_v"), "left")
    return out.withColumn(flag, F.coalesce(F.col("_mark_hit"), F.lit(False))).drop("_mark_v", "_mark_hit")


def anti_join(df: DataFrame, other: DataFrame, left_on, right_on=None, null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``.

    Default: SQL semantics, a null key never matches (row kept). ``null_safe=True``
    treats null as a member when ``other`` holds a null (pandas ``isin``).
    """
    lk = as_list(left_on)
    r, names = _renamed(other, as_list(right_on) if right_on is not None else lk, "_a")
    return df.join(r.distinct(), _match(lk, names, null_safe), "left_anti")


def semi_join(df: DataFrame, other: DataFrame, left_on, right_on=None, null_safe: bool = False,
              broadcast_other: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``other``."""
    lk = as_list(left_on)
    r, names = _renamed(other, as_list(right_on) if right_on is not None else lk, "_s")
    r = r.distinct()
    return df.join(small_side(r) if broadcast_other else r, _match(lk, names, null_safe), "left_semi")


def anti_join_tables(tables: dict, previous: dict, keys: dict, null_safe: bool = False) -> dict:
    """For each named table keep only rows whose key is absent from the previous pull."""
    return {name: anti_join(df, previous[name], keys[name], null_safe=null_safe)
            for name, df in tables.items()}


def lookup(df: DataFrame, dim: DataFrame, on: str, cols) -> DataFrame:
    """Add ``cols`` of a dimension by key, e.g. verb -> verb_type."""
    return left_join(df, dim.select(quoted(on), *[quoted(c) for c in as_list(cols)]), on)


def containment_join(df: DataFrame, list_col: str, dim: DataFrame, dim_key: str,
                     how: str = "inner") -> DataFrame:
    """Rows whose array ``list_col`` contains ``dim_key``; one output row per match.

    Written as explode + equi-join (hash lookup), not a nested-loop
    ``array_contains`` predicate. Repeats inside one list count once.
    """
    e = df.withColumn(dim_key, F.explode(F.array_distinct(quoted(list_col))))
    return left_join(e, dim, dim_key, how)


def _text_anchors(texts: DataFrame, text: str) -> DataFrame:
    """Distinct (``_id``, ``_gram``): every run of 1 to ``ANCHOR`` code points of each text, and the empty one.

    Texts are read in chunks that overlap by ``ANCHOR - 1`` code points, so a very long text is listed bit by bit."""
    chunks = F.regexp_extract_all(quoted(text), F.lit(f"(?s)(?=(.{{1,{CHUNK + ANCHOR - 1}}})).{{1,{CHUNK}}}"), 1)
    pieces = texts.select("_id", F.explode(F.concat(F.array(F.lit("")), chunks)).alias("_chunk"))
    grams = F.concat(F.array(F.lit("")), *[F.regexp_extract_all("_chunk", F.lit(f"(?s)(?=(.{{{n}}}))"), 1) for n in range(1, ANCHOR + 1)])
    return pieces.select("_id", F.explode(F.array_distinct(grams)).alias("_gram"))


def substring_join(df: DataFrame, text_col: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Theta join ``text_col`` contains ``dim_key``, every row of ``df`` kept; a dimension of any size.

    A term's first ``ANCHOR`` code points (all of it if shorter) are its anchor. Texts list their grams, which
    meet the anchors in an equi-join; the candidates, (text digest, term) pairs, go back to the rows by
    an equi-join on the digest, which confirms ``contains``. Equal texts are listed once; a null text or
    term matches nothing, an empty term matches every text.
    """
    digest = F.unhex(F.sha2(quoted(text_col), 256))
    texts = df.select(digest.alias("_id"), quoted(text_col).alias("_listed")).where("_id is not null")
    terms = dim.select(quoted(dim_key).alias("_term"), F.substring(quoted(dim_key), 1, ANCHOR).alias("_anchor")).where("_term is not null").distinct()
    found = (_text_anchors(texts, "_listed").join(small_side(terms), F.col("_gram") == F.col("_anchor"))
             .select("_id", "_term").distinct())
    rows = df.withColumn("_text_id", digest)
    hits = rows.join(found, (F.col("_text_id") == F.col("_id")) & F.contains(quoted(text_col), F.col("_term")), "left")
    return hits.join(small_side(dim), F.col("_term") == quoted(dim_key), "left").drop("_id", "_term", "_text_id")
