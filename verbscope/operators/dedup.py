"""F1 / F2: keep the first row per key.

"First" needs an explicit order (pandas' file order has no Spark counterpart). Wide keys are
grouped by a 256-bit digest, so neither the shuffle nor any sort compares texts. The first row is
``row_number() = 1`` per digest: Spark keeps one row per key and map task before the shuffle
(a window group limit), so a key that holds a third of the rows costs one row per task on the
wire, and nothing but the winners is shuffled. Nulls in key columns compare equal (as
``DataFrame.duplicated`` does). Columns of any type may be carried, maps included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .names import as_list, group_key, quoted, row_hash


def dedup_first(df: DataFrame, keys, order) -> DataFrame:
    """one row per ``keys``, the smallest by ``order`` (nulls first; ties broken by a hash of
    the row, so a tie falls the same way on every run)."""
    keys, order = as_list(keys), as_list(order)
    names = {f"_key{i}": group_key(df, k) for i, k in enumerate(keys)}
    ranked = df.withColumns({**names, "_tie": row_hash(df)})
    w = Window.partitionBy(*names).orderBy(*[quoted(c) for c in order], "_tie")
    return ranked.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop(*names, "_tie", "_rank")


def dedup_first_per_folder(df: DataFrame, folder: str, keys, order,
                           cleaned: DataFrame | None = None) -> DataFrame:
    """F1 scoped to a folder; folders listed in ``cleaned`` (column ``folder``) are skipped."""
    keys = as_list(keys)
    if cleaned is not None:
        done = cleaned.select(quoted(cleaned.columns[0]).alias("_done")).distinct()
        df = df.join(done, quoted(folder) == F.col("_done"), "left_anti")
    return dedup_first(df, [folder] + [k for k in keys if k != folder], order)
