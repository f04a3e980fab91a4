"""A6-A9, A10-A11 sinks. Spark owns part-file names; directories carry the meaning
(``partitionBy``), so a later read prunes partitions by verb, type or batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import left_join
from ..operators.names import quoted
from ..operators.sequence import with_batch_id
from .readers import CSV_SEP


def _writer(df: DataFrame, mode: str):
    return df.write.mode(mode)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                sep: str = CSV_SEP) -> None:
    """One table; Parquet by default, ``~``-separated text with a header on request.

    Struct / array columns are written as text for the delimited form."""
    if fmt == "csv":
        out = df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                          if f.dataType.typeName() in ("struct", "array", "map") else F.col(f.name)
                          for f in df.schema.fields])
        _writer(out, mode).option("sep", sep).option("header", True).option("escape", '"').csv(path)
    else:
        _writer(df, mode).format(fmt).save(path)


def write_batched(df: DataFrame, path: str, order, batch_size: int, fmt: str = "parquet",
                  mode: str = "overwrite") -> None:
    """``ceil(n / batch_size)`` near-equal batches, one directory ``batch=k`` each."""
    b = with_batch_id(df, order, batch_size=batch_size)
    writer = _writer(b.repartition("batch"), mode).partitionBy("batch")
    if fmt == "csv":
        writer.option("sep", CSV_SEP).option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_by_type(tables: dict, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One directory per data type (``data_type=tweets`` ...)."""
    for name, df in tables.items():
        write_table(df, f"{path}/data_type={name}", fmt=fmt, mode=mode)


def by_verb_rows(df: DataFrame, verbs_col: str, verbs: DataFrame) -> DataFrame:
    """A9 rows: a row repeated once per verb of its ``verbs`` list (text ``"a, b"`` or
    array) that is in the dimension, with the verb's ``verb_type``."""
    lst = F.split(quoted(verbs_col), ", ") if df.schema[verbs_col].dataType.typeName() == "string" \
        else quoted(verbs_col)
    e = df.withColumn("verb", F.explode(F.array_distinct(lst)))
    dim = verbs.select("verb", F.lower("verb_type").alias("verb_type"))
    return left_join(e, dim, "verb", how="inner")


def write_by_verb(df: DataFrame, verbs_col: str, verbs: DataFrame, path: str, fmt: str = "parquet",
                  mode: str = "overwrite") -> None:
    """Write every row under ``verb_type=<t>/verb=<v>`` for each of its verbs.

    ``REBALANCE`` on (type, verb): a verb's rows meet in as few writers as their bytes call for. AQE
    splits the partition of a frequent verb over as many tasks as it needs and puts rare verbs
    together, by the sizes of the shuffle; no number of writers is fixed.
    """
    rows = by_verb_rows(df, verbs_col, verbs).hint("rebalance", "verb_type", "verb")
    writer = _writer(rows, mode).partitionBy("verb_type", "verb")
    if fmt == "csv":
        writer.option("sep", CSV_SEP).option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_ids(ids: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A10 (write side): registry as Parquet, one ``id`` column."""
    ids.select(F.col(ids.columns[0]).cast("string").alias("id")).write.mode(mode).parquet(path)


def write_pages(pages: DataFrame, path: str, mode: str = "append") -> None:
    """A11 (write side): raw responses as JSON lines."""
    pages.write.mode(mode).json(path)
