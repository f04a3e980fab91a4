"""Helpers shared by the operators of this subpackage: intermediate tables in the
cluster's shared folder, and dense numbering without one global sort."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What counts as white space between words: ``[\x20\x09-\x0D]``.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session (tests) may leave it unset; it then gets a scratch folder.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="verbscope-llm-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


class Tables:
    """Staged tables that belong together, so that they can be deleted together."""

    def __init__(self):
        self.paths: list[str] = []

    def release(self, spark: SparkSession) -> None:
        """Delete the tables. Frames that read them can't be computed any more."""
        for path in self.paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.paths.clear()


_OWNER: ContextVar[Tables | None] = ContextVar("owner", default=None)


@contextmanager
def owned() -> Iterator[Tables]:
    """Tables staged inside belong to the object given; all others stay until their folder is cleared."""
    tables = Tables()
    token = _OWNER.set(tables)
    try:
        yield tables
    finally:
        _OWNER.reset(token)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts the
    lineage, fixes the rows (row ids, sampled bounds) and survives lost executors."""
    path = new_folder(df.sparkSession, name)
    if (owner := _OWNER.get()) is not None:
        owner.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends inside are deleted at its end, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def whole_texts(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches small: a batch holds whole texts, and the default of 10,000 rows may
    be hundreds of megabytes in an executor's Python workers and its own buffers."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names equal one of ``names`` in any letter case, so that an
    operator's own output columns never clash with extra input columns."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> Column:
    """Column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character as it is. ``lower`` is the fast path where the
    string is ASCII throughout; ``translate`` is right but slower."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality on equally named columns of two frames."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left["`" + n + "`"].eqNullSafe(right["`" + n + "`"])
    return cond


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on equally named columns, null equal to null; the result has them once. The
    frames may descend from one another."""
    renamed = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & quoted(k).eqNullSafe(quoted(f"_same_{k}"))
    return left.join(renamed, cond, how).drop(*[f"_same_{k}" for k in keys])


def numbered(df: DataFrame, groups: list[str], order: list[str], out: str,
             rows_per_bucket: int = 200_000) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... within each group, gapless, in an order fixed by the data.

    ``df`` should be a staged table: it is read twice. Rows go to hash buckets of their
    ``order`` columns; rows are counted per (group, bucket), the counts are summed up to
    offsets, and ``row_number`` runs inside each (group, bucket) only, so no task sorts a
    whole group. ``order`` should tell rows apart; rows equal in it are interchangeable.
    """
    buckets = max(16, df.count() // rows_per_bucket)
    df = df.withColumn("_b", F.pmod(F.xxhash64(*[quoted(c) for c in order]), F.lit(buckets)).cast("int"))
    keys = [*groups, "_b"]
    w = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = (df.groupBy(*keys).agg(F.count("*").alias("_n"))
               .select(*keys, (F.sum("_n").over(w) - F.col("_n")).alias("_before")))
    inner = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_r", F.row_number().over(inner))
    joined = ranked.join(offsets, same(ranked, offsets, *keys), "left")
    return joined.select(*[ranked[f"`{c}`"] for c in df.columns if c != "_b"],
                         (F.col("_before") + F.col("_r") - 1).alias(out))
