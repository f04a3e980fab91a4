"""Corpus pipeline: quality rules, exact and near deduplication, source mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame. A stage works on all rows its predecessor kept, and its decisions take effect:
all but the last return the columns of ``documents``; the last returns packed pieces. Each stage's
result is to be written before the next stage begins, as ``run`` does: the tables that a stage has
staged belong to that call, and the call of the next stage deletes them. No other table is deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verbscope.llm.common import Tables, owned, staged, whole_texts
from verbscope.llm.exact_dup import drop_duplicates
from verbscope.llm.mixing import mix
from verbscope.llm.near_dup import NearDup, drop_near_duplicates
from verbscope.llm.packing import pack
from verbscope.llm.quality_bands import with_quality

#: Tables of the latest call of a stage, until its successor is called.
_BEHIND: dict[str, Tables] = {}


def stage(after: str | None = None) -> Callable:
    """Arrow batches fit for whole texts; the tables of the stage before, whose result is written by
    now, are given back, and this call's own ones are kept together."""

    def wrap(function: Callable) -> Callable:
        def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            whole_texts(spark)
            if after in _BEHIND:
                _BEHIND.pop(after).release(spark)
            with owned() as tables:
                result = function(spark, docs, sf_dir)
            if function.__name__ != "packing":  # nothing comes after it: its result goes on reading its tables
                _BEHIND[function.__name__] = tables
            return result

        call.__name__, call.__doc__ = function.__name__, function.__doc__
        return call

    return wrap


@stage()
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Compression bands and base rules; rejected documents go."""
    return with_quality(docs).where("kept").select(*docs.columns)


@stage(after="quality")
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return drop_duplicates(docs)


@stage(after="exact_dedup")
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: the smallest doc_id of each group stays."""
    return drop_near_duplicates(docs, p=NearDup(words=5, percent=80))


@stage(after="near_dedup")
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weights 5, 2, 1; a document comes out as often as the mix takes it."""
    return mix(docs)


@stage(after="mixing")
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, packed into sequences."""
    return pack(docs, max_tokens=2048)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
          ("packing", packing)]

#: The last stage's token ids can't be had in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), Tables()
    for name, function in STAGES[:-1]:
        result = function(spark, docs, sf_dir)
        with owned() as written:
            docs = staged(result, name)
        read.release(spark)  # the result before this one has been read for the last time
        read = written
    return STAGES[-1][1](spark, docs, sf_dir)
