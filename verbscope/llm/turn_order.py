"""Rows of a group in order: their positions, and digests of what they say, streamed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbscope.llm.common import join_same, quoted, staged


def with_position(df: DataFrame, group: str, order: list[str], out: str = "at") -> DataFrame:
    """Add ``out``: 0, 1, 2, ... within each group by ``order`` (nulls first).

    Rows are range-partitioned and sorted by group and order, so a group may lie in several parts.
    A row's place in its part comes with the written table; counts per (group, part), one narrow
    row each, give what lies before. ``df`` should be narrow: it is shuffled once and written.
    """
    keys = [quoted(group), *[quoted(c) for c in order]]
    placed = staged(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("_i", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("_part", F.shiftright("_i", 33))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = placed.groupBy(group, "_part").agg(F.min("_i").alias("_first"), F.count("*").alias("_n"))
    parts = parts.select(group, "_part", (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"))
    joined = join_same(placed, parts, [group, "_part"])
    return joined.select(*[quoted(c) for c in df.columns], (F.col("_i") + F.col("_shift")).alias(out))


def ordered_sha256(df: DataFrame, group: str, order: str, value: str, out: str, between: str) -> DataFrame:
    """group, ``out``: SHA-256 (lowercase hex) of the group's ``value`` strings by ``order`` (null first),
    joined by ``between``; a null value counts as empty. Values are streamed, none are gathered; a digest runs
    over its parts in order, so one group's is the work of one task."""
    kind = df.schema[group].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done, sep, key_type = None, None, [], between.encode(), None

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], key_type), pa.array([h for _, h in done], pa.string())],
                                              names=[group, out])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, said in zip(*batch.columns, strict=True):
                key, part = key.as_py(), (said.as_py() or "").encode()
                if state is None or key != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(part)
                else:
                    state.update(sep + part)
            if done:
                yield made()
                done = []
        if state is not None:
            done.append((now, state.hexdigest()))
            yield made()

    schema = T.StructType([T.StructField(group, kind), T.StructField(out, T.StringType())])
    rows = df.repartition(group).sortWithinPartitions(group, order).select(quoted(group), quoted(value).cast("string"))
    return rows.mapInArrow(read, schema)
