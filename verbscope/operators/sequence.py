"""F5-F7 sequence operators: row index, near-equal batches, greedy page batches.

No rows meet in one window without ``partitionBy`` (that would move every row to
one task). The row index partitions by range into a table in the shared folder with each row's place in
its partition, and adds the running offset of the partitions before.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_and_reread
from .names import as_list, quoted

def _indexed(df: DataFrame, order, name: str):
    """Range-sort by ``order`` and add a 0-based global index ``name`` and ``_n_total``.

    ``order`` must be unique (add a key as the last column) so that a re-run of a
    task after an executor loss sorts the same way. Rows are shuffled and written once: a row's place in its
    sorted partition goes into the written table, and what lies before a partition is one number for
    each, broadcast to the rows (as many numbers as there are partitions).
    """
    keys = [quoted(c) for c in as_list(order)]
    parts = write_and_reread(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                             .withColumn("_i", F.monotonically_increasing_id()), "row-index")
    counts = parts.groupBy(F.shiftright("_i", 33).alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_i").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)) - F.col("_first"))
               .withColumn("_n_total", F.sum("_cnt").over(Window.partitionBy(F.lit(0))))
               .select("_pid", "_off", "_n_total"))
    out = parts.join(F.broadcast(offsets), F.shiftright("_i", 33) == F.col("_pid"))
    return out.withColumn(name, F.col("_i") + F.col("_off")).drop("_pid", "_i", "_off")


def with_row_index(df: DataFrame, order, name: str = "row_index", start: int = 0) -> DataFrame:
    """consecutive index in ``order``, starting at ``start`` (B7 uses start > 0)."""
    out = _indexed(df, order, name).drop("_n_total")
    if start:
        out = out.withColumn(name, F.col(name) + F.lit(start))
    return out


def with_batch_id(df: DataFrame, order, batch_size: int | None = None, n_batches: int | None = None,
                  name: str = "batch") -> DataFrame:
    """``k = ceil(n / batch_size)`` (or ``n_batches``) near-equal batches, 0-based.

    The first ``n mod k`` batches hold one row more (``numpy.array_split`` sizes).
    """
    if (batch_size is None) == (n_batches is None):
        raise ValueError("give exactly one of batch_size, n_batches")
    x = _indexed(df, order, "_idx")
    n = F.col("_n_total")
    k = F.ceil(n / F.lit(batch_size)) if batch_size is not None else F.least(F.lit(n_batches), n)
    k = F.greatest(k, F.lit(1)).cast("long")
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    idx = F.col("_idx")
    batch = F.when(idx < big, F.floor(idx / (q + 1))).otherwise(r + F.floor((idx - big) / q))
    return x.withColumn(name, batch.cast("long")).drop("_idx", "_n_total")


# ---------------------------------------------------------------------------
# F7 greedy page batches
# ---------------------------------------------------------------------------
# Stands for a null page number inside the folds.
NULL_PAGE = 2 ** 63 - 1


class _Fill:
    """Greedy fill of one topic's pages. From a known start it numbers pages; from an unknown one it keeps, for
    each start ``0 .. batch_size-1`` (no open batch holds more), where the fill would stand and how many batches
    it would have closed."""

    def __init__(self, batch_size: int, start: int | None, closed: int = 0):
        self.size, self.known = batch_size, start is not None
        self.state = start if self.known else np.arange(batch_size, dtype=np.int64)
        self.closed = closed if self.known else np.zeros(batch_size, dtype=np.int64)

    def add(self, n_rows) -> np.ndarray | None:
        """Batch numbers (1-based) of the next pages, or None from an unknown start."""
        if not self.known:
            for n in n_rows.tolist():
                self.state += n
                full = self.state >= self.size
                self.closed += full
                self.state[full] = 0
            return None
        out = np.empty(len(n_rows), dtype=np.int64)
        for k, n in enumerate(n_rows.tolist()):
            out[k] = self.closed + 1
            self.state += n
            if self.state >= self.size:
                self.closed, self.state = self.closed + 1, 0
        return out

    def left(self) -> tuple[list, list]:
        return np.atleast_1d(self.state).tolist(), np.atleast_1d(self.closed).tolist()


def _runs(keys) -> list[tuple[int, int]]:
    """Start and end of runs of equal consecutive keys."""
    keys = np.asarray(keys, dtype=object)
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else [0, 0]
    return [(a, e) for a, e in zip(cuts, cuts[1:]) if e > a]


def page_batches(pages: DataFrame, topic: str, page: str, rows: str, batch_size: int,
                 num_batches: int | None = None, partitions: int | None = None) -> DataFrame:
    """per topic, add pages in page order until the batch holds >= ``batch_size``
    rows, then start a new batch; keep at most ``num_batches`` batches (1-based ``batch``).

    The fill is sequential within a topic, but no topic has to lie in one task, and pages are read once. They are
    range-partitioned by (topic, page), so a task has a stretch of pages in order, cut by position whatever the
    page numbers, and streams it:

    1. a topic that begins in the task's stretch starts from nothing and is numbered at once. Only the first
       one may have begun in an earlier task: its pages wait, and what its stretch does to every
       possible start is tabulated. Pages and tables (two per task at most) are written;
    2. the tables of a topic are chained in order: one small row per task and topic that reaches over;
    3. the pages that wait are numbered from their start, again in parallel.

    A null topic is a topic, a null page comes last, a null row count is 0; equal pages go by their row count.
    """
    b = int(batch_size)
    t = quoted(topic)
    p = pages.select(F.when(t.isNull(), "null").otherwise(F.concat(F.lit("="), t.cast("string"))).alias("topic"),
                     F.coalesce(quoted(page).cast("long"), F.lit(NULL_PAGE)).alias("page"),
                     F.coalesce(quoted(rows).cast("long"), F.lit(0)).alias("n"))
    order = ["topic", "page", "n"]
    ranged = p.repartitionByRange(partitions, *order) if partitions else p.repartitionByRange(*order)
    schema = "topic string, page long, n long, batch long, part int, pos long, ends array<long>, closes array<long>"
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def number(batches):
        from pyspark import TaskContext
        part, now, fill, pos = TaskContext.get().partitionId(), None, None, 0
        for pdf in batches:
            topics, n = pdf["topic"].to_numpy(), pdf["n"].to_numpy(dtype=np.int64)
            numbers = pd.array([pd.NA] * len(pdf), dtype="Int64")
            for a, e in _runs(topics):
                if topics[a] != now:
                    if fill is not None and not fill.known:
                        yield table(now, part, fill)
                    fill = _Fill(b, None if now is None else 0)
                    now = topics[a]
                if (found := fill.add(n[a:e])) is not None:
                    numbers[a:e] = found
            yield pd.DataFrame({"topic": topics, "page": pdf["page"], "n": n, "batch": numbers, "part": part,
                                "pos": np.arange(pos, pos + len(pdf)), "ends": None, "closes": None})[names]
            pos += len(pdf)
        if fill is not None:
            yield table(now, part, fill)

    def table(now, part, fill):
        ends, closes = fill.left()
        return pd.DataFrame([(now, None, None, None, part, None, ends, closes)], columns=names).astype(
            {"page": "Int64", "n": "Int64", "batch": "Int64", "pos": "Int64"})

    made = write_and_reread(ranged.sortWithinPartitions(*order).mapInPandas(number, schema), "page-batches")

    def chain(batches):
        now, state, closed = None, 0, 0
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                if row.topic != now:
                    now, state, closed = row.topic, 0, 0
                if len(row.ends) == 1 and b > 1:  # the topic begins in this part
                    state, closed = int(row.ends[0]), int(row.closes[0])
                else:
                    out.append((row.topic, row.part, state, closed))
                    state, closed = int(row.ends[state]), closed + int(row.closes[state])
            yield pd.DataFrame(out, columns=["topic", "part", "state", "closed"])

    tables = made.where("ends is not null").select("topic", "part", "ends", "closes")
    starts = (tables.repartition("topic").sortWithinPartitions("topic", "part")
              .mapInPandas(chain, "topic string, part int, state long, closed long"))

    def renumber(batches):
        now, fill = None, None
        for pdf in batches:
            numbers = np.empty(len(pdf), dtype=np.int64)
            parts, n = pdf["part"].to_numpy(), pdf["n"].to_numpy(dtype=np.int64)
            for a, e in _runs(parts):
                if parts[a] != now:
                    now, fill = parts[a], _Fill(b, int(pdf["state"].iloc[a]), int(pdf["closed"].iloc[a]))
                numbers[a:e] = fill.add(n[a:e])
            yield pd.DataFrame({"topic": pdf["topic"], "page": pdf["page"], "n": n, "batch": numbers})

    numbered = made.where("ends is null and batch is not null").select("topic", "page", "n", "batch")
    waiting = (made.where("ends is null and batch is null").select("topic", "page", "n", "part", "pos").join(starts, ["topic", "part"])
               .repartition("part").sortWithinPartitions("part", "pos").mapInPandas(renumber, "topic string, page long, n long, batch long"))
    res = numbered.union(waiting)
    if num_batches is not None:
        res = res.where(F.col("batch") <= F.lit(num_batches))
    named = F.when(F.col("topic") != "null", F.substr("topic", F.lit(2))).cast(pages.schema[topic].dataType)
    return res.select(named.alias(topic), F.nullif("page", F.lit(NULL_PAGE)).alias(page), F.col("n").alias(rows), "batch")
