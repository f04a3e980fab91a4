"""K1-K5 state kept between runs, in batch form and as Structured Streaming queries.

Nothing here collects ids on the driver: the registry is a table, membership is an
anti / semi join, and a new registry version is written as a new directory (the
old one stays readable until the new one is complete).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.joins import anti_join
from ..operators.names import quoted
from ..operators.setops import id_union


# ---------------------------------------------------------------------------
# K1 registry
# ---------------------------------------------------------------------------
def update_registry(df: DataFrame, id_col: str, registry: DataFrame, null_safe: bool = False):
    """K1: drop rows whose id is registered; new registry = registry ∪ ids of ``df``.

    Ids are compared as strings (the reference's ids are unsigned 64-bit). Returns
    ``(kept_rows, new_registry)``; both lazy.
    """
    reg = registry.select(F.col(registry.columns[0]).cast("string").alias("_rid"))
    keyed = df.withColumn("_id_s", F.col(id_col).cast("string"))
    kept = anti_join(keyed, reg, "_id_s", "_rid", null_safe=null_safe).drop("_id_s")
    new_reg = id_union(reg.select(F.col("_rid").alias("id")),
                       df.select(F.col(id_col).cast("string").alias("id")))
    return kept, new_reg


#: Folders that a part of the registry is split into, by a hash of the id.
REGISTRY_BUCKETS = 256


def id_bucket(id_col) -> Column:
    """The bucket of an id (as text)."""
    return F.pmod(F.xxhash64(id_col), F.lit(REGISTRY_BUCKETS)).cast("int")


def registry_version_path(root: str, version: int) -> str:
    return f"{root}/v={version:06d}"


def write_part(ids: DataFrame, path: str) -> str:
    """Write ids (``id string``) as a part of a registry: one folder per bucket, one task per bucket."""
    bucketed = ids.select("id").withColumn("bucket", id_bucket("id"))
    bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    return path


def commit_registry(registry: DataFrame, root: str, version: int) -> str:
    """Write ids as part ``version`` of the registry at ``root``; it counts from when Spark
    has written its ``_SUCCESS``."""
    ids = registry.select(quoted(registry.columns[0]).cast("string").alias("id")).where("id is not null").distinct()
    return write_part(ids, registry_version_path(root, version))


def registry_parts(spark, root: str) -> list[str]:
    """Complete parts of the registry at ``root``: folders that hold ``_SUCCESS``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().getParent().toString() for f in found or [])


def read_registry(spark, root: str, leave_out: str | None = None, buckets: list[int] | None = None) -> DataFrame:
    """Registered ids: the union of the complete parts (``leave_out``: a part's folder name), of all buckets or
    those given; other buckets' folders are not read."""
    parts = [p for p in registry_parts(spark, root) if p.rsplit("/", 1)[-1] != leave_out]
    if not parts:
        return spark.createDataFrame([], "id string")
    ids = reduce(DataFrame.union, [spark.read.schema("id string, bucket int").parquet(p) for p in parts])
    if buckets is not None:
        ids = ids.where(F.col("bucket").isin(buckets))
    return ids.select("id").distinct()


def compact_registry(spark, root: str) -> str | None:
    """Put the parts of a registry together into one and delete them; the new part's folder, or None if fewer
    than two can be put together.

    The newest part of each run stays as it is: its micro-batch may be repeated and must then find its own
    ids absent. An interrupted compaction loses nothing: the new part counts once it is complete, and ids that
    two parts hold are one id.
    """
    newest: dict[str, str] = {}
    parts = registry_parts(spark, root)
    for p in parts:
        if (run := p.rsplit("/", 1)[-1]).startswith("run="):
            newest[run.rsplit("-", 1)[0]] = p  # sorted: the last one wins
    old = [p for p in parts if p not in newest.values()]
    if len(old) < 2:
        return None
    ids = reduce(DataFrame.union, [spark.read.schema("id string, bucket int").parquet(p) for p in old]).select("id").distinct()
    made = write_part(ids, f"{root}/c={uuid.uuid4().hex}")
    for p in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return made


def registry_sink(id_col: str, registry_root: str, out_path: str, run: str, registry: DataFrame | None = None):
    """K1 streaming form: a ``foreachBatch`` function. Each micro-batch drops registered ids,
    writes the kept rows, and adds its new ids as a part of the registry.

    Registered are the complete parts at ``registry_root`` and the ids of ``registry``, if
    given. ``run`` names this query's parts: keep it with the query's checkpoint and choose a new
    one for a new checkpoint. A retried batch leaves its own part out and rewrites it, and no
    part of another run is ever touched. Parts hold new ids only, so a batch writes no more
    than it brings, and lie in buckets by id, so it reads the buckets of its own ids only.
    Call ``compact_registry`` now and then, between micro-batches, to keep parts few."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"run={run}-{batch_id:06d}"
        own = batch.select(id_bucket(quoted(id_col).cast("string")).alias("b")).distinct()
        needed = sorted(r["b"] for r in own.collect())  # REGISTRY_BUCKETS numbers at most
        known = read_registry(spark, registry_root, leave_out=part, buckets=needed)
        if registry is not None:
            known = id_union(known, registry.select(quoted(registry.columns[0]).cast("string").alias("id")))
        kept, _ = update_registry(batch, id_col, known)
        # per run and batch: a retried batch overwrites its own folder
        kept.write.mode("overwrite").parquet(f"{out_path}/run={run}/batch_id={batch_id}")
        new = spark.read.schema(kept.schema).parquet(f"{out_path}/run={run}/batch_id={batch_id}")
        write_part(new.select(quoted(id_col).cast("string").alias("id")).where("id is not null").distinct(), f"{registry_root}/{part}")
    return fn


# ---------------------------------------------------------------------------
# K2 registry duplicates across files
# ---------------------------------------------------------------------------
def registry_duplicates(rows: DataFrame, file_col: str, id_col: str, registry: DataFrame) -> DataFrame:
    """K2: per id of the folder: ``seen`` (in the registry), ``n_files`` (number of
    files holding it) and ``dup`` = seen or in two or more files. Repeats inside one
    file do not count (as in the reference)."""
    per = (rows.select(F.col(file_col).alias("_f"), F.col(id_col).cast("string").alias("id"))
           .where(F.col("id").isNotNull()).distinct()
           .groupBy("id").agg(F.count(F.lit(1)).alias("n_files")))
    reg = (registry.select(F.col(registry.columns[0]).cast("string").alias("id")).distinct()
           .withColumn("seen", F.lit(True)))
    out = per.join(reg, "id", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
    return out.select("id", "seen", "n_files", (F.col("seen") | (F.col("n_files") > 1)).alias("dup"))


# ---------------------------------------------------------------------------
# K3 streaming page batches
# ---------------------------------------------------------------------------
def _fill(pages, batch: int, fill: int, batch_size: int, num_batches: int | None):
    """Greedy fill over (page, rows) in order: the (page, batch) that are kept, and the state left."""
    out = []
    for page, n in pages:
        if num_batches is None or batch <= num_batches:
            out.append((page, batch))
        fill += n
        if fill >= batch_size:
            batch, fill = batch + 1, 0
    return out, batch, fill


def _in_page_order(pages):
    """Pages by number, a page without one last (as in F7)."""
    return sorted(pages, key=lambda p: (p[0] is None, p[0] or 0))


class _PageBatches(StatefulProcessor):
    """Per topic: the open batch and its rows, and the pages that wait for the watermark to pass them."""

    def __init__(self, topic: str, page: str, rows: str, time: str, batch_size: int, num_batches: int | None):
        self.names = (topic, page, rows, time)
        self.batch_size, self.num_batches = batch_size, num_batches

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "batch long, fill long")
        self.waiting = handle.getListState("waiting", "at long, page long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        _, page, n, time = self.names
        now = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            at = pdf[time].astype("datetime64[ms]").astype("int64")
            new = [(int(t), None if pd.isna(p) else int(p), 0 if pd.isna(x) else int(x))
                   for t, p, x in zip(at, pdf[page].astype(object), pdf[n].astype(object))]
            self.waiting.appendList(new)
            # Spark has dropped rows behind the watermark already; a timer must lie ahead of it
            for t in {max(t, now + 1) for t, _, _ in new}:
                self.handle.registerTimer(t)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        topic, page, _, _ = self.names
        due, held = [], []
        for at, p, n in self.waiting.get():
            (due if at <= expiredTimerInfo.getExpiryTimeInMs() else held).append((at, p, n))
        if not due:
            return
        batch, fill = self.open.get() if self.open.exists() else (1, 0)
        out, batch, fill = _fill(_in_page_order([(p, n) for _, p, n in due]), batch, fill, self.batch_size, self.num_batches)
        self.open.update((batch, fill))
        if held:
            self.waiting.put(held)
        else:
            self.waiting.clear()
        if out:
            yield pd.DataFrame({topic: [key[0]] * len(out), page: pd.array([p for p, _ in out], "Int64"), "batch": [b for _, b in out]})

    def close(self) -> None:
        pass


def stream_page_batches(pages: DataFrame, topic: str, page: str, rows: str, batch_size: int,
                        num_batches: int | None = None, event_time: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """K3: the greedy batch fill of F7 over a stream of pages, keyed by topic. Output: topic, page, batch.

    With ``event_time`` (when a page was made; later pages of a topic are not earlier), pages wait in state until the
    watermark, ``delay`` behind the newest page of the stream, has passed them, and are then taken in page
    order: whatever order pages arrive in, the batches are those of F7 as long as none is late by
    more than ``delay`` (later ones are dropped as late data, which Spark counts). Waiting pages are bounded by
    the delay. Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).

    Without it, arrival decides: pages are in order inside a micro-batch, and one that arrives after a higher
    page of its topic is appended. A null page comes last, a null row count is 0; a null topic is a topic.
    """
    b = int(batch_size)
    tt = pages.schema[topic].dataType.simpleString()
    if event_time is not None:
        out = T.StructType([T.StructField(topic, pages.schema[topic].dataType)]).add(page, "long").add("batch", "long")
        timed = pages.withColumn(event_time, quoted(event_time).cast("timestamp")).withWatermark(event_time, delay)
        return timed.groupBy(quoted(topic)).transformWithStateInPandas(
            _PageBatches(topic, page, rows, event_time, b, num_batches), out, "append", "EventTime")

    def fn(key, pdfs, state):
        batch, fill = state.get if state.exists else (1, 0)
        # Arrow cuts a topic's pages of a micro-batch into chunks anywhere: gather, then sort once
        own = [(None if pd.isna(p) else int(p), 0 if pd.isna(n) else int(n)) for pdf in pdfs for p, n in zip(pdf["_page"], pdf["_n"])]
        out, batch, fill = _fill(_in_page_order(own), batch, fill, b, num_batches)
        state.update((batch, fill))
        yield pd.DataFrame({topic: [key[0]] * len(out), page: pd.array([p for p, _ in out], "Int64"),
                            "batch": np.array([k for _, k in out], dtype=np.int64)})

    # numbers travel as text: a null would turn a column of longs into floats, and large ones would lose digits
    sent = pages.select(quoted(topic), quoted(page).cast("string").alias("_page"), quoted(rows).cast("string").alias("_n"))
    return sent.groupBy(quoted(topic)).applyInPandasWithState(
        fn, f"`{topic}` {tt}, `{page}` long, batch long", "batch long, fill long", "append", GroupStateTimeout.NoTimeout)


# ---------------------------------------------------------------------------
# K4 bounded streaming de-duplication, K5 skip processed input
# ---------------------------------------------------------------------------
def stream_dedup(stream: DataFrame, id_col: str, ts_col: str, watermark: str = "1 day") -> DataFrame:
    """K4: admit an id once. State is bounded by the watermark: a repeat that arrives
    later than ``watermark`` after the first copy's event time is no longer
    recognised, and rows older than the watermark are dropped as late data by Spark.
    The unbounded form (ids kept for ever) is the registry, K1."""
    return stream.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark([id_col])


def skip_processed(files: DataFrame, path_col: str, processed: DataFrame) -> DataFrame:
    """K5 batch form: rows from files not yet listed in the ``processed`` table."""
    return anti_join(files, processed.select(quoted(processed.columns[0]).alias("_p")), path_col, "_p")


def process_new_files(spark, source: str, schema, process, checkpoint: str, fmt: str = "parquet", glob: str | None = None,
                      **options) -> list[int]:
    """K5: run ``process(rows, run_id)`` once over the files under ``source`` that no earlier call with this
    ``checkpoint`` has taken, and return when none is left; what has been taken is in the checkpoint.

    A file source with ``availableNow``: folders and files are listed by Spark, each file is read once, a call
    without new files reads nothing, and a call that fails is repeated with the same files and the same
    ``run_id`` (write to a folder named by it, and a repeat overwrites its own). ``rows`` has ``file_path``.
    Result: the ids of the runs that read anything.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.load(source).withColumn("file_path", F.col("_metadata.file_path"))
    query = rows.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
