import datetime as dt

from pyspark.sql import functions as F

from verbscope.operators import sequence as SQ
from verbscope.streaming import state as ST

from .conftest import rows

PAGE_SCHEMA = "topic string, page long, n long"


def _drain(stream_df, name, tmp_path, mode="append"):
    q = (stream_df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", str(tmp_path / f"ckpt-{name}")).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def test_stream_page_batches_equals_batch(spark, tmp_path):
    data = [("a", p, n) for p, n in enumerate([95, 98, 90, 99, 97, 50], start=1)] + \
           [("b", p, n) for p, n in enumerate([150, 10, 10, 200], start=1)]
    src = str(tmp_path / "pages")
    spark.createDataFrame(data, PAGE_SCHEMA).write.parquet(src)
    stream = spark.readStream.schema(PAGE_SCHEMA).parquet(src)
    _drain(ST.stream_page_batches(stream, "topic", "page", "n", 200, num_batches=2), "pb", tmp_path)
    got = rows(spark.sql("SELECT * FROM pb"), "topic", "page", "batch")
    want = rows(SQ.page_batches(spark.createDataFrame(data, PAGE_SCHEMA), "topic", "page", "n", 200, num_batches=2),
                "topic", "page", "batch")
    assert got == want


def test_stream_page_batches_carries_state(spark, tmp_path):
    src = tmp_path / "pages2"
    spark.createDataFrame([("a", 1, 95), ("a", 2, 98)], PAGE_SCHEMA).write.parquet(str(src / "part1"))
    stream = spark.readStream.schema(PAGE_SCHEMA).option("recursiveFileLookup", True).parquet(str(src))
    q = (ST.stream_page_batches(stream, "topic", "page", "n", 200).writeStream.format("memory")
         .queryName("pb2").outputMode("append").option("checkpointLocation", str(tmp_path / "ck2")).start())
    q.processAllAvailable()
    # written elsewhere in one file and moved in whole, so that no micro-batch sees page 4 before page 3
    spark.createDataFrame([("a", 3, 90), ("a", 4, 99)], PAGE_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "held"))
    (tmp_path / "held").rename(src / "part2")
    q.processAllAvailable()
    q.stop()
    got = rows(spark.sql("SELECT * FROM pb2"), "page", "batch")
    assert got == [(1, 1), (2, 1), (3, 1), (4, 2)]


def test_stream_dedup_matches_batch(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    data = [(1, t0), (2, t0 + dt.timedelta(minutes=5)), (1, t0 + dt.timedelta(minutes=10)),
            (3, t0 + dt.timedelta(minutes=20)), (2, t0 + dt.timedelta(minutes=30))]
    src = str(tmp_path / "ev")
    spark.createDataFrame(data, "id long, ts timestamp").write.parquet(src)
    stream = spark.readStream.schema("id long, ts timestamp").parquet(src)
    _drain(ST.stream_dedup(stream, "id", "ts", "1 hour"), "dd", tmp_path)
    got = sorted(r["id"] for r in spark.sql("SELECT id FROM dd").collect())
    assert got == [1, 2, 3]


def test_registry_sink_two_batches(spark, tmp_path):
    src = tmp_path / "tw"
    reg_root, out = str(tmp_path / "registry"), str(tmp_path / "kept")
    schema = "tweet_id string, text string"
    spark.createDataFrame([("1", "a"), ("2", "b")], schema).write.parquet(str(src / "f1"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(src))
    q = (stream.writeStream.foreachBatch(ST.registry_sink("tweet_id", reg_root, out, run="a"))
         .option("checkpointLocation", str(tmp_path / "ck3")).start())
    q.processAllAvailable()
    spark.createDataFrame([("2", "b again"), ("3", "c")], schema).write.parquet(str(src / "f2"))
    q.processAllAvailable()
    q.stop()
    kept = rows(spark.read.parquet(out), "tweet_id")
    assert kept == [("1",), ("2",), ("3",)]
    assert rows(ST.read_registry(spark, reg_root)) == [("1",), ("2",), ("3",)]


def test_registry_sink_starts_from_existing_registry(spark, tmp_path):
    """A registry of 11 ids, 13 rows with 10 ids of which 2 are registered: 11 rows kept, 19 ids after.
    A second run with a new checkpoint loses nothing and keeps nothing."""
    src, root, out = str(tmp_path / "tw2"), str(tmp_path / "reg2"), str(tmp_path / "kept2")
    ids = [1, 2, 3, 3, 4, 5, 6, 7, 8, 8, 9, 9, 10]
    spark.createDataFrame([(str(i), f"t{k}") for k, i in enumerate(ids)], "tweet_id string, text string").write.parquet(src)
    known = [("1",), ("2",)] + [(str(i),) for i in range(101, 110)]
    ST.commit_registry(spark.createDataFrame(known, "id string"), root, 0)
    for run, kept in (("a", 11), ("b", 0)):
        stream = spark.readStream.schema("tweet_id string, text string").parquet(src)
        (stream.writeStream.foreachBatch(ST.registry_sink("tweet_id", root, out, run=run))
         .option("checkpointLocation", str(tmp_path / f"ckr-{run}")).trigger(availableNow=True).start().awaitTermination())
        assert spark.read.parquet(f"{out}/run={run}").count() == kept
        assert ST.read_registry(spark, root).count() == 19


def test_stream_page_batches_in_small_chunks(spark, tmp_path):
    data = [("a", p, n) for p, n in enumerate([95, 98, None, 99, 97, 50, 60, 70, 80], start=1)][::-1]
    src = str(tmp_path / "pages3")
    spark.createDataFrame(data, PAGE_SCHEMA).write.parquet(src)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        stream = spark.readStream.schema(PAGE_SCHEMA).parquet(src)
        _drain(ST.stream_page_batches(stream, "topic", "page", "n", 200), "pb3", tmp_path)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = rows(spark.sql("SELECT * FROM pb3"), "topic", "page", "batch")
    assert got == rows(SQ.page_batches(spark.createDataFrame(data, PAGE_SCHEMA), "topic", "page", "n", 200), "topic", "page", "batch")


def test_skip_processed(spark):
    files = spark.createDataFrame([("a.csv", 1), ("b.csv", 2)], "path string, x int")
    done = spark.createDataFrame([("a.csv",)], "path string")
    assert rows(ST.skip_processed(files, "path", done), "path") == [("b.csv",)]


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def test_stream_page_batches_any_arrival_inside_the_watermark(spark, tmp_path):
    """Pages come in four micro-batches, out of order by less than the watermark's delay; null topic, page and row count."""
    import os
    import random
    rng = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    data = [(t, p, rng.choice([None, 30, 60, 95, 120]), t0 + dt.timedelta(minutes=p)) for t in ("a", "b", None) for p in range(1, 25)]
    data.append(("a", None, 10, t0 + dt.timedelta(minutes=25)))
    data.append(("a", 2**60 + 1, 10, t0 + dt.timedelta(minutes=24, seconds=30)))
    arrival = sorted(data, key=lambda r: r[3] + dt.timedelta(minutes=rng.uniform(0, 9)))
    parts = [arrival[k::4] if k < 0 else arrival[len(arrival) * k // 4 : len(arrival) * (k + 1) // 4] for k in range(4)]
    parts.append([("z", 1, 0, t0 + dt.timedelta(hours=5))])  # moves the watermark past all pages
    schema = PAGE_SCHEMA + ", made timestamp"
    src, held = tmp_path / "late", tmp_path / "held"
    src.mkdir()
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(src))
        made = ST.stream_page_batches(stream, "topic", "page", "n", 200, num_batches=5, event_time="made", delay="10 minutes")
        for k, part in enumerate(parts):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(held / str(k)))
            os.rename(held / str(k), src / str(k))  # files appear whole
            q = (made.writeStream.format("memory" if k < 0 else "parquet").option("path", str(tmp_path / "out")).outputMode("append")
                 .option("checkpointLocation", str(tmp_path / "ck-late")).trigger(availableNow=True).start())
            q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = rows(spark.read.parquet(str(tmp_path / "out")), "topic", "page", "batch")
    batch = SQ.page_batches(spark.createDataFrame(data, schema), "topic", "page", "n", 200, num_batches=5)
    # a page number far above the others is later than they are, the page without one comes last
    want = rows(batch, "topic", "page", "batch")
    assert [r for r in got if r[0] != "z"] == want


def test_stream_page_batches_null_pages(spark, tmp_path):
    data = [("a", 2**60 + 1, 10), ("a", None, 50), ("a", 1, None), (None, 1, 300), (None, 2, 5)]
    src = str(tmp_path / "nulls")
    spark.createDataFrame(data, PAGE_SCHEMA).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(PAGE_SCHEMA).parquet(src)
    _drain(ST.stream_page_batches(stream, "topic", "page", "n", 20), "pbn", tmp_path)
    got = rows(spark.sql("SELECT * FROM pbn"), "topic", "page", "batch")
    assert got == rows(SQ.page_batches(spark.createDataFrame(data, PAGE_SCHEMA), "topic", "page", "n", 20), "topic", "page", "batch")


def test_new_files_only(spark, tmp_path):
    src, ck, seen = tmp_path / "in", str(tmp_path / "ck5"), []
    spark.createDataFrame([(1,), (2,)], "id long").coalesce(1).write.parquet(str(src / "a"))

    def process(batch, run_id):
        batch.write.mode("overwrite").parquet(str(tmp_path / f"out/run={run_id}"))
        seen.append((run_id, sorted(r["id"] for r in batch.collect())))

    run = lambda fn=process: ST.process_new_files(spark, str(src), "id long", fn, ck)
    assert run() == [0] and seen == [(0, [1, 2])]
    assert run() == [] and len(seen) == 1  # nothing new: nothing read
    spark.createDataFrame([(3,)], "id long").coalesce(1).write.parquet(str(src / "b"))

    def broken(batch, run_id):
        raise ValueError("broken")

    try:
        run(broken)
    except Exception:
        pass
    assert run() == [1] and seen[-1] == (1, [3])  # the failed run's file again, under its id
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id") == [(1,), (2,), (3,)]


def test_registry_buckets_and_compaction(spark, tmp_path):
    root, out = str(tmp_path / "regb"), str(tmp_path / "keptb")
    sink = ST.registry_sink("id", root, out, run="x")
    frame = lambda ids: spark.createDataFrame([(str(i), i) for i in ids], "id string, n int")
    for k, ids in enumerate([range(0, 50), range(40, 90), range(80, 120), [200]]):
        sink(frame(ids), k)
    assert ST.read_registry(spark, root).count() == 121 and spark.read.parquet(out).count() == 121
    one = [r["b"] for r in frame([7]).select(ST.id_bucket("id").alias("b")).collect()]
    few = ST.read_registry(spark, root, buckets=one)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and {"7"} <= {r["id"] for r in few.collect()} and few.count() < 20
    made = ST.compact_registry(spark, root)
    parts = ST.registry_parts(spark, root)
    assert sorted(p.rsplit("/", 1)[-1][:2] for p in parts) == ["c=", "ru"] and any(p.endswith(made.rsplit("/", 1)[-1]) for p in parts)
    assert ST.read_registry(spark, root).count() == 121 and ST.compact_registry(spark, root) is None
    sink(frame([200]), 3)  # the last batch again: its own part is left out, so its row is kept again
    assert spark.read.parquet(f"{out}/run=x/batch_id=3").count() == 1
    sink(frame([200, 201, None]), 4)
    assert spark.read.parquet(f"{out}/run=x/batch_id=4").count() == 2
