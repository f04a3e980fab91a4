import random

from pyspark.sql import functions as F

from verbscope.operators import sequence as SQ

from .conftest import rows

SIZES = [95, 98, 90, 99, 97, 50]


def pages(spark, sizes_by_topic):
    data = [(t, p, n) for t, sizes in sizes_by_topic.items() for p, n in enumerate(sizes, start=1)]
    return spark.createDataFrame(data, "topic string, page long, n long")


def brute(sizes, b, num_batches=None):
    out, batch, fill = [], 1, 0
    for p, n in enumerate(sizes, start=1):
        if num_batches is None or batch <= num_batches:
            out.append((p, batch))
        fill += n
        if fill >= b:
            batch += 1
            fill = 0
    return out


def test_page_batches_hand_case(spark):
    got = rows(SQ.page_batches(pages(spark, {"q": SIZES}), "topic", "page", "n", 200), "page", "batch")
    assert [b for _, b in got] == [1, 1, 1, 2, 2, 2]


def test_page_batches_limit(spark):
    got = rows(SQ.page_batches(pages(spark, {"q": SIZES}), "topic", "page", "n", 200, num_batches=1), "page")
    assert got == [(1,), (2,), (3,)]


def test_page_batches_chunked_equals_brute_force(spark):
    rnd = random.Random(3)
    topics = {f"t{k}": [rnd.randint(0, 100) for _ in range(rnd.randint(1, 40))] for k in range(6)}
    df = pages(spark, topics)
    for parts in (2, 5, 40):
        got = rows(SQ.page_batches(df, "topic", "page", "n", 170, num_batches=4, partitions=parts),
                   "topic", "page", "batch")
        want = sorted(((t, p, b) for t, s in topics.items() for p, b in brute(s, 170, 4)), key=repr)
        assert got == want, parts


def test_near_equal_batches(spark):
    df = spark.range(13).toDF("id")
    got = SQ.with_batch_id(df, "id", n_batches=4).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in got] == [4, 3, 3, 3]
    got = SQ.with_batch_id(df, "id", batch_size=5).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in got] == [5, 4, 4]


def test_row_index_partition_invariant(spark):
    base = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k"))
    want = sorted([(k, k + 100) for k in range(500)], key=repr)
    for n in (1, 3, 8):
        got = rows(SQ.with_row_index(base.repartition(n), "k", name="idx", start=100), "k", "idx")
        assert got == want


def test_row_index_empty(spark):
    e = spark.createDataFrame([], "k long")
    assert SQ.with_row_index(e, "k").count() == 0


def test_row_index_wide_and_large(spark, tmp_path):
    """Rows with payload, more than one sampled bound, AQE on, without coalescing, and off."""
    from verbscope.sources import sinks as SK
    n = 300_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled",
                                          "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        for aqe, coalesce in (("true", "true"), ("true", "false"), ("false", "false")):
            spark.conf.set("spark.sql.adaptive.enabled", aqe)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
            out = SQ.with_row_index(df, "k", name="idx")
            assert out.agg(F.count("*"), F.countDistinct("idx"), F.sum((F.col("idx") != F.col("k")).cast("int"))).first()[:] == (n, n, 0)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    path = str(tmp_path / "batched")
    SK.write_batched(df, path, "k", batch_size=10_000)
    back = spark.read.parquet(path)
    assert back.count() == n and back.select("batch").distinct().count() == 30


def test_page_batches_keep_null_topics_and_pages(spark):
    rows = [(None, 2, 3), (None, 1, 3), (None, None, 1), ("null", 1, 9), ("a", 1, None), ("a", 2, 5), ("", 1, 1)]
    df = spark.createDataFrame(rows, "`my topic` string, page long, n long")
    for parts in (1, 7):
        out = SQ.page_batches(df, "my topic", "page", "n", batch_size=5, partitions=parts).collect()
        assert {tuple(r) for r in out} == {(None, 1, 3, 1), (None, 2, 3, 1), (None, None, 1, 2), ("null", 1, 9, 1),
                                           ("a", 1, 0, 1), ("a", 2, 5, 1), ("", 1, 1, 1)}


def test_page_batches_one_topic_over_many_parts(spark):
    """Sparse and repeated page numbers, batch sizes down to one; a topic that fills most parts."""
    rnd = random.Random(5)
    data = [("big", rnd.choice([k, 1000 * k, 7]), rnd.randint(0, 9)) for k in range(400)] + [(f"s{k}", 1, k) for k in range(20)]
    df = spark.createDataFrame(data, "topic string, page long, n long")
    for size in (1, 2, 25):
        want, by = [], {}
        for t, p, n in sorted(data):
            by.setdefault(t, []).append((p, n))
        for t, own in by.items():
            want += [(t, p, n, b) for (p, n), (_, b) in zip(own, brute([n for _, n in own], size))]
        for parts in (1, 6):
            got = rows(SQ.page_batches(df, "topic", "page", "n", size, partitions=parts))
            assert got == sorted(want, key=repr), (size, parts)


def test_row_index_shuffles_rows_once(spark):
    df = spark.range(1000).select("id", F.lit("payload").alias("p"))
    plan = SQ.with_row_index(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
