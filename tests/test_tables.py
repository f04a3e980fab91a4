from pyspark.sql import functions as F

from verbscope.operators import aggregates as AG
from verbscope.operators import dedup as DD
from verbscope.operators import joins as JN
from verbscope.operators import setops as SE
from verbscope.streaming import state as ST

from .conftest import rows


def golden_tweets(spark):
    # 13 rows, 10 distinct ids: 10 sampled rows + 3 repeats (invented text)
    ids = [f"14{n:017d}" for n in range(10)]
    data = [(ids[k], f"texto {k}") for k in range(10)] + [(ids[1], "texto 1"), (ids[4], "texto 4"),
                                                          (ids[7], "texto 7")]
    return spark.createDataFrame([(i, t, pos) for pos, (i, t) in enumerate(data)],
                                 "id string, text_orig string, pos int"), ids


def test_golden_registry(spark):
    tweets, ids = golden_tweets(spark)
    existing = [ids[2], ids[5]] + [f"99{n:017d}" for n in range(9)]
    reg = spark.createDataFrame([(x,) for x in existing], "id string")
    kept, new_reg = ST.update_registry(tweets, "id", reg)
    assert set(r["id"] for r in new_reg.collect()) == set(ids) | set(existing)
    assert new_reg.count() == 19
    assert kept.count() == 11
    assert DD.dedup_first(kept, "id", "pos").count() == 8


def test_left_join_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "k int, p string")
    right = spark.createDataFrame([("a", "AR"), (None, "NULLC")], "p string, country string")
    assert rows(JN.left_join(left, right, "p"), "k", "country") == [(1, "AR"), (2, None)]
    assert rows(JN.left_join(left, right, "p", null_safe=True), "k", "country") == [(1, "AR"), (2, "NULLC")]


def test_anti_join_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, p string")
    right = spark.createDataFrame([("a",), (None,)], "p string")
    assert rows(JN.anti_join(left, right, "p"), "k") == [(2,), (3,)]
    assert rows(JN.anti_join(left, right, "p", null_safe=True), "k") == [(3,)]


def test_mark_join(spark):
    users = spark.createDataFrame([(1, "ana"), (2, "bob"), (3, None)], "user_id int, username string")
    meta = spark.createDataFrame([("x", "bob"), ("y", "bob"), ("z", None)], "resource_id string, value string")
    assert rows(JN.mark_join(users, "username", meta, "value"), "user_id", "flagged") == \
        [(1, False), (2, True), (3, False)]


def test_dedup_first_order(spark):
    df = spark.createDataFrame([(3, "x", "late"), (1, "x", "early"), (2, None, "n1"), (5, None, "n2")],
                               "pos int, key string, v string")
    assert rows(DD.dedup_first(df, "key", "pos"), "key", "v") == sorted([(None, "n1"), ("x", "early")], key=repr)


def test_dedup_per_folder_skips_cleaned(spark):
    df = spark.createDataFrame([("f1", 1, "a"), ("f1", 2, "a"), ("f2", 3, "a"), ("f3", 4, "b")],
                               "folder string, pos int, key string")
    cleaned = spark.createDataFrame([("f3",)], "folder string")
    got = rows(DD.dedup_first_per_folder(df, "folder", "key", "pos", cleaned), "folder", "pos")
    assert got == [("f1", 1), ("f2", 3)]


def test_duplicate_report(spark):
    df = spark.createDataFrame([("f1", "a"), ("f1", "a"), ("f1", None), ("f1", None), ("f2", "b")],
                               "folder string, key string")
    assert rows(AG.duplicate_report(df, "key", "folder")) == [("f1", 4, 2), ("f2", 1, 0)]


def test_merge_pull_new_wins(spark):
    new = spark.createDataFrame([(10, "a", "new"), (11, "b", "new")], "id int, key string, src string")
    prev = spark.createDataFrame([(1, "a", "old"), (2, "c", "old")], "id int, key string, src string")
    got = rows(SE.merge_pull(new, prev, "key", "id"), "key", "src", "is_new")
    assert got == [("a", "new", False), ("b", "new", True), ("c", "old", False)]
    rep = AG.merge_report({"t": (new, prev, "key")}).first()
    assert (rep["rows"], rep["kept"], rep["dups"], rep["new"]) == (4, 3, 1, 1)


def test_append_missing_columns(spark):
    a = spark.range(2).toDF("id")
    b = spark.createDataFrame([(5, "x")], "id long, extra string")
    out = SE.append(a, b)
    assert out.count() == 3 and "extra" in out.columns


def test_id_sets(spark):
    reg = spark.createDataFrame([("1",), ("2",)], "id string")
    new = spark.createDataFrame([("2",), ("3",), ("3",)], "id string")
    assert rows(SE.id_union(reg, new)) == [("1",), ("2",), ("3",)]
    assert rows(SE.id_intersect(reg, new)) == [("2",)]
    assert rows(SE.id_difference(new, reg)) == [("3",)]


def test_registry_duplicates_files(spark):
    df = spark.createDataFrame([("file1", "7"), ("file2", "7"), ("file1", "8"), ("file1", "8"), ("file2", "9")],
                               "file string, id string")
    reg = spark.createDataFrame([("9",)], "id string")
    got = rows(ST.registry_duplicates(df, "file", "id", reg), "id", "seen", "n_files", "dup")
    assert got == [("7", False, 2, True), ("8", False, 1, False), ("9", True, 1, True)]


def test_value_counts_and_flag_rate(spark):
    df = spark.createDataFrame([("a", True), ("a", None), ("b", False), (None, True)], "v string, f boolean")
    assert [tuple(r) for r in AG.value_counts(df, "v").collect()] == [("a", 2), ("b", 1)]
    r = AG.flag_rate(df, "f").first()
    assert (r["n"], r["n_true"], r["rate"]) == (4, 2, 0.5)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a int, b string")
    assert rows(AG.null_profile(df)) == [("a", 1, 1), ("b", 1, 1)]


def test_verb_type_counts_multi_class(spark):
    verbs = spark.createDataFrame([("creer", "epistemic", "", 0), ("decir", "stative", "", 1)],
                                  "verb string, verb_type string, indicativo string, ord int")
    docs = spark.createDataFrame([(1, ["creer", "decir"]), (2, ["creer"])], "doc_id long, verbs array<string>")
    assert rows(AG.verb_type_counts(docs, "doc_id", "verbs", verbs)) == [("epistemic", 2), ("stative", 1)]


def test_small_side_goes_by_planned_bytes(spark):
    dim = spark.range(10).toDF("k")
    assert JN.small_side(dim, max_bytes=5) is dim
    hinted = spark.range(3).toDF("k").join(JN.small_side(dim), "k")
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    unknown = spark.createDataFrame([(1,)], "k int")  # no size known: never hinted
    assert JN.small_side(unknown) is unknown


def test_dotted_names_and_maps(spark):
    new = spark.createDataFrame([("k", 2, {"b": 1, "a": 2}), (None, 1, None), ("k", 1, {"x": 0})], "`a.key` string, `m.x` int, props map<string,int>")
    prev = spark.createDataFrame([(None, 5, {"q": 1}), ("old", 1, None)], new.schema)
    got = {r["a.key"]: (r["m.x"], r["props"], r["is_new"]) for r in SE.merge_pull(new, prev, "a.key", "m.x").collect()}
    assert got == {"k": (1, {"x": 0}, True), None: (1, None, False), "old": (1, None, False)}
    assert rows(AG.duplicate_report(new, "a.key")) == [(3, 1)]
    assert SE.merge_counts(new, prev, "a.key").first().asDict() == {"rows": 5, "kept": 3, "dups": 2, "new": 1}
    one = spark.createDataFrame([("k", "one")], "`a.key` string, `d.v` string")
    assert rows(JN.left_join(new.drop("props"), one, "a.key")) == [("k", 1, "one"), ("k", 2, "one"), (None, 1, None)]
    assert JN.anti_join(new, one, "a.key").count() == 1 and JN.semi_join(new, one, "a.key").count() == 2
    # map keys: entry order doesn't matter
    twice = spark.sql("select map('a', 1, 'b', 2) m, 1 n union all select map('b', 2, 'a', 1), 2")
    assert [r["n"] for r in DD.dedup_first(twice, "m", "n").collect()] == [1]


def test_keep_first_sorts_no_text(spark):
    df = spark.createDataFrame([("t", 1, "x")], "text string, id long, other string")
    for out in (DD.dedup_first(df, "text", "id"), SE.merge_pull(df, df, "text", "id"), AG.duplicate_report(df, "text", "other")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan
    assert "WindowGroupLimit" in DD.dedup_first(df, "text", "id")._jdf.queryExecution().executedPlan().toString()


def test_report_with_total(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", None), ("b", None)], "folder string, k string")
    assert rows(AG.duplicate_report(df, "k", "folder", total="all")) == [("a", 2, 1), ("all", 5, 3), ("b", 3, 1)]


def test_substring_join_any_size(spark):
    texts = ["", None, "abc", "xabcdx", "日本語テキスト", "a🙂bcd🙂e", "long " * 3000 + "needle at the end", "abc"]
    terms = ["", None, "a", "bc", "abcd", "abcde", "本語", "🙂bcd🙂", "needle", "g needle at the end", "zzz", "bc"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    dim = spark.createDataFrame([(t, k) for k, t in enumerate(terms)], "term string, n int")
    want = []
    for k, t in enumerate(texts):
        hits = [n for n, x in enumerate(terms) if t is not None and x is not None and x in t]
        want += [(k, n) for n in hits] or [(k, None)]
    assert rows(JN.substring_join(df, "text", dim, "term").select("id", "n")) == sorted(want, key=repr)
    plan = JN.substring_join(df, "text", dim, "term")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_frames(spark):
    e = spark.createDataFrame([], "id string, key string, pos int")
    assert DD.dedup_first(e, "key", "pos").count() == 0
    assert AG.duplicate_report(e, "key").first()["original"] is None
    assert SE.merge_pull(e, e, "key", "pos").count() == 0
    kept, reg = ST.update_registry(e, "id", spark.createDataFrame([], "id string"))
    assert kept.count() == 0 and reg.count() == 0


def test_filters(spark):
    from verbscope.operators import filters as FL
    df = spark.createDataFrame([(1, "creer!"), (2, "comer"), (3, None)], "id int, verb string")
    verbs = spark.createDataFrame([("creer", "e", "", 0)], "verb string, verb_type string, indicativo string, ord int")
    known, unknown = FL.filter_known_verbs(df, "verb", verbs)
    assert rows(known, "id") == [(1,)] and rows(unknown, "id") == [(2,), (3,)]
    assert rows(FL.drop_null_text(df, "verb"), "id") == [(1,), (2,)]
    d = spark.createDataFrame([(" creo[ROOT] venga[ccomp]",), (" x[dep]",)], "d string")
    assert [r[0] for r in d.select(FL.has_dependency("d")).collect()] == [True, False]


def test_append_pages_meta_latest(spark):
    p1 = {"tweets": spark.createDataFrame([("1",)], "tweet_id string"),
          "meta": spark.createDataFrame([(1, "tok1")], "page int, next_token string")}
    p2 = {"tweets": spark.createDataFrame([("2",)], "tweet_id string"),
          "meta": spark.createDataFrame([(2, None)], "page int, next_token string")}
    out = SE.append_pages([p1, p2])
    assert out["tweets"].count() == 2
    assert rows(out["meta"]) == [(2, None)]


def test_write_by_type(spark, tmp_path):
    from verbscope.sources import sinks as K
    K.write_by_type({"tweets": spark.createDataFrame([("1",)], "tweet_id string"),
                     "users": spark.createDataFrame([("u",)], "user_id string")}, str(tmp_path / "o"))
    back = spark.read.parquet(str(tmp_path / "o" / "data_type=tweets"))
    assert back.count() == 1


def test_columns_ops(spark):
    from verbscope.operators import columns as CO
    df = spark.createDataFrame([("1", "2021-11-07 22:10:00", "x", 3, 4)], "id string, created_at string, a string, r int, q int")
    df = CO.rename_columns(df, {"id": "tweet_id", "missing": "nope"})
    assert "tweet_id" in df.columns
    t = CO.convert_types(df, {"created_at": "datetime", "a": "int", "absent": "int"}).first()
    assert t["created_at"].year == 2021 and t["a"] is None
    c = CO.combine_columns(df, {"rq": ["r", "q"]}, as_text=True).first()
    assert c["rq"] == "(3, 4)"
    s = CO.combine_columns(df, {"rq": ["r", "q"]})
    assert s.schema["rq"].dataType.simpleString() == "struct<r:int,q:int>" and "r" not in s.columns
    w = spark.createDataFrame([(1,)], "`BIBLIOGRAFÍA` int")
    assert CO.standardize_columns(w).columns == ["bibliografia"]
    assert CO.drop_columns(df, ["a", "zzz"]).columns == ["tweet_id", "created_at", "r", "q"]


def test_sampling_stable_and_exact(spark):
    from verbscope.operators import sampling as SA
    df = spark.range(1000).toDF("id")
    a = rows(SA.sample_fraction(df.repartition(1), 0.2, "id", seed=5))
    b = rows(SA.sample_fraction(df.repartition(7), 0.2, "id", seed=5))
    assert a == b and 100 < len(a) < 300
    assert SA.sample_n(df, 25, "id", seed=5).count() == 25
    assert rows(SA.sample_n(df.repartition(3), 25, "id", seed=5)) == rows(SA.sample_n(df, 25, "id", seed=5))
    assert [r["id"] for r in SA.head(df, 3, "id").collect()] == [0, 1, 2]
    assert [r["id"] for r in SA.tail(df, 2, "id").collect()] == [999, 998]
    assert SA.row_at(df, 100, "id").first()["id"] == 100
    assert SA.row_at(df, 10 ** 6, "id").count() == 0
    assert SA.sample_fraction(spark.range(200_000), 0.00004, "id", seed=5).count() > 0


def test_append_pages_keeps_every_table(spark):
    from verbscope.operators.setops import append_pages
    one = {"tweets": spark.range(2), "errors": spark.range(1)}
    two = {"tweets": spark.range(3), "media": spark.range(4)}
    assert {k: v.count() for k, v in append_pages([one, two]).items()} == {"tweets": 5, "errors": 1, "media": 4}
    assert set(append_pages([one, two], tables=("tweets", "meta"))) == {"tweets"}
