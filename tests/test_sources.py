import json
import os

import pytest
from pyspark.sql import functions as F

from verbscope import schemas as S
from verbscope.sources import readers as R
from verbscope.sources import sinks as K

from .conftest import rows

HEADER = "~".join(f.name for f in S.TWEETS_RAW.fields)


def tweet_line(tid, text, user="u1"):
    return "~".join([tid, user, "p1", "2021-11-07 22:10:00", "es", text, "", "", "1", "2", "3", "4"])


def test_read_table_multiline_and_malformed(spark, tmp_path):
    p = tmp_path / "twitter-es-creer-0-3-tweets.csv"
    p.write_text("\n".join([HEADER, tweet_line("1", "hola"), tweet_line("2", '"dos\nlineas"'),
                            tweet_line("3", "mal").replace("~4", "~x")]) + "\n")
    df = R.read_table(spark, str(p), lang="es", topic="creer")
    got = rows(df, "tweet_id", "text_orig", "like_count", "topic")
    assert got == [("1", "hola", 3, "creer"), ("2", "dos\nlineas", 3, "creer")]


def test_rejects_do_not_depend_on_columns(spark, tmp_path):
    p = tmp_path / "t-tweets.csv"
    lines = [HEADER, tweet_line("1", "hola"), tweet_line("2", "mal").replace("~4", "~x"), tweet_line("3", "largo") + "~extra",
             "4~u1~p1~2021", tweet_line("5", '"con ~ y ""q"""'), tweet_line("6", "corto").rsplit("~", 2)[0],
             tweet_line("7", "corto y mal").replace("~1~", "~z~").rsplit("~", 1)[0], "8"]
    p.write_text("\n".join(lines) + "\n")
    for breaks in (True, False):
        kept = R.read_table(spark, str(p), quoted_breaks=breaks)
        want = ["1", "4", "5", "6", "8"]
        assert [r[0] for r in rows(kept, "tweet_id")] == want and kept.count() == 5
        for c in kept.columns:  # any one column, and none at all
            assert R.read_table(spark, str(p), columns=[c], quoted_breaks=breaks).count() == 5
            assert len(R.read_table(spark, str(p), columns=[c], quoted_breaks=breaks).collect()) == 5
        short = kept.where("tweet_id = '6'").first()
        assert (short["text_orig"], short["retweet_count"], short["reply_count"], short["like_count"]) == ("corto", 1, 2, None)
        bad = R.rejected_rows(R.parse_table(spark, str(p), quoted_breaks=breaks))
        assert bad.count() == 3
        assert sorted((r["record"].strip()[0], r["reason"], r["file_name"]) for r in bad.collect()) == [
            ("2", "value", "t-tweets.csv"), ("3", "fields", "t-tweets.csv"), ("7", "value", "t-tweets.csv")]


def test_reject_spanning_lines(spark, tmp_path):
    p = tmp_path / "x-tweets.csv"
    p.write_text("\n".join([HEADER, tweet_line("1", '"dos\nlineas"') + "~más", tweet_line("2", '"tres\n~\nlineas"')]) + "\n")
    bad = R.rejected_rows(R.parse_folder(spark, str(tmp_path)))
    assert [(r["record"].strip(), r["reason"]) for r in bad.collect()] == [(tweet_line("1", '"dos\nlineas"') + "~más", "fields")]
    assert rows(R.read_folder(spark, str(tmp_path)), "tweet_id", "text_orig") == [("2", "tres\n~\nlineas")]


def test_large_file_is_split_without_quoted_breaks(spark, tmp_path):
    p = tmp_path / "big-tweets.csv"
    p.write_text(HEADER + "\n" + "\n".join(tweet_line(str(k), "x" * 100) for k in range(2000)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        assert R.read_table(spark, str(p), quoted_breaks=False).rdd.getNumPartitions() > 4
        assert R.read_table(spark, str(p), quoted_breaks=False).count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_corpus_rejects(spark, tmp_path):
    from verbscope.plans.bindings import CORPUS_HEADERS
    p = tmp_path / "corpus.tsv"
    n = len(CORPUS_HEADERS)
    p.write_text("\n".join(["\t".join(CORPUS_HEADERS), "\t".join("v" * n), "\t".join("w" * (n + 1)), "\t".join("s" * (n - 2))]) + "\n")
    df = R.read_corpus(spark, str(p))
    assert [r[0] for r in rows(df, "bibliografia")] == ["s", "v"] and df.count() == 2
    assert [r["reason"] for r in R.rejected_rows(R.parse_corpus(spark, str(p))).collect()] == ["fields"]


def test_topic_from_path_many_verbs(spark):
    verbs = spark.range(30000).selectExpr("concat('v', id) as verb", "'t' as verb_type", "'' as indicativo", "cast(id as int) as ord")
    df = spark.createDataFrame([("twitter-v29999-x.csv",), ("none.v1",), (None,), ("nope",)], "name string")
    got = {r["name"]: r["topic"] for r in R.topic_from_path(df, "name", verbs).collect()}
    assert got == {"twitter-v29999-x.csv": "v2", "none.v1": None, None: None, "nope": None}


def test_read_folder(spark, tmp_path):
    for folder in ("creer", "decir"):
        d = tmp_path / folder
        d.mkdir()
        (d / f"{folder}-tweets.csv").write_text(HEADER + "\n" + tweet_line(folder[0], "x") + "\n")
        (d / f"{folder}-users.csv").write_text("ignored\n")
    df = R.read_folder(spark, str(tmp_path))
    assert rows(df, "tweet_id", "folder") == [("c", "creer"), ("d", "decir")]


PAGE = {
    "data": [{"id": "11", "text": "@ana creo que sí", "author_id": "7", "lang": "es", "created_at": "2021-11-07T22:10:00.000Z",
              "public_metrics": {"retweet_count": 1, "reply_count": 0, "like_count": 5, "quote_count": 0},
              "geo": {"place_id": "p9"}, "entities": {"mentions": [{"username": "ana"}]},
              "referenced_tweets": [{"type": "quoted", "id": "12"}]},
             {"id": "13", "text": "otro", "author_id": "8", "lang": "es", "created_at": "2021-11-07T22:11:00.000Z"}],
    "includes": {"users": [{"id": "7", "username": "bob", "location": "Lima",
                            "public_metrics": {"followers_count": 3}}],
                 "places": [{"id": "p9", "full_name": "Lima, Perú", "country": "Perú"}]},
    "errors": [{"resource_id": "99", "value": "hidden"}],
    "meta": {"next_token": "abc", "result_count": 2},
}


def test_explode_pages(spark, tmp_path):
    p = tmp_path / "pages"
    p.mkdir()
    (p / "page-1.json").write_text(json.dumps(PAGE) + "\n")
    tables = R.explode_pages(R.read_pages(spark, str(p)))
    tw = tables["tweets"]
    assert {"tweet_id", "user_id", "tweet_place_id", "text_orig", "like_count", "mentions"} <= set(tw.columns)
    assert rows(tw, "tweet_id", "tweet_place_id", "like_count") == [("11", "p9", 5), ("13", None, None)]
    assert rows(tables["users"], "user_id", "username", "followers_count") == [("7", "bob", 3)]
    assert rows(tables["places"], "place_id", "country") == [("p9", "Perú")]
    assert rows(tables["errors"]) == [("99", "hidden")]
    assert tables["meta"].first()["next_token"] == "abc"


def test_json_lines_round_trip(spark, tmp_path):
    p = tmp_path / "in"
    p.mkdir()
    (p / "a.json").write_text(json.dumps(PAGE) + "\n")
    pages = R.read_pages(spark, str(p))
    out = str(tmp_path / "out")
    K.write_pages(pages, out)
    assert R.read_pages(spark, out).first()["meta"]["result_count"] == 2


def test_flatten_struct(spark):
    df = spark.createDataFrame([(1, (2, (3,)), [1, 2])], "a int, b struct<c:int, d:struct<e:int>>, l array<int>")
    out = R.flatten_struct(df)
    assert out.columns == ["a", "b.c", "b.d.e", "l"]


def test_ids_round_trip(spark, tmp_path):
    p = tmp_path / "ids.txt"
    p.write_text("1 2,3\n 4  \n\n5,1")
    ids = R.read_ids(spark, str(p))
    assert rows(ids) == [("1",), ("2",), ("3",), ("4",), ("5",)]
    out = str(tmp_path / "reg")
    K.write_ids(ids, out)
    assert spark.read.parquet(out).count() == 5


def test_write_batched(spark, tmp_path):
    out = str(tmp_path / "b")
    K.write_batched(spark.range(13).toDF("id"), out, "id", batch_size=4)
    got = spark.read.parquet(out).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in got] == [4, 3, 3, 3]


def test_write_by_verb_multi(spark, tmp_path):
    verbs = spark.createDataFrame([("creer", "Epistemic", "", 0), ("decir", "stative", "", 1),
                                   ("temer", "stative", "", 2)], "verb string, verb_type string, indicativo string, ord int")
    df = spark.createDataFrame([(1, "creer, decir"), (2, "decir")], "tweet_id long, verbs string")
    out = str(tmp_path / "v")
    K.write_by_verb(df, "verbs", verbs, out)
    dirs = lambda p, pre: sorted(x for x in os.listdir(p) if x.startswith(pre))
    assert dirs(out, "verb_type=") == ["verb_type=epistemic", "verb_type=stative"]
    assert dirs(os.path.join(out, "verb_type=stative"), "verb=") == ["verb=decir"]
    back = spark.read.parquet(out)
    assert rows(back, "tweet_id", "verb") == [(1, "creer"), (1, "decir"), (2, "decir")]


def test_write_table_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "a~b", (1, 2))], "tweet_id string, text_orig string, m struct<x:int,y:int>")
    out = str(tmp_path / "t")
    K.write_table(df, out, fmt="csv")
    back = spark.read.option("sep", "~").option("header", True).csv(out)
    assert back.first()["text_orig"] == "a~b"


def test_read_corpus(spark, tmp_path):
    p = tmp_path / "c.tsv"
    headers = ["BIBLIOGRAFÍA", "PAÍS", "CONCORDANCIA"]
    p.write_text("\t".join(headers) + "\nlibro\tPerú\tcreo que sí\n")
    df = R.read_corpus(spark, str(p), headers=headers)
    assert df.columns == ["bibliografia", "pais", "concordancia"]
    assert df.first()["pais"] == "Perú"


def test_topic_and_keyword_from_path(spark):
    verbs = spark.createDataFrame([("decir", "s", "", 1), ("creer", "e", "", 0)],
                                  "verb string, verb_type string, indicativo string, ord int")
    df = spark.createDataFrame([("twitter-es-creer-decir-1.csv",), ("other.csv",)], "name string")
    t = R.topic_from_path(df, "name", verbs)
    assert rows(t, "name", "topic") == sorted([("twitter-es-creer-decir-1.csv", "creer"), ("other.csv", None)], key=repr)
    k = R.keyword_from_path(df, "name", "twitter-[a-z]+-([^-]+)-")
    assert rows(k, "name", "keyword") == sorted([("twitter-es-creer-decir-1.csv", "creer"), ("other.csv", None)], key=repr)


def test_load_verbs_duplicate_first_by_ord(spark, tmp_path):
    p = tmp_path / "verbs.csv"
    p.write_text("verb,verb_type,indicativo,ord\ncreer,epistemic,creo,0\ndecir,stative,digo,1\ncreer,other,x,2\n")
    v = R.load_verbs(spark, str(p))
    assert rows(v, "verb", "verb_type") == [("creer", "epistemic"), ("decir", "stative")]


def test_spread_if_narrow(spark):
    df = spark.range(10).coalesce(1)
    assert R.spread_if_narrow(df, 4).rdd.getNumPartitions() == 4
    wide = spark.range(0, 10, numPartitions=8)
    assert R.spread_if_narrow(wide, 4) is wide


def test_page_meta(spark, tmp_path):
    p = tmp_path / "pm"
    p.mkdir()
    last = dict(PAGE, meta={"next_token": None, "result_count": 0}, data=[])
    (p / "a.json").write_text(json.dumps(PAGE) + "\n" + json.dumps(last) + "\n")
    got = rows(R.page_meta(R.read_pages(spark, str(p))), "page_size", "next_token")
    assert got == sorted([(2, "abc"), (0, None)], key=repr)


def test_any_list_of_a_page_is_a_table(spark, tmp_path):
    """Lists that no schema names, lists below nested objects, items that are no objects; meta is kept whole."""
    import json
    pages = [{"data": [{"id": "1", "text": "a"}, {"id": "2"}], "includes": {"users": [{"id": "u"}], "media": [{"media_key": "m1", "type": "photo"}, {"media_key": "m2"}],
              "deep": {"polls": [{"id": 7, "options": [1, 2]}]}}, "meta": {"result_count": 2, "oldest": [1]}, "codes": [3, "x", None], "empty": []},
             {"data": [{"id": 3}], "title": "no list", "errors": [{"resource_id": "9", "value": "gone"}]}, {}]
    p = tmp_path / "pages.json"
    p.write_text("\n".join(map(json.dumps, pages)) + "\nnot json\n")
    raw = R.read_raw_pages(spark, str(p))
    assert [r["raw"] for r in raw.where("raw is not null").collect()] == ["not json"]
    lists = R.page_lists(raw.where("raw is null").drop("raw"))
    got = {}
    for r in lists.select("table", "pos", F.to_json("item").alias("j")).collect():
        got.setdefault(r["table"], []).append((r["pos"], r["j"]))
    assert {k: len(v) for k, v in got.items()} == {"data": 3, "users": 1, "media": 2, "polls": 1, "codes": 3, "errors": 1}
    assert rows(R.list_table(lists, "media", "media_key string, type string"), "media_key", "type") == [("m1", "photo"), ("m2", None)]
    assert rows(R.list_table(lists, "data", "id string, text string"), "id", "text") == [("1", "a"), ("2", None), ("3", None)]
    assert rows(R.list_table(lists, "polls", "id long, options array<int>"), "id", "options") == [(7, [1, 2])]


def test_pages_are_read_once_however_deep(spark):
    nested = "null"
    for k in range(9):
        nested = json.dumps({f"o{k}": json.loads(nested), "l": [k]})
    made = [(1, '{"a":{"b":{"c":[1,2],"n":null,"e":{}}},"c":[3],"meta":{"x":[1]},"s":5,"none":[]}'), (2, "[[7],{\"z\":[1]},8]"), (3, "5"), (4, None), (1, '{"c":[4]}')]
    pages = spark.createDataFrame(made, "id long, j string").groupBy("id").agg(F.array_sort(F.collect_list("j")).alias("js"))
    lists = R.page_lists(pages.select("id", F.explode_outer("js").alias("j")).select("id", F.parse_json("j").alias("page")))
    got = sorted(((r[0], r[1] or "", r[2], r[3]) for r in lists.select("id", "table", "pos", F.to_json("item").alias("j")).collect()))
    assert got == [(1, "c", 0, "1"), (1, "c", 0, "3"), (1, "c", 0, "4"), (1, "c", 1, "2"), (2, "", 0, "7")]
    plan = lists._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Union" not in plan
    page = spark.range(1).select(F.parse_json(F.lit(nested)).alias("page"))
    assert R.page_lists(page, depth=9).count() == 9
    with pytest.raises(Exception, match="nest deeper than 8"):
        R.page_lists(page).collect()


def test_write_by_verb_is_balanced_by_size(spark, tmp_path):
    verbs = spark.createDataFrame([("creer", "Epistemic"), ("decir", "stative"), ("ver", "stative")], "verb string, verb_type string")
    df = spark.createDataFrame([(1, "creer, decir"), (2, "creer"), (3, None), (4, "nope")], "id long, verbs string")
    K.write_by_verb(df, "verbs", verbs, str(tmp_path / "o"))
    assert rows(spark.read.parquet(str(tmp_path / "o")), "id", "verb_type", "verb") == [(1, "epistemic", "creer"), (1, "stative", "decir"), (2, "epistemic", "creer")]
    assert not (tmp_path / "o" / "verb_type=stative" / "verb=ver").exists()
