import datetime as dt

from pyspark.sql import functions as F

from verbscope.functions import text as T


def one(spark, value, fn, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(fn("t").alias("o")).first()["o"]


def test_mentions_and_breaks(spark):
    assert one(spark, "@ana_1  hola\t\tque\n\ntal", T.normalize_text) == "hola que tal"


def test_fold(spark):
    assert one(spark, "Además ñandú ÇÜ ß œ", T.ascii_fold) == "Ademas nandu CU ss oe"


def test_emoji(spark):
    assert one(spark, "x 😆❤️ y", T.strip_emoji) == "x  y"


def test_que_flag(spark):
    df = spark.createDataFrame([("porque",), ("Que sí",), ("q",), ("qué",), (None,)], "t string")
    got = [r["f"] for r in df.select(T.has_que("t").alias("f")).collect()]
    assert got == [False, True, True, False, None]
    folded = spark.createDataFrame([("qué",)], "t string").select(T.has_que(T.ascii_fold(F.col("t"))).alias("f"))
    assert folded.first()["f"] is True


def test_case_sensitive_que(spark):
    df = spark.createDataFrame([("Que sí",)], "t string")
    assert df.select(T.has_que("t", case_sensitive=True).alias("f")).first()["f"] is False


def test_token_set(spark):
    assert sorted(one(spark, "¡Hola, hola!  mundo", T.token_set)) == ["hola", "mundo"]
    assert one(spark, "", T.token_set) == []


def test_dates(spark):
    df = spark.createDataFrame([("2021-11-07 22:10:00",), ("2021-11-07T22:10:00.000Z",), ("x",)], "t string")
    got = [r["d"] for r in df.select(T.parse_created_at("t").alias("d")).collect()]
    assert got[0] == got[1] == dt.datetime(2021, 11, 7, 22, 10)
    assert got[2] is None


def test_unsigned_ids_stay_strings(spark):
    df = spark.createDataFrame([("18446744073709551615",)], "t string")
    r = df.select(F.col("t").alias("s"), F.col("t").try_cast("bigint").alias("b")).first()
    assert r["s"] == "18446744073709551615" and r["b"] is None


def test_referenced_ids(spark):
    assert one(spark, "[{'type': 'x', 'id': '12'}, {'id': '34'}]", T.extract_ref_ids) == ["12", "34"]


def test_lists(spark):
    assert one(spark, "['a', 'b']", T.parse_list) == ["a", "b"]
    assert one(spark, "[]", T.parse_list) == []
    assert one(spark, "creer, decir", T.split_list) == ["creer", "decir"]


def test_letters_and_dep_tags(spark):
    assert one(spark, "creer, decir!", T.letters_only) == "creerdecir"
    assert one(spark, " creo[ROOT] que[mark]", T.strip_dep_tags) == " creo que"


def test_highlight_neighbours(spark):
    got = one(spark, "que que, queso q", lambda c: T.highlight_terms(c, "que|q"))
    assert got == "<<que>> <<que>>, queso <<q>>"


def test_all_terms(spark):
    df = spark.createDataFrame([("el querido asi",), ("querido",)], "t string")
    got = [r["m"] for r in df.select(T.matches_all_terms("t", [T.word_pattern(["querido"]),
                                                                T.word_pattern(["asi"])]).alias("m")).collect()]
    assert got == [True, False]


def test_fold_by_decomposition(spark):
    import unicodedata
    texts = ["qu\u00e9", "que\u0301", "Vi\u1ec7t Nam \u1ebf \u01b0\u1edb", unicodedata.normalize("NFD", "Vi\u1ec7t Nam \u1ebf"), "\uff21\uff11", "\u0218\u021b",
             "\u0141\u00f3d\u017a", "\u65e5\u672c", "a\u20dd", "\u01c2 \u0434", "plain", "", None, "\u00df\u0153\u2026"]
    want = ["que", "que", "Viet Nam e uo", "Viet Nam e", "A1", "St", "Lodz", "\u65e5\u672c", "a", "\u01c2 \u0434", "plain", "", None, "ssoe..."]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", T.ascii_fold("t").alias("f"))
    assert [r["f"] for r in df.orderBy("k").collect()] == want
    assert T.FOLD_TO.isascii() and len(T.FOLD_FROM) == len(T.FOLD_TO) > 700
