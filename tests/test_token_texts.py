"""Long-form token outputs: equal to the nested ones, and the same however long documents are cut."""

import random
import re

from pyspark.sql import functions as F

from verbscope.operators import token_texts as TT
from verbscope.operators import tokens as TK

from .conftest import rows
from .test_tokens import DIST, MARK, hand_doc, verbs

WORDS = ["decir", "que", "temer", ",", "saber", ".", "ha", "a", "casa", "el", "Q", "creer!", "año", "(ir)", "comer", "de", "\n", "\t"]


def texts(n_long=900, seed=5):
    rng = random.Random(seed)
    made = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 30))) for _ in range(12)]
    big = " ".join(rng.choice(WORDS) for _ in range(n_long))
    return [(k, t) for k, t in enumerate(made)] + [(100, big), (101, "  " * 300 + "decir temer" + " " * 300), (102, "x" * 700 + " saber " + "y" * 700),
                                                   (103, ""), (104, None), (105, " \n "), (None, big[:400])]


def frames(spark, size):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    return docs, TK.annotate(docs, verbs(spark), segment_chars=size)


def everything(docs, long):
    made = TT.document_texts(long, {"tw": TT.mark_piece(), "co": TT.mark_piece("corpus"), "va": TT.mark_piece("variants"),
                                    "dep": TT.dep_piece(), "pos": TT.pos_piece(), "pc": TT.pos_piece(True), "de": TT.detail_piece()},
                             docs=docs, verbs="verbs", ccomp="cc")
    return {
        "tokens": rows(long.drop("whole", "seg")), "texts": rows(made), "runs": rows(TK.verb_runs(long)),
        "pairs": rows(TT.head_pairs(long).drop("whole")), "last": rows(TT.head_pairs(long, last_per_lemma=True).drop("whole")),
        "marked": rows(TT.marked_heads(long)), "table": rows(TT.distance_table(long, last_per_lemma=True)),
        "batch": rows(TT.process_batch(long)), "verbs": rows(TT.document_verbs(long, docs)), "cc": rows(TT.document_has_ccomp(long, docs)),
        "que": rows(TT.verb_then_que(long)), "heads": rows(TT.explode_heads(long)), "map": rows(TK.dep_map(long).select("doc_id", F.explode("dep_map")))}


def test_cut_documents_give_the_same(spark):
    whole, cut = (everything(*frames(spark, size)) for size in (10**6, 64))
    for name, want in whole.items():
        assert cut[name] == want, name
        assert want or name == "que"
    assert len(whole["texts"]) == len(texts())
    empty = {r[0]: r for r in cut["texts"] if r[0] in (103, 104, 105)}
    assert len(empty) == 3 and all(r[1] is None and set(r[2:9]) == {""} and r[9] is False for r in empty.values())


def test_long_form_equals_nested(spark):
    docs, long = frames(spark, 10**6)
    long = long.where("doc_id is not null")
    nested = TK.nest_tokens(long)
    want = nested.select("doc_id", TK.target_verbs().alias("v"), TK.mark_text().alias("tw"), TK.mark_text(mode="corpus").alias("co"),
                         TK.mark_text(mode="variants").alias("va"), TK.dep_text().alias("dep"), TK.pos_text().alias("pos"),
                         TK.pos_text(drop_punct=True).alias("pc"), TK.detail_text().alias("de"), TK.has_ccomp().alias("cc"))
    got = TT.document_texts(long, {"tw": TT.mark_piece(), "co": TT.mark_piece("corpus"), "va": TT.mark_piece("variants"), "dep": TT.dep_piece(),
                                   "pos": TT.pos_piece(), "pc": TT.pos_piece(True), "de": TT.detail_piece()}, verbs="v", ccomp="cc")
    assert rows(got) == rows(want)
    cols = ["doc_id", "head", "head_text", "head_i", "ccomp", "ccomp_i", "ccomp_dist", "v2", "v2_i", "v2_dist", "text_norm"]
    for last in (False, True):
        assert rows(TT.marked_heads(long, last_per_lemma=last), *cols) == rows(
            TK.next_verb_distance(nested, with_text=True, last_per_lemma=last), *cols)
    assert rows(TT.process_batch(long)) == rows(TK.process_batch(nested))
    assert rows(TT.verb_then_que(long)) == rows(TK.verb_then_que(nested))


def test_hand_documents(spark):
    """A parser's tokens: heads anywhere, a ccomp before its head, AUX that isn't V2, a tag that differs from is_punct."""
    r = TT.marked_heads(hand_doc(spark, DIST)).first()
    assert (r["head"], r["ccomp_i"], r["ccomp_dist"], r["v2"], r["v2_i"], r["v2_dist"]) == ("creer", 5, 3, "venir", 5, 3)
    assert r["text_norm"] == " >>CREO QUE , ella quiere VENIR<<"
    before = [("venir", "VERB", "ccomp", 2, None), (",", "PUNCT", "punct", 2, None), ("creo", "VERB", "ROOT", 2, "creer")]
    r = TT.head_pairs(hand_doc(spark, before)).first()
    assert (r["ccomp_dist"], r["v2"], r["v2_dist"]) == (0, None, None)
    many = [("creo", "VERB", "ROOT", 0, "creer"), ("venir", "VERB", "ccomp", 0, None), ("y", "CCONJ", "cc", 3, None), ("ir", "VERB", "ccomp", 0, None)]
    assert TT.head_pairs(hand_doc(spark, many)).count() == 2
    assert [r["ccomp_i"] for r in TT.head_pairs(hand_doc(spark, many), last_per_lemma=True).collect()] == [3]
    r = TT.document_texts(hand_doc(spark, MARK), {"tw": TT.mark_piece(), "de": TT.detail_piece()}).first()
    assert (r["tw"], r["de"]) == (" CREO QUE <<SABE>>.", "<Creo>(creer,False) <que>(que,False) <sabe>(saber,False)")


def test_distances_go_by_the_tag(spark):
    data = [(1, 0, "creo", "creer", "VERB", "VERB", "ROOT", 0, False), (1, 1, "...", "...", "PUNCT", "PUNCT", "p", 0, False),
            (1, 2, "#", "#", "SYM", "SYM", "x", 0, True), (1, 3, "ir", "ir", "VERB", "VERB", "ccomp", 0, False)]
    long = spark.createDataFrame(data, "doc_id long, i int, text string, lemma string, pos string, tag string, dep string, head int, is_punct boolean")
    long = TK.add_token_features(TK._target_flags(long.withColumn("is_stop", F.lit(False)), verbs(spark)))
    assert TT.head_pairs(long).first()["ccomp_dist"] == 1 and TK.next_verb_distance(TK.nest_tokens(long)).first()["ccomp_dist"] == 1


def test_one_long_document_spreads(spark):
    big = " ".join(["decir", "que", "temer", "algo"] * 20_000)
    docs = spark.createDataFrame([(1, big)] + [(k, "decir que") for k in range(2, 50)], "doc_id long, text string")
    long = TK.annotate(docs, verbs(spark), partitions=16, segment_chars=4096)
    held = [r["n"] for r in long.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(held) < sum(held) / 3
    last = long.where("doc_id = 1").agg(F.max("i"), F.max("c"), F.max("rc"), F.countDistinct("i")).first()
    assert tuple(last) == (79_999, 80_000, 40_000, 80_000)


def test_filters_reach_the_scan(spark, tmp_path):
    docs = spark.createDataFrame([(1, "decir que")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d"))
    plan = TK.annotate(read, verbs(spark)).where("not whole")._jdf.queryExecution().optimizedPlan().toString()
    generate = plan.index("Generate posexplode(_pieces") if "Generate posexplode(_pieces" in plan else plan.index("Generate")
    assert "char_length(text" in plan[generate:]
    once = TT.document_texts(TK.annotate(read, verbs(spark)).where("whole").drop("whole", "seg"), {"p": TT.pos_piece()})
    assert once.count() == 1


def test_a_task_turns_a_bounded_text_into_tokens(spark):
    """However long all texts are together: left to itself, Spark merges partitions by their compressed bytes."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('decir que temer ', 1000)").alias("text"))
    segs = TK.segments(docs)
    held = segs.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("piece")).alias("n"))
    assert max(r["n"] for r in held.collect()) < 2 * TK.TASK_BYTES
    assert TK.text_tasks(docs) == -(-48_000_000 // TK.TASK_BYTES)
    assert TK.text_tasks(docs.limit(0)) == TK.text_tasks(docs.select("doc_id", F.lit(None).cast("string").alias("text"))) == spark.sparkContext.defaultParallelism


def test_texts_are_made_before_pairs_meet_them(spark):
    docs, long = frames(spark, 10**6)
    made = TT.distance_table(long).drop("text_norm")
    above = made._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "array_join" not in above.replace("array_join(array_sort(_verbs", "")


def exchanges(df, key):
    """What rows are dealt by wherever ``key`` takes part."""
    return re.findall(rf"hashpartitioning\([^)]*\b{key}#[^)]*\)", df._jdf.queryExecution().executedPlan().toString())


def test_pairs_of_uncut_documents_are_not_shuffled(spark):
    """However many verbs: only those of cut documents are, over as many tasks as the caller says."""
    _, long = frames(spark, 64)
    for df in (TT.head_pairs(long, partitions=7), TT.marked_heads(long, partitions=7), TT.distance_table(long, partitions=7)):
        dealt = exchanges(df, "_key")
        assert len(dealt) == 2 and all(d.endswith(", 7)") for d in dealt)
    for last in (False, True):
        assert rows(TT.head_pairs(long, last_per_lemma=last, partitions=7)) == rows(TT.head_pairs(long, last_per_lemma=last))


def test_words_of_uncut_documents_are_gathered_before_the_shuffle(spark):
    docs = spark.createDataFrame([(1, "decir que decir"), (1, "temer que " + "decir casa " * 40), (2, "a b a"), (None, "que")], "doc_id long, text string")
    long = TK.annotate(docs, verbs(spark), segment_chars=64)
    got = {r[0]: r[1] for r in TK.dep_map(long).collect()}
    want = TK.dep_map(long.drop("whole", "seg")).collect()
    assert got == {r[0]: r[1] for r in want} and len(want) == len(got) == 3
    assert len(got[1]) == 4
    word = "_groupingexpression"
    assert [len(exchanges(TK.dep_map(x), word)) for x in (long, long.where("whole"), long.drop("whole", "seg"))] == [1, 0, 1]
