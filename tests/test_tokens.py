from pyspark.sql import functions as F

from verbscope.operators import tokens as TK

from .conftest import rows

# Unit-test verb dimension (classes are fixture values, not linguistic claims).
UNIT_VERBS = [("creer", "epistemic", "creo crees cree", 0), ("saber", "epistemic", "sé sabes sabe", 1),
              ("parecer", "epistemic", "parece", 2), ("acordar", "epistemic", "acuerdo", 3),
              ("querer", "volitional", "quiero quiere", 4), ("esperar", "volitional", "espero", 5),
              ("decir", "stative", "digo dice", 6), ("temer", "stative", "temo teme", 7)]


def verbs(spark):
    return spark.createDataFrame(UNIT_VERBS, "verb string, verb_type string, indicativo string, ord int")


def hand_doc(spark, toks, doc_id=1):
    """toks: (text, pos, dep, head, lemma) in order; tag = pos."""
    data = [(doc_id, i, t, (lem or t.lower()), p, p, d, h, None, False, p == "PUNCT")
            for i, (t, p, d, h, lem) in enumerate(toks)]
    long = spark.createDataFrame(
        data, "doc_id long, i int, text string, lemma string, pos string, tag string, dep string, head int, "
              "morph string, is_stop boolean, is_punct boolean")
    long = TK._target_flags(long, verbs(spark))
    return TK.add_token_features(long)


DIST = [("creo", "VERB", "ROOT", 0, "creer"), ("que", "SCONJ", "mark", 5, None), (",", "PUNCT", "punct", 5, None),
        ("ella", "PRON", "nsubj", 5, None), ("quiere", "AUX", "aux", 5, "querer"), ("venir", "VERB", "ccomp", 0, None)]


def test_distance_hand_case(spark):
    n = TK.nest_tokens(hand_doc(spark, DIST))
    r = TK.next_verb_distance(n).first()
    assert (r["head"], r["head_i"], r["ccomp_i"], r["ccomp_dist"], r["v2"], r["v2_i"], r["v2_dist"]) == \
        ("creer", 0, 5, 3, "venir", 5, 3)


def test_no_v2(spark):
    toks = [("creo", "VERB", "ROOT", 0, "creer"), ("que", "SCONJ", "mark", 2, None),
            ("cosas", "NOUN", "ccomp", 0, None)]
    r = TK.next_verb_distance(TK.nest_tokens(hand_doc(spark, toks))).first()
    assert r["v2"] is None and r["v2_dist"] is None and r["ccomp_dist"] == 1


def test_ccomp_before_head(spark):
    toks = [("venir", "VERB", "ccomp", 2, None), (",", "PUNCT", "punct", 2, None), ("creo", "VERB", "ROOT", 2, "creer")]
    r = TK.next_verb_distance(TK.nest_tokens(hand_doc(spark, toks))).first()
    assert r["ccomp_dist"] == 0


def test_mark_heads_v2_is_ccomp(spark):
    n = TK.nest_tokens(hand_doc(spark, DIST))
    r = TK.next_verb_distance(n, with_text=True).first()
    assert r["text_norm"] == " >>CREO QUE , ella quiere VENIR<<"


def test_mark_heads_v2_differs(spark):
    toks = [("creo", "VERB", "ROOT", 0, "creer"), ("que", "SCONJ", "mark", 3, None), ("sabe", "VERB", "dep", 0, None),
            ("venir", "VERB", "ccomp", 0, None)]
    r = TK.next_verb_distance(TK.nest_tokens(hand_doc(spark, toks)), with_text=True).first()
    assert r["v2"] == "sabe" and r["v2_dist"] == 1 and r["ccomp_dist"] == 2
    assert r["text_norm"] == " >>CREO QUE SABE[V2] VENIR<<"


def test_all_pairs_and_last_per_lemma(spark):
    toks = [("creo", "VERB", "ROOT", 0, "creer"), ("venir", "VERB", "ccomp", 0, None),
            ("y", "CCONJ", "cc", 3, None), ("ir", "VERB", "ccomp", 0, None)]
    n = TK.nest_tokens(hand_doc(spark, toks))
    assert TK.ccomp_heads(n).count() == 2
    last = TK.ccomp_heads(n, last_per_lemma=True).first()
    assert last["ccomp_i"] == 3


MARK = [("Creo", "VERB", "ROOT", 0, "creer"), ("que", "SCONJ", "mark", 2, None), ("sabe", "VERB", "ccomp", 0, "saber"),
        (".", "PUNCT", "punct", 0, None)]


def test_text_outputs(spark):
    n = TK.nest_tokens(hand_doc(spark, MARK))
    r = n.select(TK.mark_text(mode="twitter").alias("tw"), TK.mark_text(mode="corpus").alias("co"),
                 TK.mark_text(mode="variants").alias("va"), TK.target_verbs().alias("v"),
                 TK.dep_text().alias("d"), TK.pos_text().alias("p"), TK.pos_text(drop_punct=True).alias("pc"),
                 TK.detail_text().alias("de"), TK.has_ccomp().alias("h")).first()
    assert r["tw"] == " CREO QUE <<SABE>>."
    assert r["co"] == " creo QUE <<SABE>>."
    assert r["va"] == " CREO QUE <<SABE>> ."
    assert r["v"] == "creer, saber"
    assert r["d"] == " creo[ROOT] que[mark] sabe[ccomp] ."
    assert r["p"] == "Creo(VERB) que(SCONJ) sabe(VERB) .(PUNCT)"
    assert r["pc"] == "Creo(VERB) que(SCONJ) sabe(VERB)"
    assert r["de"] == "<Creo>(creer,False) <que>(que,False) <sabe>(saber,False)"
    assert r["h"] is True


def test_dep_map_last_wins(spark):
    toks = [("Que", "SCONJ", "mark", 0, None), ("creo", "VERB", "ROOT", 1, "creer"), ("que", "SCONJ", "obj", 1, None)]
    m = TK.dep_map(hand_doc(spark, toks)).first()["dep_map"]
    assert m == {"que": "obj", "creo": "ROOT"}


def test_pos_text_parse(spark):
    df = spark.createDataFrame([(1, "va(VERB) a(ADP) :)")], "doc_id long, pos string")
    got = rows(TK.parse_pos_text(df, "pos", "doc_id"), "i", "token", "pos")
    assert got == [(0, "va", "VERB"), (1, "a", "ADP"), (2, ":)", None)]


def test_pos_text_repeats_stay(spark):
    df = spark.createDataFrame([(1, "a(ADP) a(ADP)")], "doc_id long, pos string")
    assert TK.parse_pos_text(df, "pos", "doc_id").count() == 2


def runs_of(spark, toks):
    long = spark.createDataFrame([(1, i, t, p) for i, (t, p) in enumerate(toks)],
                                 "doc_id long, i int, text string, pos string")
    return [(r["n_verbs"], r["text"]) for r in TK.verb_runs(long).orderBy("run").collect()]


def test_verb_runs(spark):
    toks = [("va", "VERB"), ("a", "ADP"), ("comer", "VERB"), ("pan", "NOUN"), ("a", "ADP"), ("quiere", "VERB"),
            ("ir", "VERB")]
    assert runs_of(spark, toks) == [(2, "va a comer"), (2, "quiere ir")]


def test_verb_runs_single_verb(spark):
    assert runs_of(spark, [("quiere", "VERB"), ("pan", "NOUN")]) == []


def test_verb_runs_trailing_adp_kept(spark):
    assert runs_of(spark, [("quiere", "AUX"), ("ir", "VERB"), ("a", "ADP"), (".", "PUNCT")]) == [(2, "quiere ir a")]


def test_default_annotator(spark):
    docs = spark.createDataFrame([(7, "decir que temer, saber.")], "doc_id long, text string")
    long = TK.annotate(docs, verbs(spark))
    got = rows(long, "i", "text", "pos", "head", "dep")
    assert got == [(0, "decir", "VERB", 0, "dep"), (1, "que", "SCONJ", 0, "dep"), (2, "temer", "VERB", 0, "ccomp"),
                   (3, ",", "PUNCT", 2, "dep"), (4, "saber", "VERB", 2, "ccomp"), (5, ".", "PUNCT", 4, "dep")]
    n = TK.nest_tokens(long)
    assert n.select(TK.target_verbs().alias("v")).first()["v"] == "decir, saber, temer"


def test_annotator_empty_and_null_text(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "   ")], "doc_id long, text string")
    assert TK.annotate(docs, verbs(spark)).count() == 0


def test_pluggable_annotator(spark):
    import pandas as pd

    def annotator(batches):
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                for i, w in enumerate(text.split()):
                    out.append((doc_id, i, w, w, "VERB", "VERB", "ccomp" if i else "ROOT", 0, None, False, False))
            yield pd.DataFrame(out, columns=["doc_id"] + TK.TOKEN_COLS)

    docs = spark.createDataFrame([(1, "creer saber")], "doc_id long, text string")
    long = TK.annotate_with(docs, annotator, verbs(spark))
    r = TK.next_verb_distance(TK.nest_tokens(long)).first()
    assert (r["head"], r["ccomp_i"], r["v2_i"]) == ("creer", 1, 1)


def test_verb_then_que(spark):
    toks = [("creo", "VERB", "ROOT", 0, "creer"), ("que", "SCONJ", "mark", 0, None), ("creo", "VERB", "x", 0, "creer"),
            (",", "PUNCT", "p", 0, None), ("que", "SCONJ", "mark", 0, None)]
    got = rows(TK.verb_then_que(TK.nest_tokens(hand_doc(spark, toks))), "verb", "n")
    assert got == [("creer", 1)]


def test_explode_verbs_outer(spark):
    df = spark.createDataFrame([(1, "creer, decir"), (2, None)], "doc_id long, verbs string")
    got = rows(TK.explode_verbs(df), "doc_id", "verb")
    assert got == [(1, "creer"), (1, "decir"), (2, None)]


def test_query_match(spark):
    docs = spark.createDataFrame([(1, "creer", "Yo creo que sí"), (2, "creer", "nada"), (3, "decir", "él DICE")],
                                 "doc_id long, topic string, text string")
    got = rows(TK.query_match(docs, verbs(spark), "doc_id", "text", "topic"), "topic", "matched", "total")
    assert got == [("creer", 1, 2), ("decir", 1, 1)]


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    long = TK.annotate(empty, verbs(spark))
    assert long.count() == 0
    n = TK.nest_tokens(long)
    assert TK.next_verb_distance(n).count() == 0
    assert TK.verb_runs(long).count() == 0
    assert "tokens" in n.columns


def test_distance_table(spark):
    n = TK.nest_tokens(hand_doc(spark, DIST))
    r = TK.distance_table(n).first()
    assert r["verbs"] == "creer" and r["ccomp_dist"] == 3 and r["text_norm"].startswith(" >>CREO")
    assert r["details"].startswith("<creo>(creer,False)")
