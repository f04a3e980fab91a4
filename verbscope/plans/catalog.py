"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the whole test tables.

Every computed column is aliased to the name used by the matching oracle SQL in
``oracle.py``. Queries over annotated documents share one annotation plan (``_long``): documents ->
segments -> long tokens (partitioned on the segments).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import aggregates as AG
from ..operators import columns as CO
from ..operators import dedup as DD
from ..operators import joins as JN
from ..operators import sampling as SA
from ..operators import sequence as SQ
from ..operators import setops as SE
from ..operators import token_texts as TT
from ..operators import tokens as TK
from .bindings import BINDING_COMPLEMENTISERS, CORPUS_HEADERS, table, verbs_frame


# tables whose rows carry whole texts: heavy per-row work follows the scan
_TEXT_TABLES = ("documents", "conversations", "pages")


def _t(spark, sf, name, spread: bool = True):
    from ..sources.readers import spread_if_narrow
    df = table(spark, sf, name)
    return spread_if_narrow(df) if spread and name in _TEXT_TABLES else df


def _long(spark: SparkSession, sf: str) -> DataFrame:
    # annotate() hash-partitions the segments itself: no extra spread
    return TK.annotate(_t(spark, sf, "documents", spread=False), verbs_frame(spark))


def _dealt(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """``_long``, and the tasks over which its verbs are dealt: an eighth of those of its tokens, one per core at least."""
    docs = _t(spark, sf, "documents", spread=False)
    n = TK.text_tasks(docs)
    return TK.annotate(docs, verbs_frame(spark), partitions=n), max(n // 8, spark.sparkContext.defaultParallelism)


def _texts(spark: SparkSession, sf: str, **pieces) -> DataFrame:
    """One text per piece for every document, those without tokens included."""
    return TT.document_texts(_long(spark, sf), pieces, docs=_t(spark, sf, "documents", spread=False))


def _doc_verbs(spark: SparkSession, sf: str, as_text: bool = False) -> DataFrame:
    """Per document: sorted target verbs; text form joins them with ', ' and is null when there is none."""
    v = TT.document_verbs(_long(spark, sf), docs=_t(spark, sf, "documents", spread=False))
    if as_text:
        v = v.withColumn("verbs", F.when(F.size("verbs") > 0, F.array_join("verbs", ", ")))
    return v


# ---------------------------------------------------------------------------
# flagship: I6 -> F1 -> C2 -> E3
# ---------------------------------------------------------------------------
def que_rate_by_lang(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "lang", TX.normalize_text("text").alias("text_norm"))
    d = DD.dedup_first(d, ["lang", "text_norm"], "doc_id")
    d = d.withColumn("has_que", TX.has_que("text_norm"))
    return AG.flag_rate(d, "has_que", "lang", n_name="n_docs", true_name="n_que", rate_name="que_rate")


def normalize_text(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", TX.normalize_text("text").alias("text_norm"))


def parse_times(spark, sf):
    e = _t(spark, sf, "events")
    raw = (F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
           .when(F.col("event_type") == "error", F.concat(F.lit("x"), F.col("event_id").cast("string")))
           .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    p = e.select("event_id", raw.alias("raw")).withColumn("parsed", TX.parse_created_at("raw"))
    return p.select("event_id", F.unix_millis("parsed").alias("parsed_ms"), F.col("parsed").isNull().alias("bad"))


def ref_ids(spark, sf):
    e = _t(spark, sf, "events")
    refs = F.concat(F.lit("[{'type': 'replied_to', 'id': '"), F.col("event_id").cast("string"),
                    F.lit("'}, {'type': 'quoted', 'id': '"), F.col("user_id").cast("string"), F.lit("'}]"))
    lst = F.concat(F.lit("['"), F.col("event_type"), F.lit("', '"), F.col("user_id").cast("string"), F.lit("']"))
    pair = F.concat_ws(", ", F.col("event_type"), F.col("user_id").cast("string"))
    x = e.select("event_id", TX.extract_ref_ids(refs).alias("ids"), TX.parse_list(lst).alias("lst"),
                 TX.split_list(pair).alias("sp"))
    return x.select("event_id", F.array_join("ids", ",").alias("ref_ids"), F.size("ids").cast("long").alias("n_refs"),
                    F.array_join("lst", "|").alias("parsed_list"), F.size("sp").cast("long").alias("n_split"))


def _file_names(spark, sf):
    d = _t(spark, sf, "documents")
    first = F.lower(F.regexp_extract("text", "^[^\\p{L}]*(\\p{L}+)", 1))
    name = F.concat(F.lit("twitter-"), F.col("lang"), F.lit("-"), first, F.lit("-"), F.col("source"), F.lit(".csv"))
    return d.select("doc_id", name.alias("file_name"))


def topic_from_path(spark, sf):
    from ..sources.readers import topic_from_path as tfp
    return tfp(_file_names(spark, sf), "file_name", verbs_frame(spark)).select("doc_id", "topic")


def keyword_from_path(spark, sf):
    from ..sources.readers import keyword_from_path as kfp
    return kfp(_file_names(spark, sf), "file_name", "twitter-[a-z]+-([^-]+)-").select("doc_id", "keyword")


def select_rename_combine(spark, sf):
    c = _t(spark, sf, "customer")
    c = CO.rename_columns(c, {"c_custkey": "user_id", "c_name": "username", "c_nationkey": "place_id",
                              "not_there": "ignored"})
    c = CO.combine_columns(c, {"segment_place": ["c_mktsegment", "place_id"]}, as_text=True, drop=False)
    c = CO.drop_columns(c, ["c_acctbal", "missing_col"])
    return CO.select_columns(c, ["user_id", "username", "place_id", "segment_place"])


def assign_ids(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id")
    return CO.assign_ids(d, "doc_id", start=1000, name="id")


def batches(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id")
    b = SQ.with_batch_id(d, "doc_id", batch_size=64)
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"))


def assign_ids_wide(spark, sf):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return SQ.with_row_index(_t(spark, sf, "lineitem"), key, name="id", start=1)


ALL_TERMS = (TX.word_pattern(["the"]), TX.word_pattern(["and"]), "ing")


def all_terms(spark, sf):
    d = _t(spark, sf, "documents")
    return d.where(TX.matches_all_terms("text", ALL_TERMS)).select("doc_id")


def verb_then_que(spark, sf):
    return TT.verb_then_que(_long(spark, sf), words=BINDING_COMPLEMENTISERS)


def known_verbs(spark, sf):
    t = _long(spark, sf).where(F.col("pos") == "VERB").select(TX.letters_only("lemma").alias("verb"))
    known = JN.semi_join(t, verbs_frame(spark), "verb", broadcast_other=True)
    return AG.value_counts(known, "verb")


def unknown_verbs(spark, sf):
    t = _long(spark, sf).where(F.col("pos") == "VERB").select(TX.letters_only("lemma").alias("verb"))
    unknown = JN.anti_join(t, verbs_frame(spark), "verb")
    return AG.value_counts(unknown, "verb")


def _topic_col():
    # every document gets a topic: verb with ord = (number in its source name) mod 12
    return F.pmod(F.regexp_extract("source", "[0-9]+", 0).cast("int"), F.lit(12))


def query_match(spark, sf):
    v = verbs_frame(spark)
    d = _t(spark, sf, "documents").withColumn("_ord", _topic_col())
    d = d.join(F.broadcast(v.select(F.col("ord").alias("_ord"), F.col("verb").alias("topic"))), "_ord")
    return TK.query_match(d, v, "doc_id", "text", "topic")


def places_left_join(spark, sf):
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation").where(F.col("n_regionkey") != 0)
    j = JN.left_join(c, n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")),
                     "c_nationkey")
    return j.groupBy("country").agg(F.count(F.lit(1)).alias("n"))


def flagged_users(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = _t(spark, sf, "supplier").where(F.col("s_acctbal") < 0)
    return JN.mark_join(c, "c_nationkey", s, "s_nationkey").select("c_custkey", "flagged")


def _registry(spark, sf):
    return _t(spark, sf, "labels").select(F.col("doc_id").alias("id"))


def registry_kept(spark, sf):
    from ..streaming.state import update_registry
    kept, _ = update_registry(_t(spark, sf, "documents"), "doc_id", _registry(spark, sf))
    return kept.select("doc_id")


def registry_update(spark, sf):
    from ..streaming.state import update_registry
    _, reg = update_registry(_t(spark, sf, "documents"), "doc_id", _registry(spark, sf))
    return reg


def registry_duplicates(spark, sf):
    from ..streaming.state import registry_duplicates as rd
    e = _t(spark, sf, "events").select(F.col("event_type").alias("file"), F.col("user_id").alias("id"))
    reg = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"))
    return rd(e, "file", "id", reg)


def duplicate_report(spark, sf):
    return AG.duplicate_report(_t(spark, sf, "documents"), "text", "source")


def dedup_first(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text", "source")
    return DD.dedup_first(d, "text", "doc_id").select("doc_id")


def dedup_per_folder(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text", "source")
    return DD.dedup_first_per_folder(d, "source", "text", "doc_id").select("source", "doc_id")


def _pulls(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "text", "source")
    # previous pull: the labelled documents, pulled earlier under other ids
    prev = (docs.join(_t(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
            .withColumn("doc_id", F.col("doc_id") + F.lit(1_000_000)))
    return docs, prev


def merge_pull(spark, sf):
    new, prev = _pulls(spark, sf)
    return SE.merge_pull(new, prev, "text", "doc_id").select("doc_id", "is_new")


def merge_report(spark, sf):
    new, prev = _pulls(spark, sf)
    ev = _t(spark, sf, "events").select("event_id", "user_id", "event_type")
    ev_prev = ev.where(F.col("event_type") == "view")
    return AG.merge_report({
        "documents": (new, prev, "text"),
        "events": (ev, ev_prev, ["user_id", "event_type"]),
    })


def _events_with_nulls(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", "ts", "user_id", "event_type",
                    F.when(F.col("value") >= 5, F.col("value")).alias("value"),
                    F.when(F.col("event_type") != "error", F.col("props")).alias("props"))


def null_profile(spark, sf):
    return AG.null_profile(_events_with_nulls(spark, sf))


def table_profile(spark, sf):
    return AG.table_profile(_events_with_nulls(spark, sf))


def null_text_split(spark, sf):
    e = _events_with_nulls(spark, sf)
    kept = e.na.drop(subset=["props"])
    flagged = kept.withColumn("high", F.col("value") > 50)
    hi, lo = SE.split_by_flag(flagged, "high")
    return (hi.select(F.lit("high").alias("part"), "event_id")
            .unionByName(lo.select(F.lit("not_high").alias("part"), "event_id")))


def verb_type_counts(spark, sf):
    return AG.verb_type_counts(_doc_verbs(spark, sf), "doc_id", "verbs", verbs_frame(spark))


def write_by_verb_counts(spark, sf):
    from ..sources.sinks import by_verb_rows
    n = _doc_verbs(spark, sf, as_text=True).where(F.col("verbs").isNotNull())
    rows = by_verb_rows(n, "verbs", verbs_frame(spark))
    return rows.groupBy("verb_type", "verb").agg(F.count(F.lit(1)).alias("n"))


def top_tokens(spark, sf):
    t = _long(spark, sf).where(~F.col("is_punct")).select(F.lower("text").alias("word"))
    return SA.top_k(AG.value_counts(t, "word"), 20, ["n", "word"], [True, False])


def target_verbs(spark, sf):
    return _doc_verbs(spark, sf, as_text=True)


def mark_text(spark, sf):
    return _texts(spark, sf, normalized=TT.mark_piece("twitter"))


def mark_text_corpus(spark, sf):
    return _texts(spark, sf, normalized=TT.mark_piece("corpus"))


def mark_text_variants(spark, sf):
    return _texts(spark, sf, normalized=TT.mark_piece("variants"))


def dep_text(spark, sf):
    return _texts(spark, sf, dependencies=TT.dep_piece())


def pos_text(spark, sf):
    return _texts(spark, sf, pos=TT.pos_piece())


def detail_text(spark, sf):
    return _texts(spark, sf, details=TT.detail_piece())


def has_ccomp(spark, sf):
    return TT.document_has_ccomp(_long(spark, sf), docs=_t(spark, sf, "documents", spread=False))


def multi_verb(spark, sf):
    return TK.multi_verb(_doc_verbs(spark, sf, as_text=True), "verbs").select("doc_id", "verbs")


def with_target_verbs(spark, sf):
    return TK.has_target_verbs(_doc_verbs(spark, sf), "verbs").select("doc_id")


def process_batch(spark, sf):
    return TT.process_batch(_long(spark, sf), text=_t(spark, sf, "documents", spread=False))


def process_batch_corpus(spark, sf):
    return TT.process_batch(_long(spark, sf), mode="corpus")


def pos_pairs(spark, sf):
    return TK.parse_pos_text(_texts(spark, sf, pos=TT.pos_piece()), "pos", "doc_id")


def verb_runs(spark, sf):
    return TK.verb_runs(_long(spark, sf))


def ccomp_heads(spark, sf):
    long, tasks = _dealt(spark, sf)
    return TT.head_pairs(long, partitions=tasks).select("doc_id", F.col("head").alias("head_lemma"), "head_text", "head_i",
                                                         F.col("ccomp").alias("ccomp_text"), "ccomp_i")


def verb_distance(spark, sf):
    long, tasks = _dealt(spark, sf)
    return TT.head_pairs(long, partitions=tasks).select(
        "doc_id", "head", "head_i", "ccomp_i", "ccomp_dist", "v2", "v2_i", "v2_dist")


def mark_heads(spark, sf):
    long, tasks = _dealt(spark, sf)
    return TT.marked_heads(long, last_per_lemma=True, partitions=tasks).select(
        "doc_id", "head", "head_i", "ccomp_i", "v2_i", "text_norm")


def dep_map(spark, sf):
    m = TK.dep_map(_long(spark, sf))
    return m.select("doc_id", F.explode("dep_map").alias("word", "dep"))


def standardize_columns(spark, sf):
    d = _t(spark, sf, "documents")
    src = [F.col("doc_id").cast("string"), F.col("source"), F.lit(None).cast("string"), F.lit(None).cast("string"),
           F.lit("corpus"), F.lit(None).cast("string"), F.lit("written"), F.lit("web"), F.lit(None).cast("string"),
           F.col("lang"), F.lit(None).cast("string"), F.lit("prose"), F.lit(None).cast("string"), F.col("text")]
    wide = d.select(*[c.alias(h) for c, h in zip(src, CORPUS_HEADERS)])
    std = CO.standardize_columns(wide)
    out = CO.add_features(std, {"has_que": TX.has_que("concordancia")})
    return out.select("bibliografia", "autor", "pais", "tipologia", "has_que")


def renormalised_join(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text")
    norm = d.select("doc_id", TX.normalize_text("text").alias("text_norm"))
    j = JN.left_join(d, norm, "doc_id", broadcast_dim=False)
    return j.select("doc_id", F.length("text").alias("n_orig"), F.length("text_norm").alias("n_norm"))


def id_sets(spark, sf):
    ids = _t(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    reg = _registry(spark, sf)
    return (SE.id_union(reg, ids).select(F.lit("union").alias("set_name"), "id")
            .unionByName(SE.id_intersect(reg, ids).select(F.lit("seen").alias("set_name"), "id"))
            .unionByName(SE.id_difference(ids, reg).select(F.lit("unseen").alias("set_name"), "id")))


def merge_tables(spark, sf):
    tabs = {
        "documents": (_t(spark, sf, "documents").select("doc_id", "text", "source"), "doc_id", "doc_id"),
        "customer": (_t(spark, sf, "customer"), "c_custkey", "c_custkey"),
        "nation": (_t(spark, sf, "nation"), "n_nationkey", "n_nationkey"),
    }
    return SE.merge_tables_report(tabs, copies=2)


def clean_labels(spark, sf):
    n = _doc_verbs(spark, sf, as_text=True)
    return n.where(F.col("verbs").isNotNull()).select("doc_id", TX.letters_only("verbs").alias("label"))


def strip_dep_tags(spark, sf):
    n = _texts(spark, sf, dependencies=TT.dep_piece())
    return n.select("doc_id", TX.strip_dep_tags("dependencies").alias("text"))


def highlight(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select("doc_id", TX.highlight_terms(F.lower("text"), "que|q|the").alias("text"))


def explode_verbs(spark, sf):
    return TK.explode_verbs(_doc_verbs(spark, sf), "verbs").select("doc_id", "verb")


def explode_heads(spark, sf):
    long, tasks = _dealt(spark, sf)
    return TT.explode_heads(long, partitions=tasks)


def head_rows(spark, sf):
    return SA.head(_t(spark, sf, "documents").select("doc_id"), 10, "doc_id")


def tail_rows(spark, sf):
    return SA.tail(_t(spark, sf, "documents").select("doc_id"), 10, "doc_id")


def row_at(spark, sf):
    return SA.row_at(_t(spark, sf, "documents").select("doc_id", "lang"), 100, "doc_id")


def annotate(spark, sf):
    return _long(spark, sf).select("doc_id", "i", F.col("text").alias("w"), "lemma", "pos", "head", "dep")


def page_batches(spark, sf):
    c = _t(spark, sf, "conversations").select(
        F.col("conv_id").alias("topic"), F.col("turn").alias("page"),
        F.coalesce(F.pmod(F.length("text"), F.lit(100)), F.lit(0)).cast("long").alias("rows"))
    return SQ.page_batches(c, "topic", "page", "rows", batch_size=150, num_batches=2).select(
        "topic", "page", "batch")


def sample_fraction(spark, sf):
    return SA.sample_fraction(_t(spark, sf, "documents").select("doc_id"), 0.1, "doc_id", seed=7)


def sample_n(spark, sf):
    return SA.sample_n(_t(spark, sf, "documents").select("doc_id"), 25, "doc_id", seed=7)


QUERIES = {
    "que_rate_by_lang": que_rate_by_lang,
    "normalize_text": normalize_text,
    "parse_times": parse_times,
    "ref_ids": ref_ids,
    "topic_from_path": topic_from_path,
    "keyword_from_path": keyword_from_path,
    "select_rename_combine": select_rename_combine,
    "assign_ids": assign_ids,
    "assign_ids_wide": assign_ids_wide,
    "batches": batches,
    "all_terms": all_terms,
    "verb_then_que": verb_then_que,
    "known_verbs": known_verbs,
    "unknown_verbs": unknown_verbs,
    "query_match": query_match,
    "places_left_join": places_left_join,
    "flagged_users": flagged_users,
    "registry_kept": registry_kept,
    "registry_update": registry_update,
    "registry_duplicates": registry_duplicates,
    "duplicate_report": duplicate_report,
    "dedup_first": dedup_first,
    "dedup_per_folder": dedup_per_folder,
    "merge_pull": merge_pull,
    "merge_report": merge_report,
    "null_profile": null_profile,
    "table_profile": table_profile,
    "null_text_split": null_text_split,
    "verb_type_counts": verb_type_counts,
    "write_by_verb_counts": write_by_verb_counts,
    "top_tokens": top_tokens,
    "target_verbs": target_verbs,
    "multi_verb": multi_verb,
    "with_target_verbs": with_target_verbs,
    "mark_text": mark_text,
    "mark_text_corpus": mark_text_corpus,
    "mark_text_variants": mark_text_variants,
    "dep_text": dep_text,
    "pos_text": pos_text,
    "detail_text": detail_text,
    "has_ccomp": has_ccomp,
    "process_batch": process_batch,
    "process_batch_corpus": process_batch_corpus,
    "pos_pairs": pos_pairs,
    "verb_runs": verb_runs,
    "ccomp_heads": ccomp_heads,
    "verb_distance": verb_distance,
    "mark_heads": mark_heads,
    "dep_map": dep_map,
    "standardize_columns": standardize_columns,
    "renormalised_join": renormalised_join,
    "id_sets": id_sets,
    "merge_tables": merge_tables,
    "clean_labels": clean_labels,
    "strip_dep_tags": strip_dep_tags,
    "highlight": highlight,
    "explode_verbs": explode_verbs,
    "explode_heads": explode_heads,
    "head_rows": head_rows,
    "tail_rows": tail_rows,
    "row_at": row_at,
    "annotate": annotate,
    "page_batches": page_batches,
    "sample_fraction": sample_fraction,
    "sample_n": sample_n,
}
