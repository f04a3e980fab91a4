"""J2-J10, J12-J17, F4, C5 on the long form: strings and pairs of documents of any length.

* **Texts.** Each token's string is made row by row, inside generated code; a segment's strings are put
  together in token order, and only the few documents that are cut into segments need a second step.
  Documents without tokens are rows too: their texts are empty.
* **Pairs.** A head and its complement, and a head and the next verb, are matched by key: rows that hold
  a value and rows that ask for it meet in one window per (document, number). Only verbs and complements
  take part. Documents of one segment are matched on the segments' partitioning, without a shuffle; a long
  document's keys spread over all tasks.

Frames without ``whole`` and ``seg`` (see ``tokens.segments``) are taken as whole documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import QUE_VARIANTS, QUE_WORDS
from .tokens import VERB_TAGS, _is_word_in, _pybool, has_tokens, is_verb_tag

# name -> (token's string or null, separator)
Pieces = dict[str, tuple[Column, str]]


def mark_piece(mode: str = "twitter") -> tuple[Column, str]:
    """J3/J4/J5 (see ``tokens.mark_text``)."""
    t = F.col("text")
    up, lo, ccomp = F.upper(t), F.lower(t), F.col("dep") == "ccomp"
    shown = F.concat(F.lit("<<"), up, F.lit(">>"))
    body = F.when(F.col("is_punct"), t) if mode == "variants" else None
    body = (body if body is not None else F).when(_is_word_in(t, QUE_VARIANTS if mode == "variants" else QUE_WORDS), up)
    body = body.when(F.col("is_target") & ccomp, shown)
    body = (body if mode == "corpus" else body.when(F.col("is_target"), up)).otherwise(lo)
    spaced = F.concat(F.lit(" "), body)
    return (spaced if mode == "variants" else F.when(F.col("pos") == "PUNCT", t).otherwise(spaced)), ""


def dep_piece() -> tuple[Column, str]:
    """J7."""
    return F.when(F.col("pos") == "PUNCT", F.concat(F.lit(" "), "text")).otherwise(
        F.concat(F.lit(" "), F.lower("text"), F.lit("["), "dep", F.lit("]"))), ""


def pos_piece(drop_punct: bool = False) -> tuple[Column, str]:
    """J9."""
    piece = F.concat("text", F.lit("("), F.upper("pos"), F.lit(")"))
    return (F.when(F.col("pos") != "PUNCT", piece) if drop_punct else piece), " "


def detail_piece() -> tuple[Column, str]:
    """J10."""
    return F.when(F.col("pos") != "PUNCT", F.concat(F.lit("<"), "text", F.lit(">("), F.lower("lemma"), F.lit(","),
                                                    _pybool(F.col("is_stop")), F.lit(")"))), " "


def _keys(long: DataFrame, id_col: str) -> list[str]:
    return [id_col, "whole", "seg"] if "whole" in long.columns else [id_col]


def _joined(array: str, name: str, sep: str) -> Column:
    return F.array_join(F.transform(array, lambda t: t[name]), sep)


def _without_tokens(docs: DataFrame, id_col: str, text_col: str, values: dict[str, Column]) -> DataFrame:
    return docs.where(~has_tokens(F.col(text_col))).select(id_col, *[v.alias(n) for n, v in values.items()])


def document_texts(long: DataFrame, pieces: Pieces, id_col: str = "doc_id", docs: DataFrame | None = None, text_col: str = "text",
                   only_targets: bool = False, verbs: str | None = None, ccomp: str | None = None) -> DataFrame:
    """``<id>`` and one text per entry of ``pieces``, tokens in order.

    ``verbs`` / ``ccomp`` name columns for J2 (distinct target lemmas, sorted, joined by ', ', null when none) and
    J6. ``only_targets`` drops documents without a target verb (C9) before any string is put together.
    ``docs`` (``<id>, text_col``) adds the documents without tokens, whose texts are empty.
    """
    keys, names = _keys(long, id_col), list(pieces)
    whole = "whole" in long.columns
    if only_targets:
        found = F.max("is_target").over(Window.partitionBy(*keys))
        long = long.withColumn("_found", found).where(F.col("_found") | ~F.col("whole") if whole else F.col("_found"))
    strings = long.select(*keys, "i", *[p.alias(n) for n, (p, _) in pieces.items()],
                          F.when(F.col("is_target"), F.col("lemma")).alias("_target"), (F.col("dep") == "ccomp").alias("_ccomp"))
    aggs = [F.array_sort(F.collect_list(F.struct("i", *names))).alias("_t")] if names else []
    if verbs or only_targets:
        aggs.append(F.collect_set("_target").alias("_verbs"))
    if ccomp:
        aggs.append(F.max("_ccomp").alias(ccomp))
    parts = strings.groupBy(*keys).agg(*aggs)
    parts = parts.select(*keys, *[_joined("_t", n, pieces[n][1]).alias(n) for n in names],
                         *(["_verbs"] if verbs or only_targets else []), *([ccomp] if ccomp else []))

    def finish(df: DataFrame) -> DataFrame:
        if only_targets:
            df = df.where(F.size("_verbs") > 0)
        made = [F.when(F.size("_verbs") > 0, F.array_join(F.array_sort("_verbs"), ", ")).alias(verbs)] if verbs else []
        return df.select(id_col, *made, *names, *([ccomp] if ccomp else []))

    if not whole:
        out = finish(parts)
    else:
        # a segment that adds nothing must not add a separator
        bits = F.array_sort(F.collect_list(F.struct("seg", *[F.when(F.col(n) != "", F.col(n)).alias(n) for n in names])))
        more = [F.array_distinct(F.flatten(F.collect_list("_verbs"))).alias("_verbs")] if verbs or only_targets else []
        cut = parts.where("not whole").groupBy(id_col).agg(bits.alias("_b"), *more, *([F.max(ccomp).alias(ccomp)] if ccomp else []))
        cut = cut.select(id_col, *[_joined("_b", n, pieces[n][1]).alias(n) for n in names],
                         *(["_verbs"] if more else []), *([ccomp] if ccomp else []))
        out = finish(parts.where("whole")).union(finish(cut))
    if docs is not None and not only_targets:
        empty = {**({verbs: F.lit(None).cast("string")} if verbs else {}), **{n: F.lit("") for n in names}, **({ccomp: F.lit(False)} if ccomp else {})}
        out = out.union(_without_tokens(docs, id_col, text_col, empty))
    return out


def process_batch(long: DataFrame, id_col: str = "doc_id", text: DataFrame | None = None, text_col: str = "text",
                  mode: str = "twitter") -> DataFrame:
    """C9 keep documents with a target verb, then J2, J3, J6, J7, J9, J10 in one pass over the tokens.

    ``text`` (``<id>, text_col``) adds the original text, joined on the id.
    """
    made = document_texts(long, {"normalized": mark_piece(mode), "dependencies": dep_piece(), "pos": pos_piece(mode == "corpus"),
                                 "details": detail_piece()}, id_col, only_targets=True, verbs="verbs", ccomp="has_ccomp")
    out = made.select(id_col, "verbs", "normalized", "has_ccomp", "dependencies", "pos", "details")
    if text is not None:
        out = out.join(text.select(id_col, F.col(text_col).alias("text_orig")), id_col, "left")
    return out


def document_verbs(long: DataFrame, docs: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """J2 as a list: ``<id>, verbs`` (sorted distinct target lemmas, empty when none). Only target lemmas are gathered."""
    out = long.groupBy(id_col).agg(F.array_sort(F.collect_set(F.when(F.col("is_target"), F.col("lemma")))).alias("verbs"))
    if docs is not None:
        out = out.union(_without_tokens(docs, id_col, text_col, {"verbs": F.array().cast("array<string>")}))
    return out


def document_has_ccomp(long: DataFrame, docs: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, has_ccomp``, an aggregate of one flag."""
    out = long.groupBy(id_col).agg(F.max(F.col("dep") == "ccomp").alias("has_ccomp"))
    return out if docs is None else out.union(_without_tokens(docs, id_col, text_col, {"has_ccomp": F.lit(False)}))


def verb_then_que(long: DataFrame, id_col: str = "doc_id", words=QUE_WORDS) -> DataFrame:
    """Per document and target verb, how often its lemma is directly followed by a complementiser lemma.
    Verbs ask at their index plus one, complementisers answer at theirs. Output ``<id>, verb, n``."""
    que = F.lower("lemma").isin(*words)
    x = long.where(F.col("is_target") | que).select(id_col, F.explode(F.filter(F.array(
        F.when(F.col("is_target"), F.struct((F.col("i") + 1).alias("at"), F.col("lemma").alias("verb"), F.lit(False).alias("que"))),
        F.when(que, F.struct(F.col("i").alias("at"), F.lit(None).cast("string").alias("verb"), F.lit(True).alias("que")))),
        lambda e: e.isNotNull())).alias("e")).select(id_col, "e.*")
    met = x.groupBy(id_col, "at").agg(F.max("verb").alias("verb"), F.max("que").alias("que"))
    return met.where("que and verb is not null").groupBy(id_col, "verb").agg(F.count(F.lit(1)).alias("n"))


def _ask(rows: DataFrame, held: list[str], entries: list[Column], answers: dict[str, Column], keep: Callable, partitions: int | None) -> DataFrame:
    """Rows meet at numbers: ``entries`` are (kind, key) structs or null per row; within a (document, key), kind 0
    holds the values of ``answers`` for the kinds after it. Kinds above 0 are kept, with their kind. ``held`` names a document."""
    x = rows.select("*", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("_e"))
    x = x.select(*rows.columns, F.col("_e.kind").alias("_kind"), F.col("_e.key").alias("_key"))
    x = x.repartition(partitions, *held, "_key") if partitions else x
    w = Window.partitionBy(*held, "_key").orderBy("_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.select("*", *[F.first(F.when(F.col("_kind") == 0, v), ignorenulls=True).over(w).alias(n) for n, v in answers.items()])
    return keep(x.where("_kind > 0")).drop("_key")


def _entry(when: Column, kind: int, key: Column) -> Column:
    return F.when(when, F.struct(F.lit(kind).alias("kind"), key.cast("long").alias("key")))


def _pairs(long: DataFrame, held: list[str], last_per_lemma: bool, partitions: int | None = None) -> DataFrame:
    """``head_pairs`` of documents named by ``held``, which comes first in the result."""
    can_head, ccomp = F.col("pos").isin(*VERB_TAGS) & F.col("in_dim"), F.col("dep") == "ccomp"
    rows = long.where(can_head | ccomp | is_verb_tag()).select(
        *held, "i", "text", "lemma", "head", "c", "vc", (F.col("tag") != "PUNCT").alias("word"), is_verb_tag().alias("vtag"),
        can_head.alias("can_head"), ccomp.alias("ccomp"))
    # heads ask for the verb tag counted next; complements go along under keys of their own
    nxt = _ask(rows, held, [_entry(F.col("vtag"), 0, F.col("vc")), _entry(F.col("can_head"), 1, F.col("vc") + 1),
                            _entry(F.col("ccomp"), 2, -F.col("i") - 1)],
               {"v2": F.col("text"), "v2_i": F.col("i"), "v2_c": F.col("c")}, lambda x: x.withColumnRenamed("_kind", "asked"), partitions)
    # complements ask for the head at their head's index
    out = _ask(nxt, held, [_entry(F.col("asked") == 1, 0, F.col("i")), _entry(F.col("asked") == 2, 1, F.col("head"))],
               {"h_lemma": F.col("lemma"), "h_text": F.col("text"), "h_i": F.col("i"), "h_c": F.col("c"), "h_word": F.col("word"),
                "h_v2": F.col("v2"), "h_v2_i": F.col("v2_i"), "h_v2_c": F.col("v2_c")}, lambda x: x.where("h_i is not null"), partitions)
    inside = F.col("c") - F.col("word").cast("int") - F.col("h_c")
    pairs = out.select(
        *held, F.col("h_lemma").alias("head"), F.col("h_text").alias("head_text"), F.col("h_i").alias("head_i"),
        F.col("text").alias("ccomp"), F.col("i").alias("ccomp_i"),
        F.when(F.col("i") > F.col("h_i"), inside).otherwise(0).cast("int").alias("ccomp_dist"),
        F.col("h_v2").alias("v2"), F.col("h_v2_i").cast("int").alias("v2_i"),
        (F.col("h_v2_c") - 1 - F.col("h_c")).cast("int").alias("v2_dist"), F.col("h_word").alias("head_mark"), F.col("word").alias("ccomp_mark"))
    if not last_per_lemma:
        return pairs
    last = Window.partitionBy(*held, "head").orderBy(F.col("ccomp_i").desc())
    return pairs.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")


def head_pairs(long: DataFrame, id_col: str = "doc_id", last_per_lemma: bool = False, partitions: int | None = None) -> DataFrame:
    """One row per ccomp token whose head is a verb of the dimension: ``<id>`` (and ``whole``), head,
    head_text, head_i, ccomp, ccomp_i, ccomp_dist, v2, v2_i, v2_dist, head_mark, ccomp_mark (whether the
    token's tag lets it be marked).

    Distances count tokens whose tag isn't PUNCT strictly between; a ccomp before its head gives 0, no later verb
    gives a null V2 and distance. ``last_per_lemma`` keeps the last pair of each head lemma of a document.
    A document of one segment is matched where its tokens are; only cut ones are shuffled, by (document,
    number), into ``partitions`` (default: the session's).
    """
    if "whole" not in long.columns:
        return _pairs(long, [id_col], last_per_lemma, partitions)
    one = _pairs(long.where("whole"), _keys(long, id_col), last_per_lemma).drop("seg")
    return one.union(_pairs(long.where("not whole"), [id_col, "whole"], last_per_lemma, partitions))


def marked_heads(long: DataFrame, id_col: str = "doc_id", last_per_lemma: bool = False, more: Pieces | None = None,
                 partitions: int | None = None) -> DataFrame:
    """``head_pairs`` with ``text_norm``: head ``>>X``, V2 ``X[V2]`` when it is not the ccomp, ccomp ``X<<``,
    que variants upper, PUNCT as is, anything else lower; each token after a blank.

    A token's plain form is made once; per pair only the three marked ones are made anew. ``more`` adds texts of
    the document (see ``document_texts``), and ``verbs``; they are put together before pairs meet them, so that the join
    sorts strings, not tokens.
    """
    keys, names = _keys(long, id_col), list(more or {})
    t = F.col("text")
    plain = F.when(F.col("tag") == "PUNCT", t).when(_is_word_in(t, QUE_VARIANTS), F.upper(t)).otherwise(F.lower(t))
    base = long.select(*keys, "i", plain.alias("_plain"), *[p.alias(n) for n, (p, _) in (more or {}).items()],
                       F.when(F.col("is_target"), F.col("lemma")).alias("_target"))
    aggs = [F.array_sort(F.collect_list(F.struct("i", "_plain", *names))).alias("_t")]
    found = ["_verbs"] if more is not None else []
    if found:
        aggs.append(F.collect_set("_target").alias("_verbs"))
    words = F.transform("_t", lambda t: F.struct(t["i"].alias("i"), t["_plain"].alias("_plain"))) if names else F.col("_t")
    base = base.groupBy(*keys).agg(*aggs).select(*keys, words.alias("_t"), *[_joined("_t", n, more[n][1]).alias(n) for n in names], *found)

    def marked(pairs: DataFrame, base: DataFrame, on: list[str]) -> DataFrame:
        up = lambda c: F.upper(c)
        verbs = [F.when(F.size("_verbs") > 0, F.array_join(F.array_sort("_verbs"), ", ")).alias("verbs")] if found else []
        joined = pairs.join(base.select(*on, "_t", *verbs, *names), on)

        def one(x: Column) -> Column:
            word = (F.when((x["i"] == F.col("head_i")) & F.col("head_mark"), F.concat(F.lit(">>"), up("head_text")))
                    .when((x["i"] == F.col("v2_i")) & (F.col("v2_i") != F.col("ccomp_i")), F.concat(up("v2"), F.lit("[V2]")))
                    .when((x["i"] == F.col("ccomp_i")) & F.col("ccomp_mark"), F.concat(up("ccomp"), F.lit("<<")))
                    .otherwise(x["_plain"]))
            return F.concat(F.lit(" "), word)

        return joined.select(id_col, *[c for c in pairs.columns if c not in (id_col, "whole", "seg", "head_mark", "ccomp_mark")],
                             F.array_join(F.transform("_t", one), "").alias("text_norm"), *(["verbs"] if found else []), *names)

    if "whole" not in long.columns:
        return marked(_pairs(long, [id_col], last_per_lemma, partitions), base, [id_col])
    one = marked(_pairs(long.where("whole"), keys, last_per_lemma), base.where("whole"), keys)
    # a segment that adds nothing must not add a separator
    bits = F.array_sort(F.collect_list(F.struct("seg", "_t", *[F.when(F.col(n) != "", F.col(n)).alias(n) for n in names])))
    sets = [F.array_distinct(F.flatten(F.collect_list("_verbs"))).alias("_verbs")] if found else []
    cut = base.where("not whole").groupBy(id_col).agg(bits.alias("_b"), *sets).select(
        id_col, F.flatten(F.transform("_b", lambda b: b["_t"])).alias("_t"), *[_joined("_b", n, more[n][1]).alias(n) for n in names], *found)
    return one.union(marked(_pairs(long.where("not whole"), [id_col, "whole"], last_per_lemma, partitions).drop("whole"), cut, [id_col]))


def explode_heads(long: DataFrame, id_col: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """One row per document and distinct head lemma: ``<id>, verb``."""
    return head_pairs(long, id_col, partitions=partitions).select(id_col, F.col("head").alias("verb")).distinct()


def token_details(long: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per token with its details."""
    return long.drop("whole", "seg")


def distance_table(long: DataFrame, id_col: str = "doc_id", text: DataFrame | None = None, text_col: str = "text",
                   last_per_lemma: bool = False, partitions: int | None = None) -> DataFrame:
    """The full distance result per head pair -- id, the document's target verbs, head, ccomp, distances, V2, marked
    text (J15), dependency text and token details; ``text`` (``<id>, text_col``) adds the original text."""
    out = marked_heads(long, id_col, last_per_lemma, {"dependencies": dep_piece(), "details": detail_piece()}, partitions)
    if text is not None:
        out = out.join(text.select(id_col, F.col(text_col).alias("text_orig")), id_col, "left")
    return out
