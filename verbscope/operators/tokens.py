"""Token-level operators.

Two forms of an annotated document are used:

* **long** -- one row per token: ``<id>, i, text, lemma, pos, tag, dep, head, morph,
  is_stop, is_punct, is_target, c, vc``. ``c`` is the running count of non-PUNCT
  tokens up to and including ``i``; ``vc`` the running count of verb-tagged tokens.
  Windows here are always ``partitionBy(<id>).orderBy(i)``.
* **nested** -- one row per document with ``tokens array<struct<...>>`` sorted by ``i``.
  Text outputs and lookups by index (``element_at(tokens, head + 1)``) run per row
  with higher-order functions, no join.

The long table is hash-partitioned once, before the explode, on the document's segments: a document up to
``SEGMENT_CHARS`` is one segment, a longer one several, so it spreads over tasks. Later windows and groups
per segment reuse that partitioning. Text outputs on the long form are in ``token_texts``; the nested form is for documents that
fit in a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import QUE_VARIANTS, QUE_WORDS, SPACE, WORD, ascii_fold
from .joins import small_side

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Tags that make a token a verb for the V2 search (the tag, not the coarse POS:
# AUX is therefore never V2).
VERB_TAGS = ("VB", "VBD", "VBG", "VBN", "VBP", "VBZ", "VERB")
# Coarse POS values that may form or continue a verb run.
RUN_POS = ("AUX", "VERB", "ADP")

TOKEN_FIELDS = [
    T.StructField("i", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("lemma", T.StringType()),
    T.StructField("pos", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("dep", T.StringType()),
    T.StructField("head", T.IntegerType()),
    T.StructField("morph", T.StringType()),
    T.StructField("is_stop", T.BooleanType()),
    T.StructField("is_punct", T.BooleanType()),
]
TOKEN_COLS = [f.name for f in TOKEN_FIELDS]

# ---------------------------------------------------------------------------
# Default annotator (a deterministic proxy, NOT a parser)
# ---------------------------------------------------------------------------
# Lexicon of the default annotator: word, coarse POS, lemma (None = the word itself).
# These are the library's own fixture values for closed word classes in the four
# corpus languages; every entry is a stop word.
DEFAULT_LEXICON = (
    # adpositions
    ("a", "ADP", None), ("de", "ADP", None), ("en", "ADP", None), ("con", "ADP", None),
    ("por", "ADP", None), ("para", "ADP", None), ("sin", "ADP", None), ("sobre", "ADP", None),
    ("of", "ADP", None), ("in", "ADP", None), ("to", "ADP", None), ("for", "ADP", None),
    ("with", "ADP", None), ("on", "ADP", None), ("at", "ADP", None), ("by", "ADP", None),
    ("from", "ADP", None), ("dans", "ADP", None), ("pour", "ADP", None), ("sur", "ADP", None),
    ("avec", "ADP", None), ("par", "ADP", None), ("mit", "ADP", None), ("zu", "ADP", None),
    ("auf", "ADP", None), ("von", "ADP", None), ("bei", "ADP", None),
    # determiners
    ("el", "DET", None), ("la", "DET", None), ("los", "DET", None), ("las", "DET", None),
    ("un", "DET", None), ("una", "DET", None), ("the", "DET", None), ("an", "DET", None),
    ("le", "DET", None), ("les", "DET", None), ("des", "DET", None), ("du", "DET", None),
    ("der", "DET", None), ("die", "DET", None), ("das", "DET", None), ("ein", "DET", None),
    ("eine", "DET", None),
    # subordinating conjunctions
    ("que", "SCONJ", None), ("q", "SCONJ", None), ("si", "SCONJ", None),
    ("porque", "SCONJ", None), ("that", "SCONJ", None), ("if", "SCONJ", None),
    ("qui", "SCONJ", None), ("dass", "SCONJ", None), ("wenn", "SCONJ", None),
    # coordinating conjunctions
    ("y", "CCONJ", None), ("o", "CCONJ", None), ("pero", "CCONJ", None), ("and", "CCONJ", None),
    ("or", "CCONJ", None), ("but", "CCONJ", None), ("et", "CCONJ", None), ("ou", "CCONJ", None),
    ("und", "CCONJ", None), ("oder", "CCONJ", None),
    # auxiliaries
    ("es", "AUX", "ser"), ("son", "AUX", "ser"), ("fue", "AUX", "ser"), ("ha", "AUX", "haber"),
    ("han", "AUX", "haber"), ("is", "AUX", "be"), ("are", "AUX", "be"), ("was", "AUX", "be"),
    ("be", "AUX", "be"), ("has", "AUX", "have"), ("have", "AUX", "have"), ("est", "AUX", "etre"),
    ("sont", "AUX", "etre"), ("ist", "AUX", "sein"), ("sind", "AUX", "sein"), ("hat", "AUX", "haben"),
)
# A word (lower case) that ends like an infinitive or gerund is tagged VERB.
VERB_SUFFIX = "^.{2,}(ar|er|ir|ando|iendo)$"
VERB_ENDINGS = ("ar", "er", "ir", "ando", "iendo")


def _verb_suffix(lw: Column) -> Column:
    """``lw rlike VERB_SUFFIX`` without a regex: an ending plus at least two characters."""
    n = F.length(lw)
    cond = F.lit(False)
    for e in VERB_ENDINGS:
        cond = cond | (lw.endswith(e) & (n >= len(e) + 2))
    return cond


def lexicon_frame(spark, lexicon=DEFAULT_LEXICON) -> DataFrame:
    return spark.createDataFrame(list(lexicon), "lex_word string, lex_pos string, lex_lemma string")


#: Code points of a text up to which it stays one segment. Longer texts are cut at white space.
SEGMENT_CHARS = 32_768
#: Bytes of text that a task turns into tokens. A token's row takes some thirty times its text, and windows sort a
#: task's rows: this bounds that sort, however large the table.
TASK_BYTES = 2 << 20


def text_tasks(docs: DataFrame, text_col: str = "text", most: int = TASK_BYTES) -> int:
    """Tasks over which texts are dealt: at most ``most`` bytes each on average, and one per core at least. The bytes
    are summed by a job, as a file's size doesn't tell them (columns are compressed, repeated texts above all)."""
    held = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-int(held) // most))


def segments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None,
             size: int = SEGMENT_CHARS) -> DataFrame:
    """Texts as rows of bounded size: ``<id>, whole, seg, piece``. A text of at most ``size`` code points is
    one segment (``whole``, seg 0); a longer one is cut at white space, so no token is cut.

    Segments are hash-partitioned here, before any token exists: the shuffle moves text, not tokens, a
    very long document spreads over all tasks, and per-segment windows and groups need no shuffle more. The number
    of partitions is fixed (see ``text_tasks``): left open, partitions would be merged by their bytes of text.
    ``whole`` is known before a text is cut, so a filter on it reaches the scan. A document without an id
    is never cut (its pieces could not be joined again).
    """
    text, whole = F.col(text_col), F.col(id_col).isNull() | (F.char_length(text_col) <= size)
    cut = f"(?s).{{1,{size}}}(?:[{SPACE}]|\\z)|[^{SPACE}]+[{SPACE}]?"
    pieces = F.when(whole, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(cut), 0))
    d = docs.select(id_col, whole.alias("whole"), pieces.alias("_pieces")).where(F.col("whole").isNotNull())
    d = d.select(id_col, "whole", F.posexplode("_pieces").alias("seg", "piece"))
    keys = (id_col, "whole", "seg")
    return d.repartition(partitions or text_tasks(docs, text_col), *keys)


def tokens_of(pieces: DataFrame) -> DataFrame:
    """Every row's ``piece`` as tokens ``li`` (0-based in the piece), ``text``: punctuation marks are
    tokens of their own, white space separates the rest."""
    spaced = F.regexp_replace(F.col("piece"), f"([^{WORD}{SPACE}])", " $1 ")
    spaced = F.trim(F.regexp_replace(spaced, f"[{SPACE}]+", " "))
    rest = [c for c in pieces.columns if c != "piece"]
    return (pieces.select(*rest, F.posexplode(F.split(spaced, " ")).alias("li", "text")).where(F.col("text") != ""))


def has_tokens(text: Column) -> Column:
    """Whether a text has any token (null text: no)."""
    return F.coalesce(text.rlike(f"[^{SPACE}]"), F.lit(False))


def _target_flags(long: DataFrame, verbs: DataFrame) -> DataFrame:
    """``in_dim``: the lemma is a verb of the dimension (broadcast lookup where its planned size is small)."""
    dim = (verbs.select(F.col("verb").alias("_dim_lemma")).where(F.col("_dim_lemma").isNotNull())
           .distinct().withColumn("in_dim", F.lit(True)))
    out = long.join(small_side(dim), F.col("lemma") == F.col("_dim_lemma"), "left")
    return out.withColumn("in_dim", F.coalesce(F.col("in_dim"), F.lit(False))).drop("_dim_lemma")


def is_verb_tag(c="tag") -> Column:
    return F.col(c).isin(*VERB_TAGS)


def add_token_features(long: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``is_target`` (VERB with a dimension lemma) and the running counts ``c`` (tokens whose tag isn't PUNCT),
    ``vc`` (verb tags) and ``rc`` (tokens that a verb run may hold), for tokens of whole documents -- one
    window pass, growing frames only (O(n))."""
    w = Window.partitionBy(id_col).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).over(w).cast("int")
    return long.withColumn("is_target", (F.col("pos") == "VERB") & F.col("in_dim")).select(
        "*", running(F.col("tag") != "PUNCT").alias("c"), running(is_verb_tag()).alias("vc"),
        running(F.col("pos").isin(*RUN_POS)).alias("rc"))


def _tagged(tokens: DataFrame, verbs: DataFrame, lexicon) -> DataFrame:
    """Default tags of tokens: two broadcast lookups and suffix rules, row by row."""
    t = tokens.withColumn("_lw", F.lower(F.col("text")))
    lw = F.col("_lw")
    lex = F.broadcast(lexicon_frame(tokens.sparkSession, lexicon))  # fixed, ~100 rows
    t = t.join(lex, lw == F.col("lex_word"), "left")
    # a punctuation token is a single character (the tokenizer splits them off)
    is_punct = F.when(F.length("text") == 1, F.col("text").rlike(f"^[^{WORD}{SPACE}]$")).otherwise(F.lit(False))
    pos = (F.when(is_punct, "PUNCT").when(F.col("lex_pos").isNotNull(), F.col("lex_pos"))
           .when(_verb_suffix(lw), "VERB").otherwise("NOUN"))
    rest = [c for c in tokens.columns if c != "text"]
    t = t.select(*rest, "text", F.coalesce(F.col("lex_lemma"), lw).alias("lemma"), pos.alias("pos"),
                 F.col("lex_word").isNotNull().alias("is_stop"))
    return _target_flags(t, verbs)


# Three running counts in one sum of 64-bit numbers: non-PUNCT, verb tags, run tokens (20 bits each; a
# segment has at most SEGMENT_CHARS tokens).
_BITS = 20


def _packed_counts() -> Column:
    flags = (F.col("pos") != "PUNCT", is_verb_tag("pos"), F.col("pos").isin(*RUN_POS))  # tag = pos
    return reduce(lambda a, b: a + b, [F.when(f, F.lit(1 << (_BITS * k))).otherwise(F.lit(0)).cast("long") for k, f in enumerate(flags)])


def _unpacked(c: Column, k: int) -> Column:
    return F.shiftright(c, _BITS * k).bitwiseAND(F.lit((1 << _BITS) - 1))


def _verb_place(index: Column) -> Column:
    """Place and dimension flag of a VERB as one number, so that the largest is the latest; null elsewhere."""
    return F.when(F.col("pos") == "VERB", index * 2 + F.col("in_dim").cast("int"))


def _before(tagged: DataFrame, id_col: str) -> DataFrame:
    """What lies before each segment of a cut document, from one row per segment: tokens, the three
    counts, the last VERB."""
    per = tagged.groupBy(id_col, "whole", "seg").agg(
        F.count(F.lit(1)).alias("n"), F.sum(_packed_counts()).alias("p"), F.max(_verb_place(F.col("li").cast("long"))).alias("v"))
    w = Window.partitionBy(id_col).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("*", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_n"),
                     *[F.coalesce(F.sum(_unpacked(F.col("p"), k)).over(w), F.lit(0)).alias(f"_n{k}") for k in range(3)])
    return per.select(F.col(id_col).alias("_id"), F.col("whole").alias("_whole"), F.col("seg").alias("_seg"), "_n", "_n0", "_n1", "_n2",
                      F.max(F.col("_n") * 2 + F.col("v")).over(w).alias("_v"))


def annotate(docs: DataFrame, verbs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lexicon=DEFAULT_LEXICON, partitions: int | None = None, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """J1 default annotator -> long token table (a rule-based proxy, not a parser).

    * token: see ``tokens_of``;
    * pos: PUNCT for a single non-word character; else the lexicon's class; else VERB
      when the lower-cased word ends like an infinitive/gerund (``VERB_SUFFIX``);
      else NOUN. tag = pos, morph = null, is_stop = in the lexicon;
    * lemma: the lexicon's lemma, else the lower-cased word;
    * head: index of the nearest earlier VERB (a token without one is its own head);
    * dep: 'ccomp' for a VERB whose head verb has a lemma of the verb dimension, else 'dep'.

    An id stands for one document. Indexes and counts run over a document, but windows only over its segments:
    what lies before a segment comes from a table with one row per segment of a cut document. ``whole`` and
    ``seg`` stay in the result, which is partitioned by them (see ``segments``).
    """
    segs = segments(docs, id_col, text_col, partitions, segment_chars)
    before = _before(_tagged(tokens_of(segs.where(~F.col("whole"))), verbs, lexicon), id_col)
    joined = segs.join(before, (F.col(id_col) == F.col("_id")) & (F.col("whole") == F.col("_whole")) & (F.col("seg") == F.col("_seg")), "left")
    carried = [F.coalesce(c, F.lit(0)).alias(c) for c in ("_n", "_n0", "_n1", "_n2")]
    t = _tagged(tokens_of(joined.select(id_col, "whole", "seg", "piece", *carried, "_v")), verbs, lexicon)
    w = Window.partitionBy(id_col, "whole", "seg").orderBy("li")
    so_far, earlier = (w.rowsBetween(Window.unboundedPreceding, to) for to in (Window.currentRow, -1))
    t = t.select("*", F.sum(_packed_counts()).over(so_far).alias("_p"),
                 F.coalesce(F.max(_verb_place(F.col("_n") + F.col("li"))).over(earlier), F.col("_v")).alias("_prev"))
    i = (F.col("_n") + F.col("li")).cast("int")
    counts = [(F.col(f"_n{k}") + _unpacked(F.col("_p"), k)).cast("int").alias(c) for k, c in enumerate(("c", "vc", "rc"))]
    return t.select(
        id_col, i.alias("i"), "text", "lemma", "pos", F.col("pos").alias("tag"),
        F.when((F.col("pos") == "VERB") & F.coalesce(F.col("_prev") % 2 == 1, F.lit(False)), "ccomp").otherwise("dep").alias("dep"),
        F.coalesce(F.shiftright("_prev", 1).cast("int"), i).alias("head"), F.lit(None).cast("string").alias("morph"), "is_stop",
        (F.col("pos") == "PUNCT").alias("is_punct"), "in_dim", ((F.col("pos") == "VERB") & F.col("in_dim")).alias("is_target"),
        *counts, "whole", "seg")


def annotate_with(docs: DataFrame, annotator, verbs: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """J1 with a caller-supplied annotator (e.g. a tagger/parser model).

    ``annotator`` is ``Iterator[pd.DataFrame] -> Iterator[pd.DataFrame]`` taking
    ``<id>, text`` batches and yielding one row per token with ``<id>`` and the
    token columns (``TOKEN_COLS``). It runs in ``mapInPandas`` (Arrow batches); load
    the model once per worker inside the function. Documents are partitioned on the
    id first so the token windows need no further shuffle.
    """
    d = docs.select(id_col, F.col(text_col).alias("text"))
    d = d.repartition(partitions or text_tasks(d), id_col)
    id_field = docs.schema[id_col]
    schema = T.StructType([T.StructField(id_col, id_field.dataType)] + TOKEN_FIELDS)
    long = d.mapInPandas(annotator, schema)
    long = _target_flags(long, verbs)
    return add_token_features(long, id_col).select(id_col, *TOKEN_COLS, "in_dim", "is_target", "c", "vc", "rc")


# Token fields read by the text outputs (J3-J10, J16) and by the head / distance
# operators (J12-J15, F4); nesting only these keeps the per-document arrays small.
TEXT_FIELDS = ("i", "text", "lemma", "pos", "dep", "is_stop", "is_punct", "is_target")
DISTANCE_FIELDS = ("i", "text", "lemma", "pos", "tag", "dep", "head", "is_punct", "in_dim", "c", "vc")


def nest_tokens(long: DataFrame, id_col: str = "doc_id", fields=None) -> DataFrame:
    """Long -> nested: ``<id>, tokens`` sorted by ``i`` (group = one document).

    ``fields`` picks the token fields to carry (``i`` first; default: all)."""
    fields = list(fields) if fields else [c for c in long.columns if c != id_col]
    if fields[0] != "i":
        fields = ["i"] + [f for f in fields if f != "i"]
    return long.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("tokens"))


def doc_target_verbs(long: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """J2 from the long form: ``<id>, verbs`` (sorted distinct target lemmas, an empty
    list when none). Only target lemmas are collected per document."""
    return long.groupBy(id_col).agg(F.array_sort(F.array_distinct(
        F.collect_list(F.when(F.col("is_target"), F.col("lemma"))))).alias("verbs"))


def token_long(nested: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """J11 ``token_details``: nested -> long (``inline`` of the sorted array)."""
    return nested.select(id_col, F.inline("tokens"))


# ---------------------------------------------------------------------------
# Per-document text outputs (J2-J10) on the nested form
# ---------------------------------------------------------------------------
def _fold_lower(c: Column) -> Column:
    return F.lower(ascii_fold(c))


def _is_word_in(c: Column, words) -> Column:
    """``lower(ascii_fold(c)) IN words``; folding never shortens a token, so tokens
    longer than the longest word are rejected before the (costlier) fold."""
    longest = max(len(w) for w in words)
    return F.when(F.length(c) <= longest, _fold_lower(c).isin(*words)).otherwise(F.lit(False))


def target_verbs(tokens="tokens") -> Column:
    """Distinct target-verb lemmas, sorted, joined by ', '; null when none."""
    arr = F.array_sort(F.array_distinct(F.transform(F.filter(tokens, lambda t: t["is_target"]),
                                                    lambda t: t["lemma"])))
    return F.when(F.size(arr) > 0, F.array_join(arr, ", "))


def target_verb_list(tokens="tokens") -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.filter(tokens, lambda t: t["is_target"]),
                                                     lambda t: t["lemma"])))


def mark_text(tokens="tokens", mode: str = "twitter") -> Column:
    """J3/J4/J5 marked text.

    * ``twitter``: PUNCT attached as is; que/q upper; target verb upper, ``<<X>>``
      when it is a ccomp; anything else lower; each non-PUNCT token after a blank.
    * ``corpus``: as twitter, but a target verb is upper (in ``<< >>``) only when it
      is a ccomp.
    * ``variants``: every token after a blank (punctuation too); que/q/k/ke upper;
      target verbs as in twitter.
    """
    words = QUE_VARIANTS if mode == "variants" else QUE_WORDS

    def one(t):
        up = F.upper(t["text"])
        lo = F.lower(t["text"])
        is_que = _is_word_in(t["text"], words)
        ccomp = t["dep"] == "ccomp"
        if mode == "variants":
            body = (F.when(t["is_punct"], t["text"]).when(is_que, up)
                    .when(t["is_target"] & ccomp, F.concat(F.lit("<<"), up, F.lit(">>")))
                    .when(t["is_target"], up).otherwise(lo))
            return F.concat(F.lit(" "), body)
        if mode == "corpus":
            body = (F.when(is_que, up)
                    .when(t["is_target"] & ccomp, F.concat(F.lit("<<"), up, F.lit(">>")))
                    .otherwise(lo))
        else:
            body = (F.when(is_que, up)
                    .when(t["is_target"] & ccomp, F.concat(F.lit("<<"), up, F.lit(">>")))
                    .when(t["is_target"], up).otherwise(lo))
        return F.when(t["pos"] == "PUNCT", t["text"]).otherwise(F.concat(F.lit(" "), body))

    return F.array_join(F.transform(tokens, one), "")


def has_ccomp(tokens="tokens") -> Column:
    """Any token with dependency 'ccomp'."""
    return F.exists(tokens, lambda t: t["dep"] == "ccomp")


def dep_text(tokens="tokens") -> Column:
    """`` word[dep]`` per token, lower case; PUNCT bare."""
    return F.array_join(F.transform(tokens, lambda t: F.when(
        t["pos"] == "PUNCT", F.concat(F.lit(" "), t["text"])).otherwise(
        F.concat(F.lit(" "), F.lower(t["text"]), F.lit("["), t["dep"], F.lit("]")))), "")


def dep_map(long: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, lower word -> dep; the last occurrence of a word wins.

    Words of a document of one segment are gathered on the segments' partitioning, and only its finished list is
    shuffled, to meet other rows of its id; tokens of cut documents meet by (document, word).
    """
    def words(part: DataFrame, keys: list) -> DataFrame:
        last = part.groupBy(*keys, F.lower("text").alias("word")).agg(F.max("i").alias("i"), F.max_by("dep", "i").alias("dep"))
        return last.groupBy(*keys).agg(F.collect_list(F.struct("word", "i", "dep")).alias("_w")).select(id_col, "_w")

    if "whole" not in long.columns:
        return words(long, [id_col]).select(id_col, _word_map("_w").alias("dep_map"))
    lists = words(long.where("whole"), [id_col, "whole", "seg"]).union(words(long.where("not whole"), [id_col]))
    met = lists.groupBy(id_col).agg(F.collect_list("_w").alias("_l")).select(
        id_col, F.when(F.size("_l") == 1, F.col("_l")[0]).otherwise(F.array_sort(F.flatten("_l"))).alias("_w"), (F.size("_l") > 1).alias("_more"))
    # of equal words, which stand together by now, the one with the largest index
    later = F.filter("_w", lambda x, k: ~F.coalesce(F.get("_w", k + 1)["word"] == x["word"], F.lit(False)))
    return met.select(id_col, F.when(F.col("_more"), later).otherwise(F.col("_w")).alias("_w")).select(id_col, _word_map("_w").alias("dep_map"))


def _word_map(words: str) -> Column:
    return F.map_from_entries(F.array_sort(F.transform(words, lambda x: F.struct(x["word"].alias("word"), x["dep"].alias("dep")))))


def pos_text(tokens="tokens", drop_punct: bool = False) -> Column:
    """``word(POS)`` joined by blanks; the corpus variant drops PUNCT."""
    arr = F.col(tokens) if isinstance(tokens, str) else tokens
    if drop_punct:
        arr = F.filter(arr, lambda t: t["pos"] != "PUNCT")
    return F.array_join(F.transform(arr, lambda t: F.concat(t["text"], F.lit("("), F.upper(t["pos"]), F.lit(")"))), " ")


def _pybool(c: Column) -> Column:
    return F.when(c, F.lit("True")).otherwise(F.lit("False"))


def detail_text(tokens="tokens") -> Column:
    """``<word>(lemma,is_stop)`` for non-PUNCT tokens, joined by blanks."""
    return F.array_join(F.transform(F.filter(tokens, lambda t: t["pos"] != "PUNCT"), lambda t: F.concat(
        F.lit("<"), t["text"], F.lit(">("), F.lower(t["lemma"]), F.lit(","), _pybool(t["is_stop"]), F.lit(")"))), " ")


def process_batch(nested: DataFrame, id_col: str = "doc_id", text: DataFrame | None = None,
                  text_col: str = "text", mode: str = "twitter") -> DataFrame:
    """C9 keep documents with a target verb, then J2, J3, J6, J7, J9, J10 in one projection.

    ``text`` (``<id>, text_col``) adds the original text; joined on the id, which
    both sides share as partitioning key.
    """
    out = (nested.where(F.exists("tokens", lambda t: t["is_target"]))
           .select(id_col, target_verbs().alias("verbs"), mark_text(mode=mode).alias("normalized"),
                   has_ccomp().alias("has_ccomp"), dep_text().alias("dependencies"),
                   pos_text(drop_punct=(mode == "corpus")).alias("pos"), detail_text().alias("details")))
    if text is not None:
        out = out.join(text.select(id_col, F.col(text_col).alias("text_orig")), id_col, "left")
    return out


# ---------------------------------------------------------------------------
# Filters and predicates on annotated documents
# ---------------------------------------------------------------------------
def has_target_verbs(df: DataFrame, verbs_col: str = "verbs") -> DataFrame:
    """Keep rows with at least one target verb (list column or its ', ' text)."""
    c = F.col(verbs_col)
    if isinstance(df.schema[verbs_col].dataType, T.StringType):
        return df.where(c.isNotNull() & (c != ""))
    return df.where(F.size(c) > 0)


def multi_verb(df: DataFrame, verbs_col: str = "verbs") -> DataFrame:
    """Rows with more than one target verb."""
    c = F.col(verbs_col)
    if isinstance(df.schema[verbs_col].dataType, T.StringType):
        c = F.split(c, ", ")
    return df.where(F.size(c) > 1)


def explode_verbs(df: DataFrame, verbs_col: str = "verbs", out: str = "verb") -> DataFrame:
    """One row per verb of the list; an empty or null list gives one null row."""
    c = F.col(verbs_col)
    if isinstance(df.schema[verbs_col].dataType, T.StringType):
        c = F.split(c, ", ")
    return df.withColumn(out, F.explode_outer(c))


def verb_then_que(nested: DataFrame, id_col: str = "doc_id", words=QUE_WORDS) -> DataFrame:
    """Per document and target verb, how often its lemma is directly followed by a
    complementiser lemma (``que``/``q`` by default). Output ``<id>, verb, n``."""
    toks = F.col("tokens")
    n = F.size(toks)
    pairs = F.zip_with(F.slice(toks, 1, F.greatest(n - 1, F.lit(0))),
                       F.slice(toks, 2, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.when(a["is_target"] & F.lower(b["lemma"]).isin(*words), a["lemma"]))
    hits = F.filter(pairs, lambda x: x.isNotNull())
    return (nested.select(id_col, F.explode(hits).alias("verb"))
            .groupBy(id_col, "verb").agg(F.count(F.lit(1)).alias("n")))


def parse_pos_text(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """I16: ``"word(POS) ..."`` -> one row per blank-separated piece ``<id>, i, token, pos``;
    a piece without ``(POS)`` keeps itself as token and a null POS. Repeats stay."""
    pat = "^(.+)\\(([\\p{L}\\p{N}_]+)\\)$"
    e = df.select(id_col, F.posexplode(F.split(F.trim(F.col(col)), "[ \\t\\n\\r\\f]+")).alias("i", "piece"))
    e = e.where(F.col("piece") != "")
    # group 2 is non-empty exactly when the pattern matches: two regex passes, not three
    e = e.select(id_col, "i", "piece", F.regexp_extract("piece", pat, 1).alias("_tok"),
                 F.regexp_extract("piece", pat, 2).alias("_pos"))
    m = F.col("_pos") != ""
    return e.select(id_col, F.col("i").cast("int").alias("i"),
                    F.when(m, F.col("_tok")).otherwise(F.col("piece")).alias("token"),
                    F.when(m, F.col("_pos")).alias("pos"))


def query_match(docs: DataFrame, verbs: DataFrame, id_col: str, text_col: str, topic_col: str) -> DataFrame:
    """Per topic (a verb), documents whose token set holds any conjugation listed in
    the verb's ``indicativo`` (blank-separated; ASCII-folded and cleaned like the text,
    the query word ``or`` dropped). Output ``topic, matched, total``.

    The conjugations are gathered per topic into one small array (the dimension is
    bounded and broadcast), joined to the documents by topic, and each document is
    tested with ``arrays_overlap`` on its own tokens -- no token rows are shuffled;
    only the final per-topic counts are (partially aggregated).
    """
    from ..functions.text import token_list, token_set
    conj = (verbs.select(F.col("verb").alias("_topic"),
                         F.explode(token_set(ascii_fold(F.col("indicativo")))).alias("_tok"))
            .where(F.col("_tok") != "or")
            .groupBy("_topic").agg(F.collect_set("_tok").alias("_conj")))
    d = docs.select(id_col, F.col(topic_col).alias("_topic"), F.col(text_col).alias("_text"))
    d = d.join(small_side(conj), "_topic", "left")
    # set semantics are kept by arrays_overlap itself; no distinct pass over the tokens
    hit = F.coalesce(F.arrays_overlap(token_list(ascii_fold(F.col("_text"))), F.col("_conj")), F.lit(False))
    return (d.groupBy("_topic").agg(F.count(F.when(hit, 1)).alias("matched"), F.count(F.lit(1)).alias("total"))
            .select(F.col("_topic").alias("topic"), F.col("matched").cast("long"), F.col("total").cast("long")))


# ---------------------------------------------------------------------------
# F3 verb runs (gaps and islands on the long form)
# ---------------------------------------------------------------------------
def verb_runs(long: DataFrame, id_col: str = "doc_id", pos_col: str = "pos", text_col: str = "text",
              min_verbs: int = 2) -> DataFrame:
    """maximal runs of VERB/AUX tokens, ADP allowed inside once a verb has begun;
    a run is kept when it holds at least ``min_verbs`` VERB/AUX. A leading ADP is
    dropped, a trailing one kept; the run at the end of the text is kept too.

    Output ``<id>, run (0-based per document), n_verbs, text``. Within a run the index less the running
    count of run tokens (``rc``) stays the same, so a run is a group of its own, small however long the
    document is; runs of documents in one segment are grouped without a shuffle.
    """
    run_pos = F.col(pos_col).isin(*RUN_POS)
    if "rc" not in long.columns or pos_col != "pos":
        w = Window.partitionBy(id_col).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        long = long.withColumn("rc", F.sum(F.when(run_pos, 1).otherwise(0)).over(w))
    x = long.where(run_pos).select(*[c for c in (id_col, "whole", "seg") if c in long.columns], "i", F.col(text_col).alias("_w"),
                                   (F.col(pos_col) != "ADP").alias("_v"), (F.col("i") - F.col("rc")).alias("_run"))

    def runs(part: DataFrame, keys: list) -> DataFrame:
        g = part.groupBy(*keys, "_run").agg(
            F.count(F.when(F.col("_v"), 1)).alias("n_verbs"), F.min(F.when(F.col("_v"), F.col("i"))).alias("_first"),
            F.array_sort(F.collect_list(F.struct("i", "_w"))).alias("_t"))
        words = F.transform(F.filter("_t", lambda t: t["i"] >= F.col("_first")), lambda t: t["_w"])
        order = Window.partitionBy(*keys).orderBy("_first")
        return g.where(F.col("n_verbs") >= min_verbs).select(
            id_col, (F.row_number().over(order) - 1).cast("int").alias("run"), F.col("n_verbs").cast("int").alias("n_verbs"),
            F.array_join(words, " ").alias("text"))

    if "whole" not in x.columns:
        return runs(x, [id_col])
    return runs(x.where("whole"), [id_col, "whole", "seg"]).union(runs(x.where("not whole"), [id_col]))


# ---------------------------------------------------------------------------
# Heads, distances, marked heads (nested form, index lookups)
# ---------------------------------------------------------------------------
def _at(tokens: Column, idx: Column) -> Column:
    """Token at 0-based position ``idx`` (null when out of range)."""
    return F.try_element_at(tokens, (idx + 1).cast("int"))


def ccomp_pairs(tokens="tokens", verb_pos=VERB_TAGS) -> Column:
    """J12 as an array: for each ccomp token whose head is a verb (by tag) with a
    dimension lemma: ``head_lemma, head_text, head_i, ccomp_text, ccomp_i``."""
    toks = F.col(tokens) if isinstance(tokens, str) else tokens

    def pair(t):
        h = _at(toks, t["head"])
        return F.struct(h["lemma"].alias("head_lemma"), h["text"].alias("head_text"), h["i"].alias("head_i"),
                        t["text"].alias("ccomp_text"), t["i"].alias("ccomp_i"),
                        (h["pos"].isin(*verb_pos) & h["in_dim"]).alias("_ok"))

    ps = F.transform(F.filter(toks, lambda t: t["dep"] == "ccomp"), pair)
    return F.transform(F.filter(ps, lambda p: p["_ok"]), lambda p: p.dropFields("_ok"))


def ccomp_heads(nested: DataFrame, id_col: str = "doc_id", last_per_lemma: bool = False) -> DataFrame:
    """One row per (document, ccomp head pair). With ``last_per_lemma`` only
    the last pair of each head lemma is kept (a later pair overwrites an earlier one)."""
    out = nested.select(id_col, F.inline(ccomp_pairs()))
    if last_per_lemma:
        out = (out.groupBy(id_col, "head_lemma")
               .agg(F.max(F.struct("ccomp_i", "head_i", "head_text", "ccomp_text")).alias("_m"))
               .select(id_col, "head_lemma", "_m.head_text", "_m.head_i", "_m.ccomp_text", "_m.ccomp_i"))
    return out


def _distance_struct(toks: Column, verb_idx: Column, p: Column) -> Column:
    """F4 for one pair ``p`` (head_i, ccomp_i) on sorted tokens carrying ``c``/``vc``;
    ``verb_idx`` holds the positions of verb-tagged tokens (computed once per document)."""
    h = _at(toks, p["head_i"])
    k = _at(toks, p["ccomp_i"])
    v2_i = F.try_element_at(verb_idx, (h["vc"] + 1).cast("int"))
    v = _at(toks, v2_i)
    k_np = F.when(k["tag"] == "PUNCT", 0).otherwise(1)
    ccomp_dist = F.when(p["ccomp_i"] > p["head_i"], k["c"] - k_np - h["c"]).otherwise(F.lit(0))
    v2_dist = F.when(v2_i.isNotNull(), v["c"] - 1 - h["c"])
    return F.struct(p["head_lemma"].alias("head"), p["head_text"].alias("head_text"), p["head_i"].alias("head_i"),
                    p["ccomp_text"].alias("ccomp"), p["ccomp_i"].alias("ccomp_i"),
                    ccomp_dist.cast("int").alias("ccomp_dist"),
                    v["text"].alias("v2"), v2_i.cast("int").alias("v2_i"), v2_dist.cast("int").alias("v2_dist"))


def mark_heads_text(toks: Column, head_i: Column, ccomp_i: Column, v2_i: Column) -> Column:
    """Head ``>>X``, V2 ``X[V2]`` when it is not the ccomp, ccomp ``X<<``, que
    variants upper, PUNCT as is, anything else lower; each token after a blank."""
    def one(t):
        up = F.upper(t["text"])
        body = (F.when(t["tag"] == "PUNCT", t["text"])
                .when(t["i"] == head_i, F.concat(F.lit(">>"), up))
                .when((t["i"] == v2_i) & (v2_i != ccomp_i), F.concat(up, F.lit("[V2]")))
                .when(t["i"] == ccomp_i, F.concat(up, F.lit("<<")))
                .when(_is_word_in(t["text"], QUE_VARIANTS), up)
                .otherwise(F.lower(t["text"])))
        return F.concat(F.lit(" "), body)
    return F.array_join(F.transform(toks, one), "")


def next_verb_distance(nested: DataFrame, id_col: str = "doc_id", with_text: bool = False,
                       last_per_lemma: bool = False, carry=()) -> DataFrame:
    """Per ccomp head pair, V2 (first verb-tagged token after the
    head) and the non-PUNCT token counts strictly between head and ccomp, and head
    and V2. A ccomp before its head gives 0; no V2 gives null V2 and distance.

    Counts come from the running count ``c`` stored on each token: O(1) per pair.
    ``with_text`` adds the J15 marked text per pair; ``carry`` names columns of ``nested``
    that come after the pair's own.
    """
    toks = F.col("tokens")
    # computed once per document, then referenced (lambdas would re-evaluate it)
    nested = nested.withColumn("_pairs", ccomp_pairs())
    pairs = F.col("_pairs")
    if last_per_lemma:
        # keep, per head lemma, the pair with the largest ccomp index (dict overwrite)
        lemmas = F.array_distinct(F.transform(pairs, lambda p: p["head_lemma"]))
        pairs = F.transform(lemmas, lambda l: F.array_max(F.transform(
            F.filter(pairs, lambda p: p["head_lemma"] == l),
            lambda p: F.struct(p["ccomp_i"].alias("ccomp_i"), p["head_lemma"].alias("head_lemma"),
                               p["head_text"].alias("head_text"), p["head_i"].alias("head_i"),
                               p["ccomp_text"].alias("ccomp_text")))))
    if last_per_lemma:
        nested = nested.withColumn("_pairs", pairs)
        pairs = F.col("_pairs")
    nested = nested.withColumn("_vidx", F.transform(F.filter("tokens", lambda t: t["tag"].isin(*VERB_TAGS)),
                                                    lambda t: t["i"]))
    dist = F.transform(pairs, lambda p: _distance_struct(toks, F.col("_vidx"), p))
    if with_text:
        dist = F.transform(dist, lambda d: d.withField(
            "text_norm", mark_heads_text(toks, d["head_i"], d["ccomp_i"], d["v2_i"])))
    return nested.select(id_col, F.inline(dist), *carry)


def distance_table(nested: DataFrame, id_col: str = "doc_id", text: DataFrame | None = None,
                   text_col: str = "text", last_per_lemma: bool = False) -> DataFrame:
    """The full distance result per head pair -- id, the document's target verbs,
    head, ccomp, distances, V2, marked text (J15), dependency text and token details;
    ``text`` (``<id>, text_col``) adds the original text, joined on the id."""
    d = nested.select(id_col, "tokens", target_verbs().alias("verbs"), dep_text().alias("dependencies"),
                      detail_text().alias("details"))
    out = next_verb_distance(d, id_col, with_text=True, last_per_lemma=last_per_lemma,
                             carry=("verbs", "dependencies", "details"))
    if text is not None:
        out = out.join(text.select(id_col, F.col(text_col).alias("text_orig")), id_col, "left")
    return out
