"""Line deduplication that returns bitmaps, in DataFrame functions only.

Lines become (128-bit key hash, document, position). These narrow rows are range-partitioned
by (hash, salt of the document) and sorted by document and position; a window streams over
them and marks each document's first occurrence of a key. The salt splits a key that a third
of all documents hold; its parts meet again in a partial aggregate of one row per part.
A document's result is a compressed bitmap: 64-bit words of dropped positions, with words
that drop nothing left out. Texts take no part in the shuffle of lines.

Rule: a key of at least ``min_chars`` code points that at least ``min_docs`` documents hold
loses all its lines except those in the largest id that holds it. The key is the line without
``[\\x20\\x09-\\x0D]`` at both ends, with A-Z lower-cased.

Defined results: null or empty text is one empty line, which is never dropped while
``min_chars`` > 0; rows that share an id are one document when documents are counted, and rows
that share id and text share one bitmap; a null id counts as one document, smaller than all
others; extra columns are not read (bitmaps) or kept (``drop_lines``); an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbscope.llm.common import WHITE, lower_ascii, quoted, staged, without

SALTS = 64
#: Rows of a key in one part from which on there are more salts.
ROWS_PER_SALT = 1_000_000


def _text(text_col: str) -> Column:
    return F.coalesce(quoted(text_col), F.lit(""))


def line_rows(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, text hash, position, key hash) of every line whose key is long enough."""
    lines = df.select(quoted(id_col).alias("id"), F.xxhash64(_text(text_col)).alias("th"),
                      F.posexplode(F.split(_text(text_col), "\n")).alias("pos", "line"))
    keys = lines.withColumn("key", F.btrim("line", F.lit(WHITE))).where(F.char_length("key") >= min_chars)
    key = lower_ascii(F.col("key"))
    return keys.select("id", "th", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def line_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per (id, text) that loses lines: id, th (text hash), n_dropped, dropped
    (array of struct<word int, bits long>: bit k of word w drops line 64 w + k)."""
    rows = staged(line_rows(df, id_col, text_col, min_chars), "lines")
    salts = SALTS * (1 + rows.count() // (SALTS * ROWS_PER_SALT))
    salted = (rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
              .repartitionByRange("h1", "h2", "salt"))
    stream = Window.partitionBy("h1", "h2", "salt").orderBy(F.col("id").desc_nulls_last(), "th", "pos")
    marked = salted.withColumn("opens", F.when(
        (F.row_number().over(stream) > 1) & F.lag("id").over(stream).eqNullSafe(F.col("id")), 0).otherwise(1))
    parts = marked.groupBy("h1", "h2", "salt").agg(F.sum("opens").alias("docs"), F.max("id").alias("last"))
    repeated = (parts.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
                .where(F.col("docs") >= min_docs).select("h1", "h2", "last"))
    # as a table of its own, so that the join back can split a frequent key's rows
    repeated = staged(repeated, "repeated")
    lost = (rows.join(repeated, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("last")))
            .select("id", "th", (F.col("pos") / 64).cast("int").alias("word"),
                    F.expr("shiftleft(1L, pos % 64)").alias("bit")))
    words = lost.repartition("id", "th").groupBy("id", "th", "word").agg(F.bit_or("bit").alias("bits"))
    return words.groupBy("id", "th").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def kept_lines(text: Column, dropped: Column) -> Column:
    """The lines of a text that its bitmap keeps. The bitmap's words are laid out densely, once per
    text (bound by an outer lambda), so that a line's word is found by its number."""
    j = F.sequence(F.lit(0), F.size(dropped) - 1)
    before = lambda k: F.when(k == 0, -1).otherwise(F.get(dropped, k - 1)["word"])
    dense = F.flatten(F.transform(j, lambda k: F.concat(
        F.array_repeat(F.lit(0).cast("long"), F.get(dropped, k)["word"] - before(k) - 1), F.array(F.get(dropped, k)["bits"]))))

    def kept(words: Column) -> Column:
        return F.filter(F.split(text, "\n"), lambda _line, k: F.getbit(
            F.coalesce(F.get(words, F.floor(k / 64).cast("int")), F.lit(0).cast("long")), F.pmod(k, F.lit(64))) == 0)

    return F.get(F.transform(F.array(dense), kept), F.lit(0))


def drop_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All rows and columns of ``df``, plus ``n_lines``, ``n_dropped`` and ``kept_text``.
    The texts are shuffled once, to meet their bitmaps."""
    bitmaps = line_bitmaps(df, id_col, text_col, min_chars, min_docs).select(
        F.col("id").alias("_id"), F.col("th").alias("_bh"), F.col("n_dropped").alias("_n"), F.col("dropped").alias("_d"))
    docs = without(df, "n_lines", "n_dropped", "kept_text", "_th").withColumn("_th", F.xxhash64(_text(text_col)))
    both = docs.join(bitmaps, docs[f"`{id_col}`"].eqNullSafe(bitmaps["_id"]) & (docs["_th"] == bitmaps["_bh"]), "left")
    text = _text(text_col)
    return (both.withColumn("n_lines", F.size(F.split(text, "\n")).cast("long"))
            .withColumn("n_dropped", F.coalesce("_n", F.lit(0).cast("long")))
            .withColumn("kept_text", F.when(F.col("_d").isNull(), text).otherwise(
                F.array_join(kept_lines(text, F.col("_d")), "\n")))
            .drop("_th", "_id", "_bh", "_n", "_d"))


