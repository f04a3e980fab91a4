"""A1-A5, A10-A14 sources: delimited tables, corpus TSV, folders, API pages, ids.

All readers take an explicit schema (no inference on the cluster) and return lazy
DataFrames; file-level attributes come from the hidden ``_metadata`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import standardize_columns
from ..operators.dedup import dedup_first
from ..operators.joins import substring_join
from ..operators.names import quoted
from .. import schemas as S

# Fixed value: field separator of the tweet tables.
CSV_SEP = "~"


# Columns that a read carries until it is split into kept rows and rejects.
RECORD, REASON = "_record", "_reason"


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _csv(spark: SparkSession, path, schema: T.StructType, sep: str, quoted_breaks: bool = True, **options) -> DataFrame:
    """Every record of the files: the schema's columns, ``file_path``, and ``_record`` / ``_reason``, which are null
    for rows that fit.

    Parsing is permissive and whole: the reason depends on the corrupt-record column and on every data
    column, so all fields of a record are converted whatever columns are asked for later, and a row is
    rejected or kept for good. A record that is only too short is not bad: missing fields at its end are null, as the record is
    parsed again with separators added. Left are records with too many fields (``fields``) and
    records with a value that doesn't fit its type (``value``).

    ``quoted_breaks=False`` says that no quoted field holds a line break: files are split then, and
    one large file is read by many tasks.
    """
    how = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    full = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    raw = (spark.read.schema(full).options(header=True, multiLine=quoted_breaks, enforceSchema=False, **how, **options)
           .csv(path).withColumn("file_path", F.col("_metadata.file_path")).withColumn("file_name", F.col("_metadata.file_name")))
    bare = F.regexp_replace(RECORD, '"([^"]|"")*"', "")
    n_fields = F.char_length(bare) - F.char_length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    missing = F.lit(len(schema.fields)) - n_fields
    padded = F.concat(RECORD, F.repeat(F.lit(sep), missing.cast("int")))
    raw = raw.withColumn("_again", F.when(missing > 0, F.from_csv(padded, ", ".join(f"{_sql_name(f.name)} {f.dataType.simpleString()}" for f in full.fields), how)))
    mended = F.col("_again").isNotNull() & F.col(f"_again.{RECORD}").isNull()
    # always true, and reads every column: Spark converts only the columns that a plan needs, so
    # a bad value in another one would go unseen
    whole = F.xxhash64(*[quoted(f.name) for f in schema.fields]).cast("string") != ""
    reason = F.when(whole & F.col(RECORD).isNotNull() & ~mended, F.when(missing < 0, "fields").otherwise("value"))
    return raw.select(*[F.when(mended, F.col("_again")[f.name]).otherwise(quoted(f.name)).alias(f.name) for f in schema.fields],
                      "file_path", "file_name", F.col(RECORD), reason.alias(REASON))


def kept_rows(parsed: DataFrame) -> DataFrame:
    """Rows that fit the schema."""
    return parsed.where(F.col(REASON).isNull()).drop(RECORD, REASON)


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """``file_path, file_name, record, reason`` of every record that doesn't fit (the reference warns of each)."""
    return parsed.where(F.col(REASON).isNotNull()).select("file_path", "file_name", F.col(RECORD).alias("record"),
                                                          F.col(REASON).alias("reason"))


def spread_if_narrow(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over the cluster when a scan yields fewer partitions than
    the cluster can run at once (e.g. a single-row-group Parquet file), so per-row work
    after the scan runs in parallel. A plan-time decision: on a large, many-file input
    the scan is already wide and this returns ``df`` unchanged (no shuffle added)."""
    sc = df.sparkSession.sparkContext
    target = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def parse_table(spark: SparkSession, path, schema: T.StructType = S.TWEETS_RAW, sep: str = CSV_SEP,
                quoted_breaks: bool = True) -> DataFrame:
    """A1 before the split: see ``kept_rows`` and ``rejected_rows``, which read the same frame."""
    return _csv(spark, path, schema, sep, quoted_breaks)


def read_table(spark: SparkSession, path, schema: T.StructType = S.TWEETS_RAW, columns=None,
               sep: str = CSV_SEP, lang: str | None = None, topic: str | None = None,
               quoted_breaks: bool = True) -> DataFrame:
    """A1: ``~``-separated table with a header; quoted fields may span lines; rows that do not fit
    the schema are skipped, the same ones whatever ``columns``. Optional ``lang`` / ``topic`` tag columns."""
    df = kept_rows(parse_table(spark, path, schema, sep, quoted_breaks)).drop("file_path", "file_name")
    if columns:
        df = df.select(*[quoted(c) for c in columns])
    tags = {}
    if lang is not None:
        tags["lang"] = F.lit(lang)
    if topic is not None:
        tags["topic"] = F.lit(topic)
    return df.withColumns(tags) if tags else df


def parse_corpus(spark: SparkSession, path, headers=None, quoted_breaks: bool = True) -> DataFrame:
    """A2 before the split into kept and rejected rows; names as in the file."""
    from ..plans.bindings import CORPUS_HEADERS
    schema = T.StructType([T.StructField(h, T.StringType()) for h in headers or CORPUS_HEADERS])
    return _csv(spark, path, schema, "\t", quoted_breaks)


def read_corpus(spark: SparkSession, path, headers=None, quoted_breaks: bool = True) -> DataFrame:
    """A2: tab-separated concordance file, all columns strings, names unaccented and
    lower-cased (B2). Rejected are rows with too many fields."""
    return standardize_columns(kept_rows(parse_corpus(spark, path, headers, quoted_breaks)).drop("file_path", "file_name"))


def parse_folder(spark: SparkSession, root: str, schema: T.StructType = S.TWEETS_RAW, glob: str = "*tweets*.csv",
                 sep: str = CSV_SEP, quoted_breaks: bool = True) -> DataFrame:
    """A3 before the split into kept and rejected rows."""
    return _csv(spark, root, schema, sep, quoted_breaks, recursiveFileLookup=True, pathGlobFilter=glob)


def read_folder(spark: SparkSession, root: str, schema: T.StructType = S.TWEETS_RAW,
                glob: str = "*tweets*.csv", sep: str = CSV_SEP, quoted_breaks: bool = True) -> DataFrame:
    """A3: every matching file under ``root`` (recursive), with ``file_path``,
    ``file_name`` and ``folder`` (parent directory name) columns."""
    df = kept_rows(parse_folder(spark, root, schema, glob, sep, quoted_breaks))
    return df.withColumn("folder", F.element_at(F.split("file_path", "/"), -2))


def explode_pages(pages: DataFrame) -> dict:
    """A4: one API page per row -> tables ``tweets``, ``users``, ``places``, ``meta``,
    ``errors``; nested objects are flattened (A5), lists stay lists.

    ``pages`` has the page schema (``schemas.PAGE``) plus optional ``topic``/``page``.
    """
    keep = [c for c in ("topic", "page") if c in pages.columns]
    tweets = pages.select(*keep, F.explode("data").alias("t")).select(*keep, "t.*")
    tweets = flatten_struct(tweets)
    tweets = tweets.withColumnsRenamed({k: v for k, v in S.TWEET_RENAMES.items() if k in tweets.columns})
    users = flatten_struct(pages.select(*keep, F.explode("includes.users").alias("u")).select(*keep, "u.*"))
    users = users.withColumnsRenamed({k: v for k, v in S.USER_RENAMES.items() if k in users.columns})
    places = pages.select(*keep, F.explode("includes.places").alias("p")).select(*keep, "p.*")
    places = places.withColumnsRenamed({k: v for k, v in S.PLACE_RENAMES.items() if k in places.columns})
    errors = pages.select(*keep, F.explode("errors").alias("e")).select(*keep, "e.*")
    meta = pages.select(*keep, "meta.*")
    return {"tweets": tweets, "users": users, "places": places, "errors": errors, "meta": meta}


def read_raw_pages(spark: SparkSession, path) -> DataFrame:
    """Saved responses without a schema: ``page`` as ``variant``, one JSON page per line; a line that isn't
    JSON becomes null and its text stays in ``raw``."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.try_parse_json("value").alias("page"), F.when(F.try_parse_json("value").isNull(), F.col("value")).alias("raw"))


# Lists with tables of their own (see ``explode_pages``), and the object that is kept whole.
KNOWN_LISTS, KEPT_WHOLE = ("data", "users", "places"), ("meta",)


def page_lists(pages: DataFrame, page_col: str = "page", depth: int = 8) -> DataFrame:
    """A4 for pages of any shape: every list of a page, at whatever object it hangs: ``table`` (the list's
    name), ``pos``, ``item`` (variant), and the other columns of ``pages``.

    The reference walks a response's keys: a list is a table, ``meta`` is kept whole, another object is walked in turn. Here one
    level is one ``variant_explode``, which lists found before pass through, so that pages are read once; ``depth`` bounds
    how far objects may nest (a list below that would be an error, and is raised as one). No schema is needed, so a list
    that no schema names comes out as a table too.
    """
    rest = [c for c in pages.columns if c != page_col]
    level = pages.select(*[quoted(c) for c in rest], F.lit(None).cast("string").alias("table"), quoted(page_col).alias("_v"),
                         F.lit(True).alias("_walk"))
    for _ in range(depth):
        level = _members(level, rest).where(F.col("_walk") | F.col("_kind").startswith("ARRAY"))
    deeper = F.raise_error(F.lit(f"objects nest deeper than {depth}")).cast("variant")
    return _items(_members(level, rest).withColumn("_v", F.when(F.col("_member"), deeper).otherwise(F.col("_v"))), rest)


def _members(level: DataFrame, rest: list) -> DataFrame:
    """Objects to walk (``_walk``) replaced by their members, the other rows as they are: name, value, kind, whether it is
    an object to walk, and whether it came as a member."""
    names, walk = [quoted(c) for c in rest], F.col("_walk")
    out = level.lateralJoin(level.sparkSession.tvf.variant_explode_outer(F.when(walk, F.col("_v")).outer()))
    out = out.where(~walk | F.col("pos").isNotNull()).select(
        *names, F.when(walk, F.col("key")).otherwise(F.col("table")).alias("table"), F.when(walk, F.col("value")).otherwise(F.col("_v")).alias("_v"),
        walk.alias("_member"), F.when(walk, F.schema_of_variant("value")).otherwise("ARRAY").alias("_kind"))
    return out.withColumn("_walk", F.coalesce(F.col("_kind").startswith("OBJECT") & ~F.col("table").isin(*KEPT_WHOLE), F.lit(False)))


def _items(lists: DataFrame, rest: list) -> DataFrame:
    return lists.lateralJoin(lists.sparkSession.tvf.variant_explode(F.col("_v").outer())).select(
        *[quoted(c) for c in rest], "table", F.col("pos").cast("long").alias("pos"), F.col("value").alias("item"))


def list_table(lists: DataFrame, name: str, schema: T.StructType | str) -> DataFrame:
    """One list of ``page_lists`` as a table with ``schema``; fields that an item lacks, or that don't fit, are null."""
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    ddl = ddl if ddl.startswith("struct<") else f"struct<{ddl}>"
    rest = [c for c in lists.columns if c not in ("table", "pos", "item")]
    row = F.try_variant_get("item", "$", ddl)
    return lists.where(F.col("table") == name).select(*[quoted(c) for c in rest], "pos", row.alias("_r")).select(
        *[quoted(c) for c in rest], "pos", "_r.*")


def page_meta(pages: DataFrame) -> DataFrame:
    """E9 per page: rows in the page (``page_size``) and the continuation token
    (``next_token``, null on the last page)."""
    keep = [c for c in ("topic", "page") if c in pages.columns]
    return pages.select(*keep, F.coalesce(F.size("data"), F.lit(0)).cast("long").alias("page_size"),
                        F.col("meta.next_token").alias("next_token"))


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """A5: nested struct columns -> one column per leaf named ``a.b.c`` (or with
    ``sep``); arrays are left as they are."""
    cols = []

    def walk(prefix, dt, path):
        if isinstance(dt, T.StructType):
            for f in dt.fields:
                walk(prefix + [f.name], f.dataType, path + [f"`{f.name}`"])
        else:
            cols.append(F.col(".".join(path)).alias(sep.join(prefix)))

    for f in df.schema.fields:
        walk([f.name], f.dataType, [f"`{f.name}`"])
    return df.select(*cols)


def read_pages(spark: SparkSession, path) -> DataFrame:
    """A11 (read side): saved raw responses, one JSON page per line, explicit schema."""
    return spark.read.schema(S.PAGE).json(path)


def read_ids(spark: SparkSession, path) -> DataFrame:
    """A10: id registry text files (blank-, newline- or comma-separated) -> distinct
    ``id string``. Stays distributed; never collected."""
    t = spark.read.text(path)
    ids = t.select(F.explode(F.split(F.col("value"), "[\\s,]+")).alias("id")).select(F.trim("id").alias("id"))
    return ids.where(F.col("id") != "").distinct()


def topic_from_path(df: DataFrame, name_col: str, verbs: DataFrame) -> DataFrame:
    """First verb in dimension order (``ord``) that is a substring of the file
    stem; null when none.

    Distinct stems (one per file, not per row) meet the verbs in the substring join, the first verb of
    each stem is an aggregate, and rows get it by stem. Neither side has a size limit.
    """
    stem = F.regexp_replace(quoted(name_col), "\\.[^.]*$", "")
    dim = verbs.select(F.col("verb").alias("_verb"), F.col("ord").alias("_ord")).where("_verb is not null")
    stems = df.select(stem.alias("_stem")).where("_stem is not null").distinct()
    first = substring_join(stems, "_stem", dim, "_verb").where("_verb is not null")
    first = dedup_first(first, "_stem", ["_ord", "_verb"]).select(F.col("_stem").alias("_of"), F.col("_verb").alias("topic"))
    return df.drop("topic").withColumn("_stem", stem).join(first, F.col("_stem") == F.col("_of"), "left").drop("_stem", "_of")


def keyword_from_path(df: DataFrame, name_col: str, pattern: str, group: int = 1) -> DataFrame:
    """Regex group from the file name, lower-cased and trimmed."""
    kw = F.lower(F.trim(F.regexp_extract(F.col(name_col), pattern, group)))
    return df.withColumn("keyword", F.when(kw != "", kw))


def load_verbs(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Verb dimension ``verb, verb_type, indicativo, ord``; one row per verb,
    the first by ``ord`` when a verb is listed twice."""
    if fmt == "csv":
        df = spark.read.schema(S.VERBS).option("header", True).csv(path)
    else:
        df = spark.read.parquet(path)
    return dedup_first(df, "verb", "ord")
