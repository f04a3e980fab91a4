"""Queries of single operators that no other query calls, with their DuckDB SQL.

Each calls the library function itself; the SQL is written from the operator's meaning.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..operators import aggregates as AG
from ..operators import columns as CO
from ..operators import filters as FL
from ..operators import joins as JN
from ..operators import sequence as SQ
from ..operators import setops as SE
from ..operators import token_texts as TT
from ..session import shared_dir
from ..sources import readers as RD
from .bindings import verbs_frame
from .catalog import _dealt, _doc_verbs, _events_with_nulls, _long, _pulls, _t, _texts
from .oracle import DEP_TEXT, DETAIL_TEXT, ORACLE as _MAIN, PAIRS, TARGETS, VERBS, _every, _tok
from .oracle import _events_with_nulls as _events_sql
from .sqltext import W, token_set_list

_V = VERBS.replace("AS verbs(", "AS v(")


def drop_null_text(spark, sf):
    return FL.drop_null_text(_events_with_nulls(spark, sf), "props").select("event_id")


def dependency_in_text(spark, sf):
    n = _texts(spark, sf, dependencies=TT.dep_piece())
    return n.select("doc_id", FL.has_dependency("dependencies").alias("has_dep"))


def filter_known_verbs(spark, sf):
    t = _long(spark, sf).where(F.col("pos") == "VERB").select(F.col("lemma").alias("verb"))
    parts = zip(("known", "unknown"), FL.filter_known_verbs(t, "verb", verbs_frame(spark)))
    return reduce(DataFrame.unionByName, [
        df.groupBy("verb").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "verb", "n")
        for name, df in parts])


def anti_join_tables(spark, sf):
    docs = _t(spark, sf, "documents", spread=False).select("doc_id")
    orders = _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    left = JN.anti_join_tables({"documents": docs, "customer": _t(spark, sf, "customer").select("c_custkey")},
                               {"documents": _t(spark, sf, "labels"), "customer": orders},
                               {"documents": "doc_id", "customer": "c_custkey"})
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("table_name"), F.col(df.columns[0]).alias("id")) for name, df in left.items()])


def lookup(spark, sf):
    n = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    return JN.lookup(_t(spark, sf, "customer"), n, "c_nationkey", ["n_name"]).select("c_custkey", "n_name")


def containment_join(spark, sf):
    dim = verbs_frame(spark).select("verb", "verb_type")
    return JN.containment_join(_doc_verbs(spark, sf), "verbs", dim, "verb").select("doc_id", "verb", "verb_type")


def substring_join(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text")
    return JN.substring_join(d, "text", verbs_frame(spark).select("verb"), "verb").select("doc_id", "verb")


def duplicate_total(spark, sf):
    return AG.duplicate_report(_t(spark, sf, "documents"), "text")


def distinct_values(spark, sf):
    return AG.distinct_values(_t(spark, sf, "documents", spread=False), "source")


def table_shape(spark, sf):
    return AG.table_shape(_t(spark, sf, "lineitem"))


def merge_tables_first(spark, sf):
    new, prev = _pulls(spark, sf)
    merged = SE.merge_tables({"documents": SE.append(new, prev), "customer": _t(spark, sf, "customer")},
                             {"documents": "text", "customer": "c_nationkey"},
                             {"documents": "doc_id", "customer": "c_custkey"})
    return (merged["documents"].select(F.lit("documents").alias("table_name"), F.col("doc_id").alias("id"))
            .unionByName(merged["customer"].select(F.lit("customer").alias("table_name"), F.col("c_custkey").alias("id"))))


def pos_text_corpus(spark, sf):
    return _texts(spark, sf, pos=TT.pos_piece(drop_punct=True))


def token_details(spark, sf):
    return TT.token_details(_long(spark, sf)).select("doc_id", "i", F.col("text").alias("w"), "pos", "dep")


def distance_table(spark, sf):
    long, tasks = _dealt(spark, sf)
    t = TT.distance_table(long, partitions=tasks)
    return t.select("doc_id", "verbs", "head", "head_i", "ccomp_i", "ccomp_dist", "v2", "v2_dist",
                    F.md5("dependencies").alias("dependencies_md5"), F.md5("details").alias("details_md5"))


def _delimited(spark, sf):
    """Customers written as ``~``-separated files with a header, records damaged by their number's last
    digit: 3 one field too many, 4 a text where a number belongs, 5 too short, 6 separator and marks in quotes."""
    c = _t(spark, sf, "customer")
    digit, name = F.col("c_custkey") % 10, F.col("c_name")
    fields = [F.col("c_custkey").cast("string"),
              F.when(digit == 6, F.concat(F.lit('"'), name, F.lit('~""x"""'))).otherwise(name),
              F.when(digit == 4, "x").otherwise(F.col("c_nationkey").cast("string")),
              F.when(digit != 5, F.round(F.col("c_acctbal") * 100).cast("long").cast("string")), F.when(digit == 3, "more")]
    path = f"{shared_dir(spark)}/delimited-{uuid.uuid4().hex}"
    line = F.concat_ws("~", *fields).alias("~".join(f.name for f in _CUSTOMER.fields))
    c.select(line).write.options(header=True, sep="\x01", quote="", emptyValue="").csv(path)
    return RD.parse_table(spark, path, _CUSTOMER)


_CUSTOMER = T.StructType().add("id", "long").add("name", "string").add("nation", "long").add("cents", "long")


def read_table(spark, sf):
    return RD.kept_rows(_delimited(spark, sf)).select("id", "name", "nation", "cents")


def rejected_rows(spark, sf):
    r = RD.rejected_rows(_delimited(spark, sf))
    return r.select(F.substring_index("record", "~", 1).cast("long").alias("id"), "reason")


def page_lists(spark, sf):
    """Customers as saved pages of no schema: lists at several depths, one of plain numbers, one empty."""
    c = _t(spark, sf, "customer")
    page = F.to_json(F.struct(
        F.array(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("text"))).alias("data"),
        F.struct(F.struct(F.array(F.struct(F.col("c_mktsegment").alias("tag"))).alias("segments")).alias("deep"),
                 F.array("c_custkey", "c_nationkey").alias("codes"), F.array().cast("array<int>").alias("empty")).alias("includes"),
        F.struct(F.array("c_custkey").alias("data")).alias("meta")))
    return RD.page_lists(c.select(F.parse_json(page).alias("page"))).select(
        F.col("table").alias("list_name"), "pos", F.to_json("item").alias("item"))


def list_table(spark, sf):
    """A list that no schema names, as a table."""
    o = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")))).alias("orders"))
    pages = o.select("o_custkey", F.parse_json(F.to_json(F.struct("orders"))).alias("page"))
    return RD.list_table(RD.page_lists(pages), "orders", "id long, status string, missing int").select("o_custkey", "pos", "id", "status", "missing")


def duplicate_report_total(spark, sf):
    """Folder rows and the row of all folders together, keys compared across folders."""
    return AG.duplicate_report(_t(spark, sf, "documents", spread=False), "text", "source", total="all folders")


MEETS = ("the", "and", "que")


def token_intersects(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select("doc_id", F.coalesce(TX.intersects(TX.token_set("text"), MEETS), F.lit(False)).alias("meets"))


def convert_types(spark, sf):
    bad = F.col("event_type") == "error"
    raw = _t(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created"),
        F.when(bad, F.concat(F.lit("x"), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string")).alias("n"),
        F.when(bad, F.lit("none")).otherwise(F.col("value").cast("string")).alias("x"))
    typed = CO.convert_types(raw, {"created": "datetime", "n": "int", "x": "float", "not_there": "int"})
    return typed.select("event_id", F.unix_millis("created").alias("created_ms"), "n", "x")


def page_batches_all(spark, sf):
    c = _t(spark, sf, "conversations", spread=False).select(
        F.col("conv_id").alias("topic"), F.col("turn").alias("page"),
        F.coalesce(F.pmod(F.length("text"), F.lit(100)), F.lit(0)).cast("long").alias("rows"))
    return SQ.page_batches(c, "topic", "page", "rows", batch_size=150).select("topic", "page", "batch")


QUERIES = {f.__name__: f for f in (
    drop_null_text, dependency_in_text, filter_known_verbs, anti_join_tables, lookup, containment_join, substring_join,
    duplicate_total, distinct_values, table_shape, merge_tables_first, pos_text_corpus, token_details, distance_table,
    token_intersects, convert_types, page_batches_all, read_table, rejected_rows,
    duplicate_report_total, page_lists, list_table)}

ORACLE = {
    "read_table": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 6 THEN c_name || '~"x"' ELSE c_name END AS name,
       c_nationkey::BIGINT AS nation, CASE WHEN c_custkey % 10 <> 5 THEN round(c_acctbal * 100)::BIGINT END AS cents
FROM customer WHERE c_custkey % 10 NOT IN (3, 4)""",
    "rejected_rows": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 3 THEN 'fields' ELSE 'value' END AS reason
FROM customer WHERE c_custkey % 10 IN (3, 4)""",
    "page_lists": """
SELECT 'data' AS list_name, 0::BIGINT AS pos, '{"id":' || c_custkey || ',"text":"' || c_name || '"}' AS item FROM customer
UNION ALL SELECT 'segments', 0, '{"tag":"' || c_mktsegment || '"}' FROM customer
UNION ALL SELECT 'codes', 0, c_custkey::VARCHAR FROM customer UNION ALL SELECT 'codes', 1, c_nationkey::VARCHAR FROM customer""",
    "list_table": """
SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos, o_orderkey AS id, o_orderstatus AS status, NULL::INTEGER AS missing
FROM orders""",
    "duplicate_report_total": """
SELECT source, count(*) AS original, count(*) - count(DISTINCT text) AS dups FROM documents GROUP BY source
UNION ALL SELECT 'all folders', count(*), count(*) - count(DISTINCT text) FROM documents""",
    "drop_null_text": f"SELECT event_id FROM ({_events_sql()}) WHERE props IS NOT NULL",
    "dependency_in_text": _every(_tok(f"\nSELECT doc_id, contains({DEP_TEXT}, 'ccomp') AS has_dep FROM tok GROUP BY doc_id"), has_dep="false"),
    "filter_known_verbs": _tok(f"""
SELECT CASE WHEN verb IN (SELECT verb FROM {_V}) THEN 'known' ELSE 'unknown' END AS part, verb, count(*) AS n
FROM (SELECT regexp_replace(lemma, '[^{W}]+', '', 'g') AS verb FROM tok WHERE pos = 'VERB') x GROUP BY 1, 2"""),
    "anti_join_tables": """
SELECT 'documents' AS table_name, doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)
UNION ALL
SELECT 'customer', c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
    "lookup": "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
    "containment_join": _tok(f"""
SELECT DISTINCT t.doc_id, v.verb, v.verb_type FROM tok t JOIN {_V} ON v.verb = t.lemma WHERE t.is_target"""),
    "substring_join": f"SELECT doc_id, v.verb FROM documents LEFT JOIN {_V} ON contains(text, v.verb)",
    "duplicate_total": """
SELECT CAST(sum(c) AS BIGINT) AS original, CAST(sum(c) - count(*) AS BIGINT) AS dups
FROM (SELECT text, count(*) AS c FROM documents GROUP BY text)""",
    "distinct_values": "SELECT source FROM documents GROUP BY source",
    "table_shape": "SELECT count(*) AS n_rows, (SELECT count(*) FROM (DESCRIBE SELECT * FROM lineitem)) AS n_cols FROM lineitem",
    "merge_tables_first": """
WITH u AS (SELECT doc_id, text FROM documents UNION ALL
           SELECT doc_id + 1000000, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT 'documents' AS table_name, min(doc_id) AS id FROM u GROUP BY text
UNION ALL SELECT 'customer', min(c_custkey) FROM customer GROUP BY c_nationkey""",
    "pos_text_corpus": _every(_tok("""
SELECT doc_id, coalesce(string_agg(text || '(' || upper(pos) || ')', ' ' ORDER BY i) FILTER (pos <> 'PUNCT'), '') AS pos
FROM tok GROUP BY doc_id"""), pos="''"),
    "token_details": _tok("\nSELECT doc_id, i, text AS w, pos, dep FROM tok"),
    "distance_table": _tok(PAIRS + f""",
tv AS ({TARGETS}),
dt AS (SELECT doc_id, md5({DEP_TEXT}) AS dependencies_md5, md5({DETAIL_TEXT}) AS details_md5 FROM tok GROUP BY doc_id)
SELECT d.doc_id, tv.verbs, d.head_lemma AS head, d.head_i, d.ccomp_i, d.ccomp_dist, d.v2, d.v2_dist,
       dt.dependencies_md5, dt.details_md5
FROM dist2 d JOIN tv ON tv.doc_id = d.doc_id JOIN dt ON dt.doc_id = d.doc_id"""),
    "token_intersects": (f"SELECT doc_id, coalesce(list_has_any({token_set_list('text')}, ["
                         + ", ".join(f"'{w}'" for w in MEETS) + "]), false) AS meets FROM documents"),
    "convert_types": """
SELECT event_id, epoch_ms(date_trunc('second', ts)) AS created_ms, CASE WHEN event_type <> 'error' THEN user_id END AS n,
       CASE WHEN event_type <> 'error' THEN value END AS x FROM events""",
    "page_batches_all": _MAIN["page_batches"].replace(" WHERE batch <= 2", ""),
}
