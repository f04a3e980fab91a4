"""DuckDB oracle SQL for the registered queries (tables are pre-registered views).

Each statement is written from the operator's stated semantics, not from the Spark
plan: e.g. distances are counted with correlated sub-queries, the head of a token is
a ``max`` over a preceding frame, page batches are a recursive CTE.
"""

from __future__ import annotations

from ..operators.tokens import RUN_POS, VERB_TAGS
from ..functions.text import QUE_VARIANTS, QUE_WORDS
from .bindings import BINDING_COMPLEMENTISERS, verbs_values_sql
from .catalog import ALL_TERMS
from .sqltext import (W, fold, has_words, normalize, q, sql_list, token_ctes, token_set_list, upper)

VERBS = verbs_values_sql()
DOCS = "SELECT doc_id, text FROM documents"
TOK = "WITH " + token_ctes(DOCS, VERBS).strip()


def _tok(body: str) -> str:
    """Statement on top of the token CTE ``tok`` (extra CTEs may follow with a comma)."""
    return f"{TOK}{body}"


def _every(sql: str, **empty) -> str:
    """A per-document statement with the documents that have no token: their values are those of ``empty``."""
    cols = ", ".join(f"coalesce(x.{c}, {v}) AS {c}" for c, v in empty.items())
    return f"SELECT d.doc_id, {cols} FROM documents d LEFT JOIN ({sql}) x ON x.doc_id = d.doc_id"


def _fold_lower(x: str) -> str:
    return f"lower({fold(x)})"


def _mark_piece(mode: str) -> str:
    words = QUE_VARIANTS if mode == "variants" else QUE_WORDS
    is_que = f"{_fold_lower('text')} IN ({sql_list(words)})"
    up = upper("text")
    if mode == "variants":
        return (f"' ' || CASE WHEN is_punct THEN text WHEN {is_que} THEN {up} "
                f"WHEN is_target AND dep = 'ccomp' THEN '<<' || {up} || '>>' "
                f"WHEN is_target THEN {up} ELSE lower(text) END")
    if mode == "corpus":
        body = (f"CASE WHEN {is_que} THEN {up} WHEN is_target AND dep = 'ccomp' THEN '<<' || {up} || '>>' "
                f"ELSE lower(text) END")
    else:
        body = (f"CASE WHEN {is_que} THEN {up} WHEN is_target AND dep = 'ccomp' THEN '<<' || {up} || '>>' "
                f"WHEN is_target THEN {up} ELSE lower(text) END")
    return f"CASE WHEN pos = 'PUNCT' THEN text ELSE ' ' || {body} END"


def _doc_agg(expr: str, name: str, where: str = "") -> str:
    filt = f" FILTER (WHERE {where})" if where else ""
    return _tok(f"\nSELECT doc_id, coalesce(string_agg({expr}, ''{' ORDER BY i' if True else ''}){filt}, '') AS {name} "
                f"FROM tok GROUP BY doc_id")


TARGETS = ("SELECT doc_id, nullif(array_to_string(list_sort(list_distinct(list(lemma) FILTER (WHERE is_target))), "
           "', '), '') AS verbs FROM tok GROUP BY doc_id")

DEP_TEXT = ("coalesce(string_agg(CASE WHEN pos = 'PUNCT' THEN ' ' || text ELSE ' ' || lower(text) || '[' || dep || ']' "
            "END, '' ORDER BY i), '')")
POS_TEXT = "coalesce(string_agg(text || '(' || upper(pos) || ')', ' ' ORDER BY i), '')"
DETAIL_TEXT = ("coalesce(string_agg('<' || text || '>(' || lower(lemma) || ',' || CASE WHEN is_stop THEN 'True' "
               "ELSE 'False' END || ')', ' ' ORDER BY i) FILTER (WHERE pos <> 'PUNCT'), '')")

PAIRS = f""",
pairs AS (
  SELECT k.doc_id, h.lemma AS head_lemma, h.text AS head_text, h.i AS head_i, k.text AS ccomp_text, k.i AS ccomp_i
  FROM tok k JOIN tok h ON h.doc_id = k.doc_id AND h.i = k.head
  WHERE k.dep = 'ccomp' AND h.pos IN ({sql_list(VERB_TAGS)}) AND h.in_dim),
dist AS (
  SELECT p.*,
    (SELECT min(t.i) FROM tok t WHERE t.doc_id = p.doc_id AND t.i > p.head_i AND t.tag IN ({sql_list(VERB_TAGS)})) AS v2_i,
    (SELECT count(*) FROM tok t WHERE t.doc_id = p.doc_id AND t.i > p.head_i AND t.i < p.ccomp_i
        AND t.tag <> 'PUNCT') AS ccomp_dist
  FROM pairs p),
dist2 AS (
  SELECT d.*, v.text AS v2,
    CASE WHEN d.v2_i IS NOT NULL THEN (SELECT count(*) FROM tok t WHERE t.doc_id = d.doc_id AND t.i > d.head_i
        AND t.i < d.v2_i AND t.tag <> 'PUNCT') END AS v2_dist
  FROM dist d LEFT JOIN tok v ON v.doc_id = d.doc_id AND v.i = d.v2_i)"""


def _events_with_nulls() -> str:
    return ("SELECT event_id, ts, user_id, event_type, CASE WHEN value >= 5 THEN value END AS value, "
            "CASE WHEN event_type <> 'error' THEN props END AS props FROM events")


def _file_names() -> str:
    first = "lower(regexp_extract(text, '^[^\\p{L}]*(\\p{L}+)', 1))"
    return (f"SELECT doc_id, 'twitter-' || lang || '-' || {first} || '-' || source || '.csv' AS file_name "
            f"FROM documents")


def _pulls() -> str:
    return ("u AS (SELECT doc_id, text, 0 AS src FROM documents UNION ALL "
            "SELECT doc_id + 1000000, text, 1 FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))")


ORACLE = {
    "que_rate_by_lang": f"""
WITH n AS (SELECT DISTINCT lang, {normalize('text')} AS t FROM documents)
SELECT lang, CAST(count(*) AS BIGINT) AS n_docs,
       CAST(sum(CASE WHEN {has_words('t')} THEN 1 ELSE 0 END) AS BIGINT) AS n_que,
       round(sum(CASE WHEN {has_words('t')} THEN 1 ELSE 0 END) / count(*), 6) AS que_rate
FROM n GROUP BY lang""",

    "normalize_text": f"SELECT doc_id, {normalize('text')} AS text_norm FROM documents",

    "parse_times": """
WITH r AS (SELECT event_id, CASE WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')
                      WHEN event_type = 'error' THEN 'x' || CAST(event_id AS VARCHAR)
                      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw FROM events),
p AS (SELECT event_id, coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'),
                                try_strptime(raw, '%Y-%m-%dT%H:%M:%S.%gZ')) AS parsed FROM r)
SELECT event_id, epoch_ms(parsed) AS parsed_ms, parsed IS NULL AS bad FROM p""",

    "ref_ids": """
WITH s AS (SELECT event_id,
  '[{''type'': ''replied_to'', ''id'': ''' || CAST(event_id AS VARCHAR) || '''}, {''type'': ''quoted'', ''id'': '''
     || CAST(user_id AS VARCHAR) || '''}]' AS refs,
  '[''' || event_type || ''', ''' || CAST(user_id AS VARCHAR) || ''']' AS lst,
  concat_ws(', ', event_type, CAST(user_id AS VARCHAR)) AS pair FROM events),
x AS (SELECT event_id, regexp_extract_all(refs, '''id'': ''(\\d+)', 1) AS ids,
             regexp_replace(lst, '[\\[\\]'']+', '', 'g') AS body, pair FROM s)
SELECT event_id, array_to_string(ids, ',') AS ref_ids, CAST(len(ids) AS BIGINT) AS n_refs,
       CASE WHEN body = '' THEN '' ELSE array_to_string(string_split(body, ', '), '|') END AS parsed_list,
       CAST(len(string_split(pair, ', ')) AS BIGINT) AS n_split FROM x""",

    "topic_from_path": f"""
WITH f AS ({_file_names()}), s AS (SELECT doc_id, regexp_replace(file_name, '\\.[^.]*$', '') AS stem FROM f)
SELECT doc_id, (SELECT v.verb FROM {VERBS} WHERE contains(s.stem, v.verb) ORDER BY v.ord LIMIT 1) AS topic
FROM s""".replace("AS verbs(verb", "AS v(verb"),

    "keyword_from_path": f"""
WITH f AS ({_file_names()})
SELECT doc_id, nullif(lower(trim(regexp_extract(file_name, 'twitter-[a-z]+-([^-]+)-', 1))), '') AS keyword FROM f""",

    "select_rename_combine": """
SELECT c_custkey AS user_id, c_name AS username, c_nationkey AS place_id,
       '(' || concat_ws(', ', c_mktsegment, CAST(c_nationkey AS VARCHAR)) || ')' AS segment_place FROM customer""",

    "assign_ids": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 + 1000 AS id FROM documents",

    "assign_ids_wide": """
SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id FROM lineitem""",

    "sample_fraction": """
SELECT doc_id FROM documents
WHERE ('0x' || substr(md5(doc_id || '|7'), 1, 13))::BIGINT < 0.1::DOUBLE * 4503599627370496::DOUBLE""",

    "sample_n": """
SELECT doc_id FROM documents ORDER BY ('0x' || substr(md5(doc_id || '|7'), 1, 13))::BIGINT, doc_id LIMIT 25""",

    "batches": """
WITH x AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS n FROM documents),
y AS (SELECT idx, n, CAST(ceil(n / 64.0) AS BIGINT) AS k FROM x),
z AS (SELECT idx, n // k AS qq, n % k AS rr FROM y)
SELECT CAST(CASE WHEN idx < rr * (qq + 1) THEN idx // (qq + 1) ELSE rr + (idx - rr * (qq + 1)) // qq END AS BIGINT)
       AS batch, count(*) AS rows FROM z GROUP BY 1""",

    "all_terms": "SELECT doc_id FROM documents WHERE " + " AND ".join(
        f"regexp_matches(lower(text), {q(t)})" for t in ALL_TERMS),

    "verb_then_que": _tok(f""",
nx AS (SELECT doc_id, i, lemma, is_target, lead(lemma) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM tok)
SELECT doc_id, lemma AS verb, count(*) AS n FROM nx
WHERE is_target AND lower(nxt) IN ({sql_list(BINDING_COMPLEMENTISERS)}) GROUP BY doc_id, lemma"""),

    "known_verbs": _tok(f"""
SELECT verb, count(*) AS n FROM (SELECT regexp_replace(lemma, '[^{W}]+', '', 'g') AS verb FROM tok WHERE pos = 'VERB') x
WHERE verb IN (SELECT verb FROM {VERBS}) GROUP BY verb"""),

    "unknown_verbs": _tok(f"""
SELECT verb, count(*) AS n FROM (SELECT regexp_replace(lemma, '[^{W}]+', '', 'g') AS verb FROM tok WHERE pos = 'VERB') x
WHERE NOT EXISTS (SELECT 1 FROM {VERBS} WHERE verbs.verb = x.verb) GROUP BY verb"""),

    "query_match": f"""
WITH d AS (SELECT doc_id, v.verb AS topic, {token_set_list(fold('text'))} AS ts FROM documents
           JOIN {VERBS.replace('AS verbs(', 'AS v(')}
             ON v.ord = CAST(regexp_extract(source, '[0-9]+', 0) AS INTEGER) % 12),
c AS (SELECT DISTINCT verb AS topic, tok FROM (SELECT verb, unnest({token_set_list(fold('indicativo'))}) AS tok
      FROM {VERBS}) WHERE tok <> 'or'),
m AS (SELECT DISTINCT d.doc_id, d.topic FROM (SELECT doc_id, topic, unnest(ts) AS tok FROM d) d
      JOIN c ON c.topic = d.topic AND c.tok = d.tok)
SELECT t.topic, CAST(coalesce(mm.matched, 0) AS BIGINT) AS matched, CAST(t.total AS BIGINT) AS total
FROM (SELECT topic, count(*) AS total FROM d GROUP BY topic) t
LEFT JOIN (SELECT topic, count(*) AS matched FROM m GROUP BY topic) mm ON mm.topic = t.topic""",

    "places_left_join": """
SELECT n.n_name AS country, count(*) AS n FROM customer c
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""",

    "flagged_users": """
SELECT c_custkey, coalesce(c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0
                                          AND s_nationkey IS NOT NULL), false) AS flagged FROM customer""",

    "registry_kept": """
SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE CAST(l.doc_id AS VARCHAR) =
                                                 CAST(d.doc_id AS VARCHAR))""",

    "registry_update": """
SELECT DISTINCT id FROM (SELECT CAST(doc_id AS VARCHAR) AS id FROM labels
                         UNION ALL SELECT CAST(doc_id AS VARCHAR) FROM documents)""",

    "registry_duplicates": """
WITH p AS (SELECT CAST(user_id AS VARCHAR) AS id, count(DISTINCT event_type) AS n_files FROM events
           WHERE user_id IS NOT NULL GROUP BY 1),
r AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS id FROM supplier)
SELECT p.id, r.id IS NOT NULL AS seen, p.n_files, (r.id IS NOT NULL OR p.n_files > 1) AS dup
FROM p LEFT JOIN r ON r.id = p.id""",

    "duplicate_report": """
SELECT source, CAST(sum(c) AS BIGINT) AS original, CAST(sum(c) - count(*) AS BIGINT) AS dups
FROM (SELECT source, text, count(*) AS c FROM documents GROUP BY source, text) GROUP BY source""",

    "dedup_first": "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text",

    "dedup_per_folder": "SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source, text",

    "merge_pull": f"""
WITH {_pulls()},
r AS (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY src, doc_id) AS rn,
             max(src) OVER (PARTITION BY text) AS mx FROM u)
SELECT doc_id, mx = 0 AS is_new FROM r WHERE rn = 1""",

    "merge_report": f"""
WITH {_pulls()},
k1 AS (SELECT text, count(*) AS r, max(src) AS mx FROM u GROUP BY text),
e AS (SELECT user_id, event_type, 0 AS src FROM events UNION ALL
      SELECT user_id, event_type, 1 FROM events WHERE event_type = 'view'),
k2 AS (SELECT user_id, event_type, count(*) AS r, max(src) AS mx FROM e GROUP BY user_id, event_type)
SELECT 'documents' AS table_name, CAST(sum(r) AS BIGINT) AS rows, count(*) AS kept,
       CAST(sum(r) - count(*) AS BIGINT) AS dups, count(*) FILTER (WHERE mx = 0) AS new FROM k1
UNION ALL
SELECT 'events', CAST(sum(r) AS BIGINT), count(*), CAST(sum(r) - count(*) AS BIGINT),
       count(*) FILTER (WHERE mx = 0) FROM k2""",

    "null_profile": "WITH e AS (" + _events_with_nulls() + ")\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS col_name, count(*) - count({c}) AS nulls, count({c}) AS non_nulls FROM e"
        for c in ("event_id", "ts", "user_id", "event_type", "value", "props")),

    "table_profile": "WITH e AS (" + _events_with_nulls() + ")\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS col_name, {i} AS position, '{t}' AS dtype, count({c}) AS non_nulls, "
        f"count(*) - count({c}) AS nulls, count(*) AS rows FROM e"
        for i, (c, t) in enumerate((("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
                                    ("event_type", "string"), ("value", "double"), ("props", "string")))),

    "null_text_split": "WITH e AS (" + _events_with_nulls() + """)
SELECT CASE WHEN value > 50 THEN 'high' ELSE 'not_high' END AS part, event_id FROM e
WHERE props IS NOT NULL AND value IS NOT NULL""",

    "verb_type_counts": _tok(f"""
SELECT v.verb_type, count(DISTINCT t.doc_id) AS n_docs FROM tok t JOIN {VERBS.replace('AS verbs(', 'AS v(')}
  ON v.verb = t.lemma WHERE t.is_target GROUP BY v.verb_type"""),

    "write_by_verb_counts": _tok(f"""
SELECT lower(v.verb_type) AS verb_type, v.verb, count(DISTINCT t.doc_id) AS n FROM tok t
JOIN {VERBS.replace('AS verbs(', 'AS v(')} ON v.verb = t.lemma WHERE t.is_target GROUP BY 1, 2"""),

    "top_tokens": _tok("""
SELECT lower(text) AS word, count(*) AS n FROM tok WHERE NOT is_punct GROUP BY 1 ORDER BY n DESC, word LIMIT 20"""),

    "target_verbs": _every(_tok("\n" + TARGETS), verbs="NULL"),

    "multi_verb": _tok(",\ntv AS (" + TARGETS + ")\nSELECT doc_id, verbs FROM tv WHERE len(string_split(verbs, ', ')) > 1"),

    "with_target_verbs": _tok("\nSELECT DISTINCT doc_id FROM tok WHERE is_target"),

    "mark_text": _every(_tok(f"\nSELECT doc_id, coalesce(string_agg({_mark_piece('twitter')}, '' ORDER BY i), '') AS normalized "
                      f"FROM tok GROUP BY doc_id"), normalized="''"),
    "mark_text_corpus": _every(_tok(f"\nSELECT doc_id, coalesce(string_agg({_mark_piece('corpus')}, '' ORDER BY i), '') AS normalized "
                      f"FROM tok GROUP BY doc_id"), normalized="''"),
    "mark_text_variants": _every(_tok(f"\nSELECT doc_id, coalesce(string_agg({_mark_piece('variants')}, '' ORDER BY i), '') AS normalized "
                      f"FROM tok GROUP BY doc_id"), normalized="''"),

    "dep_text": _every(_tok(f"\nSELECT doc_id, {DEP_TEXT} AS dependencies FROM tok GROUP BY doc_id"), dependencies="''"),
    "pos_text": _every(_tok(f"\nSELECT doc_id, {POS_TEXT} AS pos FROM tok GROUP BY doc_id"), pos="''"),
    "detail_text": _every(_tok(f"\nSELECT doc_id, {DETAIL_TEXT} AS details FROM tok GROUP BY doc_id"), details="''"),
    "has_ccomp": _every(_tok("\nSELECT doc_id, bool_or(dep = 'ccomp') AS has_ccomp FROM tok GROUP BY doc_id"), has_ccomp="false"),

    "process_batch": _tok(f""",
agg AS (
  SELECT doc_id, nullif(array_to_string(list_sort(list_distinct(list(lemma) FILTER (WHERE is_target))), ', '), '')
           AS verbs,
         coalesce(string_agg({_mark_piece('twitter')}, '' ORDER BY i), '') AS normalized,
         bool_or(dep = 'ccomp') AS has_ccomp, {DEP_TEXT} AS dependencies, {POS_TEXT} AS pos,
         {DETAIL_TEXT} AS details
  FROM tok GROUP BY doc_id HAVING bool_or(is_target))
SELECT agg.*, d.text AS text_orig FROM agg LEFT JOIN documents d ON d.doc_id = agg.doc_id"""),

    "process_batch_corpus": _tok(f"""
SELECT doc_id, array_to_string(list_sort(list_distinct(list(lemma) FILTER (WHERE is_target))), ', ') AS verbs,
       coalesce(string_agg({_mark_piece('corpus')}, '' ORDER BY i), '') AS normalized, bool_or(dep = 'ccomp') AS has_ccomp,
       {DEP_TEXT} AS dependencies, coalesce(string_agg(text || '(' || upper(pos) || ')', ' ' ORDER BY i) FILTER (pos <> 'PUNCT'), '') AS pos,
       {DETAIL_TEXT} AS details
FROM tok GROUP BY doc_id HAVING bool_or(is_target)"""),

    "pos_pairs": _tok(f""",
pt AS (SELECT doc_id, {POS_TEXT} AS pos FROM tok GROUP BY doc_id),
pc AS (SELECT doc_id, unnest(list_transform(regexp_split_to_array(trim(pos), '[ \\t\\n\\r\\f]+'),
                                            lambda x, k: struct_pack(i := k - 1, p := x))) AS s FROM pt)
SELECT doc_id, CAST(s.i AS INTEGER) AS i,
       CASE WHEN regexp_full_match(s.p, '(.+)\\(([{W}]+)\\)') THEN regexp_extract(s.p, '^(.+)\\(([{W}]+)\\)$', 1)
            ELSE s.p END AS token,
       CASE WHEN regexp_full_match(s.p, '(.+)\\(([{W}]+)\\)') THEN regexp_extract(s.p, '^(.+)\\(([{W}]+)\\)$', 2)
       END AS pos
FROM pc WHERE s.p <> ''"""),

    "verb_runs": _tok(f""",
a AS (SELECT doc_id, i, text, pos, sum(CASE WHEN pos IN ({sql_list(RUN_POS)}) THEN 0 ELSE 1 END)
        OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM tok),
b AS (SELECT *, min(CASE WHEN pos <> 'ADP' THEN i END) OVER (PARTITION BY doc_id, isl) AS first_v
      FROM a WHERE pos IN ({sql_list(RUN_POS)})),
g AS (SELECT doc_id, isl, count(*) FILTER (WHERE pos <> 'ADP') AS n_verbs,
             string_agg(text, ' ' ORDER BY i) AS text, min(i) AS st
      FROM b WHERE first_v IS NOT NULL AND i >= first_v GROUP BY doc_id, isl)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY st) - 1 AS INTEGER) AS run,
       CAST(n_verbs AS INTEGER) AS n_verbs, text FROM g WHERE n_verbs >= 2"""),

    "ccomp_heads": _tok(PAIRS + "\nSELECT doc_id, head_lemma, head_text, head_i, ccomp_text, ccomp_i FROM pairs"),

    "verb_distance": _tok(PAIRS + """
SELECT doc_id, head_lemma AS head, head_i, ccomp_i, CAST(ccomp_dist AS INTEGER) AS ccomp_dist, v2,
       CAST(v2_i AS INTEGER) AS v2_i, CAST(v2_dist AS INTEGER) AS v2_dist FROM dist2"""),

    "mark_heads": _tok(PAIRS + f""",
lastp AS (SELECT * FROM dist2 d WHERE ccomp_i = (SELECT max(ccomp_i) FROM pairs p WHERE p.doc_id = d.doc_id
                                                AND p.head_lemma = d.head_lemma))
SELECT l.doc_id, l.head_lemma AS head, l.head_i, l.ccomp_i, CAST(l.v2_i AS INTEGER) AS v2_i,
  string_agg(' ' || CASE WHEN t.tag = 'PUNCT' THEN t.text
                         WHEN t.i = l.head_i THEN '>>' || {upper('t.text')}
                         WHEN t.i = l.v2_i AND l.v2_i <> l.ccomp_i THEN {upper('t.text')} || '[V2]'
                         WHEN t.i = l.ccomp_i THEN {upper('t.text')} || '<<'
                         WHEN {_fold_lower('t.text')} IN ({sql_list(QUE_VARIANTS)}) THEN {upper('t.text')}
                         ELSE lower(t.text) END, '' ORDER BY t.i) AS text_norm
FROM lastp l JOIN tok t ON t.doc_id = l.doc_id
GROUP BY l.doc_id, l.head_lemma, l.head_i, l.ccomp_i, l.v2_i"""),

    "dep_map": _tok("\nSELECT doc_id, lower(text) AS word, arg_max(dep, i) AS dep FROM tok GROUP BY doc_id, lower(text)"),

    "standardize_columns": f"""
SELECT CAST(doc_id AS VARCHAR) AS bibliografia, source AS autor, lang AS pais, 'prose' AS tipologia,
       {has_words('text')} AS has_que FROM documents""",

    "renormalised_join": f"""
SELECT doc_id, length(text) AS n_orig, length({normalize('text')}) AS n_norm FROM documents""",

    "id_sets": """
SELECT 'union' AS set_name, id FROM (SELECT doc_id AS id FROM labels UNION SELECT doc_id FROM documents)
UNION ALL
SELECT 'seen', id FROM (SELECT doc_id AS id FROM labels INTERSECT SELECT doc_id FROM documents)
UNION ALL
SELECT 'unseen', id FROM (SELECT DISTINCT doc_id AS id FROM documents d
                          WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))""",

    "merge_tables": """
SELECT 'documents' AS table_name, 2 * count(*) AS rows, count(DISTINCT doc_id) AS kept FROM documents
UNION ALL SELECT 'customer', 2 * count(*), count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'nation', 2 * count(*), count(DISTINCT n_nationkey) FROM nation""",

    "clean_labels": _tok(",\ntv AS (" + TARGETS + f")\nSELECT doc_id, regexp_replace(verbs, '[^{W}]+', '', 'g') AS label "
                         "FROM tv WHERE verbs IS NOT NULL"),

    "strip_dep_tags": _every(_tok(f",\ndt AS (SELECT doc_id, {DEP_TEXT} AS d FROM tok GROUP BY doc_id)\n"
                           f"SELECT doc_id, regexp_replace(d, '\\[[{W}]+\\]', '', 'g') AS text FROM dt"), text="''"),

    "highlight": f"""
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(lower(text), '[{W}]+|[^{W}]+'),
       lambda p: CASE WHEN regexp_full_match(p, 'que|q|the') THEN '<<' || p || '>>' ELSE p END), '') AS text
FROM documents""",

    "explode_verbs": _tok(",\nd AS (SELECT DISTINCT doc_id FROM documents), v AS (SELECT DISTINCT doc_id, lemma FROM tok WHERE is_target)\n"
                          "SELECT d.doc_id, v.lemma AS verb FROM d LEFT JOIN v ON v.doc_id = d.doc_id"),

    "explode_heads": _tok(PAIRS + "\nSELECT DISTINCT doc_id, head_lemma AS verb FROM pairs"),

    "head_rows": "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 10",
    "tail_rows": "SELECT doc_id FROM documents ORDER BY doc_id DESC LIMIT 10",
    "row_at": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 1 OFFSET 100",

    "annotate": _tok("\nSELECT doc_id, i, text AS w, lemma, pos, head, dep FROM tok"),

    "page_batches": """
WITH RECURSIVE p AS (SELECT conv_id AS topic, turn AS page, CAST(coalesce(length(text) % 100, 0) AS BIGINT) AS n,
                            row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
r AS (
  SELECT topic, page, rn, CAST(1 AS BIGINT) AS batch, CASE WHEN n >= 150 THEN 0 ELSE n END AS fill,
         CASE WHEN n >= 150 THEN 2 ELSE 1 END AS next_batch FROM p WHERE rn = 1
  UNION ALL
  SELECT p.topic, p.page, p.rn, r.next_batch,
         CASE WHEN r.fill + p.n >= 150 THEN 0 ELSE r.fill + p.n END,
         CASE WHEN r.fill + p.n >= 150 THEN r.next_batch + 1 ELSE r.next_batch END
  FROM r JOIN p ON p.topic = r.topic AND p.rn = r.rn + 1)
SELECT topic, page, batch FROM r WHERE batch <= 2""",
}
