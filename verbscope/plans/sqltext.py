"""SQL snippets for the DuckDB oracle, written from the operators' stated semantics.

DuckDB differences handled here: ``regexp_replace`` needs the ``'g'`` flag and writes
back-references as ``\\1``; ``upper('ß')`` is ``'ẞ'`` in DuckDB but ``'SS'`` in Python,
Java and Spark, so upper-casing goes through ``ß -> ss`` first.
"""

from __future__ import annotations

from ..functions.text import (EMOJI_CLASS, FOLD_FROM, FOLD_TO, MARK_CLASS, MULTI_CHAR_FOLDS, QUE_WORDS, SPACE,
                              WORD)
from ..operators.tokens import DEFAULT_LEXICON, VERB_SUFFIX, VERB_TAGS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_list(values) -> str:
    return ", ".join(q(v) for v in values)


# Regex constants in DuckDB spelling (RE2 reads \p{L}, \x{...} as Java does).
W = WORD.replace("\\\\", "\\")
S = SPACE.replace("\\\\", "\\")


def fold(expr: str) -> str:
    out = expr
    for a, b in MULTI_CHAR_FOLDS:
        out = f"replace({out}, {q(a)}, {q(b)})"
    out = f"regexp_replace({out}, {q(MARK_CLASS)}, '', 'g')"
    return f"translate({out}, {q(FOLD_FROM)}, {q(FOLD_TO)})"


def normalize(expr: str) -> str:
    e = f"regexp_replace({expr}, {q('@[' + W + ']+[' + chr(8) + ' ]*')}, '', 'g')"
    e = f"regexp_replace({e}, '\\t+|\\n+', ' ', 'g')"
    e = f"regexp_replace({e}, {q(EMOJI_CLASS.replace(chr(92) * 2, chr(92)))}, '', 'g')"
    return fold(e)


def upper(expr: str) -> str:
    return f"upper(replace({expr}, 'ß', 'ss'))"


def word_re(words) -> str:
    return f"(^|[^{W}])({'|'.join(words)})([^{W}]|$)"


def has_words(expr: str, words=QUE_WORDS, lower: bool = True) -> str:
    e = f"lower({expr})" if lower else expr
    return f"regexp_matches({e}, {q(word_re(words))})"


def token_set_list(expr: str) -> str:
    """I5 as a DuckDB list (unsorted, distinct, no '')."""
    cleaned = f"regexp_replace(lower({expr}), {q('[^' + W + S + ']+')}, '', 'g')"
    trimmed = f"regexp_replace({cleaned}, {q('^[' + S + ']+|[' + S + ']+$')}, '', 'g')"
    parts = f"regexp_split_to_array({trimmed}, {q('[' + S + ']+')})"
    return f"list_filter(list_distinct({parts}), lambda x: x <> '')"


def lexicon_values() -> str:
    rows = ", ".join(f"({q(w)}, {q(p)}, {('NULL' if l is None else q(l))})" for w, p, l in DEFAULT_LEXICON)
    return f"(VALUES {rows}) AS lex(lex_word, lex_pos, lex_lemma)"


def token_ctes(docs_sql: str, verbs_sql: str) -> str:
    """CTEs ``tok`` (long tokens with every field of the default annotator).

    Written from the rules over whole documents: the head is the largest earlier VERB index, its dimension
    flag the last one seen before, and ``c``/``vc`` are running sums.
    """
    punct1 = "([^" + W + S + "])"
    return f"""
_d AS ({docs_sql}),
_sp AS (SELECT doc_id, string_split(trim(regexp_replace(regexp_replace(text, {q(punct1)}, ' \\1 ', 'g'),
        {q('[' + S + ']+')}, ' ', 'g')), ' ') AS ws FROM _d),
_u AS (SELECT doc_id, unnest(list_transform(ws, lambda x, k: struct_pack(i := k - 1, w := x))) AS s FROM _sp),
_t0 AS (SELECT doc_id, CAST(s.i AS INTEGER) AS i, s.w AS text FROM _u WHERE s.w <> ''),
_t1 AS (
  SELECT t.doc_id, t.i, t.text, coalesce(lex.lex_lemma, lower(t.text)) AS lemma,
         CASE WHEN regexp_matches(t.text, {q('^[^' + W + S + ']$')}) THEN 'PUNCT'
              WHEN lex.lex_pos IS NOT NULL THEN lex.lex_pos
              WHEN regexp_matches(lower(t.text), {q(VERB_SUFFIX)}) THEN 'VERB'
              ELSE 'NOUN' END AS pos,
         lex.lex_word IS NOT NULL AS is_stop
  FROM _t0 t LEFT JOIN {lexicon_values()} ON lower(t.text) = lex.lex_word),
_vd AS (SELECT DISTINCT verb FROM {verbs_sql} WHERE verb IS NOT NULL),
_t2 AS (
  SELECT t.*, t.pos AS tag, t.pos = 'PUNCT' AS is_punct,
         EXISTS (SELECT 1 FROM _vd WHERE _vd.verb = t.lemma) AS in_dim
  FROM _t1 t),
_t3 AS (
  SELECT *, max(CASE WHEN pos = 'VERB' THEN i END) OVER earlier AS prev_v,
         last_value(CASE WHEN pos = 'VERB' THEN in_dim END IGNORE NULLS) OVER earlier AS prev_dim,
         CAST(sum(CASE WHEN tag <> 'PUNCT' THEN 1 ELSE 0 END) OVER so_far AS INTEGER) AS c,
         CAST(sum(CASE WHEN tag IN ({sql_list(VERB_TAGS)}) THEN 1 ELSE 0 END) OVER so_far AS INTEGER) AS vc
  FROM _t2 WINDOW earlier AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                  so_far AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
tok AS (
  SELECT doc_id, i, text, lemma, pos, tag, CASE WHEN pos = 'VERB' AND coalesce(prev_dim, false) THEN 'ccomp' ELSE 'dep' END AS dep,
         CAST(coalesce(prev_v, i) AS INTEGER) AS head, is_stop, is_punct, in_dim,
         pos = 'VERB' AND in_dim AS is_target, c, vc
  FROM _t3)
"""
