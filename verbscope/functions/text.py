"""Column functions for tweet / corpus text (all JVM-side, no Python UDF).

Every function takes and returns a ``Column`` so it composes inside one ``select``
and stays inside whole-stage codegen. Regular expressions are written in the
portable subset shared by Java and RE2: ``[\\p{L}\\p{N}_]`` instead of ``\\w`` (Java's
``\\w`` is ASCII-only), explicit neighbours instead of ``\\b``, no look-around.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the reference behaviour)
# ---------------------------------------------------------------------------
# A word character: letter, digit or underscore (Python's Unicode ``\w``).
WORD = "\\p{L}\\p{N}_"
# ASCII white space as both Java and RE2 read ``\s``.
SPACE = " \\t\\n\\r\\f"
# Complementiser spellings flagged by ``has_que``.
QUE_WORDS = ("que", "q")
# Complementiser spellings upper-cased in the distance text (``mark_text`` mode "variants").
QUE_VARIANTS = ("que", "q", "k", "ke")
# Emoji: pictographs U+1F000-U+1FAFF, dingbats/symbols U+2600-U+27BF,
# variation selector 16 U+FE0F and zero width joiner U+200D.
EMOJI_CLASS = "[\\x{1F000}-\\x{1FAFF}\\x{2600}-\\x{27BF}\\x{FE0F}\\x{200D}]"
# Characters folded to more than one ASCII character, and typographic marks.
MULTI_CHAR_FOLDS = (
    ("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"),
    ("þ", "th"), ("Þ", "Th"), ("ĳ", "ij"), ("Ĳ", "IJ"),
    ("“", '"'), ("”", '"'), ("„", '"'), ("«", "<<"), ("»", ">>"),
    ("‘", "'"), ("’", "'"), ("‚", "'"), ("–", "-"), ("—", "-"), ("…", "..."),
)
# Latin letters without a canonical decomposition, folded one to one.
SINGLE_CHAR_EXTRA = (
    ("Ø", "O"), ("ø", "o"), ("Đ", "D"), ("đ", "d"), ("Ð", "D"), ("ð", "d"),
    ("Ł", "L"), ("ł", "l"), ("Ħ", "H"), ("ħ", "h"), ("ı", "i"), ("ĸ", "k"),
    ("Ŧ", "T"), ("ŧ", "t"), ("¡", "!"), ("¿", "?"),
)


# Combining marks (blocks), which transliteration drops.
MARKS = ((0x0300, 0x036F), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0xFE20, 0xFE2F))
MARK_CLASS = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in MARKS) + "]"


def _is_mark(ch: str) -> bool:
    return any(a <= ord(ch) <= b for a, b in MARKS)


def _fold_table() -> tuple[str, str]:
    """One-to-one fold table for the Basic Multilingual Plane.

    Built by rule: a character whose decomposition (canonical, or compatibility as for full-width letters), without
    combining marks, is one ASCII letter or digit, or one of the letters below, is folded to it.
    """
    singles = dict(SINGLE_CHAR_EXTRA)
    multi = {a for a, _ in MULTI_CHAR_FOLDS}
    table = dict(singles)
    for cp in range(0x00A0, 0x10000):
        ch = chr(cp)
        if ch in multi or ch in table or 0xD800 <= cp <= 0xDFFF:
            continue
        base = [c for c in unicodedata.normalize("NFKD", ch) if not _is_mark(c)]
        if len(base) == 1 and base[0] != ch:
            to = singles.get(base[0], base[0])
            if to.isascii() and to.isalnum():
                table[ch] = to
    return "".join(table), "".join(table.values())


FOLD_FROM, FOLD_TO = _fold_table()


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# I1-I6 normalisation
# ---------------------------------------------------------------------------
def strip_mentions(c) -> Column:
    """Delete ``@word`` and the blanks (or backspaces) after it."""
    return F.regexp_replace(_c(c), f"@[{WORD}]+[\\x08 ]*", "")


def squash_breaks(c) -> Column:
    """A run of tabs, or a run of newlines, becomes one blank."""
    return F.regexp_replace(_c(c), "\\t+|\\n+", " ")


def strip_emoji(c) -> Column:
    """Remove emoji (code-point ranges; an approximation of a full emoji table)."""
    return F.regexp_replace(_c(c), EMOJI_CLASS, "")


def ascii_fold(c) -> Column:
    """I4: transliterate Latin letters and typographic marks to ASCII.

    Letters fold by their decomposition (``FOLD_FROM``), whether they come composed (``é``), as letter and combining
    marks, or with several marks (``ế``); marks in ``MULTI_CHAR_FOLDS`` become several characters; other scripts
    are left as they are. A text that is ASCII already is returned at once.
    """
    col = _c(c)
    out = col
    for a, b in MULTI_CHAR_FOLDS:
        out = F.replace(out, F.lit(a), F.lit(b))
    # one scan decides whether the chain of multi-character replacements is needed
    multi_class = "[" + "".join(a for a, _ in MULTI_CHAR_FOLDS) + "]"
    bare = F.regexp_replace(F.when(col.rlike(multi_class), out).otherwise(col), MARK_CLASS, "")
    return F.when(F.octet_length(col) == F.char_length(col), col).otherwise(F.translate(bare, FOLD_FROM, FOLD_TO))


def normalize_text(c) -> Column:
    """Strip mentions, squash breaks, strip emoji, fold to ASCII -- in that order."""
    return ascii_fold(strip_emoji(squash_breaks(strip_mentions(c))))


# ---------------------------------------------------------------------------
# Predicates
# ---------------------------------------------------------------------------
def word_pattern(words, flags: str = "") -> str:
    alts = "|".join(words)
    return f"{flags}(^|[^{WORD}])({alts})([^{WORD}]|$)"


def has_que(c, words=QUE_WORDS, case_sensitive: bool = False) -> Column:
    """The text holds the word ``que`` or ``q`` (whole word). Null text gives null."""
    col = _c(c) if case_sensitive else F.lower(_c(c))
    return col.rlike(word_pattern(words))


def matches_all_terms(c, terms) -> Column:
    """C4: every regex term is found in the lower-cased text (AND of ``rlike``)."""
    low = F.lower(_c(c))
    cond = F.lit(True)
    for t in terms:
        cond = cond & low.rlike(t)
    return cond


def token_list(c) -> Column:
    """I5 without the distinct step: strip, lower, delete punctuation, split on blanks."""
    cleaned = F.regexp_replace(F.lower(_c(c)), f"[^{WORD}{SPACE}]+", "")
    return F.split(F.regexp_replace(cleaned, f"^[{SPACE}]+|[{SPACE}]+$", ""), f"[{SPACE}]+")


def token_set(c) -> Column:
    """Strip, lower, delete punctuation, split on blanks, distinct, drop ''."""
    return F.array_remove(F.array_distinct(token_list(c)), "")


def intersects(tokens, values) -> Column:
    """The token set meets a list (``arrays_overlap``)."""
    vals = values if isinstance(values, Column) else F.array(*[F.lit(v) for v in values])
    return F.arrays_overlap(_c(tokens), vals)


# ---------------------------------------------------------------------------
# I8-I14 small scalars
# ---------------------------------------------------------------------------
def extract_ref_ids(c) -> Column:
    """I8: every ``'id': '<digits>'`` in a stringified list of referenced tweets."""
    return F.regexp_extract_all(_c(c), F.lit("'id': '(\\d+)"), 1)


def parse_list(c) -> Column:
    """``"['a', 'b']"`` -> ``[a, b]`` without evaluating the text; '[]' -> []."""
    body = F.regexp_replace(_c(c), "[\\[\\]']+", "")
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, ", "))


def split_list(c) -> Column:
    """``"a, b"`` -> ``[a, b]``."""
    return F.split(_c(c), ", ")


def letters_only(c) -> Column:
    """Delete every non-word character."""
    return F.regexp_replace(_c(c), f"[^{WORD}]+", "")


def strip_dep_tags(c) -> Column:
    """``word[dep]`` -> ``word``."""
    return F.regexp_replace(_c(c), f"\\[[{WORD}]+\\]", "")


def highlight_terms(c, term: str) -> Column:
    """Wrap every whole-word match of ``term`` in ``<<`` ``>>``.

    The text is cut into alternating word / non-word pieces and a word piece that
    matches ``term`` entirely is wrapped, so neighbouring matches (``que que``) are
    all marked, as with ``\\b`` boundaries. ``term`` is a regex over word characters.
    """
    pieces = F.regexp_extract_all(_c(c), F.lit(f"[{WORD}]+|[^{WORD}]+"), 0)
    marked = F.transform(pieces, lambda p: F.when(p.rlike(f"^({term})$"),
                                                   F.concat(F.lit("<<"), p, F.lit(">>"))).otherwise(p))
    return F.array_join(marked, "")


# Date formats tried in order: the cleaned form, then the API's ISO form.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSX")


def parse_created_at(c) -> Column:
    """First format that parses wins; failures give null.

    Both formats are read as UTC instants whatever the session time zone: the
    zone-less form gets an explicit ``+0000``, the API form carries ``Z``."""
    col = _c(c)
    utc_plain = F.try_to_timestamp(F.concat(col, F.lit("+0000")), F.lit(DATE_FORMATS[0] + "Z"))
    return F.coalesce(utc_plain, F.try_to_timestamp(col, F.lit(DATE_FORMATS[1])))
