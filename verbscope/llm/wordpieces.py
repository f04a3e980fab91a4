"""Ids of whole texts, and the tokenizer's pre-tokens for operators that merge by themselves.

Whole texts are encoded by a rank-merging library's public call where that is the same as the
vocabulary file's own library: ids must stand in merge order, which is checked, and the split
pattern must be the byte-level one. Its splits were compared with the file's library on every
code point. Elsewhere, and for a run of white space that overflows the pattern's stack, the
file's own library encodes. No memo is needed, so memory doesn't depend on the texts.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np

# The split pattern of the byte-level vocabularies (see the tokenizer
# files' README), with its character classes written out up to U+024F.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
_SPLIT = re.compile(f" ?[{_L}]+| ?[{_N}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: Texts of these characters only are split by the pattern above; others by the library.
_PLAIN = re.compile("[\x00-ɏ‐-‧€]*")

def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, once per worker and file."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def special_tokens(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


@functools.lru_cache(maxsize=4)
def _special_split(path: str) -> re.Pattern | None:
    found = sorted(special_tokens(path), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None


def split_words(text: str, path: str) -> list[str]:
    """Pre-tokens of a text without special tokens; their concatenation is the text."""
    if _PLAIN.fullmatch(text):
        return _SPLIT.findall(text)
    return [text[i:j] for _, (i, j) in tokenizer(path).pre_tokenizer.pre_tokenize_str(text)]


def split_specials(text: str, path: str) -> list[str]:
    """Text parts at even, special tokens at odd positions (the library's default)."""
    pattern = _special_split(path)
    return pattern.split(text) if pattern and pattern.search(text) else [text]


@functools.lru_cache(maxsize=4)
def byte_letters() -> dict[int, str]:
    """byte -> the letter that stands for it in byte-level vocabularies: itself where it
    prints, the next letter from U+0100 on otherwise (a rule, not a table)."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return {b: chr(b) for b in prints} | {b: chr(0x100 + k) for k, b in enumerate(others)}


def as_letters(word: str) -> str:
    """The word's UTF-8 bytes in the vocabulary's letters."""
    return word.encode().decode("latin-1").translate(byte_letters())


# Fixed value: the byte-level split pattern of the vocabulary files' README in possessive form, which matches the same
# without keeping places to go back to: a run of a class is never cut short, only white space before a word.
PATTERN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@functools.lru_cache(maxsize=4)
def ranked(path: str):
    """The vocabulary as ranks, or None where merging by rank isn't the same as the file's merges."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, letters = whole["model"], {c: b for b, c in byte_letters().items()}
    if (whole.get("normalizer") or (whole.get("pre_tokenizer") or {}).get("type") != "ByteLevel"
            or whole["pre_tokenizer"].get("add_prefix_space") or not whole["pre_tokenizer"].get("use_regex", True)):
        return None
    vocab = model["vocab"]
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    singles = {vocab.get(c) for c in letters}
    if None in made or None in singles or made != sorted(set(made)) or max(singles) > made[0]:
        return None
    import tiktoken
    used = {*made, *singles}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, special_tokens=special_tokens(path), mergeable_ranks={
        bytes(letters[c] for c in token): k for token, k in vocab.items() if k in used})


def encode(text: str, path: str, specials: bool = True) -> bytes:
    """A text's ids as little-endian unsigned 32-bit bytes. ``specials``: special tokens'
    strings in the text become their ids (the library's default), else ordinary text."""
    if (fast := ranked(path)) is not None:
        try:
            found = fast.encode_to_numpy(text, allowed_special="all" if specials else set(), disallowed_special=())
            return found.astype("<u4", copy=False).tobytes()
        except ValueError:  # the pattern's stack is too small for a very long run of white space
            pass
    library = tokenizer(path) if specials else _ordinary(path)
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@functools.lru_cache(maxsize=4)
def _ordinary(path: str):
    """The library's tokenizer for texts whose special tokens' strings are ordinary text."""
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return own


@functools.lru_cache(maxsize=4)
def id_bytes(path: str) -> list[bytes]:
    """id -> bytes of the token, for decoding."""
    letters = {c: b for b, c in byte_letters().items()}
    vocab = tokenizer(path).get_vocab(with_added_tokens=False)
    table = [b""] * (max(vocab.values()) + 1)
    for token, k in vocab.items():
        table[k] = bytes(letters[c] for c in token)
    return table
