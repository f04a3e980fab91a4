"""SentencePiece BPE encoding with one token remembered per prefix.

The encoding of every prefix of a text has one last token. Left to right, the candidates at a
position are the pieces that end there (an automaton finds them all), and the right one is the
one that is compatible with the last token of the prefix before it: encoding the two tokens'
joint text gives just these two. A chain of compatible tokens is the encoding itself: as long as
no merge has crossed a border between tokens, every token's inside merges as it would alone, and
the first merge that crosses a border would also cross it in the joint text of its two
neighbours alone. So one token a position is enough, and the ids are read backwards from the end.

Texts are cut where no piece reaches across (before white space, around line breaks, if the
vocabulary's pieces allow it), and short parts are remembered per worker in a memo bounded in bytes.

Defined results: null text is empty and has no ids; rows come out as they went in, repeated ones
too; columns named like the result's are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbscope.llm.common import quoted, without
from verbscope.llm.memo import Memo

SPACE = "▁"  # what SentencePiece writes for a blank
#: Parts up to this many characters are worth remembering; longer ones rarely come back.
MEMO_CHARS = 32
#: Bytes of one generation of the memo (a worker holds two at most).
MEMO_BYTES = 64 << 20


def default_pieces() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceTable:
    """A BPE vocabulary with byte fallback: its pieces as automaton, and which tokens may follow which."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        if any(sp.is_unused(k) for k in every):
            raise ValueError("vocabularies with unused pieces are split differently by the library")
        self.bytes = {int(sp.id_to_piece(k)[3:5], 16): k for k in every if sp.is_byte(k)}
        if len(self.bytes) != 256:
            raise ValueError("a vocabulary with byte fallback is needed")
        self.ids = {sp.id_to_piece(k): k for k in every
                    if not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k))}
        self.rank = {piece: -sp.get_score(k) for piece, k in self.ids.items()}  # lower merges first
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, (piece, len(piece)))
        self.automaton.make_automaton()
        apart = not any(SPACE in piece.lstrip(SPACE) or ("\n" in piece and len(piece) > 1) for piece in self.ids)
        self.parts = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if apart else "(?s).+").findall
        self.merges: dict[str, tuple | None] = {}
        self.follows: dict[tuple[str, str], bool] = {}
        self.known = Memo(self.part_ids, MEMO_BYTES)
        self.decimal = list(map(str, every))

    def merges_of(self, token: str) -> tuple | None:
        """How a token's characters merge when it stands alone: (rank, first symbol, last symbol)
        before each merge, and the token itself at the end; None if they don't become the token."""
        if token in self.merges:
            return self.merges[token]
        symbols, steps = list(token), []
        while len(symbols) > 1:
            ranks = [self.rank.get(a + b, np.inf) for a, b in zip(symbols, symbols[1:], strict=False)]
            best = min(ranks)
            if best == np.inf:
                break
            steps.append((best, symbols[0], symbols[-1]))
            k = ranks.index(best)
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        steps.append((np.inf, symbols[0], symbols[-1]))
        self.merges[token] = found = tuple(steps) if len(symbols) == 1 else None
        return found

    def compatible(self, left: str, right: str) -> bool:
        """Whether the joint text of two tokens encodes to the two. Both merge side by side, the
        lower rank first and the left one on ties; they are incompatible as soon as the pair
        across their border is the best one."""
        a, b = self.merges_of(left), self.merges_of(right)
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            (rank_a, _, last), (rank_b, first, _) = a[i], b[j]
            across = self.rank.get(last + first)
            if across is not None and across < rank_a and across <= rank_b:
                return False
            if rank_a == rank_b == np.inf:
                return True
            if rank_a <= rank_b:
                i += 1
            else:
                j += 1

    def tested(self, pair: tuple[str, str]) -> bool:
        if len(self.follows) >= 500_000:  # pairs of vocabulary entries; forgotten ones are tested again
            self.follows.clear()
        fits = self.follows[pair] = self.compatible(*pair)
        return fits

    def part_tokens(self, part: str) -> list[str]:
        """Tokens of a part, by the table of last tokens. A position that no piece fits is a
        character of its own."""
        last: list[str | None] = [None] * (len(part) + 1)
        known = self.follows.get
        for end, (piece, size) in self.automaton.iter(part):
            end += 1
            if last[end] is not None:
                continue
            start = end - size
            if start:
                pair = (last[start] or part[start - 1], piece)
                fits = known(pair)
                if fits is None:
                    fits = self.tested(pair)
            else:
                fits = self.merges_of(piece) is not None
            if fits:
                last[end] = piece
        tokens, at = [], len(part)
        while at:
            tokens.append(last[at] or part[at - 1])
            at -= len(tokens[-1])
        return tokens[::-1]

    def part_ids(self, part: str) -> bytes:
        """Ids of a part as little-endian unsigned 32-bit bytes; unknown characters by their bytes."""
        tokens = self.part_tokens(part)
        try:
            out = [self.ids[t] for t in tokens]
        except KeyError:
            out = [k for t in tokens for k in ((self.ids[t],) if t in self.ids else (self.bytes[b] for b in t.encode()))]
        return struct.pack(f"<{len(out)}I", *out)

    def encode(self, text: str) -> bytes:
        known, whole = self.known, self.part_ids
        return b"".join([known[p] if len(p) <= MEMO_CHARS else whole(p) for p in self.parts(self.library.normalize(text))])


@functools.lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    """Once per worker and file."""
    return PieceTable(path)


def encode_pieces(df: DataFrame, text_col: str = "text", out: str = "piece_ids", model_path: str | None = None) -> DataFrame:
    """Add ``out``: a text's ids as little-endian unsigned 32-bit bytes, without begin or end ids."""
    path = model_path or default_pieces()

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        table = piece_table(path)
        return pa.array([table.encode(t.as_py() or "") for t in texts], pa.binary())

    # marked so that the ids are made once, not once for each column that is derived from them
    return without(df, out).withColumn(out, encode.asNondeterministic()(quoted(text_col)))


def decode_pieces(df: DataFrame, ids_col: str = "piece_ids", out: str = "decoded", model_path: str | None = None) -> DataFrame:
    """Add ``out``: the library's decoding of ids given as little-endian unsigned 32-bit bytes (null: none)."""
    path = model_path or default_pieces()

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        library = piece_table(path).library
        return pa.array([library.decode(np.frombuffer(k.as_py() or b"", "<u4").tolist()) for k in ids], pa.string())

    return without(df, out).withColumn(out, decode(quoted(ids_col)))


def ids_digest(ids_col: str = "piece_ids", model_path: str | None = None):
    """SHA-256 (lowercase hex) of the decimal ids, joined by commas."""
    path = model_path or default_pieces()

    @F.arrow_udf("string")
    def digest(ids: pa.Array) -> pa.Array:
        import hashlib
        written = piece_table(path).decimal.__getitem__
        return pa.array([hashlib.sha256(",".join(map(written, np.frombuffer(k.as_py(), "<u4").tolist())).encode()).hexdigest()
                         for k in ids], pa.string())

    return digest(quoted(ids_col))
