"""Best-fit packing of documents into sequences by length patterns.

Documents become pieces of at most ``max_tokens`` ids. What is packed is the histogram of
piece lengths, which has at most ``max_tokens`` entries whatever the corpus:

1. patterns: every pair of lengths that fills a sequence exactly, and triples whose smallest
   length is a multiple of ``step``;
2. a non-negative least squares fit of repeat counts to the histogram;
3. rounding: patterns in order of their fitted counts, each repeated as often as it rounds to
   and the remaining pieces allow;
4. the residual histogram by best fit, longest first, on counts.

The plan then is a list of runs: "pieces of length L with ranks a..b go to these sequences at
this offset". Its size depends on ``max_tokens`` only, so it may go to every executor. Pieces
get their ranks within their length by bucketed counting, never by one sort per length.

Defined results: null text is an empty document, which is one piece with the end id alone;
rows that share an id are documents of their own; null ids are kept; extra columns are not
read; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbscope.llm.common import numbered, quoted, staged
from verbscope.llm.wordpieces import default_tokenizer, encode

END_ID = 0
Pattern = tuple[tuple[int, int], ...]  # ((length, how often), ...)


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else ``most`` each but for a
    first piece that takes the rest."""
    first = n % most or min(n, most)
    return [(0, first), *((s, most) for s in range(first, n, most))]


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048,
           tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    path = tokenizer_path or default_tokenizer()
    end = END_ID.to_bytes(4, "little")
    fields = [pa.field("piece", pa.int32()), pa.field("start", pa.int64()), pa.field("length", pa.int64()),
              pa.field("ids_crc32", pa.int64())] + [pa.field("ids", pa.binary())] * with_ids

    @F.arrow_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long" + ",ids:binary" * with_ids + ">>")
    def encode_and_cut(texts: pa.Array) -> pa.Array:
        cols: list[list] = [[] for _ in fields]
        offsets = [0]
        for t in texts:
            ids = encode(t.as_py() or "", path) + end
            for k, (start, length) in enumerate(cut(len(ids) // 4, max_tokens)):
                part = ids[4 * start : 4 * (start + length)]
                for c, v in zip(cols, (k, start, length, zlib.crc32(part), part), strict=False):
                    c.append(v)
            offsets.append(len(cols[0]))
        rows = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields, strict=True)], fields=fields)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return (df.select(quoted(id_col).alias("doc_id"), encode_and_cut(quoted(text_col)).alias("p"))
            .select("doc_id", F.inline("p")))


# ---- the plan: arithmetic on a histogram of at most max_tokens entries ----

def enumerate_patterns(lengths: np.ndarray, most: int, step: int) -> np.ndarray:
    """Rows of three lengths (0: none) that sum to ``most``, of lengths that occur."""
    occurs = np.zeros(most + 1, bool)
    occurs[lengths] = True
    small = lengths[2 * lengths <= most]
    found = [np.stack([np.zeros_like(small), small, most - small], 1)]
    for a in lengths[(lengths % step == 0) & (3 * lengths <= most)]:
        b = lengths[(lengths >= a) & (2 * lengths <= most - a)]
        found.append(np.stack([np.full_like(b, a), b, most - a - b], 1))
    p = np.concatenate(found)
    return p[occurs[p[:, 2]]]


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares of pattern counts to the histogram (weight: length), by
    accelerated projected gradient steps; memory and time depend on the patterns only."""
    most = len(histogram) - 1
    weight = np.arange(most + 1) / most  # entry 0 stands for "no piece" and weighs nothing
    target = histogram * weight**2
    x = y = np.zeros(len(patterns))
    t = 1.0

    def project(v: np.ndarray) -> np.ndarray:  # pattern counts -> pieces used per length
        return sum(np.bincount(patterns[:, k], v, most + 1) for k in range(3))

    lipschitz, probe = 1.0, np.ones(len(patterns))
    for _ in range(20):  # largest eigenvalue by power iteration
        z = (project(probe) * weight**2)[patterns].sum(1)
        lipschitz = float(np.linalg.norm(z)) or 1.0
        probe = z / lipschitz
    for _ in range(rounds):
        gradient = (project(y) * weight**2 - target)[patterns].sum(1)
        new = np.maximum(y - gradient / (1.05 * lipschitz), 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def best_fit(histogram: np.ndarray) -> list[tuple[int, Pattern]]:
    """Best fit, longest first, on counts: (how many sequences, pattern)."""
    most = len(histogram) - 1
    open_: dict[int, list[tuple[int, Pattern]]] = defaultdict(list)  # free tokens -> sequences
    free = np.zeros(most + 1, np.int64)

    def put(n: int, space: int, pattern: Pattern) -> None:
        open_[space].append((n, pattern))
        free[space] += n

    for length in range(most, 0, -1):
        left = int(histogram[length])
        while left:
            fits = np.flatnonzero(free[length:])
            if len(fits):
                space = length + int(fits[0])
                n, pattern = open_[space].pop()
                free[space] -= n
                each = space // length  # the same sequence stays the best fit for the next piece
                use = min(n, left // each)
                if use:
                    put(use, space - each * length, (*pattern, (length, each)))
                    left -= use * each
                if use < n:
                    if left and left < each:
                        put(1, space - left * length, (*pattern, (length, left)))
                        n, left = n - 1, 0
                    if n > use:
                        put(n - use, space, pattern)
            else:
                each = min(most // length, left)
                put(left // each, most - each * length, ((length, each),))
                left %= each
    return [x for group in open_.values() for x in group]


def plan(histogram: np.ndarray, step: int = 16) -> list[tuple[int, Pattern]]:
    """(how many sequences, pattern) for the whole histogram; entry k counts pieces of length k."""
    most = len(histogram) - 1
    rest, done = histogram.astype(np.int64).copy(), []
    if rest[most]:
        done.append((int(rest[most]), ((most, 1),)))
        rest[most] = 0
    patterns = enumerate_patterns(np.flatnonzero(rest), most, step)
    if len(patterns):
        x = fit_counts(patterns, rest.astype(float))
        for k in np.argsort(-x, kind="stable"):
            wanted = int(x[k] + 0.5)
            if not wanted:
                break
            parts = defaultdict(int)
            for length in patterns[k].tolist():
                if length:
                    parts[length] += 1
            n = min([wanted, *(int(rest[a]) // m for a, m in parts.items())])
            if n > 0:
                done.append((n, tuple(sorted(parts.items(), reverse=True))))
                for a, m in parts.items():
                    rest[a] -= n * m
    return done + best_fit(rest)


@dataclass
class Runs:
    """The plan as arrays, sorted by place: run k starts at ``place[k]`` = pieces of smaller
    lengths + rank; its pieces go ``each`` to a sequence from ``sequence`` on."""

    base: np.ndarray
    place: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    each: np.ndarray

    @classmethod
    def of(cls, chosen: list[tuple[int, Pattern]], histogram: np.ndarray) -> Runs:
        base = np.concatenate([[0], np.cumsum(histogram)[:-1]]).astype(np.int64)
        used, rows, sequence = np.zeros(len(histogram), np.int64), [], 0
        for n, pattern in chosen:
            at = 0
            for length, each in pattern:
                rows.append((int(base[length] + used[length]), sequence, at, each))
                used[length] += n * each
                at += length * each
            sequence += n
        cols = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return cls(base, *cols.T)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces."""
        place = self.base[length] + rank
        k = np.searchsorted(self.place, place, "right") - 1
        seq, slot = np.divmod(place - self.place[k], self.each[k])
        return self.sequence[k] + seq, self.offset[k] + slot * length


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048,
         tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset."""
    table = staged(pieces(df, id_col, text_col, max_tokens, tokenizer_path, with_ids), "pieces")
    histogram = np.zeros(max_tokens + 1, np.int64)
    for r in table.groupBy("length").count().collect():  # at most max_tokens rows
        histogram[r["length"]] = r["count"]
    runs = Runs.of(plan(histogram), histogram)

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = runs.find(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], names=["sequence_id", "offset"])

    ranked = numbered(table, ["length"], ["doc_id", "piece", "ids_crc32"], "rank")
    return ranked.withColumn("at", place("length", "rank")).select(*[quoted(c) for c in table.columns], "at.*")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., with_ids=True)``: sequence_id, ids, and
    the documents' ids and offsets in order. A group is one sequence, at most ``max_tokens`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(bytearray()), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))
