"""Quality rules by compression bands.

Each whole text is compressed with zstandard, and so is each of its full fixed-size
chunks by itself. Repetitive text compresses too well, noise too badly. What is normal
depends on the length (short texts have little to refer back to), so each length class
has its own band; chunks, all of one size, share one band.

Defined results: null text has no words and fails the base rules like empty text; texts
shorter than the first class have no band verdict; existing columns with the output names
are replaced; repeated rows are judged alike; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbscope.llm.common import WHITE, quoted, without

WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits on raw bytes / compressed bytes.

    whole: (smallest length in bytes, lowest ratio, highest ratio), lengths ascending.
    chunk: lowest and highest ratio of a full chunk of ``chunk_bytes``; a text with more
    than ``bad_share`` of its full chunks outside is rejected.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (64, 0.75, 2.6), (256, 1.1, 2.8), (512, 1.2, 3.0), (1024, 1.3, 3.5), (4096, 1.45, 4.5),
        (16384, 1.5, 5.5), (65536, 1.5, 7.0))
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (1.4, 4.5)
    bad_share: float = 0.25
    level: int = 3


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list) -> int:
    """Words inside 8-word windows that occur twice or more in the list, the first
    occurrence included. Windows get exact ids by doubling: pairs, then fours, then eights."""
    n = len(words)
    if n <= WINDOW_WORDS:
        return 0
    seen: dict = {}
    ids = np.array([seen.setdefault(w, k) for k, w in enumerate(words)], dtype=np.int64)
    step = 1
    while step < WINDOW_WORDS:
        _, ids, counts = np.unique(ids[:-step] * (n + 1) + ids[step:], return_inverse=True, return_counts=True)
        if counts.max() == 1:
            return 0  # nothing repeats at this width, so nothing does at a larger one
        step *= 2
    starts = counts[ids] > 1
    edges = np.zeros(n + 1, dtype=np.int64)
    edges[: len(starts)] += starts
    edges[WINDOW_WORDS : WINDOW_WORDS + len(starts)] -= starts
    return int((np.cumsum(edges) > 0).sum())


def base_stats(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    words = text.encode().split()  # of bytes: splits at exactly the six white characters
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def ratios(data: bytes, compressor, chunk_bytes: int, low: float, high: float) -> tuple[float, int, int]:
    """(whole ratio, full chunks, full chunks outside low..high)."""
    whole = len(data) / len(compressor.compress(data)) if data else 0.0
    full = len(data) // chunk_bytes
    bad = 0
    for k in range(full):
        r = chunk_bytes / len(compressor.compress(data[k * chunk_bytes : (k + 1) * chunk_bytes]))
        bad += not low <= r <= high
    return whole, full, bad


def band_ok(n_bytes: Column, ratio: Column, chunks: Column, bad: Column, bands: Bands) -> Column:
    """The verdict of the bands as a Column."""
    ok = F.lit(True)
    for smallest, low, high in bands.whole:  # the last class that applies wins
        ok = F.when(n_bytes >= smallest, ratio.between(low, high)).otherwise(ok)
    return ok & (bad <= bands.bad_share * chunks)


def with_quality(df: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """Add the base figures, ``zstd_ratio``, ``n_chunks``, ``n_bad_chunks``, ``base_failed``
    and ``kept``. One pass over the rows, no shuffle."""
    out = pa.struct([pa.field(n, pa.int64()) for n in FIELDS]
                    + [pa.field("zstd_ratio", pa.float64()), pa.field("n_chunks", pa.int64()),
                       pa.field("n_bad_chunks", pa.int64())])
    b = bands

    @F.arrow_udf(", ".join(f"{n} long" for n in FIELDS) + ", zstd_ratio double, n_chunks long, n_bad_chunks long")
    def measure(texts: pa.Array) -> pa.Array:
        import zstandard
        compressor = zstandard.ZstdCompressor(level=b.level)
        cols: list[list] = [[] for _ in out]
        for t in texts:
            text = t.as_py() or ""
            row = (*base_stats(text), *ratios(text.encode(), compressor, b.chunk_bytes, *b.chunk))
            for c, v in zip(cols, row, strict=True):
                c.append(v)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out, strict=True)],
                                          fields=list(out))

    names = (*FIELDS, "zstd_ratio", "n_chunks", "n_bad_chunks", "base_failed", "kept", "_q")
    q = F.col("_q")
    text = quoted(text_col)
    return (without(df, *names).withColumn("_q", measure(text))
            .withColumns({n: q[n] for n in names[:-3]})
            .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
            .withColumn("kept", ~F.col("base_failed") & band_ok(
                F.octet_length(F.coalesce(text, F.lit(""))), F.col("zstd_ratio"), F.col("n_chunks"),
                F.col("n_bad_chunks"), bands))
            .drop("_q"))
