"""Token counts by byte-pair merging with a heap and a linked list.

A pre-token starts as its bytes, linked to their neighbours. The heap holds adjacent
pairs by (merge rank, position); the lowest is popped, merged if both halves still stand,
and the two new neighbour pairs are pushed. The count is the number of bytes less the
number of merges; no ids are made. O(n log n) in the length of a pre-token, so a single
word of a megabyte is no special case.

Defined results: null and empty text count 0; special tokens' strings inside a text count
one each (the library's default); an existing column of the output's name is replaced;
repeated rows are counted each; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import heapq
import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbscope.llm.common import quoted, without
from verbscope.llm.memo import Memo
from verbscope.llm.wordpieces import as_letters, default_tokenizer, split_specials, split_words


@functools.lru_cache(maxsize=4)
def merge_ranks(path: str) -> dict[tuple[str, str], int]:
    with open(path, encoding="utf-8") as f:
        merges = json.load(f)["model"]["merges"]
    return {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): k for k, m in enumerate(merges)}


def count_symbols(word: str, ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left of ``word`` (one letter per byte) after all merges."""
    n = len(word)
    after = list(range(1, n + 1))  # where the symbol that starts here ends; 0: merged away
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = ranks.get((word[i], word[i + 1]))
        if r is not None:
            heap.append((r, i, i + 1, i + 2))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, j, e = heapq.heappop(heap)
        if after[i] != j or after[j] != e:
            continue  # one half has been merged since
        after[i], after[j] = e, 0
        merges += 1
        if e < n:
            before[e] = i
            r = ranks.get((word[i:e], word[e:after[e]]))
            if r is not None:
                heapq.heappush(heap, (r, i, e, after[e]))
        p = before[i]
        if p >= 0:
            r = ranks.get((word[p:i], word[i:e]))
            if r is not None:
                heapq.heappush(heap, (r, p, i, e))
    return n - merges


@functools.lru_cache(maxsize=4)
def count_memo(path: str) -> Memo:
    ranks = merge_ranks(path)
    return Memo(lambda w: count_symbols(as_letters(w), ranks))


def count_text(text: str | None, path: str) -> int:
    if not text:
        return 0
    memo, total = count_memo(path), 0
    for k, part in enumerate(split_specials(text, path)):
        if k % 2:
            total += 1
        elif part:
            total += sum(map(memo.__getitem__, split_words(part, path)))
    return total


def with_token_count(df: DataFrame, text_col: str = "text", out: str = "n_tokens",
                     tokenizer_path: str | None = None) -> DataFrame:
    """Add ``out``: the number of tokens of each whole text. No shuffle."""
    path = tokenizer_path or default_tokenizer()

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([count_text(t.as_py(), path) for t in texts], pa.int64())

    return without(df, out).withColumn(out, count(quoted(text_col)))
