"""Quality rules: every base column and the verdict of whole documents, against plain Python and zstandard."""

import re

import zstandard

from verbscope.llm import queries
from verbscope.llm.quality_bands import Bands

SF = "/root/testdata/sf0.001"


def base(text):
    words = re.findall("[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = {}
    for k in range(len(words) - 7):
        at.setdefault(tuple(words[k : k + 8]), []).append(k)
    inside = {j for places in at.values() if len(places) > 1 for k in places for j in range(k, k + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def verdict(text, b):
    raw, pack = text.encode(), zstandard.ZstdCompressor(level=b.level).compress
    kept = True
    for smallest, low, high in b.whole:
        if len(raw) >= smallest:
            kept = low <= len(raw) / len(pack(raw)) <= high
    chunks = [raw[k : k + b.chunk_bytes] for k in range(0, len(raw) - b.chunk_bytes + 1, b.chunk_bytes)]
    bad = sum(not b.chunk[0] <= b.chunk_bytes / len(pack(c)) <= b.chunk[1] for c in chunks)
    return kept and bad <= b.bad_share * len(chunks)


def test_all_columns_of_all_documents(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op1_quality_bands(spark, SF).collect()
    assert len(got) == len(texts)
    outcomes = set()
    for r in got:
        text = texts[r["doc_id"]]
        want = base(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, r["doc_id"]
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed and verdict(text, Bands())), r["doc_id"]
        outcomes.add((r["base_failed"], r["kept"]))
    assert outcomes >= {(False, True), (True, False)}
