"""Every operator on one hostile table: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbscope.llm import chat, exact_dup, line_dedup, mixing, near_dup, packing, quality_bands, shards, token_count, url_filter, wordpieces

LINE = "  The same LINE of more than twenty points  "
BASE = " ".join(f"w{k}" for k in range(60))
TEXTS = [
    (1, None, "a"), (2, "", "a"), (3, BASE, None), (4, BASE.upper(), None), (5, BASE + " extra", "b"),
    (6, f"{LINE}\nown line one\n{LINE}", "b"), (7, LINE.strip() + "\n\nx", "b"), (8, LINE.lower(), "b"), (8, LINE.lower(), "b"),
    (None, "no id", "c"), (None, LINE, None), (9, "x" * 30_000, "c"), (10, "a b " * 20_000, "c"), (11, "日本 語 <|endoftext|> É é", "d"),
    (12, "a  b\t\n \x0b", "d"), (13, "two words", "d"), (13, "two words", "d"), (14, "A b", "e"), (15, "a B", "e"),
]
CLASH = ("kept", "Kept_Text", "n_words", "N_TOKENS", "copies", "target", "_row", "_t", "rank", "id")


def clash():
    return {c: F.lit("theirs") for c in CLASH}


SCHEMA = "doc_id long, text string, source string"
WS = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, SCHEMA).withColumns(clash()).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def fold(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute_repeats(words):
    n, seen = len(words), {}
    for i in range(n - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)})


def test_quality(docs, none):
    got = quality_bands.with_quality(docs).select("text", "n_words", "word_chars", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(got) == len(TEXTS)
    for r in got:
        words = (r["text"] or "").encode().split()
        assert (r["n_words"], r["word_chars"]) == (len(words), sum(len(w.decode()) for w in words))
        if len(words) < 5000:
            assert r["n_repeat_words"] == brute_repeats(words)
        assert not (r["base_failed"] and r["kept"])
    rng = np.random.default_rng(1)
    for n in (5, 8, 9, 30, 200):
        words = [str(x) for x in rng.integers(0, 2, n)]
        assert quality_bands.repeated_words(words) == brute_repeats(words)
    assert quality_bands.with_quality(none).count() == 0


def test_bands(spark):
    import base64
    rng = np.random.default_rng(3)
    noise = base64.b64encode(rng.bytes(6000)).decode()
    noise = " ".join(noise[k : k + 30] for k in range(0, len(noise), 30))
    vocab = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(800)]
    prose = " ".join(rng.choice(vocab, 900))
    spam = " ".join(f"buy cheap pills now {k % 3}" for k in range(900))
    d = spark.createDataFrame([(1, noise), (2, prose), (3, spam)], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in quality_bands.with_quality(d).collect()} == {1: False, 2: True, 3: False}


def test_line_dedup(docs, none):
    got = line_dedup.drop_lines(docs).select("doc_id", "text", "n_lines", "n_dropped", "kept_text").collect()
    holders = {}
    for i, t, _ in TEXTS:
        for x in (t or "").split("\n"):
            if len(x.strip(WS)) >= 20:
                holders.setdefault(fold(x.strip(WS)), set()).add(i)
    assert len(got) == len(TEXTS)
    for r in got:
        lines = (r["text"] or "").split("\n")
        lost = [len(h := holders.get(fold(x.strip(WS)), set())) >= 3 and r["doc_id"] != max(h, key=lambda v: -1 if v is None else v) for x in lines]
        assert (r["n_lines"], r["n_dropped"]) == (len(lines), sum(lost))
        assert r["kept_text"] == "\n".join(x for x, y in zip(lines, lost, strict=True) if not y)
    assert line_dedup.drop_lines(none).count() == 0


def test_line_bitmap_beyond_one_word(spark):
    text = "\n".join(f"{'shared' if k % 3 else k} line with a long enough key" for k in range(200))
    d = spark.createDataFrame([(k, text.replace("9", str(k))) for k in range(4)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.drop_lines(d).collect()}
    assert got[3] == 0 and min(got[k] for k in range(3)) >= 133


def check_packing(rows, most):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= most
    return len(by)


def test_packing(docs, none):
    path = wordpieces.default_tokenizer()
    tok = wordpieces.tokenizer(path)
    out = packing.pack(docs, max_tokens=64, with_ids=True)
    rows = out.collect()
    check_packing(rows, 64)
    want = []
    for i, t, _ in TEXTS:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, (a, n) in enumerate(packing.cut(len(ids), 64)):
            want.append((i, k, a, n, zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())))
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows)
    seqs = packing.sequences(out).collect()
    assert sum(len(s["ids"]) for s in seqs) == 4 * sum(r["length"] for r in rows)
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("n", [50, 3000, 60_000])
def test_plan_is_close_to_the_bound(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(6, 1, n).astype(int), 1, 2048)
    lengths[: n // 3] = 700  # a third of all of one length
    h = np.bincount(lengths, minlength=2049)
    chosen = packing.plan(h)
    used = np.zeros(2049, int)
    for m, pattern in chosen:
        assert sum(a * b for a, b in pattern) <= 2048
        for a, b in pattern:
            used[a] += m * b
    assert (used == h).all()
    assert sum(m for m, _ in chosen) <= sum(m for m, _ in packing.best_fit(h)) * 1.005 + 1


def test_urls(spark):
    urls = [None, "", "no scheme", "http://a.net", "http://A.NET/", "https://x.example.net/en/1?q#f", "http://example.net/english", "ftp://example.com/de/",
            "http://notexample.com/de/x", "http://b.org/fr/?x", "http://net/q", "http://a.net/b://c", "http://.net/", "x://"]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("example.net", "/eng", "allow"),
             (None, "/", "block")]
    pages = spark.createDataFrame([(k, u, "theirs") for k, u in enumerate(urls * 2)], "page_id long, url string, Rule string")
    got = {(r["page_id"]): (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(
        pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    for k, u in enumerate(urls * 2):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cutat = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = fold(rest[:cutat]), rest[cutat:].split("?")[0].split("#")[0]
        fits = [r for r in rules if r[0] and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        assert got[k] == (host, path, best and best[0] + best[1], best[2] if best else "allow"), u
    assert url_filter.judge_urls(pages.limit(0), spark.createDataFrame([], "host string, path string, verdict string")).count() == 0


def brute_components(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = [x.lower() for x in (t or "").encode().split()]
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_near_duplicates(spark, docs, none):
    rng = np.random.default_rng(5)
    base = [f"t{k}" for k in range(120)]
    rows = [(i, t) for i, t, _ in TEXTS if i is not None and len(t or "") < 1000]
    for k in range(100, 160):  # a chain of near copies around one base, some of them too far off
        w = list(base)
        for j in rng.integers(0, 120, rng.integers(0, 9)):
            w[j] = f"n{k}{j}"
        rows.append((k, " ".join(w)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for words, percent in ((3, 85), (5, 80)):
        p = near_dup.NearDup(words=words, percent=percent, tile=8, per_leader=4)
        got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.with_components(d, p=p).collect()}
        assert got == brute_components(rows, words, percent)
    whole = near_dup.with_components(docs).collect()
    assert len(whole) == len(TEXTS) and all(r["kept"] and r["component_id"] is None for r in whole if r["id"] is None)
    left = near_dup.drop_near_duplicates(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} >= {1, 2, 3, None}
    assert near_dup.with_components(none).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))
    b = np.concatenate([a[:800], np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64))])
    same = (near_dup.signature(a, 2000, 1) == near_dup.signature(b, 2000, 1)).mean()
    assert abs(same - 800 / 1200) < 0.06


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 65537])
def test_feistel_is_a_permutation(n):
    assert (np.sort(shards.feistel(np.arange(n), n, 7)) == np.arange(n)).all()


def test_shards(spark, docs, none, tmp_path):
    folder, placement, manifest = shards.materialise(docs, str(tmp_path / "s"), seq_len=32, per_shard=50)
    n = placement.count()
    assert [r["slot"] for r in placement.orderBy("slot").collect()] == list(range(n))
    assert manifest.agg(F.sum("records")).first()[0] == n
    read = {r["slot"]: np.frombuffer(r["ids"], "<u4") for r in shards.read_shards(spark, folder, 32, 50).collect()}
    tok = wordpieces.tokenizer(wordpieces.default_tokenizer())
    by = {}
    for r in placement.collect():
        by.setdefault(r["doc_id"], []).append((r["piece"], read[r["slot"]][: r["length"]]))
    for i, t, _ in TEXTS:
        if i not in (None, 8, 13):
            assert np.concatenate([x for _, x in sorted(by[i], key=lambda v: v[0])]).tolist() == tok.encode(t or "", add_special_tokens=False).ids + [50256]
    assert shards.materialise(none, str(tmp_path / "e"))[1].count() == 0


def test_training_order_depends_on_data_only(spark, docs, tmp_path):
    from verbscope.llm.common import quoted
    found = []
    for parts in (3, 5):
        d = docs.select("doc_id", "text").repartition(parts, quoted("text"))
        _, placement, _ = shards.materialise(d, str(tmp_path / str(parts)), seq_len=32, per_shard=50, key=9)
        found.append(sorted(tuple(r) for r in placement.select("slot", F.coalesce("doc_id", F.lit(-1)), "piece", "length").collect()))
    assert found[0] == found[1] and len(found[0]) > 400
    plan = placement._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan
    assert shards.qualified(spark, "/some/where").startswith("file:") and shards.qualified(spark, "file:/a") == "file:/a"


def test_ids_are_kept_in_the_shards_alone(spark, docs, tmp_path):
    """The table that ids come from goes when the shards are written; the placement doesn't count slots again."""
    before = {t.name for t in spark.catalog.listTables()}
    _, placement, _ = shards.materialise(docs, str(tmp_path / "k"), seq_len=32, per_shard=50)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert not [f for f in placement.inputFiles() if "/sequences/" in f]
    assert sorted(r["slot"] for r in placement.select("slot").collect()) == list(range(placement.count()))
    assert "Window" not in placement._jdf.queryExecution().optimizedPlan().toString()


def test_ids_are_compressed_against_a_dictionary(spark, tmp_path):
    d = spark.range(600).select(F.col("id").alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(1, 60), k -> concat('word', (k * 7 + id * k) % 400)))").alias("text"))
    held = lambda dictionary: shards.token_sequences(d, seq_len=64, dictionary=dictionary).agg(F.sum(F.length("ids"))).first()[0]
    trained = shards.id_dictionary(d, seq_len=64)
    assert 0 < len(trained) <= shards.DICTIONARY_BYTES and held(trained) < 0.8 * held(b"")
    assert shards.id_dictionary(d.limit(0)) == shards.id_dictionary(d.select(F.lit(None).cast("string").alias("text"))) == b""
    found = [sorted(map(tuple, shards.materialise(x, str(tmp_path / n), seq_len=64, per_shard=50)[2].collect()))
             for n, x in (("a", d), ("b", d.orderBy(F.col("doc_id").desc())))]
    assert found[0] == found[1]


def test_shards_are_written_in_rounds(spark, tmp_path, monkeypatch):
    """Each round shuffles the ids of its own shards only, and leaves no shuffle files; shards are the same as in one round."""
    import time

    def shuffle_files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in found.split("\n") if "/shuffle_" in f}

    found, write = [], shards.write_shards
    d = spark.range(200).select(F.col("id").alias("doc_id"), F.expr("repeat(concat('text ', id, ' '), int(id % 40))").alias("text"))
    for rounds in (1, 3):
        taken, before = [], shuffle_files()
        monkeypatch.setattr(shards, "SHARD_ROUNDS", rounds)
        monkeypatch.setattr(shards, "ROUND_SHARDS", 2)
        monkeypatch.setattr(shards, "write_shards", lambda placed, *a: taken.append({r["slot"] for r in placed.select("slot").collect()}) or write(placed, *a))  # noqa: B023
        folder, placement, manifest = shards.materialise(d, str(tmp_path / str(rounds)), seq_len=32, per_shard=50)
        until = time.time() + 20  # executors delete them in the background
        while shuffle_files() - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffle_files() - before
        n = placement.count()
        assert len(taken) == rounds and sorted(x for t in taken for x in t) == list(range(n))
        assert max(map(len, taken)) <= n / rounds + 50 and all(len({x // 50 for x in t}) >= 2 for t in taken)
        found.append((sorted(map(tuple, manifest.collect())), sorted(map(tuple, shards.read_shards(spark, folder, 32, 50).collect()))))
        monkeypatch.setattr(shards, "write_shards", write)
    assert found[0] == found[1] and len(found[0][0]) == -(-n // 50)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_frequent_ids_are_renumbered(spark, monkeypatch):
    path = wordpieces.default_tokenizer()
    d = spark.range(600).select(F.col("id").alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(1, 60), k -> concat('word', (k * 7 + id * k) % 400)))").alias("text"))
    trained = shards.id_dictionary(d, seq_len=64)
    ids = np.frombuffer(b"".join(wordpieces.encode(r["text"], path) for r in d.collect()), "<u4")
    for kind in ("<u2", "<u4"):
        monkeypatch.setattr(shards, "record_type", lambda _, kind=kind: np.dtype(kind))
        number, back, _ = shards._coding(b"", path)
        assert (number == back).all() and (number == np.arange(len(number))).all()
        number, back, _ = shards._coding(trained if kind == "<u2" else shards.id_dictionary(d, seq_len=64), path)
        assert (back[number] == np.arange(len(number))).all() and number.dtype == np.dtype(kind)
        assert number[ids].max() < len(np.unique(ids)) and number[np.bincount(ids).argmax()] == 0


def test_ids_are_the_librarys():
    """The possessive split pattern: every code point of the plain class next to words, marks and white space of any length."""
    path = wordpieces.default_tokenizer()
    library = wordpieces.tokenizer(path)
    white = ["\t", "\n", "\r", " ", "\x0b", "\x0c", "\x85", "\xa0", "\u2003", "\u2028", "\u3000"]
    texts = [f"a{x}1{x}!{x} {x}\n{x}{x}b '{x}  {x}" for x in map(chr, [*range(0x250), *range(0x2010, 0x2028), 0x20AC])]
    texts += [f"{a * n}{b}{x}{a * n}{b * n}" for a in white for b in white for n in (1, 2, 5) for x in ("", "b", "1", "!", "'s", "''ll", "'S", "<|endoftext|>")]
    for t in texts:
        assert np.frombuffer(wordpieces.encode(t, path), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    assert "++" in wordpieces.PATTERN


def test_slots_are_the_permuted_index(spark, tmp_path):
    """Slots against brute force: rows by document, piece and checksum within the buckets of ``numbered``, permuted."""
    d = spark.createDataFrame([(k, f"text {k} " * (k % 9 + 1)) for k in range(40)], "doc_id long, text string").repartition(4)
    _, placement, _ = shards.materialise(d, str(tmp_path / "x"), seq_len=8, per_shard=16, key=3)
    rows = placement.select("doc_id", "piece", "slot").collect()
    n = len(rows)
    table = shards.by_part(shards.token_sequences(d, seq_len=8)).select("doc_id", "piece", F.pmod(F.xxhash64("doc_id", "piece", "crc"), F.lit(16)).alias("b"), "crc")
    ordered = sorted((r["b"], r["doc_id"], r["piece"]) for r in table.collect())
    want = {(i, p): s for (_, i, p), s in zip(ordered, shards.feistel(np.arange(n), n, 3).tolist(), strict=True)}
    assert {(r["doc_id"], r["piece"]): r["slot"] for r in rows} == want


def test_ids_stay_where_they_are_when_slots_are_joined(spark):
    d = spark.createDataFrame([(k, f"text {k} " * (k % 9 + 1)) for k in range(40)], "doc_id long, text string").repartition(5)
    sequences = shards.token_sequences(d, seq_len=8)
    placed = shards.with_slots(shards.by_part(sequences, 5), 3, 5)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("ids#", plan.index("ShuffledHashJoin") + 1)  # the table with the ids lies right below the join
    assert "Bucketed: true" in plan and "Exchange" not in plan[plan.index("ShuffledHashJoin"):scan]
    assert sorted(r["slot"] for r in placed.select("slot").collect()) == list(range(placed.count()))


def test_long_urls(spark):
    import time
    url = "http://" + "a." * 2000 + "example.com/de/" + "/" * 100_000 + "?q"
    pages = spark.createDataFrame([(1, url), (2, "http://x.net/"), (3, "http://y.org/fr")], "page_id long, url string")
    rules = spark.createDataFrame([("example.com", "/de/", "block"), ("org", "/fr", "block")], "host string, path string, verdict string")
    t0 = time.time()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got == {1: ("example.com/de/", "block"), 2: (None, "allow"), 3: ("org/fr", "block")} and time.time() - t0 < 60


def test_text_of_many_lines(spark):
    lines = [f"a line that many documents hold {k % 1000}" if k % 3 else f"own line number {k}" for k in range(100_000)]
    shared = "\n".join(f"a line that many documents hold {k}" for k in range(0, 1000, 2))
    d = spark.createDataFrame([(1, "\n".join(lines)), (2, shared), (3, shared)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_dedup.drop_lines(d).collect()}
    lost = [k % 3 != 0 and (k % 1000) % 2 == 0 for k in range(100_000)]
    assert got[1]["n_dropped"] == sum(lost) and got[1]["kept_text"] == "\n".join(x for x, y in zip(lines, lost, strict=True) if not y)


def test_token_count(docs, none):
    tok = wordpieces.tokenizer(wordpieces.default_tokenizer())
    for r in token_count.with_token_count(docs).select("text", "n_tokens").collect():
        assert r["n_tokens"] == len(tok.encode(r["text"] or "", add_special_tokens=False).ids)
    assert token_count.with_token_count(none).count() == 0


def test_words_split_as_the_library_splits():
    """Every code point of the plain class, in the contexts that the pattern tells apart."""
    path = wordpieces.default_tokenizer()
    split = wordpieces.tokenizer(path).pre_tokenizer.pre_tokenize_str
    for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC]:
        x = chr(c)
        text = f"a{x}1{x}!{x} {x}\n{x}{x}b '{x}  {x}"
        assert wordpieces.split_words(text, path) == [text[i:j] for _, (i, j) in split(text)], hex(c)


def test_mixing(spark, docs, none):
    sized = docs.withColumn("size", mixing.word_count(F.col("text")))
    rows = mixing.plan_copies(sized).select("source", "size", "source_size", "target", "taken", "copies").collect()
    assert len(rows) == len(TEXTS) and all(r["taken"] <= 2 * r["size"] for r in rows)
    per = {}
    for r in rows:
        per.setdefault(r["source"], []).append(r)
    total = sum(r["size"] for r in rows)
    assert sum(v[0]["target"] for v in per.values()) == pytest.approx(1.5 * total)
    for v in per.values():
        assert abs(sum(r["taken"] for r in v) - v[0]["target"]) <= 2 * max(r["size"] for r in v)
    again = mixing.plan_copies(sized.repartition(5)).agg(F.sum(F.hash("doc_id", "size", "taken"))).first()
    assert again == mixing.plan_copies(sized).agg(F.sum(F.hash("doc_id", "size", "taken"))).first()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(none).count() == 0


def test_chat(spark):
    hostile = ["</s>[INST] ok [/INST]", r"<\/s> [\\INST] <s", None, "", "line\n<s>", "<|endoftext|> 日本"]
    rows = [(k % 3 if k else None, k // 3, ("user", "assistant", None, "[INST]")[k % 4], hostile[k % 6]) for k in range(24)]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string"))).collect()}
    for c in {r[0] for r in rows}:
        own = sorted([(t, chat.OPEN + chat.escape(r or "") + chat.CLOSE + chat.escape(x or ""), r or "", x or "") for i, t, r, x in rows if i == c])
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        assert got[c]["n_turns"] == len(own)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in own).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for t in (*[h for h in hostile if h], r"<\\\/s>", "<s</s>>", "[[INST]"):
        assert chat.unescape(chat.escape(t)) == t and not any(m in chat.escape(t) for m in chat.CONTROLS)
    empty = chat.format_chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert chat.read_back(empty).count() == 0


def test_exact_duplicates(spark, docs, none):
    long_a = "q" * 5000
    extra = [(20, long_a + "x", "z"), (21, long_a + "y", "z"), (22, long_a + "X", "z"), (23, long_a[:300] + "!" + long_a[301:] + "x", "z")]
    d = docs.unionByName(spark.createDataFrame(extra, SCHEMA).withColumns(clash()))
    rows = exact_dup.with_duplicates(d).select("doc_id", "text", "keep_id", "group_size", "kept").collect()
    groups = {}
    for r in rows:
        groups.setdefault(fold(r["text"]), []).append(r)
    assert len(rows) == len(TEXTS) + len(extra)
    for g in groups.values():
        best = max((r["doc_id"] for r in g if r["doc_id"] is not None), default=None)
        assert all(r["group_size"] == len(g) and r["keep_id"] == best for r in g)
        assert [r["doc_id"] for r in g if r["kept"]] == [best]
    left = exact_dup.drop_duplicates(d)
    assert left.columns == d.columns and left.count() == len(groups)
    assert exact_dup.with_duplicates(none).count() == 0


def test_pipeline(spark):
    """run() against a brute-force version of its stages on the small table."""
    import corpus_pipeline as cp
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    kept = {r["doc_id"] for r in quality_bands.with_quality(docs).where("kept").collect()}
    by = {}
    for i, t, _ in rows:
        if i in kept:
            by[fold(t)] = max(i, by.get(fold(t), -1))
    stays = {i: t for t, i in by.items()}
    text = {i: t for i, t, _ in rows}
    comps = brute_components([(i, text[i]) for i in stays], 5, 80)
    near = {i for i, (_, c) in comps.items() if c == i}
    out = cp.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} <= near
    size = {i: len(text[i].encode().split()) for i in near}
    pieces = [r for r in out if r["piece"] == 0]
    copies = {i: sum(r["doc_id"] == i for r in pieces) for i in near}
    assert max(copies.values()) <= 2
    source = {i: s for i, _, s in rows}
    assert abs(sum(copies[i] * size[i] for i in near) - 1.5 * sum(size.values())) <= 2 * len(set(source.values())) * max(size.values())
    check_packing(out, 2048)


def test_small_table_queries_match_sql(spark):
    import duckdb

    from verbscope.llm.queries import ORACLE, QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in ORACLE.items():
        got, want = QUERIES[name](spark, sf).toPandas(), con.execute(sql).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns)
        a, b = (json.loads(x[cols].sort_values(cols).to_json(orient="values")) for x in (got, want))
        assert a == b, name


def test_frames_outlive_a_pipeline_run(spark, docs):
    """Tables of other operators, and of the result of an earlier run, are nobody else's to delete."""
    import corpus_pipeline as cp
    held = line_dedup.drop_lines(docs.select("doc_id", "text", "source"))
    first = cp.run(spark, "/root/testdata/sf0.001")
    n = first.count()
    second = cp.run(spark, "/root/testdata/sf0.001")
    assert held.count() == len(TEXTS) and first.count() == n == second.count()
