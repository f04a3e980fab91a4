"""Turn repair, prefix trie and piece encoding against brute force, the library and their SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from verbscope.llm import piece_encoding, prefix_trie, queries, turn_order, turn_repair

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def hostile(n, seed):
    """Conversations with nulls everywhere, ties, repeated rows, odd roles, very long texts and one very long conversation."""
    rng = random.Random(seed)
    texts = ["Fine.", "cut off", "", " \t", None, "Fine.", "What?", "a" * 30_000 + "!", "x", "é 日本.", "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "u", "User"]
    rows = []
    for c in [None, *range(n)]:
        for t in range(rng.randint(1, 9)):
            row = (c, rng.choice([t, t, t, None, 3]), rng.choice(roles), rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 2, 5])
    rows += [(5000, t, ("user", "assistant")[t % 2 ^ (t % 7 == 0)], f"turn {t}" + "." * (t % 5 > 0)) for t in range(700)]
    return rows


# ---- turn repair ----

def solve(rows):
    seen, faults = set(), []
    for role, text in rows:
        said = re.findall("[^\x20\x09-\x0D]", text)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(4):
            for state, (cost, edits, out) in list(best.items()):
                for c, name in names.items():
                    if (to := moves[state].get(c)) and ((new := (cost + 3, edits + "I")) < best.get(to, (1e9,))[:2]):
                        best[to] = (*new, (*out, (name, "")))
        return best

    best = inserted({"": (0, "", ())})
    for (role, text), fault in zip(rows, faults, strict=True):
        now = {}

        def put(state, found, now=now):
            if state and found[:2] < now.get(state, (1e9,))[:2] or not state and found[:2] < now.get("", (1e9,))[:2]:
                now[state] = found

        for state, (cost, edits, out) in best.items():
            put(state, (cost + 4, edits + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            if role and (to := moves[state].get(role[0])):
                put(to, (cost + more, edits + "K", (*out, (role, text))))
            for c, name in names.items():
                if to := moves[state].get(c):
                    put(to, (cost + 3 + more, edits + "R", (*out, (name, text))))
        best = inserted(now)
    cost, edits, out = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return [faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, edits, out


def in_order(rows):
    by = {}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        by.setdefault(c, []).append(((t is not None, t or 0), role.encode(), hashlib.sha256(text.encode()).digest(), role, text))
    return {c: sorted(x) for c, x in by.items()}


@pytest.mark.parametrize("block", [3, 4096])
def test_repair_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(turn_repair, "BLOCK", block)
    rows = hostile(60, 3)
    d = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("theirs") for c in ("Audit", "position", "at", "letter")})
    summary, repaired = turn_repair.repair(d.repartition(5))
    got = {r["conv_id"]: r for r in summary.collect()}
    left = {}
    for r in repaired.collect():
        left.setdefault(r["conv_id"], []).append((r["position"], r["role"], r["text"]))
    want = in_order(rows)
    assert set(got) == set(want)
    for c, turns in want.items():
        (blank, duplicate, truncated), illegal, cost, edits, out = solve([x[3:] for x in turns])
        days = [x[0][1] for x in turns if x[0][0]]
        gaps = max(days) - min(days) + 1 - len(set(days)) if days else 0
        r = got[c]
        assert (r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["gaps"]) == (
            blank, duplicate, truncated, illegal, cost, edits, gaps), c
        assert [x[1:] for x in sorted(left.get(c, []))] == list(out)
        assert [x[0] for x in sorted(left.get(c, []))] == list(range(len(out)))


def test_repair_of_nothing(spark):
    summary, repaired = turn_repair.repair(spark.createDataFrame([], SCHEMA))
    assert summary.count() == 0 and repaired.count() == 0


def test_rules_change_no_result():
    rng = random.Random(1)
    plain = turn_repair.Solver(())
    seqs = ["".join(rng.choice("AEFEIIFJOLG") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    grammar, symbols = (), [[turn_repair._TO_SYMBOL[c] for c in s] for s in seqs]
    for _ in range(4):
        counts = {}
        for s in symbols:
            now = turn_repair.compress(s, grammar)
            for p in zip(now, now[1:], strict=False):
                counts[p] = counts.get(p, 0) + 1
        grammar += (turn_repair.choose(sorted(((a, b, n) for (a, b), n in counts.items()), key=lambda x: (-x[2], x))),)
    ruled = turn_repair.Solver(grammar)
    assert len(ruled.matrices) > 20
    assert max(len(turn_repair.compress(s, grammar)) / max(1, len(s)) for s in symbols if len(s) > 20) < 0.8
    for s in seqs:
        assert ruled(s) == plain(s)


def test_rope_order():
    rng = random.Random(2)

    def rope(text):
        if len(text) < 2 or rng.random() < 0.2:
            return (text,)
        k = rng.randint(0, len(text))
        return (rope(text[:k]), rope(text[k:]))

    for _ in range(500):
        a, b = ("".join(rng.choice("DK") for _ in range(rng.randint(0, 6))) for _ in range(2))
        assert turn_repair.comes_before(rope(a), rope(b)) == (a < b)


# ---- prefix trie ----

def brute_trie(convs):
    nodes, kids, leaves, saved = {}, {}, {}, {}
    least = lambda m: min((c for c in m if c is not None), default=None)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    for k in sorted(nodes, key=len, reverse=True):
        below = kids.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) or 1
        saved[k] = sum(saved[x] for x in below) + ((len(nodes[k]) - 1) * len(k[-1][1]) if k else 0)
    return sorted(((least(m), len(k), least(nodes[k[:-1]]) if k else None, len(m), len(kids.get(k, [])), leaves[k], saved[k],
                    sha(",".join("" if c is None else str(c) for c in sorted((c for c in m if len(convs[c]) == len(k)), key=lambda c: (c is not None, c)))))
                   for k, m in nodes.items()), key=repr)


def trie_of(turns, block, more=()):
    spark = turns.sparkSession
    rows = prefix_trie.turn_rows(turns).withColumnRenamed("conv_id", "conv")
    convs = rows.select("conv").distinct()
    if more:
        convs = convs.union(spark.createDataFrame([(c,) for c in more], "conv long"))
    nodes, members = prefix_trie.prefix_trie(rows, convs, block)
    ends = turn_order.ordered_sha256(members, "p", "conv", "conv", "ends", ",")
    got = nodes.join(ends, "p", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.sha2(F.lit(""), 256)))
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("block", [2, 5, 256])
def test_trie_against_brute_force(spark, block):
    rng = random.Random(block)
    convs = {}
    for c in range(60):  # combs, copies, prefixes of each other, one very long, one with a null id
        other = convs.get(rng.randrange(max(1, c)), [])
        convs[c] = other[: rng.randint(0, len(other))] + [(rng.choice("ua"), rng.choice(["", "x", "yy", "日本語"])) for _ in range(rng.randint(0, 4))]
        convs[c] = convs[c] or [("u", "x")]
    convs[100] = convs[59] + [("u", str(k % 3)) for k in range(40)]
    convs[101] = convs[100][:-1] + [("a", "end")]
    convs[None] = [("u", "x"), ("", "")]
    rows = [(c, t, r or None, x or None) for c, seq in convs.items() for t, (r, x) in enumerate(seq)]
    d = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("theirs") for c in ("p", "Depth", "at", "digest")})
    assert trie_of(d.repartition(4), block, more=(777,)) == brute_trie({**convs, 777: []})


def test_trie_of_nothing(spark):
    d = spark.createDataFrame([], SCHEMA)
    assert trie_of(d, 256) == []
    got = trie_of(d, 256, more=(3,))
    assert [r[:7] for r in got] == [(3, 0, None, 1, 0, 1, 0)]


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    d = spark.createDataFrame(pairs, "a long, b long").withColumn("f", prefix_trie.two_fattest(F.col("a"), F.col("b")))
    for r in d.collect():
        assert r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=lambda k: k & -k)


def test_positions_and_digests(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, k]), k) for k in range(500)]
    d = spark.createDataFrame(rows, "g long, o long, u long").repartition(7)
    by = {}
    for g, o, u in rows:
        by.setdefault(g, []).append(((o is not None, o or 0), u))
    want = sorted(((g, k, u) for g, x in by.items() for k, (_, u) in enumerate(sorted(x))), key=repr)
    assert sorted((tuple(r) for r in turn_order.with_position(d, "g", ["o", "u"]).select("g", "at", "u").collect()), key=repr) == want
    got = {r["g"]: r["h"] for r in turn_order.ordered_sha256(d, "g", "u", "o", "h", "-").collect()}
    assert got == {g: sha("-".join("" if o is None else str(o) for k, o, u in rows if k == g)) for g in by}


# ---- SQL of both ----

@pytest.mark.parametrize("name", ["op11_turn_repair", "op12_prefix_trie"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    df = queries.QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(want, key=repr)


def test_damage(spark):
    rows = hostile(20, 8)
    got = sorted((tuple(r) for r in queries.damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    want = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            want += [(c, t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    assert got == sorted(want, key=repr)


# ---- piece encoding ----

def test_pieces_equal_the_library(spark):
    path = piece_encoding.default_pieces()
    table = piece_encoding.piece_table(path)
    library, rng = table.library, random.Random(7)
    alphabet, pieces = "ab ▁\n\té日🙂\x00theings  .,'0﷽", list(table.ids)
    texts = [None, "", " ", "  ", "\n", "a", "<s> </s> <unk> <0x0A>", "x" * 50_000, " " * 20_000, "the " * 20_000, "ab" * 20_000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 16))) for _ in range(3000)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) for _ in range(3000)]
    d = spark.createDataFrame([(k, t, "theirs") for k, t in enumerate(texts)], "doc_id long, text string, PIECE_IDS string")
    got = piece_encoding.decode_pieces(piece_encoding.encode_pieces(d)).withColumn("h", piece_encoding.ids_digest()).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "")
        assert np.frombuffer(r["piece_ids"], "<u4").tolist() == ids, texts[r["doc_id"]][:50]
        assert r["decoded"] == library.decode(ids) and r["h"] == sha(",".join(map(str, ids)))
    assert piece_encoding.encode_pieces(d.limit(0)).count() == 0


def test_whole_documents_equal_the_library(spark):
    library = piece_encoding.piece_table(piece_encoding.default_pieces()).library
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op13_piece_encoding(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


def test_memo_is_bounded_in_bytes():
    from verbscope.llm.memo import ENTRY_BYTES, Memo
    made = []
    memo = Memo(lambda w: made.append(w) or w.encode(), limit=100 * (ENTRY_BYTES + 10))
    for k in range(1000):
        assert memo[f"{k:05d}"] == f"{k:05d}".encode()
    assert len(memo) + len(memo.old) <= 200 and len(made) == 1000
    assert memo["00999"] and len(made) == 1000
    assert memo["x" * 10**6] and "x" * 10**6 not in memo


def test_plain_encoding_equals_the_file_library():
    from verbscope.llm import wordpieces
    path = wordpieces.default_tokenizer()
    library, rng = wordpieces.tokenizer(path), random.Random(9)
    alphabet = "ab \n\té日🙂\x00the's  .,'0\x85\x1c 　ſ<|endoftext|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20))) for _ in range(4000)]
    texts += [" " * 300_000, "x" * 100_000, "\n \n" * 1000, "<|endoftext|> a<|endoftext|>", "<|endoftext", ""]
    for t in texts:
        assert np.frombuffer(wordpieces.encode(t, path), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    ordinary = np.frombuffer(wordpieces.encode("<|endoftext|>", path, specials=False), "<u4").tolist()
    assert 50256 not in ordinary and len(ordinary) > 1
