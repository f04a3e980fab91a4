"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its distinct word shingles. Documents with equal sets form a class; a
class is represented by its smallest id. Per class:

* signature: one permutation scatters the shingles over the 32-bit universe; coordinate k is
  the smallest value of a second permutation after a circular shift by k steps. Two
  permutations thus give all coordinates.
* bands: runs of ``rows`` coordinates, hashed to a bucket key. The number of bands follows from
  the threshold and ``miss``, the probability that a pair at the threshold shares no bucket.
* links, first round: within each bucket every class is compared with the smallest class (a
  pair per member, not all pairs), on whole sets. Linked classes are merged to components.
* links, second round: in buckets whose members still lie in several components, the members
  outside the smallest class's component are compared with all others, in tiles of ``tile``
  members, inside tasks: an indicator matrix product gives all exact intersections of a tile.
  A tile returns a spanning forest of its links only. Pairs within the smallest class's
  component are left out, as they can't merge anything.

So every pair that shares a bucket ends in one component if it links, no pair list of a group is
ever written, and no task holds a group.

Defined results: a text without words (null, empty, white only) has an empty set and is linked
with nothing; with fewer words than a shingle the whole word sequence is the one shingle; rows
that share an id are one document, linked by any of its texts; rows with a null id are linked
with nothing, have a null component and are kept; columns other than the two named are not read;
an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbscope.llm.common import quoted, staged
from verbscope.llm.components import components

M64 = (1 << 64) - 1


@dataclass(frozen=True)
class NearDup:
    """Link documents with ``100 * intersection >= percent * union`` of their shingle sets."""

    words: int = 5
    percent: int = 80
    rows: int = 5
    miss: float = 1e-6
    tile: int = 512
    per_leader: int = 512
    seed: int = 1

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))


# ---- sets and signatures (inside tasks) ----

def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# one random 64-bit number per byte, 0 for the six white characters
_BYTES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_BYTES[list(b" \t\n\x0b\x0c\r")] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20


def _blocks(data: bytes) -> Iterator[bytes]:
    """The text in blocks of about a megabyte, cut at blanks (a longer word stays whole)."""
    start = 0
    while len(data) - start > _BLOCK:
        end = data.find(b" ", start + _BLOCK)
        if end < 0:
            break
        yield data[start:end]
        start = end
    yield data[start:]


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, in order: polynomials of their bytes, mixed."""
    values = _BYTES[np.frombuffer(data, np.uint8)]
    inside = values != 0
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.empty(0, np.uint64)
    values, inside, starts = values[starts[0] :], inside[starts[0] :], starts - starts[0]
    room = np.diff(np.append(starts, len(values)))
    power = np.cumprod(np.full(int(room.max()), _BASE))
    place = np.arange(len(values)) - np.repeat(starts, room)
    length = np.add.reduceat(inside, starts, dtype=np.uint64)
    return _mix64(np.add.reduceat(values * power[place], starts) + length)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    data = (text or "").encode().lower()  # of bytes: A-Z only
    h = np.concatenate([word_hashes(b) for b in _blocks(data)])
    if not len(h):
        return h
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mix64(out + h[k : len(h) - width + 1 + k])
    return np.unique(out)


def signature(shingles: np.ndarray, size: int, seed: int) -> np.ndarray:
    """``size`` coordinates by two permutations of the 32-bit universe, the second shifted."""
    def permute(x: np.ndarray, key: int) -> np.ndarray:  # a bijection of 32-bit numbers
        x = (x ^ np.uint32(key)) * np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(13)
        return x

    at = permute((shingles >> np.uint64(32)).astype(np.uint32), seed)
    shifts = np.arange(size, dtype=np.uint32)[:, None] * np.uint32(0x9E3779B1)  # steps around the circle
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(at), 256):  # small blocks stay in the cache
        np.minimum(least, permute(at[None, k : k + 256] + shifts, 0x5BD1E995 ^ seed).min(1), out=least)
    return least


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band."""
    key = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        key = _mix64(key + sig.reshape(bands, rows)[:, k].astype(np.uint64) + np.uint64(1))
    return key.view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(shingles.tobytes())


def jaccard_links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def tile_links(sets: list[np.ndarray], labels: list, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of different labels, as index pairs."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    values, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    shared = counts > 1
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    both = np.zeros((n, n), np.float32)  # whole numbers below 2**24, exact
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 4096
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((n, width), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    parent: dict = {x: x for x in labels}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        x, y = root(labels[i]), root(labels[j])
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(i), int(j)))
    return out


# ---- the Spark jobs ----

def _signatures(df: DataFrame, p: NearDup) -> DataFrame:
    """id, n_shingles, digest of the set, band keys."""

    @F.arrow_udf("n_shingles long, digest binary, keys array<long>")
    def sign(texts: pa.Array) -> pa.Array:
        n, digests, keys = [], [], []
        for t in texts:
            s = shingle_set(t.as_py(), p.words)
            n.append(len(s))
            digests.append(_digest(s) if len(s) else None)
            keys.append(band_keys(signature(s, p.bands * p.rows, p.seed), p.bands, p.rows) if len(s) else None)
        lists = pa.array(keys, pa.list_(pa.int64()))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(digests, pa.binary()), lists],
                                          names=["n_shingles", "digest", "keys"])

    return staged(df.select("id", sign("text").alias("s")).select("id", "s.*"), "signatures")


def _sets(docs: DataFrame, wanted: DataFrame, p: NearDup) -> DataFrame:
    """(node, shingles) of the wanted nodes: their texts are fetched and cut once more."""

    @F.arrow_udf("binary")
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t.as_py(), p.words).tobytes() for t in texts], pa.binary())

    texts = docs.join(wanted, docs["id"] == wanted["node"], "left_semi")
    return staged(texts.select(F.col("id").alias("node"), cut("text").alias("shingles")).where("octet_length(shingles) > 0"),
                  "sets")


def _verify(pairs: DataFrame, sets: DataFrame, p: NearDup) -> DataFrame:
    """The pairs (a, b) that link on whole sets. A leader's set is sent once per block of its
    partners and held while they stream past."""
    sized = pairs.withColumn("block", F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(
        F.col("n_a") / p.per_leader))).cast("int"))
    leaders = sized.select("a", "block").distinct().join(sets, F.col("a") == sets["node"]).select(
        "a", "block", F.lit(None).cast("long").alias("b"), "shingles")
    others = sized.join(sets, F.col("b") == sets["node"]).select("a", "block", "b", "shingles")
    rows = leaders.union(others).repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, []
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, block, b, s in zip(*batch.columns, strict=True):
                a, block, b = a.as_py(), block.as_py(), b.as_py()
                values = np.frombuffer(s.as_py(), np.uint64)
                if key != (a, block):
                    key, own = (a, block), []
                if b is None:
                    own.append(values)
                elif any(jaccard_links(x, values, p.percent) for x in own):
                    found.append((a, b))
            u, v = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return rows.mapInArrow(compare, "u long, v long")


def _tiles(labelled: DataFrame, sets: DataFrame, p: NearDup) -> DataFrame:
    """Links between classes of different components in one bucket. ``labelled``: key, node, a
    (the bucket's smallest class), comp. Members fall into parts: 0 .. n_main - 1 for those of the
    component of ``a``, the next n_rest for the others. Tile (i, j) holds parts i and j."""
    heads = labelled.where("node = a").select("key", F.col("comp").alias("main"))
    flagged = staged(labelled.join(heads, "key").select("key", "node", "comp", (F.col("comp") != F.col("main")).alias("rest")), "flagged")
    half = p.tile // 2
    sizes = (flagged.groupBy("key").agg(F.count_if("rest").alias("r"), F.count_if(~F.col("rest")).alias("m")).where("r > 0")
             .select("key", F.ceil(F.col("m") / half).cast("int").alias("n_main"), F.ceil(F.col("r") / half).cast("int").alias("n_rest")))
    h = F.xxhash64("node", F.lit(7))
    own = F.when(F.col("rest"), F.col("n_main") + F.pmod(h, F.col("n_rest"))).otherwise(F.pmod(h, F.col("n_main"))).cast("int")
    rows = (flagged.join(sizes, "key").withColumn("own", own)
            .withColumn("other", F.explode(F.expr("sequence(if(rest, 0, n_main), n_main + n_rest - 1)"))).where("own != other")
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "comp")
            .join(sets, "node").select("key", "i", "j", "node", "comp", "shingles")
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, comps, found_sets = None, [], [], []

        def close() -> pa.RecordBatch:
            pairs = tile_links(found_sets, comps, p.percent) if len(set(comps)) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in pairs], pa.int64()),
                                               pa.array([nodes[j] for _, j in pairs], pa.int64())], names=["u", "v"])

        for batch in batches:
            for k, i, j, node, comp, s in zip(*batch.columns, strict=True):
                now = (k.as_py(), i.as_py(), j.as_py())
                if now != key:
                    if nodes:
                        yield close()
                    key, nodes, comps, found_sets = now, [], [], []
                nodes.append(node.as_py())
                comps.append(comp.as_py())
                found_sets.append(np.frombuffer(s.as_py(), np.uint64))
        if nodes:
            yield close()

    return rows.mapInArrow(compare, "u long, v long")


def with_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: NearDup = NearDup()) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of ``df``. Ids are integers."""
    docs = df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    signed = _signatures(docs, p)
    named = signed.where("digest is not null and id is not null")
    classes = staged(named.groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("n")), "classes")
    # one row of keys per class: the representative's
    rep = named.join(classes.select("digest", "node"), "digest").where("id = node").select("node", F.explode("keys").alias("key")).distinct()
    buckets = rep.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n_a")).where("n_a > 1")
    members = staged(rep.join(buckets.select("key", "a"), "key").select("key", "node", "a"), "members")

    sets = _sets(docs, members.select("node").distinct(), p)
    pairs = members.where("node != a").select("a", F.col("node").alias("b")).distinct()
    fan = pairs.groupBy("a").agg(F.count("*").alias("n_a"))
    first = staged(_verify(staged(pairs.join(fan, "a"), "pairs"), sets, p), "links")
    roots = components(first)
    labelled = members.join(roots, members["node"] == roots["u"], "left").select(
        "key", "node", "a", F.coalesce("root", "node").alias("comp"))
    second = _tiles(labelled, sets, p)

    # rows that share an id but not a set are one document: link the classes of such ids
    placed = named.join(classes.select("digest", "node"), "digest")
    several = named.groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x != y").select("id")
    twin = placed.join(several, "id").select("id", "node").distinct()
    twins = twin.join(twin.groupBy("id").agg(F.min("node").alias("v")), "id").select(F.col("node").alias("u"), "v")
    roots = components(roots.select("u", F.col("root").alias("v")).union(second).union(twins))
    labels = classes.join(roots, classes["node"] == roots["u"], "left").select(
        F.col("digest").alias("of"), F.coalesce("root", "node").alias("label"))
    return (signed.join(labels, signed["digest"] == labels["of"], "left")
            .select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("label", "id")).alias("component_id"))
            .withColumn("kept", F.col("id").isNull() | (F.col("id") == F.col("component_id"))))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: NearDup = NearDup()) -> DataFrame:
    """The rows whose id is the smallest of its component, with the columns of ``df`` alone. Rows
    that share this id all stay; null ids stay."""
    found = with_components(df, id_col, text_col, p).where("not kept").select(F.col("id").alias("_lost")).distinct()
    return df.join(found, quoted(id_col).cast("long") == found["_lost"], "left_anti")
