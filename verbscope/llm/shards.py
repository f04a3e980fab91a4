"""Training-order materialisation: token ids as fixed-stride binary shards.

Every sequence gets a dense index, and a keyed Feistel permutation of 0 .. n-1 (cycle-walking
back into the range) turns the index into its global slot. Slot k is record k % per_shard of
shard k // per_shard, at byte (k % per_shard) * stride: a reader resumes at any slot by
arithmetic alone, and reads in training order sequentially. Sequences are range-partitioned by
shard, sorted by slot and streamed into files; a shard is written under a task's own name and
then moved into place, so a task that runs again leaves whole files only.

A sequence's index is its running number by document, piece and checksum, counted in buckets over narrow
rows; it depends on the data alone. Ids go to their shards in one range shuffle; the table they come from is
bucketed by task, and slots are dealt by the same buckets, so that ids stay where they are when slots are joined to them.
Slots and places are small tables of their own, so slots are counted once and the table of ids is deleted when the
shards are written. Shards are written in rounds over ranges of slots, and a round's shuffle files are deleted when it
ends: besides the table and the shards, disk holds the ids of one round.

On the way ids are renumbered, the most frequent ones first, and compressed record by record, both after the first rows
(``SAMPLE_ROWS``, ``SAMPLE_CHARS`` of each): a record of its own is too short to compress well. What is written doesn't
depend on it.

Records hold ids as little-endian unsigned 16-bit numbers if the vocabulary allows, else 32-bit,
padded to ``seq_len`` with ``pad_id``.

Defined results: null or empty text is one sequence that holds the end id alone; rows that share
an id are sequences of their own; extra columns are not read; an empty table gives no shard.
"""

from __future__ import annotations

import functools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbscope.llm.common import new_folder, numbered, quoted, shuffles_deleted, staged
from verbscope.llm.wordpieces import default_tokenizer, encode, special_tokens, tokenizer

ROUNDS = 4
SAMPLE_ROWS, SAMPLE_CHARS, DICTIONARY_BYTES, RENUMBERED = 1024, 8192, 112_640, 8192
#: Rounds in which shards are written, and shards that a round has at least.
SHARD_ROUNDS, ROUND_SHARDS = 4, 16


def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of indexes under the keyed permutation of 0 .. n-1."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 2**63, ROUNDS, dtype=np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & mask)
        return (left << np.uint64(half)) | right

    slots = once(index.astype(np.uint64))
    while True:  # a permutation of the larger range: walk on until back inside
        out = slots >= n
        if not out.any():
            return slots.astype(np.int64)
        slots[out] = once(slots[out])


def id_dictionary(df: DataFrame, text_col: str = "text", seq_len: int = 512, tokenizer_path: str | None = None) -> bytes:
    """What sequences are compressed with, from the first rows: how many ids are renumbered (4 bytes), these ids, the most
    frequent first, and a dictionary of renumbered ids. Empty if the rows are too few to train one."""
    import zstandard
    path = tokenizer_path or default_tokenizer()
    rows = df.select(F.substring(quoted(text_col), 1, SAMPLE_CHARS).alias("t")).where("t != ''").take(SAMPLE_ROWS)
    ids = [np.frombuffer(encode(r["t"], path), "<u4").astype(record_type(path)) for r in rows]
    if not ids:
        return b""
    found, times = np.unique(np.concatenate(ids), return_counts=True)
    common = found[np.argsort(-times, kind="stable")][:RENUMBERED].tobytes()
    head = (len(common) // ids[0].itemsize).to_bytes(4, "little") + common
    number = _coding(head, path)[0]
    try:
        return head + zstandard.train_dictionary(
            DICTIONARY_BYTES - len(head), [number[x[a : a + seq_len]].tobytes() for x in ids for a in range(0, len(x), seq_len)]).as_bytes()
    except zstandard.ZstdError:
        return b""


def _coding(dictionary: bytes, path: str):
    """(number of each id, id of each number, compression dictionary) of an ``id_dictionary``; empty: ids as they are."""
    import zstandard
    kind = record_type(path)
    ids = np.arange(1 << 16 if kind.itemsize == 2 else max(tokenizer(path).get_vocab(with_added_tokens=True).values()) + 1, dtype=kind)
    n = int.from_bytes(dictionary[:4], "little")
    common = np.frombuffer(dictionary, kind, n, 4) if n else ids[:0]
    back = np.concatenate([common, np.setdiff1d(ids, common)])
    number = np.empty_like(ids)
    number[back] = ids
    return number, back, zstandard.ZstdCompressionDict(dictionary[4 + common.nbytes :])


def token_sequences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seq_len: int = 512,
                    tokenizer_path: str | None = None, dictionary: bytes = b"") -> DataFrame:
    """One row per sequence: doc_id, piece, length, ids (compressed against ``dictionary``), crc (of the ids), part and pos
    (its place in its task). A document's ids, the end id last, are cut every ``seq_len``."""
    path = tokenizer_path or default_tokenizer()
    schema = "doc_id long, piece int, length int, ids binary, crc long, part int, pos long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext
        part, pos, kind = TaskContext.get().partitionId(), 0, record_type(path)
        number, _, trained = _coding(dictionary, path)
        compress = zstandard.ZstdCompressor(level=3, dict_data=trained, write_dict_id=False).compress
        end = next(iter(special_tokens(path).values())).to_bytes(4, "little")
        names = [x.strip().split(" ")[0] for x in schema.split(",")]
        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int64())

        def batch_of(rows: list) -> pa.RecordBatch:
            cols = zip(*rows, strict=True) if rows else [()] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        rows, held = [], 0
        for batch in batches:
            for doc, text in zip(*batch.columns, strict=True):
                ids = np.frombuffer(encode(text.as_py() or "", path) + end, "<u4").astype(kind)
                for k, a in enumerate(range(0, len(ids), seq_len)):
                    data = ids[a : a + seq_len]
                    rows.append((doc.as_py(), k, len(data), compress(number[data].tobytes()), zlib.crc32(data.tobytes()), part, pos))
                    pos, held = pos + 1, held + data.nbytes
                if held > 1 << 23:
                    yield batch_of(rows)
                    rows, held = [], 0
        yield batch_of(rows)

    return df.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text")).mapInArrow(cut, schema)


def record_type(path: str) -> np.dtype:
    return np.dtype("<u2" if tokenizer(path).get_vocab_size(with_added_tokens=True) <= 65536 else "<u4")


def tasks_of(sequences: DataFrame) -> int:
    return max(1, sequences.rdd.getNumPartitions())


def by_part(sequences: DataFrame, buckets: int | None = None, name: str | None = None, path: str | None = None) -> DataFrame:
    """The sequences as a table in the shared folder, bucketed by the task that wrote them (one file per
    task), so that what is known of a task's rows can be joined to them by task."""
    spark = sequences.sparkSession
    name = name or f"sequences_{uuid.uuid4().hex}"
    sequences.write.bucketBy(buckets or tasks_of(sequences), "part").option("path", path or new_folder(spark, "sequences")).saveAsTable(name)
    return spark.table(name)


def with_slots(sequences: DataFrame, key: int = 0, buckets: int | None = None) -> DataFrame:
    """Add ``slot`` to a table of ``by_part``, which has ``buckets`` buckets.

    The index that is permuted counts sequences by document, piece and checksum, in narrow rows, so slots depend
    on the data and the key alone, not on how the input was split. Slots go back to their rows as one
    list per task, by an equi-join on the bucketed task number.
    """
    return _with_lists(sequences, _slot_lists(sequences, key), buckets)


def _slot_lists(sequences: DataFrame, key: int) -> DataFrame:
    """of_part, slots: the slots of a task's rows in the order of their places."""
    n = sequences.count()

    @F.arrow_udf("long")
    def slot(index: pa.Array) -> pa.Array:
        return pa.array(feistel(index.to_numpy(zero_copy_only=False), n, key), pa.int64())

    narrow = sequences.select("doc_id", "piece", "crc", "part", "pos")
    indexed = numbered(narrow, [], ["doc_id", "piece", "crc"], "index").select(F.col("part").alias("of_part"), "pos", slot("index").alias("slot"))
    return indexed.groupBy("of_part").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "slot"))), lambda x: x["slot"]).alias("slots"))


def _with_lists(sequences: DataFrame, lists: DataFrame, buckets: int | None) -> DataFrame:
    if buckets:  # the table's own: with any other number of partitions its ids would be dealt anew
        lists = lists.repartition(buckets, "of_part")
    joined = sequences.join(lists.hint("shuffle_hash"), F.col("part") == F.col("of_part"))
    return joined.withColumn("slot", F.get("slots", F.col("pos").cast("int"))).drop("of_part", "slots")


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder with its scheme: without one it is a place in Spark's default file system, not an
    executor's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _files(uri: str):
    """(file system, path) that executors write to."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_shards(placed: DataFrame, folder: str, seq_len: int = 512, per_shard: int = 8192,
                 tokenizer_path: str | None = None, dictionary: bytes = b"") -> DataFrame:
    """Write the shards under ``folder``; the manifest: shard, file, records, crc32. ``dictionary`` is that of the ids."""
    path = tokenizer_path or default_tokenizer()
    rows = (placed.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("long")).select("shard", "slot", "ids")
            .repartitionByRange("shard").sortWithinPartitions("shard", "slot"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        files, root = _files(folder)
        files.create_dir(root, recursive=True)
        kind, (_, back, trained) = record_type(path), _coding(dictionary, path)
        expand = zstandard.ZstdDecompressor(dict_data=trained).decompress
        stride = seq_len * kind.itemsize
        pad = np.full(seq_len, next(iter(special_tokens(path).values())), kind).tobytes()
        shard, out, temp, n, crc, done = None, None, "", 0, 0, []

        def close() -> None:
            out.close()
            name = f"shard-{shard:08d}.bin"
            files.move(temp, f"{root}/{name}")
            done.append((shard, name, n, crc))

        for batch in batches:
            for s, _, data in zip(*batch.columns, strict=True):
                if s.as_py() != shard:
                    if out is not None:
                        close()
                    shard, n, crc, temp = s.as_py(), 0, 0, f"{root}/.{uuid.uuid4().hex}"
                    out = files.open_output_stream(temp)
                ids = back[np.frombuffer(expand(data.as_py()), kind)].tobytes()
                record = ids + pad[len(ids) :]
                out.write(record)
                n, crc = n + 1, zlib.crc32(record, crc)
                assert len(record) == stride
        if out is not None:
            close()
        cols = list(zip(*done, strict=True)) if done else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64()),
                                                                         strict=True)], names=["shard", "file", "records", "crc32"])

    return rows.mapInArrow(write, "shard long, file string, records long, crc32 long")


def read_shards(spark: SparkSession, folder: str, seq_len: int = 512, per_shard: int = 8192,
                tokenizer_path: str | None = None) -> DataFrame:
    """(slot, shard, ids) of every record, ids as little-endian unsigned 32-bit, padding included."""
    path = tokenizer_path or default_tokenizer()
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(folder)
             .select(F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("long").alias("shard"), "content"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = record_type(path)
        for batch in batches:
            for s, content in zip(*batch.columns, strict=True):
                records = np.frombuffer(content.as_buffer(), kind).reshape(-1, seq_len).astype("<u4")
                shard = s.as_py()
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard * per_shard + np.arange(len(records)), pa.int64()), pa.array([shard] * len(records), pa.int64()),
                    pa.array([r.tobytes() for r in records], pa.binary())], names=["slot", "shard", "ids"])

    return files.mapInArrow(split, "slot long, shard long, ids binary")


def materialise(df: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                seq_len: int = 512, per_shard: int = 8192, key: int = 0,
                tokenizer_path: str | None = None) -> tuple[str, DataFrame, DataFrame]:
    """Tokenise, permute and write. (folder, placement: doc_id, piece, length, slot; manifest)."""
    folder = qualified(df.sparkSession, folder or new_folder(df.sparkSession, "shards"))
    spark = df.sparkSession
    with shuffles_deleted(spark):
        dictionary = id_dictionary(df, text_col, seq_len, tokenizer_path)
        sequences = token_sequences(df, id_col, text_col, seq_len, tokenizer_path, dictionary)
        buckets, name, path = tasks_of(sequences), f"sequences_{uuid.uuid4().hex}", new_folder(spark, "sequences")
        table = by_part(sequences, buckets, name, path)
        lists = staged(_slot_lists(table, key), "slots")
        places = staged(table.select("doc_id", "piece", "length", "part", "pos"), "places")
        placed, written, n = _with_lists(table, lists, buckets), [], -(-places.count() // per_shard)
        rounds = max(1, min(SHARD_ROUNDS, n // ROUND_SHARDS))
        for k in range(rounds):
            some = placed.where((F.col("slot") >= n * k // rounds * per_shard) & (F.col("slot") < n * (k + 1) // rounds * per_shard))
            written.append(staged(write_shards(some, folder, seq_len, per_shard, tokenizer_path, dictionary), "manifest"))
        manifest = functools.reduce(DataFrame.union, written)
    # ids lie in the shards now
    spark.sql(f"DROP TABLE {name}")
    spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    return folder, _with_lists(places, lists, None).select("doc_id", "piece", "length", "slot"), manifest
