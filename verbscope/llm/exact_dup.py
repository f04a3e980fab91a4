"""Exact deduplication by distributed radix partitioning, most significant bytes first.

Texts are split by successive bytes: first by length and their first 32 bytes, then by the
next 224, 1792, ... bytes (a digit eight times as wide at each level). A group of one is done;
a group whose texts have ended is a group of equal texts. No digest decides anything.

Only texts that still share a group go on to the next level. There, a group whose smallest and
largest digit agree stays as it is, which a partial aggregate tells without moving the texts;
only groups with differing digits are split. Groups of any size are counted by partial
aggregates, never gathered.

Texts are equal when identical after lower-casing A-Z only.

Defined results: null text counts as empty, and all empty texts are equal; of equal texts the
row with the largest id stays, of several such rows one of them; null ids are smallest
(keep_id is null only if the whole group's ids are null); existing columns with the output
names are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbscope.llm.common import quoted, staged, without

FIRST_BYTES, WIDER = 32, 8
LEVELS = 10  # 32 * 8**9 bytes exceed the largest string there can be


def digit_ranges() -> list[tuple[int, int]]:
    """(start, length) in bytes of each level's digit."""
    ends = [0, *[FIRST_BYTES * WIDER**k for k in range(LEVELS)]]
    return [(a, min(b, 2**31 - 1) - a) for a, b in zip(ends, ends[1:], strict=False) if a < 2**31 - 1]


def normalised(text: Column) -> Column:
    """A-Z lower-cased, null as empty."""

    @F.arrow_udf("string")
    def fold(texts: pa.Array) -> pa.Array:
        import pyarrow.compute as pc
        return pc.ascii_lower(pc.fill_null(texts, ""))

    return fold(text)


def _split(table: DataFrame, level: int, mixed: DataFrame) -> DataFrame:
    """New groups of the rows of groups with differing digits, singletons dropped."""
    digit = f"_d{level}"
    rows = table.select("_rid", "_g", F.col(digit).alias("d"), "_n")
    part = rows.join(mixed, "_g", "left_semi")
    counts = part.groupBy("_g", "d").agg(F.min("_rid").alias("g2"), F.count("*").alias("c"))
    p, c = part.alias("p"), counts.alias("c")
    return (p.join(c, (F.col("p._g") == F.col("c._g")) & F.col("p.d").eqNullSafe(F.col("c.d")))
            .select("p._rid", "g2", "c.c"))


def with_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep_text: bool = True) -> DataFrame:
    """All rows of ``df`` plus keep_id, group_size and kept. ``keep_text=False`` leaves the text
    column out of the result and so out of the tables in between."""
    cols = [c for c in df.columns if c.lower() not in ("keep_id", "group_size", "kept")
            and (keep_text or c != text_col)]
    ranges = digit_ranges()
    bytes_ = F.col("_t").cast("binary")
    table = (without(df, "keep_id", "group_size", "kept", "_t", "_n", "_rid", "_g", "_id")
             .withColumn("_t", normalised(quoted(text_col))))
    table = staged(table.select(
        *[quoted(c) for c in cols], F.monotonically_increasing_id().alias("_rid"), quoted(id_col).alias("_id"),
        F.octet_length("_t").alias("_n"),
        *[F.when(F.octet_length("_t") > a, F.substring(bytes_, a + 1, n)).alias(f"_d{k}")
          for k, (a, n) in enumerate(ranges)]), "digits")

    # level 0: length and first bytes; narrow rows only
    first = table.select("_rid", "_n", "_d0")
    counts = first.groupBy("_n", "_d0").agg(F.min("_rid").alias("_g"), F.count("*").alias("c")).where("c > 1")
    f, c = first.alias("f"), counts.alias("c")
    shared = f.join(c, (F.col("f._n") == F.col("c._n")) & F.col("f._d0").eqNullSafe(F.col("c._d0"))).select("f._rid", "_g")
    digits = [f"_d{k}" for k in range(1, len(ranges))]
    left = staged(table.select("_rid", "_id", "_n", *digits).join(shared, "_rid"), "shared")

    for level in range(1, len(ranges)):
        start = ranges[level][0]
        going = left.where(F.col("_n") > start)
        d = F.col(f"_d{level}")
        mixed = going.groupBy("_g").agg(F.min(d).alias("a"), F.max(d).alias("b"), F.count("*").alias("rows"))
        mixed = staged(mixed.select("_g", (F.col("a") != F.col("b")).alias("differ")), f"level{level}")
        if mixed.isEmpty():
            break  # every text has ended
        if mixed.where("differ").isEmpty():
            continue
        new = _split(going, level, mixed.where("differ").select("_g")).withColumnRenamed("_rid", "r2")
        rest = [f"_d{k}" for k in range(level + 1, len(ranges))]
        kept = [f"_d{k}" for k in range(1, level + 1)]
        left = staged(left.join(new, left["_rid"] == new["r2"], "left").where("c is null or c > 1").select(
            "_rid", "_id", "_n", F.coalesce("g2", "_g").alias("_g"), *[F.lit(None).cast("binary").alias(k) for k in kept],
            *rest), f"split{level}")

    groups = left.groupBy("_g").agg(F.count("*").alias("size"), F.max("_id").alias("keep"),
                                    F.max(F.struct("_id", (-F.col("_rid")).alias("r"))).alias("best"))
    m, g = left.select("_rid", "_g").alias("m"), groups.alias("g")
    found = m.join(g, F.col("m._g") == F.col("g._g")).select(
        F.col("m._rid").alias("r2"), "size", "keep", (F.col("m._rid") == -F.col("best.r")).alias("stays"))
    rows = table.select(*[quoted(c) for c in cols], "_rid", "_id")
    both = rows.join(found, rows["_rid"] == found["r2"], "left")
    return both.select(
        *[quoted(c) for c in cols], F.when(F.col("r2").isNull(), F.col("_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), F.coalesce("stays", F.lit(True)).alias("kept"))


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``df`` alone."""
    packed = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("_row"), quoted(id_col).alias("_key"),
                       quoted(text_col).alias("_text"))
    return with_duplicates(packed, "_key", "_text", keep_text=False).where("kept").select("_row.*")
