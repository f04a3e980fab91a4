"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Each source gets a target size; every document of the source is expected target / source
size times. The documents of a source stand in a fixed order; their expected copies are summed
up, one offset per source is added, and a document is taken once for every integer that its
interval of the running sum crosses. The order is by size, so that the words taken differ
from the target by about one document at most.

The running sum needs no task that holds a source: documents are counted per (source, size,
bucket of the id's hash); two windows over these counts give each bucket its offset, and ranks
are made inside buckets.

Targets: ``share`` of all sizes goes to the sources by weight. The weights repeat over the
sources in code-point order, null last. A target stops at ``cap`` times its source's size; the
excess goes to the other sources by weight until none is above its cap.

Defined results: a null size counts as 0; a document of size 0 may be taken like any other
(it adds no words); null ids are ordered first; rows equal in source, size and id are
interchangeable; a source of total size 0 has target 0 and takes nothing; existing columns
with the output names are replaced; an empty table gives an empty table. Reruns agree: order
and offsets depend on the data and the seed only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbscope.llm.common import WORD, quoted, same, without

OUT = ("source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _unit(c: Column) -> Column:
    """[0, 1) from the first 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: int) -> DataFrame:
    """From (source, source_size): source, source_size, target. One row per source; sources
    above their cap are a prefix of the order by cap / weight, found by running sums. All sums
    are of whole numbers, so the targets don't depend on the order of summing."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight.cast("long")).withColumn("limit", F.col("source_size") * cap)
    whole = Window.partitionBy()
    total, all_weights = F.sum("source_size").over(whole), F.sum("weight").over(whole)
    before = (Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    zero = F.lit(0).cast("long")
    s = (s.withColumn("total", total).withColumn("weights", all_weights)
         .withColumn("gone", F.coalesce(F.sum("limit").over(before), zero))
         .withColumn("used", F.coalesce(F.sum("weight").over(before), zero)))
    s = s.withColumn("capped", F.col("limit") * (F.col("weights") - F.col("used"))
                     <= (F.lit(share) * F.col("total") - F.col("gone")) * F.col("weight"))
    gone = F.coalesce(F.sum(F.when(F.col("capped"), F.col("limit"))).over(whole), zero)
    used = F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))).over(whole), zero)
    s = s.withColumn("all_gone", gone).withColumn("all_used", used)
    open_target = ((F.lit(share) * F.col("total") - F.col("all_gone")) * F.col("weight")
                   / F.nullif(F.col("weights") - F.col("all_used"), zero))
    return s.select("source", "source_size", F.when(F.col("capped"), F.col("limit").cast("double"))
                    .otherwise(open_target).alias("target"))


def plan_copies(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
                weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: int = 2, seed: int = 0) -> DataFrame:
    """All rows and columns of ``df`` plus source_size, target, copies and taken.

    ``df`` is read twice: for the counts and for the rows. Rows are shuffled once, to their
    (source, size, bucket).
    """
    key = F.md5(F.coalesce(quoted(id_col).cast("string"), F.lit("")))
    rows = without(df, *OUT, "_source", "_size", "_key", "_bucket").withColumns({
        "_source": quoted(source_col), "_size": F.coalesce(quoted(size_col).cast("long"), F.lit(0).cast("long")), "_key": key})
    rows = rows.withColumn("_bucket", F.substring("_key", 1, 3))
    groups = ["_source", "_size", "_bucket"]
    counts = rows.groupBy(*groups).agg(F.count("*").alias("n"))
    sizes = counts.groupBy(F.col("_source").alias("source")).agg(F.sum(F.col("n") * F.col("_size")).alias("source_size"))
    targets = source_targets(sizes, weights, share, cap)

    by_bucket = Window.partitionBy("_source", "_size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    by_size = Window.partitionBy("_source").orderBy("_size").rowsBetween(Window.unboundedPreceding, 0)
    inside = counts.withColumn("in_size", F.sum("n").over(by_bucket) - F.col("n"))
    per_size = (counts.groupBy("_source", "_size").agg(F.sum("n").alias("m"))
                .withColumn("in_source", F.sum("m").over(by_size) - F.col("m")).drop("m"))
    offsets = inside.join(per_size, same(inside, per_size, "_source", "_size")).select(
        inside["_source"].alias("o_source"), inside["_size"].alias("o_size"), inside["_bucket"].alias("o_bucket"),
        (F.col("in_size") + F.col("in_source")).alias("before"))
    offsets = (offsets.join(targets, F.col("o_source").eqNullSafe(F.col("source")))
               .select("o_source", "o_size", "o_bucket", "before", "source_size", "target"))

    ranked = rows.withColumn("_rank", F.row_number().over(
        Window.partitionBy(*groups).orderBy("_key", quoted(id_col))))
    both = ranked.join(offsets, ranked["_source"].eqNullSafe(offsets["o_source"]) & (ranked["_size"] == offsets["o_size"])
                       & (ranked["_bucket"] == offsets["o_bucket"]), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _unit(F.concat(F.lit(f"{seed}:"), F.coalesce(quoted(source_col).cast("string"), F.lit("null"))))
    rank = F.col("before") + F.col("_rank")
    copies = F.floor(rank * rate + offset) - F.floor((rank - 1) * rate + offset)
    both = both.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("copies") * F.col("_size"))
    return both.select(*[quoted(c) for c in rows.columns if c not in ("_source", "_size", "_key", "_bucket")],
                       *OUT)


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        **options) -> DataFrame:
    """The mix itself: the rows of ``df``, each repeated as often as it is taken (not at all for
    0), with the columns of ``df`` alone."""
    packed = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("_row"), quoted(id_col).alias("_id"),
                       quoted(source_col).alias("_from"), word_count(quoted(text_col)).alias("_words"))
    planned = plan_copies(packed, "_id", "_from", "_words", **options).where(F.col("copies") > 0)
    taken = planned.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select("_row.*")
