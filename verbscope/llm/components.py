"""Connected components by alternating large-star and small-star steps on a staged edge table.

Every step is a join and a partial aggregate on the edges, so neither a hub with very many
edges nor a large component meets in one task. Edges and labels never reach the driver; only
a count and a checksum per round do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbscope.llm.common import staged


def _min_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _min_neighbour(both).select("u", F.least("m", "u").alias("m"))
    return both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Edges go from larger to smaller (u > v): link a node and its smaller neighbours to the
    smallest of them."""
    least = _min_neighbour(edges)
    others = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node that isn't the smallest of its component. ``edges``: u, v of one
    orderable type, without nulls; direction, repeats and self-loops don't matter."""
    now = staged(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                 "edges")
    seen = None
    while True:
        # a forest of stars: no node has two parents, no parent has one itself
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum")).first()
        if state["n"] == 0 or state == seen:
            return now.select("u", F.col("v").alias("root"))
        seen = state
        now = staged(small_star(large_star(now)), "stars")
