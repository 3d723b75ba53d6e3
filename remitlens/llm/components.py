"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.scratch import cut, release


def _settled(edges: DataFrame) -> bool:
    """Whether each node hangs on one root, and no root hangs on another."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("to")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("to"))
    )
    seen = ends.groupBy("node").agg(F.min("to").alias("a"), F.max("to").alias("b"), F.max(F.col("to").isNull()).alias("root"))
    return seen.where("a <> b or (root and a is not null)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v); label: smallest node.

    Each round hangs all neighbours of a node on the smallest one, first the
    larger neighbours, then the smaller; paths shrink by a constant factor, so
    the rounds grow with the logarithm of the longest path. A node's neighbours
    are never gathered: minima combine before their shuffle and are joined
    back, and the join of a node with very many is split like any other. The
    disk of a round is given back before the next one.
    """
    edges = cut(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while not _settled(edges):
        release(edges.sparkSession)  # a round's shuffles are of no use to the next
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = (
            both.join(least, F.col("u") == F.col("c"))
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        hung = large.join(least, F.col("u") == F.col("c")).select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        edges = cut(hung.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return cut(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots))
