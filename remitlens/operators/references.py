"""References of children to parents: one shuffle for any number of relations.

Keys of parents and children are stacked, tagged with the parent they belong to
and the relation they come from, and grouped once by parent and key. A group
without a parent row holds the unmatched rows of each relation. Children of one
parent share the parent's shuffle, no side is joined, and the map-side combine
makes a hot key one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Relation:
    """Rows of ``child`` refer to ``parent`` by a key. ``parent_name`` tells
    parents apart: relations of one name must give the same parent and key."""

    child: DataFrame
    column: str
    parent: DataFrame
    parent_column: str
    parent_name: str
    #: whether a NULL key counts as unmatched (a left join that finds nothing)
    null_is_unmatched: bool = False


def _grouped(relations: Sequence[Relation]) -> DataFrame:
    """(parent, key, known, n_0, n_1, ...): child rows of each relation by key."""
    parents: dict[str, int] = {}
    stacked = None
    for i, r in enumerate(relations):
        rows = [(r.child, r.column, i, r.null_is_unmatched)]
        if r.parent_name not in parents:
            parents[r.parent_name] = len(parents)
            rows.append((r.parent, r.parent_column, -1, False))
        for df, column, relation, with_nulls in rows:
            own = df.select(
                F.lit(parents[r.parent_name]).alias("parent"), F.col(column).cast("string").alias("key"), F.lit(relation).alias("relation")
            )
            own = own if with_nulls else own.where(F.col("key").isNotNull())
            stacked = own if stacked is None else stacked.unionByName(own)
    counts = [F.count_if(F.col("relation") == i).alias(f"n_{i}") for i in range(len(relations))]
    return stacked.groupBy("parent", "key").agg(F.max(F.col("relation") == -1).alias("known"), *counts)


def unmatched_counts(relations: Sequence[Relation]) -> DataFrame:
    """One row: ``n_i``, the unmatched child rows of relation i."""
    missing = _grouped(relations).where(~F.col("known"))
    return missing.agg(*[F.coalesce(F.sum(f"n_{i}"), F.lit(0)).cast("bigint").alias(f"n_{i}") for i in range(len(relations))])


def unmatched_keys(relation: Relation) -> DataFrame:
    """(key, n): unmatched keys of one relation, with their child rows."""
    missing = _grouped([relation]).where(~F.col("known") & (F.col("n_0") > 0))
    return missing.select("key", F.col("n_0").alias("n"))


def unmatched_by_relation(relations: Sequence[Relation]) -> list[DataFrame | None]:
    """For each relation (key, n): its unmatched keys with their child rows, or
    None where there are none.

    Runs one job: all relations are grouped by one shuffle, and the keys that
    are missing in a parent are kept in the session's checkpoint folder.
    """
    if not relations:
        return []
    names = list(dict.fromkeys(r.parent_name for r in relations))
    missing = _grouped(relations).where(~F.col("known"))
    missing = missing.where(F.greatest(F.lit(0), *[F.col(f"n_{i}") for i in range(len(relations))]) > 0).drop("known")
    ensure_checkpoint_dir(missing.sparkSession)
    missing = missing.checkpoint()
    hit = missing.agg(*[F.max(F.col(f"n_{i}") > 0).alias(f"n_{i}") for i in range(len(relations))]).first()
    return [
        missing.where((F.col("parent") == names.index(r.parent_name)) & (F.col(f"n_{i}") > 0)).select("key", F.col(f"n_{i}").alias("n"))
        if hit[f"n_{i}"]
        else None
        for i, r in enumerate(relations)
    ]
