"""Weighted rendezvous hashing of records into shards (DataFrame only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.scratch import cut

#: Sub-ranges in which slots are numbered; a shard's rows are split over them.
RANGES = 1024


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest score for ``key``.

    Each (key, shard) pair draws u in (0, 1) from a hash; the score
    ``-weight / ln(u)`` depends on no other shard, so adding a shard only
    moves the keys that the new shard wins.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")

    def score(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
        return -F.lit(float(weight)) / F.log((bits + 0.5) / F.lit(float(1 << 53)))

    # the shard number breaks ties of scores
    pairs = [F.struct(score(i, w).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    return (F.greatest(*pairs) if len(pairs) > 1 else pairs[0])["shard"]


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float],
    grown: Sequence[float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The id and the weights alone decide the shard (law ``key``). ``slot``
    counts from 0 without gaps within a shard. ``grown_shard`` is the shard
    under the weights ``grown`` (default: one more shard of the last weight).
    Size: UTF-8 bytes plus 16; a null text has none. A null id is a key of its
    own; rows of one id share a shard and get different slots. Columns other
    than the two named are ignored. An empty table gives no rows.

    A slot is the count of rows in lower hash ranges of the shard plus the
    place within the range, so no task ever orders a whole shard. Rows of one
    id may be many (repeats of a mix): the range also depends on the text and
    on a spread of equal rows.
    """
    grown = [*weights, weights[-1]] if grown is None else grown
    key = F.col("id").cast("string")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select(
        F.col("id").alias("doc_id"),
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, grown).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = cut(rows.withColumn("range", F.pmod(F.xxhash64("doc_id", "row"), F.lit(RANGES)).cast("int")))
    counts = rows.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    # at most len(weights) * RANGES rows, RANGES to a window
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    place = F.row_number().over(Window.partitionBy("shard", "range").orderBy("doc_id", "row"))
    return (
        rows.withColumn("place", place)
        .join(bases, ["shard", "range"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("base") + F.col("place") - 1).cast("long").alias("slot"),
            F.col("grown_shard").cast("int").alias("grown_shard"),
        )
    )
