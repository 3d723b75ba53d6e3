"""Mixing sources to target weights by hash thresholds, without sorting rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.scratch import cut

#: A word of a text.
WORD = r"[^\x20\x09-\x0D]+"
#: Levels of the histogram and the hash bits that each resolves.
LEVELS, BITS = 3, 10
#: Rows (of one source each) that are broadcast to documents with their texts.
FEW_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ticket(id_col: Column) -> Column:
    """60 hash bits of a record's key."""
    key = F.coalesce(id_col.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Target of every source: (source, source_size) to (.., target double).

    The words of all sources are shared by weight; a source stops at ``most``
    times its size and its excess goes to the others by weight until none is
    above. That is one water level: in the order of size per weight, sources
    below the level are full, the first that isn't full sets it. Windows run
    over one row per source.
    """
    spread = F.array(*[F.lit(int(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_need = Window.orderBy(F.col("source_size") / F.col("w"), F.col("place"))
    full = by_need.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("w", F.element_at(spread, (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("size_before", F.coalesce(F.sum("source_size").over(full), F.lit(0)))
        .withColumn("w_before", F.coalesce(F.sum("w").over(full), F.lit(0)))
        .withColumn("size_all", F.sum("source_size").over(all_rows))
        .withColumn("w_all", F.sum("w").over(all_rows))
        .withColumn(
            "level",
            (F.col("size_all") - most * F.col("size_before")).cast("double") / (F.col("w_all") - F.col("w_before")),
        )
        .withColumn("open", most * F.col("source_size") >= F.col("level") * F.col("w"))
        .withColumn("level", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(all_rows))
    )
    target = F.least(most * F.col("source_size").cast("double"), F.col("level") * F.col("w"))
    return ranked.select("source", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, targets: DataFrame, levels: int = LEVELS, bits: int = BITS) -> DataFrame:
    """Per source: ``whole`` copies of all rows, plus one of rows below ``cut``.

    ``rows`` has (source, size, ticket). A level sums sizes by source and the
    next ``bits`` of the ticket, within the boundary bucket that the level
    before has found; its running sums show in which bucket the budget runs
    out. The last boundary bucket is taken if that comes nearer the target.
    Budgets nest: a larger one has a higher threshold over the same tickets.
    A level's windows hold 2**bits rows of a source, whatever its size.
    """
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    state = cut(
        targets.select(
            "source",
            "source_size",
            "target",
            whole.alias("whole"),
            (F.col("target") - whole * F.col("source_size")).alias("rest"),
            F.lit(0).cast("long").alias("prefix"),
            F.lit(0).cast("long").alias("taken"),
            F.lit(0).cast("long").alias("bucket_size"),
        )
    )
    running = Window.partitionBy("s").orderBy("b")
    for level in range(1, levels + 1):
        own = F.shiftright(F.col("ticket"), 60 - bits * level)
        limits = state.select(F.col("source").alias("s"), F.col("prefix"), F.col("taken"), F.col("rest"))
        sums = (
            rows.select("source", "size", own.alias("b"))
            .groupBy("source", "b")
            .agg(F.sum("size").alias("size"))
            if level == 1
            else rows.join(limits, F.col("source").eqNullSafe(F.col("s")))
            .where(F.shiftright(own, bits) == F.col("prefix"))
            .groupBy("source", own.alias("b"))
            .agg(F.sum("size").alias("size"))
        )
        found = (
            sums.withColumnRenamed("source", "r")
            .join(limits, F.col("r").eqNullSafe(F.col("s")))
            .withColumn("upto", F.col("taken") + F.sum("size").over(running))
            .where(F.col("upto") >= F.col("rest"))
            .groupBy("s")
            .agg(F.min(F.struct("b", "upto", "size")).alias("m"))
            .select("s", F.col("m.b").alias("b"), (F.col("m.upto") - F.col("m.size")).alias("t"), F.col("m.size").alias("z"))
        )
        state = cut(
            state.join(found, F.col("source").eqNullSafe(F.col("s")), "left").select(
                "source",
                "source_size",
                "target",
                "whole",
                "rest",
                F.coalesce("b", F.lit(0)).alias("prefix"),
                F.coalesce("t", F.lit(0)).alias("taken"),
                F.coalesce("z", F.lit(0)).alias("bucket_size"),
            )
        )
    over = F.col("taken") + F.col("bucket_size") - F.col("rest") < F.col("rest") - F.col("taken")
    return state.select(
        "source",
        "source_size",
        "target",
        "whole",
        F.shiftleft(F.col("prefix") + over.cast("long"), 60 - bits * levels).alias("cut"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies.

    Sources in code-point order (null last) weigh ``weights``, repeating.
    ``taken`` is the document's size times the copies that the mix holds,
    ``most`` at most. The id alone orders a source's documents, so rows of one
    id are taken or left together and reruns agree. Null or wordless text has
    size 0 and takes nothing (its copies still follow the threshold). Other
    columns are ignored. An empty table gives no rows.
    """
    rows = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col).cast("string")).alias("size"),
            ticket(F.col(id_col)).alias("ticket"),
        )
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    limits = thresholds(rows, source_targets(sizes, weights, most)).withColumnRenamed("source", "s")
    copies = (F.col("whole") + (F.col("ticket") < F.col("cut")).cast("long")).cast("long")
    return (
        rows.join(limits, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("copies", F.least(copies, F.lit(most).cast("long")))
        .select(
            "doc_id",
            "size",
            F.col("source_size").cast("long").alias("source_size"),
            "target",
            (F.col("size") * F.col("copies")).alias("taken"),
            "copies",
        )
    )


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them."""
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    rows = docs.select(packed, F.col("source").cast("string").alias("own"), ticket(F.col("doc_id")).alias("ticket"))
    sized = cut(rows.select(F.col("own").alias("source"), word_count(F.col("document.text").cast("string")).alias("size"), "ticket"))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    limits = cut(thresholds(sized, source_targets(sizes, weights, most)).select("source", "whole", "cut"))
    if limits.count() <= FEW_SOURCES:  # else the join shuffles, and splits large sources
        limits = F.broadcast(limits)
    copies = F.least(F.col("whole") + (F.col("ticket") < F.col("cut")).cast("long"), F.lit(most).cast("long"))
    return (
        rows.join(limits, F.col("own").eqNullSafe(F.col("source")))
        .withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
        .select("document.*")
    )
