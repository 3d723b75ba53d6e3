"""Exact duplicates by a tree merge of sorted digest runs (DataFrame only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.scratch import cut

#: What normalisation deletes.
SPACES = r"[\x20\x09-\x0D]"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One small row per document: id, row number, length, digest, check.

    ``check`` (normalised length and a second, unrelated hash) verifies that
    texts of one digest are the same text wherever runs meet.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = F.regexp_replace(text, SPACES, "")
    return docs.select(F.col(id_col).alias("id"), text.alias("t"), plain.alias("n")).select(
        "id",
        F.monotonically_increasing_id().alias("row"),
        F.char_length("t").cast("long").alias("length"),
        F.sha2("n", 256).alias("digest"),
        F.struct(F.octet_length("n").alias("bytes"), F.xxhash64("n").alias("hash")).alias("check"),
        F.spark_partition_id().alias("run"),
    )


def _best(winner, count) -> list:
    return [F.min(winner).alias("winner"), F.sum(count).alias("size")]


def merge_runs(rows: DataFrame, fan_in: int = 16, runs: int | None = None) -> DataFrame:
    """Winner and size of every digest.

    Each partition of ``rows`` is a run. A round exchanges runs so that
    ``fan_in`` neighbouring ones meet, and merges them digest by digest: the
    smallest (winner) record and the sum of sizes stay. A group of any size
    puts one record per run into a round, at most ``fan_in`` of which meet in
    one group of the next, so copies never gather in one task. The last round
    leaves one run, spread over tasks by digest.
    """
    runs = rows.rdd.getNumPartitions() if runs is None else runs
    winner = F.struct(
        (-F.col("length")).alias("shortness"), F.col("id").isNull().alias("no_id"), "id", "row"
    )
    merged = rows.groupBy("run", "digest", "check").agg(*_best(winner, F.lit(1)))
    while runs > 1:
        runs = -(-runs // fan_in)
        merged = (
            merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .groupBy("run", "digest", "check")
            .agg(*_best(F.col("winner"), F.col("size")))
        )
    return merged.drop("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 16) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without ``[\\x20\\x09-\\x0D]``. The row
    with the longest original text (code points), then the smallest id, stays;
    a null id comes after all ids; of rows that agree in all of these, one
    stays. Null text counts as empty; empty texts are one group. Columns other
    than the two named are ignored. An empty table gives no rows.
    """
    rows = cut(digests(docs, id_col, text_col))
    # cut: the join reads both sides through plain shuffles, which the engine
    # splits where one digest holds a large share of the rows
    groups = cut(merge_runs(rows, fan_in)).select(
        F.col("digest").alias("d"),
        F.col("check").alias("c"),
        F.col("winner.id").alias("keep_id"),
        F.col("winner.row").alias("keep_row"),
        F.col("size").alias("group_size"),
    )
    return rows.join(groups, (F.col("digest") == F.col("d")) & (F.col("check") == F.col("c"))).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
