"""Corpus pipeline: documents to shards, through five of the operators.

Each stage is a function of (spark, docs, sf_dir); its rows are written as
Parquet and read again as the next one's documents, so a lost executor costs a
re-read. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm.decontaminate import without_passages
from remitlens.llm.jaccard import jaccard_components
from remitlens.llm.langid import spoken_documents
from remitlens.llm.mix import mixed_documents
from remitlens.llm.scratch import cut, key_filter
from remitlens.llm.shard import assign_shards
from remitlens.session import ensure_checkpoint_dir

SHARDS = 40


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; letterless ones and those
    below the calibrated threshold go."""
    return spoken_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the
    smallest id (rows without id come last, then by a hash of the text). Of
    rows that agree in id and text one stays."""
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), key.alias("key"))
    groups = cut(jaccard_components(keyed.select(F.col("key").alias("doc_id"), F.col("document.text").alias("text"))))
    dropped = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("k")).distinct()
    repeated = groups.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("k"))
    may = key_filter(dropped.unionByName(repeated), "k")
    # only documents that may be dropped are shuffled
    checked = keyed.where(may("key")).join(dropped, F.col("key") == F.col("k"), "left_anti").dropDuplicates(["key"])
    return keyed.where(~may("key")).unionByName(checked).select("document.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return assign_shards(docs, [1.0] * SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", sharding),
]

#: SQL can express neither the classifier nor the similarity groups.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over all documents of ``sf_dir``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4()}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
