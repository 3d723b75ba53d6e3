"""The pipeline over sf0.001: what each stage must do to its documents."""

from __future__ import annotations

import collections

import corpus_pipeline
from remitlens.llm import decontaminate, jaccard
from remitlens.llm.queries import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = [r[0] for r in docs.select("doc_id").collect()]
        if name == "near_duplicates":
            groups = collections.defaultdict(list)
            for r in jaccard.jaccard_components(before).collect():
                groups[r["component_id"] if r["n_shingles"] else ("empty", r["doc_id"])].append(r["doc_id"])
            texts = {r[0]: r[1] for r in before.select("doc_id", "text").collect()}
            assert sorted(kept[name]) == sorted(min(g) for g in groups.values()) and texts
        if name == "decontamination":
            benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            dirty = {r["doc_id"] for r in decontaminate.contamination(before, benchmark).where("contaminated").collect()}
            assert sorted(kept[name]) == sorted(set(kept["near_duplicates"]) - dirty)
        if name != "sharding":
            assert docs.columns == columns
    assert len(kept["sharding"]) == len(kept["source_mix"])
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in whole) == sorted(kept["sharding"])


def test_registered():
    names = queries()
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(oracle_sql()) <= set(names)
