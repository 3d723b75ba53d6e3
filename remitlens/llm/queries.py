"""Registered queries of the package: thin applications of its operators to
the tables of a data folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from remitlens.llm.decontaminate import contamination
from remitlens.llm.dedup import exact_dedup
from remitlens.llm.html_extract import main_texts
from remitlens.llm.jaccard import jaccard_components
from remitlens.llm.langid import predicted_languages
from remitlens.llm.lexical import ranked_documents
from remitlens.llm.lm import lm_scores
from remitlens.llm.mix import mix_sources
from remitlens.llm.negatives import hard_negatives, shifted_label
from remitlens.llm.neighbours import nearest_neighbours
from remitlens.llm.quality import quality_scores
from remitlens.llm.shard import assign_shards
from remitlens.llm.suffix_dedup import remove_repeats


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted_languages(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), [1.0] * corpus_pipeline.SHARDS)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"), relabel=shifted_label())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    applied = (
        op1_mix_sources,
        op2_ngram_jaccard,
        op3_language_id,
        op4_decontaminate,
        op5_html_extract,
        op6_quality,
        op7_lm_score,
        op8_suffix_dedup,
        op9_shard,
        op10_exact_dedup,
        op11_ranked_search,
        op12_nearest_neighbours,
        op13_hard_negatives,
    )
    return {f.__name__: f for f in applied} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return dict(SQL) | whole


SQL = {
    "op11_ranked_search": r"""
with d as materialized (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as words
  from documents),
q as materialized (
  select i, item_id, term, count(*) as reps
  from (select row_number() over () as i, item_id,
               unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark)
  group by i, item_id, term),
tf as materialized (
  select r, doc_id, n, term, count(*) as tf
  from (select r, doc_id, len(words) as n, unnest(words) as term from d)
  where term in (select term from q)
  group by r, doc_id, n, term),
corpus as materialized (select count(*) filter (where len(words) > 0) as n_docs, sum(len(words))::bigint as n_words from d),
w as (
  select t.term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(tf.r) + 1)))::bigint as w
  from (select distinct term from q) t left join tf using (term) cross join corpus
  group by t.term, n_docs),
scored as (
  select i, item_id, r, doc_id,
         sum(reps * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_words))))::bigint as score
  from q join w using (term) join tf using (term) cross join corpus
  group by i, item_id, r, doc_id)
select item_id, row_number() over (partition by i order by score desc, doc_id nulls last)::integer as rank, doc_id, score
from scored
where score > 0
qualify rank <= 20
""",
    "op13_hard_negatives": r"""
with v as materialized (
  select row_number() over () as r, vec_id,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from embeddings
  where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (
  select a.r as a, a.vec_id as anchor_id, a.label = b.label as same, b.r as r, b.vec_id,
         list_inner_product(a.e, b.e)::bigint as score
  from v a join v b on a.r <> b.r
  where a.vec_id % 100 = 0),
p as (
  select * from s where same
  qualify row_number() over (partition by a order by score desc, vec_id nulls last) <= 5)
select p.anchor_id, p.vec_id as positive_id,
       row_number() over (partition by p.a, p.r order by n.score desc, n.vec_id nulls last)::integer as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from p join s n on n.a = p.a and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score
qualify rank <= 5
""",
    "op10_exact_dedup": r"""
with d as (
  select doc_id, length(coalesce(text, '')) as len,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents)
select doc_id,
       first_value(doc_id) over w as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       row_number() over w = 1 as kept,
       text_sha256
from d
window w as (partition by text_sha256 order by len desc, doc_id nulls last)
""",
    "op1_mix_sources": r"""
with recursive d as (
  select doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 15))::bigint as h
  from documents),
s as (
  select source, sum(size)::bigint as z,
         1 + (row_number() over (order by source nulls last) - 1) % 3 as w
  from d group by source),
-- rounds of resharing: full sources leave, the rest shares what is left
round(n, lvl) as (
  select 0, sum(z)::double / sum(w) from s
  union all
  select n + 1, (select (sum(z) - 3 * coalesce(sum(z) filter (where 3 * z < lvl * w), 0))::double
                        / sum(w) filter (where 3 * z >= lvl * w) from s)
  from round where n < (select count(*) from s)),
t as (
  select source, z, least(3 * z::double, (select arg_max(lvl, n) from round) * w) as target from s),
b as (
  select source, h >> 30 as p, sum(size)::bigint as size from d group by 1, 2),
c as (
  select t.source, p, size, target - floor(target / greatest(z, 1)) * z as rest,
         sum(size) over (partition by t.source order by p) as upto
  from b join t on b.source is not distinct from t.source),
cut as (
  select source, min(p + case when upto - rest < rest - (upto - size) then 1 else 0 end) as p
  from (select *, row_number() over (partition by source order by p) as k from c where upto >= rest)
  where k = 1 group by source)
select d.doc_id, d.size, z as source_size, target,
       (d.size * least(3, floor(target / greatest(z, 1))::bigint + (d.h >> 30 < cut.p)::int))::bigint as taken,
       least(3, floor(target / greatest(z, 1))::bigint + (d.h >> 30 < cut.p)::int)::bigint as copies
from d join t on d.source is not distinct from t.source
       left join cut on cut.source is not distinct from d.source
""",
}
