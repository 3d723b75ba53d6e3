"""Full-refresh build: stored fact, marts from the stored fact, stored checks."""

from __future__ import annotations

from remitlens.plans.build import run_build
from remitlens.plans.models import Models
from tests.fixture_tables import CLAIMS, raw_tables


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_build_to_folder_matches_lazy_models(spark, tmp_path):
    raw = raw_tables(spark)
    out = run_build(spark, raw, str(tmp_path / "target"))
    lazy = Models(spark, raw)
    for name in ("claims_with_denials", "denial_fact", "denial_patterns", "recoverable_pool", "fix_recommendations"):
        assert _rows(out.tables[name]) == _rows(getattr(lazy, name)), name
    assert out.checks.count() == 52 + 3 + 6
    assert out.checks.filter("failures != 0").count() == 0
    assert out.orphan_claims == 0
    # marts read the written fact, not the joins
    plan = out.tables["denial_fact"]._jdf.queryExecution().analyzed().toString().lower()
    assert "parquet" in plan
    # the fact was derived from the denied partition of the stored claim grain only
    denied = out.tables["claims_with_denials"].filter("is_denied")
    scan = denied._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_denied" in scan


def test_build_is_idempotent_and_reports_orphans(spark, tmp_path):
    claims = CLAIMS + [("CLM9", "ENC_X", "PAY1", 1.0, 0.55, 0.55, "paid", "2024-01-09")]
    raw = raw_tables(spark, raw_claims=claims)
    target = str(tmp_path / "target")
    run_build(spark, raw, target, with_checks=False)
    out = run_build(spark, raw, target)
    assert out.orphan_claims == 1
    assert out.tables["denial_fact"].count() == 4
    bad = {(r.check_name, r.column_name): r.failures for r in out.checks.filter("failures != 0").collect()}
    assert bad == {("relationships", "encounter_id"): 1, ("claims_preserved", "claim_id"): 1}


def test_build_as_catalog_tables(spark):
    out = run_build(spark, raw_tables(spark), "claims_marts", as_tables=True, with_checks=False)
    assert spark.table("claims_marts.fix_recommendations").count() == 4
    assert out.checks is None
    assert {t.name for t in spark.catalog.listTables("claims_marts")} >= {"denial_fact", "recoverable_pool"}


def test_model_views(spark):
    m = Models(spark, raw_tables(spark))
    m.register_views(prefix="v_")
    assert spark.sql("select count(*) from v_denial_fact").first()[0] == 4
    assert spark.sql("select count(*) from v_stg_claims").first()[0] == 6


def test_build_default_target_and_partitioned_fact(spark):
    from pyspark.sql import functions as F

    from remitlens.session import ensure_checkpoint_dir

    out = run_build(spark, raw_tables(spark), with_checks=False, fact_partition_by=["carc_category"])
    ckpt = ensure_checkpoint_dir(spark).replace("file:", "")
    assert out.target.replace("file:", "").startswith(ckpt)
    fact = out.tables["denial_fact"]
    assert fact.columns[0] == "denial_key" and fact.count() == 4
    plan = fact.filter(F.col("carc_category") == "coding")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(carc_category" in plan


def test_checkpointed_models(spark):
    m = Models(spark, raw_tables(spark))
    c = m.checkpointed()
    assert _rows(c.fix_recommendations) == _rows(m.fix_recommendations)
    assert _rows(c.denial_patterns) == _rows(m.denial_patterns)
    plan = c.denial_fact._jdf.queryExecution().analyzed().toString()
    assert "LogicalRDD" in plan  # reads the checkpoint, not the joins
