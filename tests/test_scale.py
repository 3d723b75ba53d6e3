"""Plan behaviour that matters at scale, forced on small inputs.

Broadcasts are switched off so the sort-merge plans a large cluster would get
are used, and AQE's skew thresholds are lowered so a hot payer key on a few
thousand rows counts as skewed.
"""

from __future__ import annotations

import contextlib

import pytest

from remitlens.plans.models import Models
from remitlens.sources.raw import RawTables
from remitlens.sources.schemas import RAW_SCHEMAS

HOT_CLAIMS = 4000


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed_raw(spark) -> RawTables:
    """One payer (PAY0) carries two thirds of all claims; every claim is denied."""
    from pyspark.sql import functions as F

    n = HOT_CLAIMS
    ids = spark.range(n)
    claims = ids.select(
        F.concat(F.lit("CLM"), F.col("id").cast("string")).alias("claim_id"),
        F.concat(F.lit("ENC"), F.col("id").cast("string")).alias("encounter_id"),
        F.when(F.col("id") % 3 != 0, F.lit("PAY0"))
        .otherwise(F.concat(F.lit("PAY"), (F.col("id") % 50).cast("string")))
        .alias("payer_id"),
        F.lit(100.0).alias("billed_amount"),
        F.lit(55.0).alias("allowed_amount"),
        F.lit(0.0).alias("paid_amount"),
        F.lit("denied").alias("status"),
        F.lit("2024-01-01").alias("claim_date"),
    )
    encounters = ids.select(
        F.concat(F.lit("ENC"), F.col("id").cast("string")).alias("encounter_id"),
        F.lit("PT1").alias("patient_id"),
        F.concat(F.lit("PRV"), (F.col("id") % 7).cast("string")).alias("provider_id"),
        F.lit("2024-01-01").alias("encounter_date"),
        F.lit("99213").alias("procedure_code"),
        F.lit("Office visit").alias("procedure_desc"),
        F.lit("office_visit").alias("procedure_category"),
        F.lit("I10").alias("diagnosis_code"),
    )
    denials = ids.select(
        F.concat(F.lit("DNL"), F.col("id").cast("string")).alias("denial_id"),
        F.concat(F.lit("CLM"), F.col("id").cast("string")).alias("claim_id"),
        F.lit("16").alias("carc_code"),
        F.lit("N1").alias("rarc_code"),
        F.lit("2024-01-11").alias("denial_date"),
        F.lit("not_appealed").alias("appeal_status"),
    )
    payers = spark.range(50).select(
        F.concat(F.lit("PAY"), F.col("id").cast("string")).alias("payer_id"),
        F.lit("name").alias("payer_name"),
        F.when(F.col("id") % 2 == 0, F.lit("commercial")).otherwise(F.lit("medicare")).alias("payer_type"),
    )
    providers = spark.range(7).select(
        F.concat(F.lit("PRV"), F.col("id").cast("string")).alias("provider_id"),
        F.lit("Dr").alias("provider_name"),
        F.lit("Cardiology").alias("specialty"),
        F.lit("1").alias("npi"),
        F.lit("East").alias("region"),
    )
    small = {
        "raw_patients": spark.createDataFrame(
            [("PT1", "A", "B", "1980-01-01", "M", "00001", "commercial")], RAW_SCHEMAS["raw_patients"]
        ),
        "dim_carc_codes": spark.createDataFrame(
            [("16", "Lacks information", "technical", 0.72, 1.0)], RAW_SCHEMAS["dim_carc_codes"]
        ),
    }
    return RawTables(
        raw_patients=small["raw_patients"],
        raw_encounters=encounters,
        raw_claims=claims,
        raw_denials=denials,
        dim_carc_codes=small["dim_carc_codes"],
        dim_providers=providers,
        dim_payers=payers,
    )


@pytest.fixture
def no_broadcast_skew_conf(spark):
    """Large dimensions: no size-based broadcast."""
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
        },
    ):
        yield


def test_hot_payer_join_is_split_by_aqe(spark, no_broadcast_skew_conf):
    m = Models(spark, _skewed_raw(spark))
    fact = m.denial_fact.select("denial_id", "payer_type")
    assert len(fact.collect()) == HOT_CLAIMS  # runs this Dataset's own plan to its final form
    final = fact._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in final
    assert "isSkew=true" in final or "skew=true" in final.lower(), final[:3000]


def test_skewed_results_are_whole(spark, no_broadcast_skew_conf):
    m = Models(spark, _skewed_raw(spark))
    seg = {(r.payer_type, r.specialty): (r.total_claims, r.denied_claims) for r in m.segment_claims.collect()}
    hot = HOT_CLAIMS - (HOT_CLAIMS + 2) // 3  # claims with id % 3 != 0
    assert sum(t for t, _ in seg.values()) == HOT_CLAIMS
    assert seg[("commercial", "Cardiology")][0] >= hot
    pool = m.recoverable_pool.first()
    assert pool.denial_count == HOT_CLAIMS and pool.pct_of_total_recoverable == 100


def test_denial_fact_plan_shape_without_size_broadcasts(spark, no_broadcast_skew_conf):
    """At scale: two shuffles per join key, nothing broadcast by a hint, no
    cartesian product."""
    import re

    from tests.fixture_tables import raw_tables

    m = Models(spark, raw_tables(spark))
    plan = m.denial_fact._jdf.queryExecution().executedPlan().toString()
    keys = sorted(re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^,]*),", plan))
    wanted = ("carc_category", "carc_code", "claim_id", "encounter_id", "payer_id", "provider_id")
    assert keys == [k for k in wanted for _ in range(2)]
    assert "BroadcastHashJoin" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # denials meet claims before the encounter join: the claim_id join is the innermost
    assert plan.rfind("SortMergeJoin [claim_id") > plan.rfind("SortMergeJoin [encounter_id")


def test_bucketed_load_removes_claim_id_shuffles(spark, no_broadcast_skew_conf):
    import re

    from remitlens.sources.raw import read_catalog_tables
    from remitlens.sources.sinks import load_raw_tables
    from tests.fixture_tables import raw_tables

    load_raw_tables(spark, raw_tables(spark), "bucketed_raw", buckets=4)
    m = Models(spark, read_catalog_tables(spark, "bucketed_raw"))
    for df in (m.denied_claims, m.claims_with_denials):
        plan = df._jdf.queryExecution().executedPlan().toString()
        keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^,]*),", plan)]
        assert keys == ["encounter_id"], keys
    from remitlens.operators.checks import unique_checks

    keyed = unique_checks(read_catalog_tables(spark, "bucketed_raw").raw_claims, "raw_claims", ["claim_id"])
    assert "Exchange hashpartitioning" not in keyed._jdf.queryExecution().executedPlan().toString()
    lazy = Models(spark, raw_tables(spark))
    assert sorted(map(tuple, m.fix_recommendations.collect())) == sorted(map(tuple, lazy.fix_recommendations.collect()))
    assert sorted(map(tuple, m.claims_with_denials.collect())) == sorted(
        map(tuple, lazy.claims_with_denials.collect())
    )


def test_planner_broadcasts_assumptions_by_their_known_size(spark):
    """No hint is needed: a VALUES relation of known size is broadcast under
    the session's threshold."""
    from tests.fixture_tables import raw_tables

    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "1MB"}):
        plan = Models(spark, raw_tables(spark)).reason_economics._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [carc_category" in plan


def test_segment_and_payer_match_read_no_denials(spark):
    from remitlens.plans import profile
    from tests.fixture_tables import raw_tables

    m = Models(spark, raw_tables(spark))
    matched = profile.payer_match_rate(m.claim_visits, m.staged.payers, m.staged.patients)
    for df in (m.segment_claims, matched):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "denial_id" not in plan and "appeal_status" not in plan
