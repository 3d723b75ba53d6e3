"""Driver contract, expected figures on the test data, oracle agreement, plan shape."""

from __future__ import annotations

import os
from decimal import Decimal as D

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
HAVE_DATA = os.path.isdir(SF0001)
needs_data = pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")


CLAIM_KEYS = sorted(entry._claim_queries())


def test_every_claim_query_has_an_oracle():
    from remitlens_oracle import ORACLE_SQL

    assert set(CLAIM_KEYS) == set(ORACLE_SQL)
    assert set(CLAIM_KEYS) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert len(CLAIM_KEYS) >= 35


@needs_data
def test_entry_flagship(spark):
    rows = entry.entry(spark).collect()
    assert [(r.priority_rank, r.payer_type, r.specialty, r.carc_code, r.denial_count, r.total_recoverable,
             r.priority_score) for r in rows] == [
        (1, "BUILDING", "NATION_15", "Brand#5", 5, D("1077683.93"), D("862147.14")),
        (2, "FURNITURE", "NATION_15", "Brand#12", 4, D("839048.50"), D("713191.23")),
        (3, "HOUSEHOLD", "NATION_15", "Brand#1", 3, D("828553.03"), D("662842.42")),
        (4, "FURNITURE", "NATION_15", "Brand#5", 4, D("787632.59"), D("630106.07")),
        (5, "BUILDING", "NATION_18", "Brand#5", 3, D("774006.34"), D("619205.07")),
    ]


@needs_data
def test_expected_figures_sf001(spark):
    q = entry.queries()
    pool = {r.carc_category: (r.denial_count, r.total_recoverable, r.pct_of_total_recoverable)
            for r in q["recoverable_pool"](spark, SF001).collect()}
    assert pool == {
        "technical": (1144, D("210831214.70"), D("42.6")),
        "coding": (1414, D("225313217.57"), D("45.5")),
        "coverage": (1086, D("39534377.53"), D("8.0")),
        "medical_necessity": (1215, D("19399108.30"), D("3.9")),
    }
    assert q["orphan_claims"](spark, SF001).first().orphan_claims == 257
    assert q["denial_fact"](spark, SF001).count() == 4859
    assert q["opportunities"](spark, SF001).count() == 2059
    weekdays = {r.weekday: r.claim_count for r in q["volume_by_weekday"](spark, SF001).collect()}
    assert [weekdays[i] for i in range(7)] == [2159, 2166, 2124, 2052, 2164, 2210, 2125]
    lag = q["denial_lag"](spark, SF001).first()
    assert (lag.min_lag_days, lag.max_lag_days, lag.out_of_range) == (7, 34, 0)
    share = {r.is_high_appeal_value: r.pct_of_total_recoverable for r in q["appealable_share"](spark, SF001).collect()}
    assert share[True] == D("88.1")
    assert q["payer_match_rate"](spark, SF001).first().matched_claims == 13607


@needs_data
def test_all_queries_match_oracle_sf0001(spark):
    report = compare(spark, SF0001, CLAIM_KEYS)
    bad = {k: v for k, v in report.items() if not v.get("match")}
    assert not bad, bad


@needs_data
def test_results_do_not_depend_on_partition_count(spark):
    q = entry.queries()
    keys = ["denial_patterns", "fix_recommendations", "check_unique", "segment_lift"]
    before = {k: sorted(map(tuple, q[k](spark, SF0001).collect())) for k in keys}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            for k in keys:
                assert sorted(map(tuple, q[k](spark, SF0001).collect())) == before[k], (k, n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_plan_shapes(spark):
    q = entry._claim_queries()
    for k in q:
        p = _plan(q[k](spark, SF0001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k
    assert "TakeOrderedAndProject" in _plan(q["fix_recommendations"](spark, SF0001))
    # references: one grouping of stacked keys, no join of children and parents
    assert "Union" in _plan(q["orphan_claims"](spark, SF0001)) and "Join" not in _plan(q["orphan_claims"](spark, SF0001)).split("Union")[0]
    fact_plan = q["denial_fact"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    # the denied-order filter reaches the orders scan
    assert "EqualTo(o_orderstatus,F)" in fact_plan
    # only the needed lineitem columns are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint>" in fact_plan or (
        "l_extendedprice" not in fact_plan
    )


@needs_data
def test_invariants_sf001(spark):
    from pyspark.sql import functions as F

    q = entry.queries()
    fact = q["denial_fact"](spark, SF001).agg(F.sum("recoverable_amount")).first()[0]
    patterns = q["denial_patterns"](spark, SF001).agg(F.sum("total_recoverable")).first()[0]
    pool = q["recoverable_pool"](spark, SF001)
    pool_total = pool.agg(F.sum("total_recoverable")).first()[0]
    assert fact == patterns == pool_total == D("495077918.10")
    pct = pool.agg(F.sum("pct_of_total_recoverable")).first()[0]
    assert abs(pct - 100) <= D("0.2")
    grain = {r.check_name: r.failures for r in q["check_grain"](spark, SF001).collect()}
    staged = q["stg_denials"](spark, SF001).count()
    assert q["denial_fact"](spark, SF001).count() == staged - grain["one_fact_row_per_denial"]
    seg = q["segment_claims"](spark, SF001).agg(F.sum("total_claims")).first()[0]
    assert seg == q["claims_with_denials"](spark, SF001).count() == 14743
