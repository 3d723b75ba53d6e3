"""Reusable operators on small inputs."""

from __future__ import annotations

from decimal import Decimal as D

from pyspark.sql import functions as F

from remitlens.operators.joins import anti_join
from remitlens.operators.metrics import scored_top_k, segment_rate, share_of_total


def test_share_of_total_both_ways(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, v long")
    got = {
        r.k: r.share
        for r in share_of_total(df, "v", "share", scale=1).collect()
    }
    assert got == {"a": D("33.3"), "b": D("33.3"), "c": D("33.3")}
    frac = share_of_total(df, "v", "f", scale=3, as_percent=False)
    assert dict(frac.dtypes)["f"] == "decimal(38,3)"
    assert {r.f for r in frac.collect()} == {D("0.333")}


def test_share_of_total_subquery_keeps_rows_distributed(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.lit(1).alias("v"))
    out = share_of_total(df, "v", "share")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "SinglePartition" not in plan.split("Subquery")[0]
    assert out.count() == 1000


def test_share_of_total_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 0)], "k string, v long")
    assert share_of_total(df, "v", "s").first().s is None


def test_segment_rate_null_flag_counts_as_not_flagged(spark):
    df = spark.createDataFrame([("x", "denied"), ("x", None), ("x", "paid")], "seg string, status string")
    r = segment_rate(df, ["seg"], F.col("status") == "denied").first()
    assert (r.total_claims, r.denied_claims) == (3, 1)


def test_scored_top_k_null_last_and_ties(spark):
    df = spark.createDataFrame(
        [("b", 5), ("a", 5), ("c", None), ("d", 7), ("e", 1)], "name string, score long"
    )
    rows = scored_top_k(df, F.col("score"), 4, tiebreak=["name"], rank_name="r").collect()
    assert [(r.r, r.name) for r in rows] == [(1, "d"), (2, "a"), (3, "b"), (4, "e")]
    plan = scored_top_k(df, F.col("score"), 2, ["name"], "r")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_anti_join_keeps_null_keys(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",)], "k string")
    assert sorted(r.k or "-" for r in anti_join(left, right, "k").collect()) == ["-", "b"]
