"""Profile reports over the claim tables.

Status mix and denial share are the sanity figures printed after data
generation; the rest answer the questions the project's documents pose about
planted patterns (segment lift, dominant reason per segment), the appealable
share of the pool, seasonality, claim-to-denial lag and payer/patient
coverage agreement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from remitlens.functions.numeric import TOTAL, percent, round_ratio
from remitlens.operators.metrics import share_of_total, with_totals
from remitlens.plans.marts import SEGMENT

# Expected claim-to-denial lag in days (inclusive).
DENIAL_LAG_MIN_DAYS = 7
DENIAL_LAG_MAX_DAYS = 34


def status_mix(claims: DataFrame) -> DataFrame:
    """Claims per status and their share of all claims (3 digits)."""
    counts = claims.groupBy("claim_status").agg(F.count(F.lit(1)).cast("bigint").alias("claim_count"))
    shared = share_of_total(counts, "claim_count", "claim_share", scale=3, as_percent=False)
    return shared.withColumn("claim_share", F.col("claim_share").cast("decimal(4,3)"))


def denial_share(spark: SparkSession, claims: DataFrame, denials: DataFrame) -> DataFrame:
    """Denial rows / claim rows, one row. Both counts are scalar subqueries."""
    counts = spark.range(1).select(
        denials.agg(F.count(F.lit(1))).scalar().cast("bigint").alias("denial_rows"),
        claims.agg(F.count(F.lit(1))).scalar().cast("bigint").alias("claim_rows"),
    )
    return counts.withColumn(
        "denial_share", round_ratio("denial_rows", "claim_rows", 3).cast("decimal(4,3)")
    )


def segment_lift(segments: DataFrame, threshold: str = "1.20") -> DataFrame:
    """Denial rate of each payer type x specialty against the overall rate.

    ``lift = (denied_s / total_s) / (denied_all / total_all)``, rounded
    exactly to 2 digits; ``is_elevated`` when lift >= threshold.
    """
    segments = with_totals(segments, "everything", "total_claims", "denied_claims")
    total_all, denied_all = F.col("everything.total_claims"), F.col("everything.denied_claims")
    num = F.col("denied_claims").cast("decimal(38,0)") * total_all.cast("decimal(38,0)")
    den = F.col("total_claims").cast("decimal(38,0)") * denied_all.cast("decimal(38,0)")
    lift = round_ratio(num, den, 2).cast("decimal(10,2)")
    return segments.select(
        *SEGMENT,
        F.col("total_claims").cast("bigint").alias("total_claims"),
        F.col("denied_claims").cast("bigint").alias("denied_claims"),
        percent("denied_claims", "total_claims").alias("segment_denial_rate_pct"),
        percent(denied_all, total_all).alias("overall_denial_rate_pct"),
        lift.alias("lift"),
        F.coalesce(lift >= F.lit(threshold).cast("decimal(10,2)"), F.lit(False)).alias("is_elevated"),
    )


def dominant_reason(fact: DataFrame) -> DataFrame:
    """Most frequent reason code per payer type x specialty.

    Counts per (segment, code) first; the window then ranks at most one row
    per code within a segment. Ties go to the smallest code.
    """
    per_code = fact.groupBy(*SEGMENT, "carc_code", "carc_category").agg(
        F.count(F.lit(1)).alias("denial_count")
    )
    w = Window.partitionBy(*SEGMENT)
    ranked = per_code.withColumn(
        "rn", F.row_number().over(w.orderBy(F.col("denial_count").desc(), F.col("carc_code").asc_nulls_first()))
    ).withColumn("segment_denials", F.sum("denial_count").over(w))
    return ranked.filter(F.col("rn") == 1).select(
        *SEGMENT,
        "carc_code",
        "carc_category",
        F.col("denial_count").cast("bigint").alias("denial_count"),
        F.col("segment_denials").cast("bigint").alias("segment_denials"),
        percent("denial_count", "segment_denials").alias("share_of_segment_pct"),
    )


def volume_by_weekday(claims: DataFrame) -> DataFrame:
    """Claims per weekday of the claim date (Monday = 0)."""
    return claims.groupBy(F.weekday("claim_date").alias("weekday")).agg(
        F.count(F.lit(1)).cast("bigint").alias("claim_count"),
        F.count_if(F.col("claim_status") == "denied").cast("bigint").alias("denied_claims"),
    )


def volume_by_month(claims: DataFrame) -> DataFrame:
    """Claims, denied claims and billed dollars per calendar month."""
    return claims.groupBy(F.trunc("claim_date", "month").alias("claim_month")).agg(
        F.count(F.lit(1)).cast("bigint").alias("claim_count"),
        F.count_if(F.col("claim_status") == "denied").cast("bigint").alias("denied_claims"),
        F.sum("billed_amount").cast(TOTAL).alias("total_billed"),
    )


def denial_lag(claims: DataFrame, denials: DataFrame) -> DataFrame:
    """Days from claim to denial: min, max, mean (2 digits) and rows outside
    the expected window. One row."""
    lag = F.datediff(F.col("denial_date"), F.col("claim_date"))
    joined = denials.select("claim_id", "denial_date").join(claims.select("claim_id", "claim_date"), "claim_id")
    stats = joined.select(lag.alias("lag")).agg(
        F.count(F.lit(1)).cast("bigint").alias("denials_joined"),
        F.min("lag").alias("min_lag_days"),
        F.max("lag").alias("max_lag_days"),
        F.sum("lag").alias("sum_lag"),
        F.count("lag").alias("n_lag"),
        F.count_if(~F.col("lag").between(DENIAL_LAG_MIN_DAYS, DENIAL_LAG_MAX_DAYS)).cast("bigint").alias(
            "out_of_range"
        ),
    )
    return stats.select(
        "denials_joined",
        F.col("min_lag_days").cast("int").alias("min_lag_days"),
        F.col("max_lag_days").cast("int").alias("max_lag_days"),
        round_ratio("sum_lag", "n_lag", 2).cast("decimal(10,2)").alias("avg_lag_days"),
        "out_of_range",
    )


def payer_match_rate(visits: DataFrame, payers: DataFrame, patients: DataFrame) -> DataFrame:
    """Share of claims with a visit whose payer type equals the patient's
    insurance type.

    ``visits`` needs payer_id and patient_id. Claims are counted per (payer,
    patient) first, so a hot payer or a frequent patient is one row per pair in
    the joins.
    """
    per_pair = visits.groupBy("payer_id", "patient_id").agg(F.count(F.lit(1)).alias("n"))
    joined = per_pair.join(payers.select("payer_id", "payer_type"), "payer_id", "inner").join(
        patients.select("patient_id", "insurance_type"), "patient_id", "inner"
    )
    stats = joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("joined_claims"),
        F.coalesce(F.sum(F.when(F.col("payer_type") == F.col("insurance_type"), F.col("n"))), F.lit(0))
        .cast("bigint")
        .alias("matched_claims"),
    )
    return stats.withColumn("match_rate_pct", percent("matched_claims", "joined_claims"))
