"""Claim-grain join and the denial fact.

Grain rules: a claim has one encounter and at most one denial, so the
encounter join is inner (a claim without encounter is dropped and reported by
the orphan check) and the denial join is left (paid and pending claims keep
NULL denial columns). Joining denials on anything coarser than ``claim_id``
would fan out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.functions.keys import surrogate_key
from remitlens.functions.numeric import AMOUNT

#: The claim grain's columns but the denial flag, in order.
GRAIN_COLUMNS = [
    "claim_id", "encounter_id", "payer_id", "billed_amount", "allowed_amount", "paid_amount", "claim_status", "claim_date",
    "patient_id", "provider_id", "procedure_code", "procedure_desc", "procedure_category", "diagnosis_code", "encounter_date",
    "denial_id", "carc_code", "rarc_code", "denial_date", "appeal_status",
]
VISIT_COLUMNS = ["payer_id", "provider_id", "patient_id", "claim_status"]


def claims_with_denials(claims: DataFrame, encounters: DataFrame, denials: DataFrame) -> DataFrame:
    """One row per claim that has an encounter, with its denial if any.

    Both joins are fact-to-fact on unique ids: hash-partitioned by the planner
    (sort-merge, or broadcast when a side is small), never forced. Denials are
    attached first (on ``claim_id``), then encounters: the same rows as the
    other order, and with claims and denials bucketed on ``claim_id`` the first
    join needs no shuffle.
    """
    joined = claims.join(denials, "claim_id", "left").join(encounters, "encounter_id", "inner")
    return joined.selectExpr(*GRAIN_COLUMNS, "denial_id is not null as is_denied")


def claim_visits(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    """The few columns of the claim grain that need no denial: who paid, who
    treated whom, and the claim's status."""
    return (
        claims.select("claim_id", "encounter_id", "payer_id", "claim_status")
        .join(encounters.select("encounter_id", "provider_id", "patient_id"), "encounter_id", "inner")
        .select(*VISIT_COLUMNS)
    )


def denied_claims(claims: DataFrame, encounters: DataFrame, denials: DataFrame) -> DataFrame:
    """The rows of ``claims_with_denials`` where ``is_denied`` holds.

    Same rows as filtering the claim grain, but joined in the cheaper order:
    denials meet claims first (on ``claim_id``), so only denied claims are
    carried into the encounter join instead of every claim.
    """
    joined = denials.where("denial_id is not null").join(claims, "claim_id", "inner").join(encounters, "encounter_id", "inner")
    return joined.selectExpr(*GRAIN_COLUMNS, "true as is_denied")


def denial_fact(
    claims_with_denials_df: DataFrame,
    providers: DataFrame,
    payers: DataFrame,
    economics: DataFrame,
) -> DataFrame:
    """One row per denial, denormalised, with the recoverable estimate.

    ``recoverable_amount = round(billed * appeal_win_rate * category_multiplier, 2)``
    computed in exact decimals. Inner joins: a denial whose provider, payer or
    reason code is unknown is dropped (reported by the relationship checks).
    Accepts the claim grain (filtered on ``is_denied`` here) or the output of
    ``denied_claims``.
    """
    joined = (
        claims_with_denials_df.where("is_denied")
        .join(providers, "provider_id", "inner")
        .join(payers, "payer_id", "inner")
        .join(economics, "carc_code", "inner")
    )
    return joined.withColumn("denial_key", surrogate_key("denial_id")).selectExpr(
        "denial_key", "denial_id", "claim_id", "encounter_id",
        "provider_id", "provider_name", "specialty", "region",
        "payer_id", "payer_name", "payer_type",
        "procedure_code", "procedure_desc", "procedure_category", "diagnosis_code",
        "carc_code", "carc_description", "carc_category", "is_high_appeal_value",
        "billed_amount", "allowed_amount", "paid_amount",
        "appeal_win_rate", "category_multiplier",
        f"cast(round(billed_amount * appeal_win_rate * category_multiplier, 2) as {AMOUNT}) as recoverable_amount",
        "claim_date", "denial_date", "rarc_code", "appeal_status",
    )
