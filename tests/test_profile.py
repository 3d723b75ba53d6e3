"""Profile reports on the hand-made fixture."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from remitlens.plans import profile
from remitlens.plans.models import Models
from tests.fixture_tables import DENIALS, raw_tables


@pytest.fixture(scope="module")
def m(spark):
    return Models(spark, raw_tables(spark))


def test_status_mix(m):
    got = {r.claim_status: (r.claim_count, r.claim_share) for r in profile.status_mix(m.staged.claims).collect()}
    assert got == {"denied": (4, D("0.667")), "paid": (1, D("0.167")), "pending": (1, D("0.167"))}


def test_denial_share(spark, m):
    r = profile.denial_share(spark, m.staged.claims, m.staged.denials).first()
    assert (r.denial_rows, r.claim_rows, r.denial_share) == (4, 6, D("0.667"))


def test_segment_lift_finds_raised_segments(m):
    got = {(r.payer_type, r.specialty): r for r in profile.segment_lift(m.segment_claims).collect()}
    assert got[("commercial", "Cardiology")].lift == D("1.50")
    assert got[("commercial", "Cardiology")].is_elevated is True
    assert got[("medicare", "Orthopedics")].lift == D("0.75")
    assert got[("commercial", "Orthopedics")].is_elevated is False
    assert {r.overall_denial_rate_pct for r in got.values()} == {D("66.7")}
    assert sorted(k for k, r in got.items() if r.is_elevated) == [
        ("commercial", "Cardiology"), ("medicare", "Cardiology"),
    ]


def test_dominant_reason_tie_goes_to_smallest_code(m):
    got = {(r.payer_type, r.specialty): r for r in profile.dominant_reason(m.denial_fact).collect()}
    r = got[("commercial", "Cardiology")]
    assert (r.carc_code, r.denial_count, r.segment_denials, r.share_of_segment_pct) == ("11", 1, 2, D("50.0"))


def test_dominant_reason_planted_pattern(spark):
    denials = DENIALS + [
        (f"DNLx{i}", f"CLM{i}", "16", "N1", "2024-02-01", "not_appealed") for i in (4, 5)
    ]
    m = Models(spark, raw_tables(spark, raw_denials=denials))
    got = {(r.payer_type, r.specialty): r.carc_code for r in profile.dominant_reason(m.denial_fact).collect()}
    # CLM4 (medicare, Orthopedics) now also has reason 16, tied with 50 -> smaller code "16"
    assert got[("medicare", "Orthopedics")] == "16"


def test_appealable_share(m):
    got = {r.is_high_appeal_value: r for r in m.appealable_share.collect()}
    assert got[True].total_recoverable == D("201.20") and got[True].pct_of_total_recoverable == D("64.9")
    assert got[False].pct_of_total_recoverable == D("35.1")


def test_volume_by_weekday_monday_is_zero(m):
    got = {r.weekday: r.claim_count for r in profile.volume_by_weekday(m.staged.claims).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1}  # 2024-01-01 is a Monday


def test_volume_by_month(m):
    rows = profile.volume_by_month(m.staged.claims).collect()
    assert [(r.claim_month, r.claim_count, r.denied_claims, r.total_billed) for r in rows] == [
        (dt.date(2024, 1, 1), 6, 4, D("2100.00"))
    ]


def test_denial_lag(m):
    r = profile.denial_lag(m.staged.claims, m.staged.denials).first()
    assert (r.denials_joined, r.min_lag_days, r.max_lag_days, r.avg_lag_days, r.out_of_range) == (
        4, 10, 10, D("10.00"), 0,
    )


def test_payer_match_rate(m):
    r = profile.payer_match_rate(m.claims_with_denials, m.staged.payers, m.staged.patients).first()
    assert (r.joined_claims, r.matched_claims, r.match_rate_pct) == (6, 6, D("100.0"))
