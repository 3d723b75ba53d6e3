"""Each check passes on the clean fixture and reports exactly the planted failure."""

from __future__ import annotations

import pytest

from remitlens.plans import quality
from remitlens.plans.models import Models
from tests.fixture_tables import CLAIMS, DENIALS, ENCOUNTERS, PROVIDERS, REASONS, raw_tables

DOMAINS = quality.CLINIC_DOMAINS


def failures(df):
    return {(r.check_name, r.table_name, r.column_name): r.failures for r in df.collect()}


def nonzero(df):
    return {k: v for k, v in failures(df).items() if v}


@pytest.fixture(scope="module")
def clean(spark):
    return Models(spark, raw_tables(spark))


def test_declared_suite_has_52_checks_and_passes(clean):
    got = failures(quality.declared_suite(clean, DOMAINS))
    assert len(got) == 52
    kinds = [k[0] for k in got]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values"),
            kinds.count("relationships")) == (23, 15, 8, 6)
    assert not any(got.values())


def test_row_rules_and_grain_pass_on_clean(clean):
    assert not nonzero(quality.row_rules(clean))
    assert not nonzero(quality.grain_checks(clean))
    assert quality.orphan_claims(clean.staged.claims, clean.staged.encounters).first().orphan_claims == 0


def test_not_null_reports_null_key(spark):
    claims = CLAIMS + [(None, "ENC9", "PAY1", 1.0, 0.55, 0.0, "paid", "2024-01-09")]
    m = Models(spark, raw_tables(spark, raw_claims=claims))
    assert nonzero(quality.not_null_suite(m)) == {("not_null", "stg_claims", "claim_id"): 1}


def test_unique_reports_duplicated_value_once(spark):
    claims = CLAIMS + [
        ("CLM1", "ENC1b", "PAY1", 1.0, 0.55, 0.55, "paid", "2024-01-09"),
        ("CLM1", "ENC1c", "PAY1", 1.0, 0.55, 0.55, "paid", "2024-01-09"),
    ]
    m = Models(spark, raw_tables(spark, raw_claims=claims))
    got = nonzero(quality.unique_suite(m))
    assert got == {("unique", "stg_claims", "claim_id"): 1}


def test_accepted_values_counts_distinct_bad_values_null_passes(spark):
    providers = PROVIDERS + [
        ("PRV3", "Dr Three", "Astrology", "3", "North"),
        ("PRV4", "Dr Four", "Astrology", "4", "North"),
        ("PRV5", "Dr Five", None, "5", "North"),
    ]
    m = Models(spark, raw_tables(spark, dim_providers=providers))
    assert nonzero(quality.accepted_values_suite(m, DOMAINS)) == {
        ("accepted_values", "stg_providers", "specialty"): 1
    }


def test_relationships_counts_child_rows_null_passes(spark):
    enc = ENCOUNTERS + [
        ("ENC7", "PT1", "PRV9", "2024-01-07", "99213", "Office visit", "office_visit", "I10"),
        ("ENC8", "PT1", "PRV9", "2024-01-08", "99213", "Office visit", "office_visit", "I10"),
        ("ENC9", "PT1", None, "2024-01-09", "99213", "Office visit", "office_visit", "I10"),
    ]
    m = Models(spark, raw_tables(spark, raw_encounters=enc))
    assert nonzero(quality.relationships_suite(m)) == {("relationships", "stg_encounters", "provider_id"): 2}


def test_unknown_category_is_reported_and_gives_null_recoverable(spark):
    reasons = [r if r[0] != "16" else ("16", "Lacks information", "astral", 0.7, 1.0) for r in REASONS]
    m = Models(spark, raw_tables(spark, dim_carc_codes=reasons))
    got = nonzero(quality.declared_suite(m, DOMAINS))
    assert got == {
        ("accepted_values", "stg_reason_codes", "carc_category"): 1,
        ("accepted_values", "denial_fact", "carc_category"): 1,
        ("not_null", "denial_fact", "recoverable_amount"): 1,
        # the pool row of the unknown category has a NULL total
        ("not_null", "recoverable_pool", "total_recoverable"): 1,
        ("not_null", "denial_patterns", "total_recoverable"): 1,
        ("not_null", "fix_recommendations", "priority_score"): 1,
        ("not_null", "fix_recommendations", "recommended_action"): 1,
    }


def test_row_rule_paid_amount(spark):
    claims = [c if c[0] != "CLM4" else c[:5] + (100.0,) + c[6:] for c in CLAIMS]
    m = Models(spark, raw_tables(spark, raw_claims=claims))
    assert nonzero(quality.row_rules(m)) == {("paid_amount_rule", "stg_claims", "paid_amount"): 1}


def test_grain_two_denials_on_one_claim(spark):
    denials = DENIALS + [("DNL1b", "CLM1", "11", "N1", "2024-01-20", "not_appealed")]
    m = Models(spark, raw_tables(spark, raw_denials=denials))
    got = nonzero(quality.grain_checks(m))
    assert got == {("one_row_per_claim", "claims_with_denials", "claim_id"): 1}
    # the fan-out reaches the fact: its claim_id repeats as well
    assert nonzero(quality.unique_suite(m)) == {
        ("unique", "stg_denials", "claim_id"): 1,
        ("unique", "denial_fact", "claim_id"): 1,
    }


def test_grain_claim_without_encounter_and_orphans(spark):
    claims = CLAIMS + [
        ("CLM7", "ENC_MISSING", "PAY1", 10.0, 5.5, 5.5, "paid", "2024-01-07"),
        ("CLM8", None, "PAY1", 10.0, 5.5, 5.5, "paid", "2024-01-08"),
    ]
    m = Models(spark, raw_tables(spark, raw_claims=claims))
    assert nonzero(quality.grain_checks(m)) == {("claims_preserved", "claims_with_denials", "claim_id"): 2}
    # the orphan count (left join + IS NULL semantics) counts a NULL encounter id too
    assert quality.orphan_claims(m.staged.claims, m.staged.encounters).first().orphan_claims == 2
    # the relationship test leaves NULL keys out
    assert nonzero(quality.relationships_suite(m)) == {("relationships", "stg_claims", "encounter_id"): 1}


def test_grain_status_text_vs_denial_row(spark):
    # CLM4 is paid but has a denial row; CLM6 is denied but its denial row is gone
    denials = [d for d in DENIALS if d[1] != "CLM6"] + [("DNL4", "CLM4", "16", "N1", "2024-01-14", "appeal_won")]
    m = Models(spark, raw_tables(spark, raw_denials=denials))
    assert nonzero(quality.grain_checks(m)) == {("denial_flag_matches_status", "claims_with_denials", "is_denied"): 2}


def test_grain_fact_drops_denial_of_unknown_payer(spark):
    claims = [c if c[0] != "CLM2" else c[:2] + ("PAY9",) + c[3:] for c in CLAIMS]
    m = Models(spark, raw_tables(spark, raw_claims=claims))
    assert nonzero(quality.grain_checks(m)) == {("one_fact_row_per_denial", "denial_fact", "denial_id"): 1}
    assert nonzero(quality.relationships_suite(m)) == {("relationships", "stg_claims", "payer_id"): 1}


def test_unique_checks_empty_table_and_all_null_column(spark):
    from remitlens.operators.checks import unique_checks

    empty = spark.createDataFrame([], "a string, b string")
    assert failures(unique_checks(empty, "t", ["a", "b"])) == {("unique", "t", "a"): 0, ("unique", "t", "b"): 0}
    df = spark.createDataFrame([("x", None, 1), ("x", None, 1), ("y", None, 2)], "a string, b string, c int")
    assert failures(unique_checks(df, "t", ["a", "b", "c"])) == {
        ("unique", "t", "a"): 1, ("unique", "t", "b"): 0, ("unique", "t", "c"): 1,
    }


def test_grain_counts_cannot_cancel(spark):
    """A duplicated payer doubles one denial, an unknown payer drops another,
    a denial has no claim and one a claim without encounter."""
    from tests.fixture_tables import PAYERS

    claims = [c if c[0] != "CLM2" else c[:2] + ("PAY9",) + c[3:] for c in CLAIMS]
    claims += [("CLM7", "ENC_MISSING", "PAY1", 10.0, 5.5, 0.0, "denied", "2024-01-07")]
    denials = DENIALS + [
        ("DNL8", "CLM7", "16", "N1", "2024-01-14", "appeal_won"),
        ("DNL9", "CLM_NONE", "16", "N1", "2024-01-14", "appeal_won"),
    ]
    hit = next(c for c in claims if c[0] in {d[1] for d in DENIALS} and c[2] != "PAY9")
    payers = PAYERS + [p for p in PAYERS if p[0] == hit[2]]
    m = Models(spark, raw_tables(spark, raw_claims=claims, raw_denials=denials, dim_payers=payers))
    got = nonzero(quality.grain_checks(m))
    assert got[("one_fact_row_per_denial", "denial_fact", "denial_id")] == 3
    assert got[("fact_denial_once", "denial_fact", "denial_id")] >= 1
    assert all(v >= 0 for v in got.values())


def test_checks_read_current_data(spark, tmp_path):
    import shutil

    import __spark_entry__ as entry
    from pyspark.sql import functions as F

    folder = f"{tmp_path}/sf"
    shutil.copytree("/root/testdata/sf0.001", folder, ignore=lambda d, names: [n for n in names if n[:4] in ("docu", "page", "embe", "conv")])
    check = entry.queries()["check_grain"]
    before = {r.check_name: r.failures for r in check(spark, folder).collect()}
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    import os

    os.chmod(folder, 0o755)
    orders.unionByName(orders).write.parquet(f"{folder}/twice")
    os.rename(f"{folder}/orders.parquet", f"{folder}/old")
    os.rename(f"{folder}/twice", f"{folder}/orders.parquet")
    after = {r.check_name: r.failures for r in check(spark, folder).collect()}
    assert before["one_row_per_claim"] == 0 < after["one_row_per_claim"]
