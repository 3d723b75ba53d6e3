"""Staging, claim-grain join, economics, fact and marts on the hand-made fixture."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from remitlens.plans import economics as econ
from remitlens.plans.models import Models
from tests.fixture_tables import CLAIMS, DENIALS, ENCOUNTERS, REASONS, raw_tables


@pytest.fixture(scope="module")
def m(spark):
    return Models(spark, raw_tables(spark))


def test_staging_types_and_renames(m):
    c = m.staged.claims
    assert dict(c.dtypes) == {
        "claim_id": "string", "encounter_id": "string", "payer_id": "string",
        "billed_amount": "decimal(12,2)", "allowed_amount": "decimal(12,2)", "paid_amount": "decimal(12,2)",
        "claim_status": "string", "claim_date": "date",
    }
    p = m.staged.patients.filter("patient_id = 'PT1'").first()
    assert p.date_of_birth == dt.date(1980, 2, 3) and p.zip_code == "02110"
    assert m.staged.reason_codes.columns == ["carc_code", "carc_description", "carc_category"]


def test_staging_bad_date_raises(spark):
    bad = list(CLAIMS)
    bad[0] = bad[0][:7] + ("2024-13-45",)
    m = Models(spark, raw_tables(spark, raw_claims=bad))
    with pytest.raises(Exception):
        m.staged.claims.collect()


def test_claims_with_denials_grain(m):
    rows = {r.claim_id: r for r in m.claims_with_denials.collect()}
    assert len(rows) == 6
    assert {k for k, r in rows.items() if r.is_denied} == {"CLM1", "CLM2", "CLM3", "CLM6"}
    assert rows["CLM4"].denial_id is None and rows["CLM4"].carc_code is None
    assert rows["CLM1"].denial_date == dt.date(2024, 1, 11)


def test_claim_without_encounter_is_dropped(spark):
    claims = CLAIMS + [("CLM7", "ENC_MISSING", "PAY1", 10.0, 5.5, 0.0, "denied", "2024-01-07")]
    m = Models(spark, raw_tables(spark, raw_claims=claims))
    assert m.claims_with_denials.count() == 6


def test_reason_economics_unknown_and_null_category(spark):
    reasons = REASONS + [("99", "Mystery", "astral", 0.0, 0.0), ("98", "Blank", None, 0.0, 0.0)]
    m = Models(spark, raw_tables(spark, dim_carc_codes=reasons))
    e = {r.carc_code: r for r in m.reason_economics.collect()}
    assert e["16"].appeal_win_rate == D("0.72") and e["16"].category_multiplier == D("1.00")
    assert e["16"].is_high_appeal_value is True and e["45"].is_high_appeal_value is False
    assert e["99"].appeal_win_rate is None and e["99"].is_high_appeal_value is False
    assert e["98"].appeal_win_rate is None and e["98"].is_high_appeal_value is False


def test_tunable_assumptions(spark):
    custom = tuple(
        econ.CategoryAssumption(a.category, D("0.50"), D("1.00"), a.high_appeal_value, a.fix_probability,
                                a.recommended_action)
        for a in econ.DEFAULT_ASSUMPTIONS
    )
    m = Models(spark, raw_tables(spark), assumptions=econ.assumptions_frame(spark, custom))
    got = {r.denial_id: r.recoverable_amount for r in m.denial_fact.collect()}
    assert got == {"DNL1": D("50.00"), "DNL2": D("100.00"), "DNL3": D("150.00"), "DNL6": D("300.00")}


def test_denial_fact_values(m):
    f = m.denial_fact
    assert f.dtypes[0] == ("denial_key", "string")
    got = {r.denial_id: r for r in f.collect()}
    assert {k: r.recoverable_amount for k, r in got.items()} == {
        "DNL1": D("72.00"), "DNL2": D("129.20"), "DNL3": D("18.90"), "DNL6": D("90.00"),
    }
    assert got["DNL6"].payer_type == "medicare" and got["DNL6"].specialty == "Cardiology"
    assert dict(f.dtypes)["recoverable_amount"] == "decimal(18,2)"
    assert len(f.columns) == 29


def test_denial_fact_drops_unknown_dimension_members(spark):
    denials = DENIALS + [("DNL5", "CLM5", "77", "N1", "2024-01-15", "not_appealed")]  # unknown reason
    enc = [e if e[0] != "ENC2" else ("ENC2", "PT1", "PRV9") + e[3:] for e in ENCOUNTERS]  # unknown provider
    m = Models(spark, raw_tables(spark, raw_denials=denials, raw_encounters=enc))
    assert sorted(r.denial_id for r in m.denial_fact.collect()) == ["DNL1", "DNL3", "DNL6"]


def test_unknown_category_gives_null_recoverable(spark):
    reasons = [r if r[0] != "16" else ("16", "Lacks information", "astral", 0.7, 1.0) for r in REASONS]
    m = Models(spark, raw_tables(spark, dim_carc_codes=reasons))
    row = m.denial_fact.filter("denial_id = 'DNL1'").first()
    assert row.recoverable_amount is None and row.is_high_appeal_value is False


def test_segment_claims(m):
    got = {(r.payer_type, r.specialty): (r.total_claims, r.denied_claims) for r in m.segment_claims.collect()}
    assert got == {
        ("commercial", "Cardiology"): (2, 2),
        ("medicare", "Orthopedics"): (2, 1),
        ("commercial", "Orthopedics"): (1, 0),
        ("medicare", "Cardiology"): (1, 1),
    }


def test_denial_patterns(m):
    got = {(r.payer_type, r.specialty, r.carc_category): r for r in m.denial_patterns.collect()}
    assert len(got) == 4
    r = got[("medicare", "Orthopedics", "medical_necessity")]
    assert (r.denial_count, r.distinct_carc_codes, r.total_claims, r.denied_claims) == (1, 1, 2, 1)
    assert r.segment_denial_rate_pct == D("50.0")
    assert r.total_recoverable == D("18.90") and r.recoverable_per_denial == D("18.90")
    assert len({x.pattern_key for x in got.values()}) == 4


def test_recoverable_pool(m):
    rows = m.recoverable_pool.collect()
    assert [r.carc_category for r in rows] == ["coding", "coverage", "technical", "medical_necessity"]
    pct = {r.carc_category: r.pct_of_total_recoverable for r in rows}
    assert pct == {"technical": D("23.2"), "coding": D("41.7"), "coverage": D("29.0"), "medical_necessity": D("6.1")}
    tech = [r for r in rows if r.carc_category == "technical"][0]
    assert tech.appeal_win_rate == D("0.72") and tech.total_denied_billed == D("100.00")


def test_fix_recommendations_fewer_than_k(m):
    rows = m.fix_recommendations.collect()
    assert [r.priority_rank for r in rows] == [1, 2, 3, 4]
    assert [r.carc_category for r in rows] == ["coding", "technical", "coverage", "medical_necessity"]
    # 18.90 x 0.25 = 4.725: shown rounded half up
    assert rows[3].priority_score == D("4.73")
    assert rows[0].recommended_action.startswith("Add pre-submission coding QA")


def test_fix_recommendations_tie_break(spark):
    claims = CLAIMS + [("CLM7", "ENC7", "PAY1", 100.0, 55.0, 0.0, "denied", "2024-01-07")]
    enc = ENCOUNTERS + [("ENC7", "PT1", "PRV2", "2024-01-07", "99213", "Office visit", "office_visit", "I10")]
    denials = DENIALS + [("DNL7", "CLM7", "16", "N130", "2024-01-17", "not_appealed")]
    m = Models(spark, raw_tables(spark, raw_claims=claims, raw_encounters=enc, raw_denials=denials))
    rows = m.fix_recommendations.collect()
    tied = [(r.priority_rank, r.specialty) for r in rows if r.priority_score == D("61.20")]
    assert tied == [(2, "Cardiology"), (3, "Orthopedics")]


def test_top_k_parameter(spark):
    m = Models(spark, raw_tables(spark), top_k=2)
    assert m.fix_recommendations.count() == 2


def test_fact_reuse_with_written_table(spark, m, tmp_path):
    from remitlens.sources.sinks import materialize

    fact = materialize(spark, m.denial_fact, str(tmp_path / "fact"))
    m2 = m.with_fact(fact)
    assert sorted(map(tuple, m2.fix_recommendations.collect())) == sorted(map(tuple, m.fix_recommendations.collect()))


def test_recoverable_per_denial_exact_half_cent(spark):
    # commercial x Cardiology x technical gets a second denial: 72.00 + 72.01 = 144.01 over 2
    claims = CLAIMS + [("CLM7", "ENC7", "PAY1", 100.02, 55.01, 0.0, "denied", "2024-01-07")]
    enc = ENCOUNTERS + [("ENC7", "PT1", "PRV1", "2024-01-07", "99213", "Office visit", "office_visit", "I10")]
    denials = DENIALS + [("DNL7", "CLM7", "16", "N130", "2024-01-17", "not_appealed")]
    m = Models(spark, raw_tables(spark, raw_claims=claims, raw_encounters=enc, raw_denials=denials))
    r = m.denial_patterns.filter("carc_category = 'technical' and specialty = 'Cardiology'").first()
    assert (r.denial_count, r.total_recoverable, r.recoverable_per_denial) == (2, D("144.01"), D("72.01"))
    assert r.segment_denial_rate_pct == D("100.0") and r.total_claims == 3


def test_assumptions_reject_repeated_category(spark):
    dup = econ.DEFAULT_ASSUMPTIONS + (econ.DEFAULT_ASSUMPTIONS[0],)
    with pytest.raises(ValueError):
        econ.assumptions_frame(spark, dup)


def test_signed_amounts_have_shares(spark):
    from remitlens.plans import marts

    fact = spark.createDataFrame(
        [("coding", True, D("10000000.00"), D("100000.00")), ("coverage", False, D("10.00"), D("-99999.99"))],
        "carc_category string, is_high_appeal_value boolean, billed_amount decimal(12,2), recoverable_amount decimal(12,2)",
    ).selectExpr("*", "cast(0.5 as decimal(3,2)) as appeal_win_rate", "cast(1 as decimal(3,2)) as category_multiplier")
    assert marts.recoverable_pool(marts.category_rows(fact)).first().pct_of_total_recoverable == D("1000000000.0")
    assert marts.appealable_share(marts.flag_rows(fact)).count() == 2


def test_staging_casts_like_the_reference_engine(spark):
    from remitlens.plans.staging import Field, cast_sql

    money = spark.createDataFrame([(1.005,), (2.675,), (1.115,), (-3.5,)], "a double")
    amount = cast_sql(Field("a", "a", "money"), "double")
    assert [r[0] for r in money.selectExpr(amount).collect()] == [D("1.00"), D("2.68"), D("1.12"), D("-3.50")]
    date = Field("d", "d", "date")
    texts = {"2024-1-5": True, "2024-01-05T10:00:00": True, " 2024-01-05 ": True, "2024-01-05 10:00:00.5": True, "2024-01-05 10:00:00+02": True}
    texts |= dict.fromkeys(("2024", "2024-03", "2024-01-05 xx", "2024-01-05 9xyz", "2024-01-05T", "2024-01-05 10", "2024-01-05 25:00:00", "2024-01-05Z", "+2024-01-05", "20240105", "", "x2024-01-05"), False)
    for text, good in texts.items():
        row = spark.createDataFrame([(text,)], "d string")
        if good:
            assert str(row.selectExpr(cast_sql(date, "string")).first()[0]) == "2024-01-05", text
        else:
            with pytest.raises(Exception, match="not a date"):
                row.selectExpr(cast_sql(date, "string")).collect()
        lenient = row.selectExpr(cast_sql(date, "string", lenient=True)).first()[0]
        assert (lenient is not None) is good, text


def test_rollup_gives_the_marts(spark, m):
    from remitlens.plans import marts

    stored = m.with_tables(mart_rollup=m.mart_rollup.checkpoint())
    for name in ("denial_patterns", "recoverable_pool", "appealable_share", "opportunities", "fix_recommendations"):
        a, b = m.model(name), stored.model(name)
        assert a.schema.simpleString() == b.schema.simpleString(), name
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
    # the fact's tables are read once, by the aggregation at the finest grain
    plan = m.mart_rollup._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("denial_id") and plan.count("Expand") >= 1
    assert {r.level for r in stored.mart_rollup.collect()} == set(marts.LEVELS)


def test_rollup_of_repeated_codes_and_no_rows(spark):
    from remitlens.plans import marts

    schema = (
        "payer_type string, specialty string, carc_code string, carc_description string, carc_category string, is_high_appeal_value boolean, "
        "billed_amount decimal(12,2), recoverable_amount decimal(18,2), appeal_win_rate decimal(3,2), category_multiplier decimal(3,2)"
    )
    # one code with two descriptions, a NULL code, NULL dollars
    rows = [
        ("p", "s", "16", "one", "technical", True, D("1.00"), D("0.72"), D("0.72"), D("1.00")),
        ("p", "s", "16", "two", "technical", True, D("2.00"), D("1.44"), D("0.72"), D("1.00")),
        ("p", "s", None, None, None, False, D("3.00"), None, None, None),
    ]
    fact = spark.createDataFrame(rows, schema)
    rollup = marts.mart_rollup(fact)
    patterns = {r.carc_category: r for r in marts.level_rows(rollup, "pattern").collect()}
    assert (patterns["technical"].denial_count, patterns["technical"].distinct_carc_codes) == (2, 1)
    assert (patterns[None].distinct_carc_codes, patterns[None].total_recoverable) == (0, None)
    assert marts.level_rows(rollup, "opportunity").count() == 3
    total = marts.level_rows(rollup, "total").first()
    assert (total.denial_count, total.total_denied_billed, total.total_recoverable) == (3, D("6.00"), D("2.16"))
    assert marts.mart_rollup(fact.limit(0)).collect() == []


def test_only_what_a_model_needs_is_planned(spark):
    from remitlens.sources.raw import RawTables

    made = []
    given = raw_tables(spark)
    lazy = RawTables(**{name: lambda name=name, df=df: made.append(name) or df for name, df in given.items()})
    m = Models(spark, lazy)
    assert m.reason_economics.count() == 4 and made == ["dim_carc_codes"]
    m.model("denial_fact")
    assert "raw_patients" not in made
    with pytest.raises(ValueError):
        m.model("nothing")
    with pytest.raises(ValueError):
        RawTables(raw_claims=given.raw_claims)


def test_building_the_graph_runs_no_job(spark):
    from remitlens.plans.models import Models
    from tests.fixture_tables import raw_tables

    raw = raw_tables(spark)
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    Models(spark, raw).views()
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() == before
