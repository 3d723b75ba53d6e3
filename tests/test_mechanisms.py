"""Checks inside the write, two-round uniqueness, tagged references,
fingerprints, failing rows, quarantine, publishing and stored views."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from remitlens.operators.checks import column_checks, literal_checks, unique_checks
from remitlens.operators.fingerprint import same_values
from remitlens.operators.observed import Watch
from remitlens.operators.references import Relation, unmatched_by_relation, unmatched_counts, unmatched_keys
from remitlens.operators.uniqueness import repeated_values, suspects
from remitlens.plans import build as build_module
from remitlens.plans import quality
from remitlens.plans.build import checks_in_write, run_build, stored_failing_rows
from remitlens.plans.models import Models
from remitlens.plans.quarantine import quarantine_report, stage_with_quarantine
from remitlens.plans.rejects import failing_rows
from remitlens.plans.views import create_views
from remitlens.sources.publish import RUNS, current_run, read_published
from remitlens.sources.raw import RawTables
from tests.fixture_tables import CLAIMS, DENIALS, ENCOUNTERS, PAYERS, PROVIDERS, REASONS, raw_tables

DOMAINS = quality.CLINIC_DOMAINS


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def counts(df):
    return {(r.check_name, r.table_name, r.column_name): r.failures for r in df.collect()}


FAULTY = {
    "raw_claims": CLAIMS + [(None, "ENC9", "PAY1", 1.0, 0.55, 0.0, "odd", "2024-01-09"), ("CLM1", "ENC_X", "PAY9", 1.0, 0.55, 0.0, "odd", "2024-01-09")],
    "raw_encounters": ENCOUNTERS + [("ENC9", "PT1", "PRV9", "2024-01-10", "99213", "Office visit", "office_visit", "I10")],
    "raw_denials": DENIALS + [("DNL1", "CLM4", None, "N1", "2024-01-14", "maybe")],
    "dim_providers": PROVIDERS + [("PRV3", "Dr Three", "Astrology", "3", "North")],
    "dim_carc_codes": [r if r[0] != "16" else ("16", "Lacks information", "astral", 0.7, 1.0) for r in REASONS],
}


# --- checks in the write -------------------------------------------------------


@pytest.mark.parametrize("faulty", [False, True])
def test_checks_counted_in_the_write_equal_a_pass(spark, faulty):
    m = Models(spark, raw_tables(spark, **(FAULTY if faulty else {})))
    expected = counts(quality.column_suite(m, DOMAINS)) | counts(quality.row_rules(m))
    assert len(expected) == 23 + 8 + 3
    got = checks_in_write(m, DOMAINS)
    assert counts(got) == expected and any(expected.values()) is faulty


def test_passing_checks_scan_nothing_again(spark, tmp_path):
    """After the write, a table whose checks all passed is not in any plan."""
    m = Models(spark, raw_tables(spark))
    watched = quality.watches(DOMAINS)
    stored, tables = build_module.write_models(m, str(tmp_path / "run"), watched)
    settled = quality.settled(stored, DOMAINS, watched)
    plan = settled._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan.lower()  # stored tables
    # of the staged tables only the patients, which no written table reads
    assert "date_of_birth" not in plan and "encounter_id" not in plan and "billed" not in plan
    assert len(counts(settled)) == 34
    assert set(tables) == {"claims_with_denials", "denial_fact", "mart_rollup", *build_module.MARTS}


def test_a_watch_that_saw_no_rows_or_failures_is_open(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "k int, v string")
    watch = Watch({"k": F.col("k").isNull(), "v": F.col("v").isNull(), "null": F.col("v") == "zz"})
    watch.on(df).write.parquet(str(tmp_path / "one"))
    assert watch.passed() == {"k", "null"}
    empty = Watch({"k": F.col("k").isNull()})
    empty.on(df.limit(0)).write.parquet(str(tmp_path / "two"))
    assert empty.passed() == set()
    assert Watch({"k": F.col("k").isNull()}).passed() == set()


# --- uniqueness ---------------------------------------------------------------


def test_two_round_uniqueness_is_exact(spark):
    rng = random.Random(3)
    values = [(f"k{i}", rng.choice([None, f"v{i}", "hot"]), rng.randrange(400)) for i in range(1000)]
    df = spark.createDataFrame(values, "a string, b string, c int").repartition(7)
    other = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "x int")
    found = repeated_values(spark, {"t": (df, ("a", "b", "c")), "u": (other, ("x",))})
    want = {
        ("t", "a"): {},
        ("t", "b"): {v: n for v, n in Counter(r[1] for r in values if r[1]).items() if n > 1},
        ("t", "c"): {v: n for v, n in Counter(r[2] for r in values).items() if n > 1},
        ("u", "x"): {1: 2},
    }
    assert found["t", "a"] is None
    for key, df_ in found.items():
        got = {} if df_ is None else {r["value"]: r["n"] for r in df_.collect()}
        assert got == want[key], key
    assert {(c.column_name, c.failures) for c in unique_checks(df, "t", ["a", "b", "c"]).collect()} == {
        (c, len(want["t", c])) for c in "abc"
    }


def test_suspects_across_and_within_tasks(spark, monkeypatch):
    from remitlens.operators import uniqueness

    monkeypatch.setattr(uniqueness, "HELD", 50)  # several flushes of a task
    within = spark.range(200).selectExpr("id % 199 as v").coalesce(1)
    across = spark.range(200).selectExpr("id % 198 as v").repartition(8)
    found = suspects(spark, [(within, ("v",)), (across, ("v",)), (within.where("v < 0"), ("v",))])
    assert Counter(r["name"] for r in found.collect()) == {0: 1, 1: 2}


def test_no_key_is_shuffled_as_itself(spark):
    df = spark.createDataFrame([("a",), ("b",)], "key_text string")
    plan = suspects(spark, [(df, ("key_text",))])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.split("Exchange hashpartitioning(", 1)[1]
    assert plan.count("Exchange hashpartitioning(") == 1 and "MapInArrow" in exchange.split("Project", 1)[0]


# --- references -----------------------------------------------------------------


def test_tagged_references_count_like_anti_joins(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    one = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    two = spark.createDataFrame([("b",), ("y",), ("x",)], "k2 string")
    relations = [
        Relation(one, "k", parent, "id", "p"),
        Relation(two, "k2", parent, "id", "p"),
        Relation(one, "k", parent, "id", "p", null_is_unmatched=True),
        Relation(parent, "id", two, "k2", "q"),
    ]
    got = unmatched_counts(relations)
    assert tuple(got.first()) == (2, 2, 3, 1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {(r.key, r.n) for r in unmatched_keys(relations[0]).collect()} == {("x", 2)}
    none = parent.limit(0)
    assert tuple(unmatched_counts([Relation(one, "k", none, "id", "p"), Relation(none, "id", parent, "id", "p2")]).first()) == (3, 0)


def test_relationships_and_orphans_from_one_grouping(spark):
    m = Models(spark, raw_tables(spark, **FAULTY))
    checks, orphans = quality.references_and_orphans(m)
    assert counts(checks) == counts(quality.relationships_suite(m))
    assert orphans.first().orphan_claims == quality.orphan_claims(m.staged.claims, m.staged.encounters).first().orphan_claims == 1


# --- fingerprints ---------------------------------------------------------------


def test_fingerprint_tells_multisets_apart(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "v string")
    assert same_values(a, a.repartition(5).orderBy(F.col("v").desc()), "v")
    for other in ([("x",), ("y",), ("x",), (None,)], [("x",), ("y",), ("y",)], [("x",), ("y",), ("y",), ("z",)], [("x",)] * 2 + [("y",)] * 2):
        assert not same_values(a, spark.createDataFrame(other, "v string"), "v")
    assert same_values(a.limit(0), a.limit(0), "v")


def test_equal_tables_are_reconciled_without_a_join(spark):
    clean = Models(spark, raw_tables(spark))
    plan = quality.grain_checks(clean.checkpointed())._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and not any(counts(quality.grain_checks(clean)).values())
    lost = Models(spark, raw_tables(spark, raw_claims=[c if c[0] != "CLM2" else c[:2] + ("PAY9",) + c[3:] for c in CLAIMS], dim_payers=PAYERS + PAYERS[:1]))
    got = {k[0]: v for k, v in counts(quality.grain_checks(lost)).items() if v}
    assert got == {"one_fact_row_per_denial": 1, "fact_denial_once": 1}


# --- failing rows ------------------------------------------------------------------


def test_failing_rows_name_each_planted_fault(spark):
    m = Models(spark, raw_tables(spark, **FAULTY))
    got = rows(failing_rows(m, DOMAINS, sample=None))
    per_check = Counter(r[:3] for r in got)
    for (check, table, column), n in counts(quality.declared_suite(m, DOMAINS)).items():
        if check == "accepted_values":
            assert len({r[4] for r in got if r[:3] == (check, table, column)}) == n
        else:
            assert per_check[check, table, column] == n, (check, table, column)
    assert ("not_null", "stg_claims", "claim_id", None, None) in got
    assert ("unique", "stg_claims", "claim_id", "CLM1", "2 rows") in got
    assert ("relationships", "stg_claims", "payer_id", "CLM1", "PAY9") in got
    assert ("accepted_values", "stg_providers", "specialty", "PRV3", "Astrology") in got
    assert ("claim_date_is_encounter_date", "claims_with_denials", "claim_date", None, "2024-01-09") in got


def test_failing_rows_are_bounded_and_limited(spark):
    claims = [(f"C{i}", "ENC1", "PAY1", 1.0, 0.55, 0.0, "odd", "2024-01-01") for i in range(50)]
    m = Models(spark, raw_tables(spark, raw_claims=claims))
    odd = ("accepted_values", "stg_claims", "claim_status")
    got = rows(failing_rows(m, DOMAINS, sample=3, checks=[odd]))
    assert [r[3] for r in got] == ["C0", "C1", "C10"] and {r[:3] for r in got} == {odd}
    assert failing_rows(m, DOMAINS, checks=[]).count() == 0
    assert failing_rows(Models(spark, raw_tables(spark)), DOMAINS).count() == 0


def test_unmatched_keys_of_all_relations_from_one_grouping(spark):
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    one, two = spark.createDataFrame([("a",), ("x",), ("x",)], "k string"), spark.createDataFrame([("y",), ("x",)], "k2 string")
    asked = [Relation(one, "k", parent, "id", "p"), Relation(parent, "id", parent, "id", "p"), Relation(two, "k2", one, "k", "q")]
    first, second, third = unmatched_by_relation(asked)
    assert rows(first) == [("x", 2)] and second is None and rows(third) == [("y", 1)] and unmatched_by_relation([]) == []


def test_all_checks_read_each_raw_fact_once(spark, tmp_path, monkeypatch):
    """The failing rows of all checks equal those of unstored tables, and the
    raw encounters and denials are read once for them."""
    raw, read = raw_tables(spark, **FAULTY), spark.sparkContext.accumulator(0)

    def counted(x):
        read.add(1)
        return x

    once = F.udf(counted, "string").asNondeterministic()
    seen = {"raw_encounters": raw.table("raw_encounters").withColumn("encounter_id", once("encounter_id")), "raw_denials": raw.table("raw_denials").withColumn("denial_id", once("denial_id"))}
    n = sum(raw.table(t).count() for t in seen)
    monkeypatch.setattr(build_module, "ensure_checkpoint_dir", lambda _: str(tmp_path))
    got = rows(stored_failing_rows(Models(spark, RawTables(**(dict(raw.items()) | seen))), DOMAINS, sample=None))
    assert read.value == n and list(tmp_path.iterdir()) == []
    assert got == rows(failing_rows(Models(spark, raw), DOMAINS, sample=None))


# --- quarantine ------------------------------------------------------------------


def test_rows_that_do_not_cast_go_aside(spark, tmp_path):
    claims = CLAIMS + [
        ("CLM7", "ENC7", "PAY1", 10.0, 5.5, 5.5, "paid", "2024-13-45"),
        ("CLM8", "ENC8", "PAY1", 1e15, float("nan"), 5.5, "paid", "2024-01-05 9xyz"),
        ("CLM9", "ENC9", "PAY1", None, None, None, "paid", None),
    ]
    raw = raw_tables(spark, raw_claims=claims)
    staged, rejects = stage_with_quarantine(spark, raw, str(tmp_path / "q"))
    assert rows(rejects) == [
        ("stg_claims", "CLM7", "claim_date", "2024-13-45"),
        ("stg_claims", "CLM8", "allowed_amount", "NaN"),
        ("stg_claims", "CLM8", "billed_amount", "1.0E15"),
        ("stg_claims", "CLM8", "claim_date", "2024-01-05 9xyz"),
    ]
    assert sorted(r.claim_id for r in staged.claims.collect()) == ["CLM1", "CLM2", "CLM3", "CLM4", "CLM5", "CLM6", "CLM9"]
    clean = Models(spark, raw_tables(spark))
    for name in ("patients", "encounters", "denials", "reason_codes", "providers", "payers"):
        one, two = getattr(staged, name), getattr(clean.staged, name)
        assert one.dtypes == two.dtypes and rows(one) == rows(two), name
    report = {r.table_name: tuple(r)[1:] for r in quarantine_report(raw).collect()}
    assert report["stg_claims"] == (7, 2, 4) and report["stg_patients"] == (2, 0, 0) and len(report) == 7
    # only the good part of the files is read
    plan = staged.claims._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_rejected" in plan


def test_build_with_quarantine_loads_the_rest(spark, tmp_path):
    claims = CLAIMS + [("CLM7", "ENC7", "PAY1", 10.0, 5.5, 5.5, "paid", "soon")]
    raw = raw_tables(spark, raw_claims=claims)
    with pytest.raises(Exception, match="not a date"):
        run_build(spark, raw, str(tmp_path / "strict"))
    out = run_build(spark, raw, str(tmp_path / "lenient"), quarantine=True)
    assert rows(out.rejects) == [("stg_claims", "CLM7", "claim_date", "soon")]
    assert out.tables["claims_with_denials"].count() == 6 and out.checks.where("failures <> 0").count() == 0


# --- publishing --------------------------------------------------------------------


def test_a_failed_run_leaves_the_published_one(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    first = run_build(spark, raw_tables(spark), target)
    reader = read_published(spark, target, "denial_fact")
    before = rows(reader)
    assert read_published(spark, target, "claims_with_denials").schema == first.tables["claims_with_denials"].schema
    assert current_run(spark, target) == first.run and first.failing_rows.count() == 0
    monkeypatch.setattr(build_module, "failing_rows", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_build(spark, raw_tables(spark, raw_denials=DENIALS[:1]), target)
    monkeypatch.undo()
    assert current_run(spark, target) == first.run and rows(read_published(spark, target, "denial_fact")) == before
    assert len(list((tmp_path / "target" / RUNS).iterdir())) == 1  # the failed run is gone
    second = run_build(spark, raw_tables(spark, raw_denials=DENIALS[:1]), target, with_checks=False)
    assert read_published(spark, target, "denial_fact").count() == 1 and second.run != first.run
    assert rows(reader) == before  # who had the old run still reads it
    third = run_build(spark, raw_tables(spark), target, with_checks=False)
    kept = {p.name for p in (tmp_path / "target" / RUNS).iterdir()}
    assert kept == {second.run.rsplit("/", 1)[1], third.run.rsplit("/", 1)[1]}
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "none"), "denial_fact")


def test_catalog_names_switch_to_the_new_run(spark):
    spark.sql("create database if not exists switched")
    spark.range(3).write.mode("overwrite").saveAsTable("switched.denial_fact")  # of an earlier release
    run_build(spark, raw_tables(spark), "switched", as_tables=True)
    assert spark.table("switched.denial_fact").count() == 4 and spark.table("switched.checks").count() == 61
    other = spark.newSession()
    run_build(spark, raw_tables(spark, raw_denials=DENIALS[:1]), "switched", as_tables=True, with_checks=False)
    assert other.table("switched.denial_fact").count() == 1
    plan = other.table("switched.claims_with_denials").where("is_denied")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "is_denied" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


# --- stored views ---------------------------------------------------------------------


def test_stored_views_read_like_the_models(spark):
    from remitlens.plans.economics import CategoryAssumption
    from remitlens.sources.raw import read_catalog_tables
    from remitlens.sources.sinks import load_raw_tables

    load_raw_tables(spark, raw_tables(spark), "viewed_raw")
    names = create_views(spark, "viewed", "viewed_raw")
    assert len(names) == 8
    other, m = spark.newSession(), Models(spark, read_catalog_tables(spark, "viewed_raw"))
    for name in names:
        df = other.table(f"viewed.{name}")
        assert df.dtypes == m.model(name).dtypes and rows(df) == rows(m.model(name)), name
    own = CategoryAssumption("technical", *(__import__("decimal").Decimal(x) for x in ("0.5", "1")), True, __import__("decimal").Decimal("0.1"), "it's \\ tuned")
    create_views(spark, "viewed", "viewed_raw", (own,))
    got = {r.carc_code: (r.is_high_appeal_value, r.appeal_win_rate) for r in other.table("viewed.reason_economics").collect()}
    assert str(got["16"][1]) == "0.50" and got["11"] == (False, None)
    create_views(spark, "viewed", "viewed_raw", ())
    assert {r.appeal_win_rate for r in other.table("viewed.reason_economics").collect()} == {None}


# --- command line ---------------------------------------------------------------------


def test_command_line_parameters(spark, tmp_path):
    from remitlens.__main__ import main
    from remitlens.plans.economics import DEFAULT_ASSUMPTIONS
    from remitlens.sources.sinks import write_raw_tables

    raw = str(tmp_path / "raw")
    write_raw_tables(raw_tables(spark), raw)
    rules = [vars(a) | {"appeal_win_rate": 0.5, "category_multiplier": "1.00", "fix_probability": 0.1} for a in DEFAULT_ASSUMPTIONS]
    (tmp_path / "rules.json").write_text(json.dumps(rules, default=str))
    (tmp_path / "lists.json").write_text(json.dumps({"specialties": ["Cardiology"]}))
    source = ["--raw", raw]
    tuned = ["--assumptions", str(tmp_path / "rules.json")]
    shown = main(["run", "denial_fact", *source, *tuned])
    assert {str(r["recoverable_amount"]) for r in shown["rows"]} == {"50.00", "100.00", "150.00", "300.00"}
    assert len(main(["run", "fix_recommendations", *source, "--top-k", "2"])["rows"]) == 2
    main(["run", "stg_payers", *source, "--output", str(tmp_path / "payers")])
    assert spark.read.parquet(str(tmp_path / "payers")).count() == 2
    assert main(["check", "unique", *source]) == {"checks": 15, "failing_checks": []}
    assert main(["check", "stg_claims", *source])["checks"] == 4
    failing = main(["check", "accepted_values", *source, "--domains", str(tmp_path / "lists.json")])["failing_checks"]
    assert [(r["table_name"], r["failures"]) for r in failing] == [("stg_providers", 1)]
    report = main(["build", *source, *tuned, "--top-k", "1", "--domains", str(tmp_path / "lists.json"), "--target", str(tmp_path / "out")])
    assert report["rows"]["fix_recommendations"] == 1 and report["failing_rows"] == 1 and len(report["failing_checks"]) == 1
    for bad in (["check", "nothing", *source], ["run", "nothing", *source]):
        with pytest.raises(ValueError):
            main(bad)
    (tmp_path / "lists.json").write_text(json.dumps({"colours": []}))
    with pytest.raises(SystemExit):
        main(["check", "accepted_values", *source, "--domains", str(tmp_path / "lists.json")])
    (tmp_path / "rules.json").write_text(json.dumps([{"category": "x"}]))
    with pytest.raises(SystemExit):
        main(["run", "denial_fact", *source, *tuned])


def test_literal_checks_keep_their_order_and_types(spark):
    given = [("unique", "t", "a", 0), ("not_null", "u", "b", 7)]
    df = literal_checks(spark, given)
    assert [tuple(r) for r in df.collect()] == given and dict(df.dtypes)["failures"] == "bigint"
    assert literal_checks(spark, []).collect() == []
    both = df.unionByName(column_checks(spark.range(1), "r", ["id"]))
    assert both.count() == 3
