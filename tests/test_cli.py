"""The command line runs load and build end to end on the fixture."""

from __future__ import annotations

from remitlens.__main__ import main
from remitlens.sources.sinks import write_raw_tables
from tests.fixture_tables import CLAIMS, raw_tables


def test_cli_load_and_build(spark, tmp_path):
    claims = CLAIMS + [("CLM9", "ENC_X", "PAY1", 1.0, 0.55, 0.55, "paid", "2024-01-09")]
    root = str(tmp_path / "raw")
    write_raw_tables(raw_tables(spark, raw_claims=claims), root)

    loaded = main(["load", "--raw", root, "--database", "cli_raw"])
    assert loaded["rows"]["raw_claims"] == 7 and loaded["orphan_claims"] == 1

    built = main(["build", "--raw", root, "--target", str(tmp_path / "marts")])
    assert built["rows"]["denial_fact"] == 4 and built["rows"]["fix_recommendations"] == 4
    assert built["checks"] == 61
    assert {(c["check_name"], c["column_name"]) for c in built["failing_checks"]} == {
        ("relationships", "encounter_id"),
        ("claims_preserved", "claim_id"),
    }


def test_cli_bucketed_load_then_build_from_catalog(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_raw_tables(raw_tables(spark), root)
    main(["load", "--raw", root, "--database", "cli_bucketed", "--buckets", "4"])
    desc = {r.col_name: r.data_type for r in spark.sql("describe extended cli_bucketed.raw_claims").collect()}
    assert desc.get("Num Buckets") == "4"
    built = main(["build", "--database", "cli_bucketed", "--target", str(tmp_path / "m"), "--no-checks"])
    assert built["rows"]["denial_fact"] == 4
