"""Sources and sinks: raw readers, full-refresh writes, namespaces, load report."""

from __future__ import annotations

from remitlens.sources.raw import read_raw_tables, register_raw_views
from remitlens.sources.sinks import (
    create_namespace,
    load_report,
    materialize,
    save_table,
    write_parquet,
    write_raw_tables,
)
from tests.fixture_tables import raw_tables


def test_raw_round_trip_and_load_report(spark, tmp_path):
    raw = raw_tables(spark)
    root = str(tmp_path / "raw")
    write_raw_tables(raw, root)
    back = read_raw_tables(spark, root)
    got = {r.table_name: r.row_count for r in load_report(back).collect()}
    assert got == {
        "raw_patients": 2, "raw_encounters": 6, "raw_claims": 6, "raw_denials": 4,
        "dim_carc_codes": 4, "dim_providers": 2, "dim_payers": 2,
    }
    assert back.raw_claims.schema == raw.raw_claims.schema


def test_full_refresh_is_idempotent(spark, tmp_path):
    raw = raw_tables(spark)
    path = str(tmp_path / "claims")
    write_parquet(raw.raw_claims, path)
    write_parquet(raw.raw_claims, path)
    assert spark.read.parquet(path).count() == 6


def test_save_table_overwrite_and_namespace(spark):
    create_namespace(spark, "marts_test")
    create_namespace(spark, "marts_test")  # idempotent
    raw = raw_tables(spark)
    save_table(raw.raw_claims, "marts_test.claims")
    save_table(raw.raw_claims.limit(2), "marts_test.claims")
    assert spark.table("marts_test.claims").count() == 2


def test_save_table_bucketed(spark):
    raw = raw_tables(spark)
    save_table(raw.raw_claims, "claims_bucketed", bucket_by=(4, ["claim_id"]))
    desc = {r.col_name: r.data_type for r in spark.sql("describe extended claims_bucketed").collect()}
    assert desc.get("Num Buckets") == "4"


def test_materialize_cuts_lineage(spark, tmp_path):
    raw = raw_tables(spark)
    df = materialize(spark, raw.raw_denials, str(tmp_path / "d"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "LogicalRDD" not in plan and "parquet" in plan.lower()
    assert df.count() == 4


def test_register_raw_views(spark):
    register_raw_views(raw_tables(spark))
    assert spark.sql("select count(*) from raw_claims").first()[0] == 6


def test_scalar_value_guards(spark):
    import pytest

    from remitlens.sources.sinks import scalar_value

    assert scalar_value(spark.range(5).selectExpr("count(*) as n")) == 5
    with pytest.raises(ValueError):
        scalar_value(spark.range(5))


def test_save_table_partitioned(spark):
    raw = raw_tables(spark)
    save_table(raw.raw_claims, "claims_by_status", partition_by=["status"])
    t = spark.table("claims_by_status")
    assert t.count() == 6
    plan = t.filter("status = 'denied'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan


def test_external_location_survives_a_forgotten_catalog_entry(spark, tmp_path):
    from remitlens.sources.sinks import load_raw_tables

    raw = raw_tables(spark)
    where = str(tmp_path / "ext")
    load_raw_tables(spark, raw, "ext_raw", buckets=2, location=where)
    # the catalog forgets the tables (as a new local session would); files stay
    for name, _ in raw.items():
        spark.sql(f"drop table ext_raw.{name}")
    load_raw_tables(spark, raw, "ext_raw", buckets=2, location=where)
    assert spark.table("ext_raw.raw_claims").count() == 6
