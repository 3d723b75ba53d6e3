"""Derive the seven raw tables from the driver's TPC-H-style test tables.

The claim is an order (``o_orderkey`` is unique; line numbers repeat), the
encounter is the order's line summary, the provider is a supplier, the payer
and the patient are a customer, the reason code is a part brand. Everything is
a lazy Spark plan over the given parquet files, so the work grows with them.

Plan notes for large inputs: the only wide step is the per-order line summary
(one aggregation of ``lineitem`` on ``l_orderkey``, map-side combined); the
order join reuses that partitioning, the part lookup joins on the summary's
part key, and the tiny nation / region tables are broadcast by size.
"""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.plans.economics import DEFAULT_ASSUMPTIONS
from remitlens.sources.raw import RawTables
from remitlens.sources.schemas import TESTDATA_SCHEMAS

# Fixed values of the mapping (must match the documented test mapping).
ORDER_STATUS_TO_CLAIM_STATUS = {"F": "denied", "O": "paid", "P": "pending"}
PRIORITY_TO_APPEAL_STATUS = {
    "1-URGENT": "appeal_won",
    "2-HIGH": "appeal_lost",
    "3-MEDIUM": "appeal_pending",
}
OTHER_APPEAL_STATUS = "not_appealed"
# Reason category by brand number modulo 4.
BRAND_CATEGORY_BY_REMAINDER = ["technical", "coding", "coverage", "medical_necessity"]
ALLOWED_SHARE = Decimal("0.55")
DOB_BASE = "1930-01-01"
DOB_SPAN_DAYS = 30000
DENIAL_LAG_BASE_DAYS = 7
DENIAL_LAG_SPREAD_DAYS = 28
PATIENT_OVERRIDE_SEGMENT = "BUILDING"  # insurance type when c_custkey % 10 = 0


def read_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TESTDATA_SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _id(prefix: str, key: str) -> str:
    return f"concat('{prefix}', cast({key} as string))"


def _iso_date(ts: str) -> str:
    return f"cast(cast({ts} as date) as string)"


def _map_values(x: str, mapping: dict, default: str | None = None) -> str:
    """SQL that maps the values of ``x`` to literals."""
    text = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    cases = " ".join(f"when {x} = {text(k)} then {text(v)}" for k, v in mapping.items())
    return f"case {cases}{f' else {text(default)}' if default is not None else ''} end"


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has lines: smallest supplier and part key."""
    return (
        read_testdata(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("line_suppkey"), F.min("l_partkey").alias("line_partkey"))
    )


def _orders_with_lines(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    lines = _order_lines(spark, sf_dir).withColumnsRenamed({"l_orderkey": "o_orderkey", "line_partkey": "p_partkey"})
    return orders.join(lines, "o_orderkey").join(read_testdata(spark, sf_dir, "part"), "p_partkey")


def raw_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_testdata(spark, sf_dir, "customer").selectExpr(
        f"{_id('PT', 'c_custkey')} as patient_id",
        "c_name as first_name",
        "c_name as last_name",
        f"cast(date_add(date '{DOB_BASE}', cast(c_custkey % {DOB_SPAN_DAYS} as int)) as string) as dob",
        "case when c_custkey % 2 = 0 then 'M' else 'F' end as gender",
        "lpad(cast(c_custkey as string), 5, '0') as zip",
        f"case when c_custkey % 10 = 0 then '{PATIENT_OVERRIDE_SEGMENT}' else c_mktsegment end as insurance_type",
    )


def raw_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_lines(spark, sf_dir, read_testdata(spark, sf_dir, "orders")).selectExpr(
        f"{_id('ENC', 'o_orderkey')} as encounter_id",
        f"{_id('PT', 'o_custkey')} as patient_id",
        f"{_id('PRV', 'line_suppkey')} as provider_id",
        f"{_iso_date('o_orderdate')} as encounter_date",
        "cast(p_partkey as string) as procedure_code",
        "p_name as procedure_desc",
        "p_type as procedure_category",
        "cast(p_size as string) as diagnosis_code",
    )


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = _map_values("o_orderstatus", ORDER_STATUS_TO_CLAIM_STATUS)
    allowed = f"cast(cast(o_totalprice as decimal(12,2)) * {ALLOWED_SHARE}BD as decimal(12,2))"
    return read_testdata(spark, sf_dir, "orders").selectExpr(
        f"{_id('CLM', 'o_orderkey')} as claim_id",
        f"{_id('ENC', 'o_orderkey')} as encounter_id",
        f"{_id('PAY', 'o_custkey')} as payer_id",
        "o_totalprice as billed_amount",
        f"cast({allowed} as double) as allowed_amount",
        f"cast(case when {status} = 'paid' then {allowed} else 0.00BD end as double) as paid_amount",
        f"{status} as status",
        f"{_iso_date('o_orderdate')} as claim_date",
    )


def raw_denials(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_testdata(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    lag = f"{DENIAL_LAG_BASE_DAYS} + cast(o_orderkey % {DENIAL_LAG_SPREAD_DAYS} as int)"
    return _orders_with_lines(spark, sf_dir, orders).selectExpr(
        f"{_id('DNL', 'o_orderkey')} as denial_id",
        f"{_id('CLM', 'o_orderkey')} as claim_id",
        "p_brand as carc_code",
        f"{_id('N', 'o_orderkey % 10')} as rarc_code",
        f"cast(date_add(cast(o_orderdate as date), {lag}) as string) as denial_date",
        f"{_map_values('o_orderpriority', PRIORITY_TO_APPEAL_STATUS, OTHER_APPEAL_STATUS)} as appeal_status",
    )


def dim_carc_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = read_testdata(spark, sf_dir, "part").select(F.col("p_brand").alias("carc_code")).distinct()
    remainder = f"cast(substring_index(carc_code, '#', -1) as int) % {len(BRAND_CATEGORY_BY_REMAINDER)}"
    rates = {a.category: a for a in DEFAULT_ASSUMPTIONS}
    win = {i: float(rates[c].appeal_win_rate) for i, c in enumerate(BRAND_CATEGORY_BY_REMAINDER)}
    mult = {i: float(rates[c].category_multiplier) for i, c in enumerate(BRAND_CATEGORY_BY_REMAINDER)}
    return brands.selectExpr(
        "carc_code",
        "concat('Reason ', carc_code) as description",
        f"{_map_values(remainder, dict(enumerate(BRAND_CATEGORY_BY_REMAINDER)))} as category",
        f"cast({_map_values(remainder, win)} as double) as appeal_win_rate",
        f"cast({_map_values(remainder, mult)} as double) as category_multiplier",
    )


def dim_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_testdata(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    n = read_testdata(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return s.join(n, "n_nationkey").join(read_testdata(spark, sf_dir, "region"), "r_regionkey").selectExpr(
        f"{_id('PRV', 's_suppkey')} as provider_id",
        "s_name as provider_name",
        "n_name as specialty",
        "lpad(cast(s_suppkey as string), 10, '0') as npi",
        "r_name as region",
    )


def dim_payers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_testdata(spark, sf_dir, "customer").selectExpr(
        f"{_id('PAY', 'c_custkey')} as payer_id", "c_name as payer_name", "c_mktsegment as payer_type"
    )


def raw_tables_from_testdata(spark: SparkSession, sf_dir: str) -> RawTables:
    makers = (raw_patients, raw_encounters, raw_claims, raw_denials, dim_carc_codes, dim_providers, dim_payers)
    return RawTables(**{make.__name__: lambda make=make: make(spark, sf_dir) for make in makers})


# Domain lists of the test mapping, for the accepted-values checks
# (the test data has other payer segments and specialties than a clinic).
TESTDATA_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
TESTDATA_SPECIALTIES = [f"NATION_{i}" for i in range(25)]
