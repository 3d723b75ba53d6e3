"""Schemas of the seven raw tables and of the driver's test tables.

Raw layer as written by upstream systems: identifiers and codes are text,
dates are ISO text, money is double. Staging casts them (see plans.staging).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


RAW_PATIENTS = StructType(
    _strings("patient_id", "first_name", "last_name", "dob", "gender", "zip", "insurance_type")
)

RAW_ENCOUNTERS = StructType(
    _strings(
        "encounter_id",
        "patient_id",
        "provider_id",
        "encounter_date",
        "procedure_code",
        "procedure_desc",
        "procedure_category",
        "diagnosis_code",
    )
)

RAW_CLAIMS = StructType(
    _strings("claim_id", "encounter_id", "payer_id")
    + [
        StructField("billed_amount", DoubleType()),
        StructField("allowed_amount", DoubleType()),
        StructField("paid_amount", DoubleType()),
    ]
    + _strings("status", "claim_date")
)

RAW_DENIALS = StructType(
    _strings("denial_id", "claim_id", "carc_code", "rarc_code", "denial_date", "appeal_status")
)

DIM_REASON_CODES = StructType(
    _strings("carc_code", "description", "category")
    + [
        StructField("appeal_win_rate", DoubleType()),
        StructField("category_multiplier", DoubleType()),
    ]
)

DIM_PROVIDERS = StructType(_strings("provider_id", "provider_name", "specialty", "npi", "region"))

DIM_PAYERS = StructType(_strings("payer_id", "payer_name", "payer_type"))

# Raw table name -> schema. Names are the file/table names upstream uses.
RAW_SCHEMAS: dict[str, StructType] = {
    "raw_patients": RAW_PATIENTS,
    "raw_encounters": RAW_ENCOUNTERS,
    "raw_claims": RAW_CLAIMS,
    "raw_denials": RAW_DENIALS,
    "dim_carc_codes": DIM_REASON_CODES,
    "dim_providers": DIM_PROVIDERS,
    "dim_payers": DIM_PAYERS,
}

# --- driver test tables (only the ones the mapping reads) -------------------

TD_REGION = StructType([StructField("r_regionkey", IntegerType()), StructField("r_name", StringType())])

TD_NATION = StructType(
    [
        StructField("n_nationkey", IntegerType()),
        StructField("n_name", StringType()),
        StructField("n_regionkey", IntegerType()),
    ]
)

TD_CUSTOMER = StructType(
    [
        StructField("c_custkey", LongType()),
        StructField("c_name", StringType()),
        StructField("c_nationkey", IntegerType()),
        StructField("c_acctbal", DoubleType()),
        StructField("c_mktsegment", StringType()),
    ]
)

TD_SUPPLIER = StructType(
    [
        StructField("s_suppkey", LongType()),
        StructField("s_name", StringType()),
        StructField("s_nationkey", IntegerType()),
        StructField("s_acctbal", DoubleType()),
    ]
)

TD_PART = StructType(
    [
        StructField("p_partkey", LongType()),
        StructField("p_name", StringType()),
        StructField("p_brand", StringType()),
        StructField("p_type", StringType()),
        StructField("p_size", IntegerType()),
        StructField("p_retailprice", DoubleType()),
    ]
)

TD_ORDERS = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
        StructField("o_orderdate", TimestampNTZType()),
        StructField("o_orderpriority", StringType()),
    ]
)

TD_LINEITEM = StructType(
    [
        StructField("l_orderkey", LongType()),
        StructField("l_partkey", LongType()),
        StructField("l_suppkey", LongType()),
        StructField("l_linenumber", IntegerType()),
        StructField("l_quantity", DoubleType()),
        StructField("l_extendedprice", DoubleType()),
        StructField("l_discount", DoubleType()),
        StructField("l_tax", DoubleType()),
        StructField("l_returnflag", StringType()),
        StructField("l_linestatus", StringType()),
        StructField("l_shipdate", TimestampNTZType()),
    ]
)

TESTDATA_SCHEMAS: dict[str, StructType] = {
    "region": TD_REGION,
    "nation": TD_NATION,
    "customer": TD_CUSTOMER,
    "supplier": TD_SUPPLIER,
    "part": TD_PART,
    "orders": TD_ORDERS,
    "lineitem": TD_LINEITEM,
}
