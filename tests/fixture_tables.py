"""Small hand-made raw tables for unit tests.

``raw_tables(spark, **overrides)`` gives a consistent seven-table fixture;
pass a list of tuples (in raw schema order) to replace any table.

Base fixture (all consistent, every check passes):

    providers  PRV1 Cardiology, PRV2 Orthopedics
    payers     PAY1 commercial, PAY2 medicare
    patients   PT1 commercial M, PT2 medicare F
    reasons    16 technical, 11 coding, 45 coverage, 50 medical_necessity
    claims     CLM1..CLM6, one encounter each (ENCn), claim date = encounter date
               CLM1 denied PAY1/PRV1 reason 16 billed 100.00
               CLM2 denied PAY1/PRV1 reason 11 billed 200.00
               CLM3 denied PAY2/PRV2 reason 50 billed 300.00
               CLM4 paid   PAY2/PRV2            billed 400.00 (allowed 220.00)
               CLM5 pending PAY1/PRV2           billed 500.00
               CLM6 denied PAY2/PRV1 reason 45 billed 600.00
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from remitlens.sources.raw import RawTables
from remitlens.sources.schemas import RAW_SCHEMAS

PATIENTS = [
    ("PT1", "Ann", "Lee", "1980-02-03", "M", "02110", "commercial"),
    ("PT2", "Bo", "Ng", "1975-12-31", "F", "10001", "medicare"),
]
PROVIDERS = [
    ("PRV1", "Dr One", "Cardiology", "0000000001", "East"),
    ("PRV2", "Dr Two", "Orthopedics", "0000000002", "West"),
]
PAYERS = [("PAY1", "Acme Health", "commercial"), ("PAY2", "Gov Care", "medicare")]
REASONS = [
    ("16", "Lacks information", "technical", 0.72, 1.0),
    ("11", "Diagnosis inconsistent", "coding", 0.68, 0.95),
    ("45", "Exceeds fee schedule", "coverage", 0.30, 0.50),
    ("50", "Not medically necessary", "medical_necessity", 0.18, 0.35),
]
ENCOUNTERS = [
    (f"ENC{i}", pt, prv, f"2024-01-0{i}", "99213", "Office visit", "office_visit", "I10")
    for i, pt, prv in [
        (1, "PT1", "PRV1"),
        (2, "PT1", "PRV1"),
        (3, "PT2", "PRV2"),
        (4, "PT2", "PRV2"),
        (5, "PT1", "PRV2"),
        (6, "PT2", "PRV1"),
    ]
]
CLAIMS = [
    ("CLM1", "ENC1", "PAY1", 100.0, 55.0, 0.0, "denied", "2024-01-01"),
    ("CLM2", "ENC2", "PAY1", 200.0, 110.0, 0.0, "denied", "2024-01-02"),
    ("CLM3", "ENC3", "PAY2", 300.0, 165.0, 0.0, "denied", "2024-01-03"),
    ("CLM4", "ENC4", "PAY2", 400.0, 220.0, 220.0, "paid", "2024-01-04"),
    ("CLM5", "ENC5", "PAY1", 500.0, 275.0, 0.0, "pending", "2024-01-05"),
    ("CLM6", "ENC6", "PAY2", 600.0, 330.0, 0.0, "denied", "2024-01-06"),
]
DENIALS = [
    ("DNL1", "CLM1", "16", "N130", "2024-01-11", "not_appealed"),
    ("DNL2", "CLM2", "11", "N657", "2024-01-12", "appeal_won"),
    ("DNL3", "CLM3", "50", "M76", "2024-01-13", "appeal_lost"),
    ("DNL6", "CLM6", "45", "N522", "2024-01-16", "appeal_pending"),
]


def raw_tables(spark: SparkSession, **overrides) -> RawTables:
    base = {
        "raw_patients": PATIENTS,
        "raw_encounters": ENCOUNTERS,
        "raw_claims": CLAIMS,
        "raw_denials": DENIALS,
        "dim_carc_codes": REASONS,
        "dim_providers": PROVIDERS,
        "dim_payers": PAYERS,
    }
    base.update(overrides)
    return RawTables(**{k: spark.createDataFrame(v, RAW_SCHEMAS[k]) for k, v in base.items()})
