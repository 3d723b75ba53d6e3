"""Permanent views of the staging and economics layers in a catalog.

Staging and the economics per reason code are not stored: they are views over
the loaded raw tables, of the same SQL text as the staged DataFrames, so any
session of the catalog reads them, computed when read. Replacing a view is one
step of the catalog; building them runs no job.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from remitlens.plans.economics import DEFAULT_ASSUMPTIONS, RATE, CategoryAssumption, assumptions_values
from remitlens.plans.staging import PROJECTIONS, quoted, stage_sql
from remitlens.sources.raw import read_catalog_tables
from remitlens.sources.sinks import create_namespace


def economics_sql(reasons: str, assumptions: tuple[CategoryAssumption, ...] = DEFAULT_ASSUMPTIONS) -> str:
    """The economics per reason code over the relation ``reasons``; a category
    without assumptions has NULL rates and the flag false."""
    rate = RATE.simpleString()
    if not assumptions:
        rates = f"false as is_high_appeal_value, cast(null as {rate}) as appeal_win_rate, cast(null as {rate}) as category_multiplier"
        return f"select carc_code, carc_description, carc_category, {rates} from {reasons}"
    return (
        "select r.carc_code, r.carc_description, r.carc_category, coalesce(a.high_appeal_value, false) as is_high_appeal_value, "
        f"a.appeal_win_rate, a.category_multiplier from {reasons} as r left join {assumptions_values(assumptions)} on a.category = r.carc_category"
    )


def create_views(
    spark: SparkSession,
    database: str,
    raw_database: str,
    assumptions: tuple[CategoryAssumption, ...] = DEFAULT_ASSUMPTIONS,
) -> list[str]:
    """Create or replace ``stg_*`` and ``reason_economics`` in ``database``,
    over the raw tables of ``raw_database``; returns their names."""
    create_namespace(spark, database)
    raw = read_catalog_tables(spark, raw_database)
    texts = {
        table: f"select {', '.join(stage_sql(table, dict(raw.table(source).dtypes)))} from {quoted(raw_database)}.{quoted(source)}"
        for table, (source, _) in PROJECTIONS.items()
    }
    texts["reason_economics"] = economics_sql(f"{quoted(database)}.stg_reason_codes", assumptions)
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(database)}.{quoted(name)} AS {text}")
    return list(texts)
