"""Lenient staging: rows with values that do not fit go aside, the others load.

The strict mode (``plans.staging``) fails a run at the first bad date or amount.
Here each raw row is cast once with ``try_cast``; a row with a value that is
lost by its cast is rejected, with the columns and texts at fault. One pass
writes both kinds, apart by the partition column ``is_rejected``, so the good
rows and the rejects are each read without the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.plans.staging import PROJECTIONS, Staged, cast_sql, quoted
from remitlens.sources.raw import RawTables
from remitlens.sources.sinks import write_parquet

#: Column that names a row of a staged table in the rejects: its first.
REJECTS = "array<struct<column_name: string, value: string>>"


def lenient(table: str, raw: DataFrame) -> DataFrame:
    """The staged columns of all rows, ``rejects`` (columns and texts that did
    not fit) and ``is_rejected``. Values that do not fit are NULL."""
    types = dict(raw.dtypes)
    columns, faults = [], []
    for f in PROJECTIONS[table][1]:
        cast = cast_sql(f, types[f.source], lenient=True)
        columns.append(f"{cast} as {quoted(f.name)}")
        if f.kind != "as is":
            at_fault = f"{quoted(f.source)} is not null and {cast} is null"
            faults.append(f"case when {at_fault} then named_struct('column_name', '{f.name}', 'value', cast({quoted(f.source)} as string)) end")
    found = f"filter(array({', '.join(faults)}), x -> x is not null)" if faults else f"cast(array() as {REJECTS})"
    return raw.selectExpr(*columns, f"{found} as rejects").withColumn("is_rejected", F.size("rejects") > 0)


def _stored(spark: SparkSession, target: str, table: str, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of one table, written in one pass."""
    rows = lenient(table, raw)
    path = f"{target.rstrip('/')}/{table}"
    write_parquet(rows, path, partition_by=["is_rejected"])
    names = [f.name for f in PROJECTIONS[table][1]]
    back = spark.read.schema(rows.schema).parquet(path)
    good = back.where(~F.col("is_rejected")).select(*names)
    bad = back.where(F.col("is_rejected")).select(
        F.lit(table).alias("table_name"), F.col(names[0]).cast("string").alias("row_key"), F.inline("rejects")
    )
    return good, bad


def stage_with_quarantine(spark: SparkSession, raw: RawTables, target: str) -> tuple[Staged, DataFrame]:
    """Stage all seven tables into the folder ``target``: the staged tables of
    the good rows, and the rejects (table_name, row_key, column_name, value)."""
    good, rejects = {}, None
    for table, (source, _) in PROJECTIONS.items():
        kept, bad = _stored(spark, target, table, raw.table(source))
        good[table.removeprefix("stg_")] = kept
        rejects = bad if rejects is None else rejects.unionByName(bad)
    return Staged(raw, **good), rejects


def quarantine_report(raw: RawTables) -> DataFrame:
    """Rows that load and rows that would be rejected, by staged table: one
    pass of each raw table, nothing is written."""
    out = None
    for table, (source, _) in PROJECTIONS.items():
        counts = lenient(table, raw.table(source)).agg(
            F.count_if(~F.col("is_rejected")).cast("bigint").alias("good_rows"),
            F.count_if("is_rejected").cast("bigint").alias("rejected_rows"),
            F.coalesce(F.sum(F.size("rejects")), F.lit(0)).cast("bigint").alias("rejected_values"),
        )
        own = counts.select(F.lit(table).alias("table_name"), "good_rows", "rejected_rows", "rejected_values")
        out = own if out is None else out.unionByName(own)
    return out
