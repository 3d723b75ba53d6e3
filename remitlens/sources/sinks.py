"""Sinks: full-refresh tables and parquet, namespaces, the load report.

Full refresh is idempotent: every write replaces the previous contents, so a
re-run after a failure (or a lost executor) leaves the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.sources.raw import RawTables


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def save_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Replace the catalog table ``name`` with ``df``.

    ``bucket_by=(n, cols)`` stores the table hash-bucketed (and sorted) on
    ``cols``, so later joins or aggregations on those keys read it without a
    shuffle. ``location`` stores it as an external table in that folder,
    which is overwritten as well (a managed table's folder that outlived its
    catalog entry would make the write fail).
    """
    w = df.write.mode("overwrite").format(fmt)
    if location:
        w = w.option("path", location)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by is not None:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(name)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the parquet folder at ``path`` with ``df``."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def materialize(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to ``path`` and return a DataFrame reading it back.

    Used to cut lineage on a shared folder: consumers read the files, so a
    lost executor costs a re-read, not a recomputation of the whole plan.
    """
    write_parquet(df, path, partition_by)
    back = spark.read.schema(df.schema).parquet(path)
    # partition columns come back last; restore the original column order
    return back.select(*df.columns) if partition_by else back


def scalar_value(df: DataFrame):
    """The single value of a one-row, one-column result (e.g. a global count).

    Refuses anything else, so it can never pull a table to the driver.
    """
    if len(df.columns) != 1:
        raise ValueError(f"expected one column, got {df.columns}")
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one row, got {len(rows)}")
    return rows[0][0]


def write_raw_tables(raw: RawTables, root: str) -> None:
    """Write the seven raw tables as ``<root>/<name>.parquet`` folders."""
    for name, df in raw.items():
        write_parquet(df, f"{root}/{name}.parquet")


# Join key each raw fact table is bucketed on by ``load_raw_tables``: claims and
# denials share ``claim_id`` (same bucket count, so they join without a
# shuffle); encounters are bucketed on the key the claims join them by.
FACT_BUCKET_KEYS = {
    "raw_claims": "claim_id",
    "raw_denials": "claim_id",
    "raw_encounters": "encounter_id",
}


def load_raw_tables(
    spark: SparkSession,
    raw: RawTables,
    database: str,
    buckets: int | None = None,
    location: str | None = None,
) -> None:
    """Full-refresh load of the seven raw tables into catalog ``database``.

    With ``buckets`` the three fact tables are stored hash-bucketed (and
    sorted) on their join keys: the load pays one shuffle per fact table once,
    and every later run joins claims to denials without a shuffle and reads
    encounters without one. Dimensions are stored as they are. With
    ``location`` the tables are external tables in ``<location>/<name>``.
    """
    create_namespace(spark, database)
    for name, df in raw.items():
        key = FACT_BUCKET_KEYS.get(name)
        bucket_by = (buckets, [key]) if buckets and key else None
        path = f"{location}/{name}" if location else None
        save_table(df, f"{database}.{name}", bucket_by=bucket_by, location=path)


def load_report(raw: RawTables) -> DataFrame:
    """Rows per raw table: one count per table, stacked (table_name, row_count)."""
    parts = [
        df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in raw.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
