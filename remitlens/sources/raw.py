"""Raw table bundle and readers (parquet scan with a declared schema)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from remitlens.sources.schemas import RAW_SCHEMAS

TABLE_NAMES: tuple[str, ...] = tuple(RAW_SCHEMAS)


class RawTables:
    """The seven source tables of the domain, as lazy DataFrames.

    Attributes are the upstream table names; ``table(name)`` resolves a
    source reference by that name. A table may be given as a function without
    arguments: it is called when the table is first asked for, so a job that
    needs two tables plans two.
    """

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]):
        if set(tables) != set(TABLE_NAMES):
            raise ValueError(f"expected the tables {sorted(TABLE_NAMES)}, got {sorted(tables)}")
        self._tables = dict(tables)

    def table(self, name: str) -> DataFrame:
        given = self._tables[name]
        if callable(given):
            given = self._tables[name] = given()
        return given

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.table(name)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, self.table(name)) for name in TABLE_NAMES]


def read_raw_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Parquet scan with the declared raw schema: no inference pass over the
    files, and column pruning / filter pushdown reach the scan."""
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(path)


def read_raw_tables(spark: SparkSession, root: str) -> RawTables:
    """Read ``<root>/<table>.parquet`` (file or folder) for all seven tables."""
    return RawTables(
        **{name: lambda n=name: read_raw_table(spark, os.path.join(root, f"{n}.parquet"), n) for name in TABLE_NAMES}
    )


def read_catalog_tables(spark: SparkSession, database: str) -> RawTables:
    """The seven raw tables from catalog ``database`` (bucketing is kept)."""
    return RawTables(**{name: lambda n=name: spark.table(f"`{database}`.`{n}`") for name in TABLE_NAMES})


def register_raw_views(raw: RawTables) -> None:
    """Expose the raw tables to SQL under their upstream names."""
    for name, df in raw.items():
        df.createOrReplaceTempView(name)
