"""Publishing by a switch: results appear whole, or not at all.

A run writes its tables into a folder of its own, ``<root>/_runs/<run>/<table>``.
Only when all are written does the pointer ``<root>/_current`` name the new run:
a small file, written aside and renamed over the old one in one step. A reader
that resolved the old run goes on reading its files, which stay until the run
after the next; a run that fails leaves the pointer, and so every reader, where
they were.

In a catalog the tables of a run are views over its folder, replaced one by one
after the last write: each replacement is one step of the catalog.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from remitlens.sources.sinks import create_namespace

POINTER = "_current"
RUNS = "_runs"
#: File of a run that holds the schemas of its tables (a partition column's type
#: cannot be read from its folder names).
SCHEMAS = "_schemas.json"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def new_run(root: str) -> str:
    """The folder of a new run under ``root``."""
    return f"{root.rstrip('/')}/{RUNS}/{uuid.uuid4().hex}"


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs = _filesystem(spark, path)
    if not fs.exists(_path(spark, path)):
        return None
    stream = fs.open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    out = _filesystem(spark, path).create(_path(spark, path), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def current_run(spark: SparkSession, root: str) -> str | None:
    """The folder of the published run, or None before the first."""
    name = _read_text(spark, f"{root.rstrip('/')}/{POINTER}")
    return f"{root.rstrip('/')}/{RUNS}/{name.strip()}" if name else None


def publish(spark: SparkSession, root: str, run: str, tables: Mapping[str, DataFrame]) -> None:
    """Make ``run`` with its ``tables`` the current run of ``root``, then delete
    runs that no reader of the last pointer can have."""
    before = current_run(spark, root)
    _write_text(spark, f"{run}/{SCHEMAS}", json.dumps({name: df.schema.jsonValue() for name, df in tables.items()}))
    pointer = f"{root.rstrip('/')}/{POINTER}"
    aside = f"{pointer}-{uuid.uuid4().hex}"
    _write_text(spark, aside, run.rstrip("/").rsplit("/", 1)[1])
    fs, hadoop = _filesystem(spark, pointer), spark._jvm.org.apache.hadoop.fs
    # a rename that replaces its target in one step
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, aside), _path(spark, pointer), options)
    _forget(spark, root, [r for r in (run, before) if r])


def _forget(spark: SparkSession, root: str, keep: Iterable[str]) -> None:
    names = {r.rstrip("/").rsplit("/", 1)[1] for r in keep}
    folder = f"{root.rstrip('/')}/{RUNS}"
    fs = _filesystem(spark, folder)
    for status in fs.listStatus(_path(spark, folder)):
        if status.getPath().getName() not in names:
            fs.delete(status.getPath(), True)


def discard(spark: SparkSession, run: str) -> None:
    """Delete what a failed run wrote."""
    _filesystem(spark, run).delete(_path(spark, run), True)


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the published run, with the schema it was written with."""
    run = current_run(spark, root)
    if run is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    schema = StructType.fromJson(json.loads(_read_text(spark, f"{run}/{SCHEMAS}"))[table])
    # partition columns come back last
    return spark.read.schema(schema).parquet(f"{run}/{table}").select(*schema.names)


def database_folder(spark: SparkSession, database: str) -> str:
    """Where the tables of a catalog database lie."""
    create_namespace(spark, database)
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def publish_views(spark: SparkSession, database: str, run: str, tables: Mapping[str, DataFrame]) -> None:
    """Point the names of a database to the tables of a run, typed as they were
    written. A table that an earlier release stored under a name makes room."""
    for table, df in tables.items():
        full = f"`{database}`.`{table}`"
        if spark.catalog.tableExists(f"{database}.{table}") and spark.catalog.getTable(f"{database}.{table}").tableType != "VIEW":
            spark.sql(f"DROP TABLE {full}")
        listed = ", ".join(f"cast(`{c}` as {kind}) as `{c}`" for c, kind in df.dtypes)
        spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT {listed} FROM parquet.`{run}/{table}`")
