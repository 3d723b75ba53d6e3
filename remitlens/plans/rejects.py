"""Failing rows of the checks: which check, which row, which value.

The rows of a table are looked at once for all its checks of single rows: a row
that fails some is exploded into one row per failure, a good row into none.
Repeated and unmatched values come from the two-round unique check and the
tagged grouping. A bounded number per check is kept, the smallest by key and
value, cut down by each task before it is sent (a window over the rank).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.operators.references import unmatched_by_relation
from remitlens.plans.models import Models
from remitlens.plans.quality import RELATIONSHIPS, ROW_KEY, Domains, relations, repeated_keys, row_checks

SCHEMA = "check_name string, table_name string, column_name string, row_key string, value string"
#: Rows kept of each check.
SAMPLE = 100

Check = tuple[str, str, str]


def _of_rows(m: Models, domains: Domains, wanted: set[Check] | None) -> list[DataFrame]:
    parts = []
    for table, checks in row_checks(domains).items():
        own = [c for c in checks if wanted is None or (c.check, table, c.column) in wanted]
        if not own:
            continue
        faults = F.array(
            *[
                F.when(c.failing, F.struct(F.lit(c.check).alias("check_name"), F.lit(c.column).alias("column_name"), F.col(c.column).cast("string").alias("value")))
                for c in own
            ]
        )
        found = m.model(table).select(F.col(ROW_KEY[table]).cast("string").alias("row_key"), F.explode(F.filter(faults, lambda x: x.isNotNull())).alias("x"))
        parts.append(found.select("x.check_name", F.lit(table).alias("table_name"), "x.column_name", "row_key", "x.value"))
    return parts


def _of_keys(m: Models, wanted: set[Check] | None) -> list[DataFrame]:
    parts = []
    unique = None if wanted is None else {(t, c) for k, t, c in wanted if k == "unique"}
    if unique is None or unique:
        for (t, c), df in repeated_keys(m).items():
            if df is not None and (unique is None or (t, c) in unique):
                row = (F.lit("unique").alias("check_name"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"))
                parts.append(df.select(*row, F.col("value").cast("string").alias("row_key"), F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("value")))
    asked = [(t, c, r) for (t, c, _, _), r in zip(RELATIONSHIPS, relations(m), strict=True) if wanted is None or ("relationships", t, c) in wanted]
    for (t, c, relation), keys in zip(asked, unmatched_by_relation([r for _, _, r in asked]), strict=True):
        if keys is not None:
            missing = keys.select(F.col("key").alias("missing"))
            rows = relation.child.select(F.col(ROW_KEY[t]).cast("string").alias("row_key"), F.col(c).cast("string").alias("value"))
            row = (F.lit("relationships").alias("check_name"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"))
            parts.append(rows.join(missing, F.col("value") == F.col("missing"), "left_semi").select(*row, "row_key", "value"))
    return parts


def failing_rows(m: Models, domains: Domains, sample: int | None = SAMPLE, checks: Iterable[Check] | None = None) -> DataFrame:
    """(check_name, table_name, column_name, row_key, value) of failing rows.

    ``row_key`` names the row (the table's key column; the repeated value of a
    unique check, whose ``value`` is its number of rows), ``value`` is what the
    checked column holds. ``sample`` rows of each check at most, None for all.
    ``checks`` limits the work to the named ones, such as those that failed.
    """
    wanted = None if checks is None else set(checks)
    parts = [] if wanted is not None and not wanted else _of_rows(m, domains, wanted) + _of_keys(m, wanted)
    if not parts:
        return m.spark.createDataFrame([], SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if sample is None:
        return out
    order = Window.partitionBy("check_name", "table_name", "column_name").orderBy(F.col("row_key").asc_nulls_first(), F.col("value").asc_nulls_first())
    return out.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample).drop("place")
