"""Declarative table checks as Spark aggregates.

Every check yields rows of ``(check_name, table_name, column_name, failures)``
with ``failures`` a bigint and 0 meaning pass. Semantics follow the usual
generic data tests:

* not_null: rows where the column is NULL.
* unique: distinct non-NULL values that occur more than once.
* accepted_values: distinct non-NULL values outside the list (NULL passes).
* relationships: child rows with a non-NULL key that has no parent row.
* row rule: rows where a boolean rule is not true.

Checks on one table that can share a pass are fused: all not-null and
accepted-values columns of a table are one aggregation; all row rules of a
table are another. Uniqueness and relationships need a shuffle on their key
and run once per key, with partial aggregation first so a hot key costs one
row per partition, never one task holding all its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from remitlens.operators.joins import anti_join

CHECK_SCHEMA = StructType(
    [
        StructField("check_name", StringType(), False),
        StructField("table_name", StringType(), False),
        StructField("column_name", StringType(), True),
        StructField("failures", LongType(), True),
    ]
)


def _rows(agg_row: DataFrame, specs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Turn a one-row aggregate into check rows.

    ``specs`` lists ``(alias_in_agg_row, check_name, table_name, column_name)``.
    """
    entries = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(table).alias("table_name"),
            F.lit(column).cast("string").alias("column_name"),
            F.col(alias).cast("bigint").alias("failures"),
        )
        for alias, check, table, column in specs
    ]
    return agg_row.select(F.explode(F.array(*entries)).alias("c")).select("c.*")


def column_checks(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    accepted_values: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """not_null and accepted_values checks of one table in one pass."""
    accepted_values = dict(accepted_values or {})
    aggs: list[Column] = []
    specs: list[tuple[str, str, str, str]] = []
    for i, c in enumerate(not_null):
        alias = f"nn_{i}"
        aggs.append(F.count_if(F.col(c).isNull()).alias(alias))
        specs.append((alias, "not_null", table, c))
    for i, (c, values) in enumerate(accepted_values.items()):
        alias = f"av_{i}"
        bad = F.when(~F.col(c).isin(list(values)), F.col(c))
        aggs.append(F.count_distinct(bad).alias(alias))
        specs.append((alias, "accepted_values", table, c))
    if not aggs:
        raise ValueError("column_checks needs at least one check")
    return _rows(df.agg(*aggs), specs)


def unique_check(df: DataFrame, table: str, column: str) -> DataFrame:
    """Distinct non-NULL values of ``column`` that occur more than once."""
    return unique_checks(df, table, [column])


def unique_checks(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """unique checks of several columns of one table.

    Each column is grouped by itself: over a table bucketed on it that takes
    no shuffle, otherwise one of that column alone (map-side combined, so a
    hot duplicate costs one row per partition). The global aggregate yields 0
    for an empty table or an all-NULL column.
    """
    parts = []
    for c in columns:
        counted = df.select(F.col(c).alias("value")).filter(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        parts.append(_rows(counted.agg(F.count_if(F.col("n") > 1).alias("u")), [("u", "unique", table, c)]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def relationship_check(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no ``parent_column`` match.

    The child keys are counted per key first (map-side combined), then the
    distinct keys are anti-joined to the parent keys: the join sees each key
    once, whatever its frequency.
    """
    keys = (
        child.select(F.col(column).alias("_k"))
        .filter(F.col("_k").isNotNull())
        .groupBy("_k")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parents = parent.select(F.col(parent_column).alias("_k"))
    missing = anti_join(keys, parents, "_k").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
    return _rows(missing, [("failures", "relationships", table, column)])


def row_rule_checks(df: DataFrame, table: str, rules: Mapping[str, tuple[str | None, Column]]) -> DataFrame:
    """Rows where a rule is not true (a NULL rule result is a failure).

    ``rules`` maps a check name to ``(column_name, boolean Column)``; all rules
    of the table are evaluated in one pass.
    """
    aggs = []
    specs = []
    for i, (name, (column, rule)) in enumerate(rules.items()):
        alias = f"rr_{i}"
        aggs.append(F.count_if(~F.coalesce(rule, F.lit(False))).alias(alias))
        specs.append((alias, name, table, column))
    return _rows(df.agg(*aggs), specs)


def literal_checks(spark: SparkSession, rows: Sequence[tuple[str, str, str, int]]) -> DataFrame:
    """Check rows whose counts are known, as a relation of known size."""
    if not rows:
        return spark.sql("select '' as check_name, '' as table_name, '' as column_name, cast(0 as bigint) as failures where false")
    values, args = [], {}
    for i, (check, table, column, failures) in enumerate(rows):
        values.append(f"(:k{i}, :t{i}, :c{i}, cast({int(failures)} as bigint))")
        args |= {f"k{i}": check, f"t{i}": table, f"c{i}": column}
    return spark.sql(f"select * from values {', '.join(values)} as t(check_name, table_name, column_name, failures)", args=args)


def union_checks(spark: SparkSession, parts: Sequence[DataFrame]) -> DataFrame:
    """Stack check results; an empty list gives an empty result."""
    if not parts:
        return spark.createDataFrame([], CHECK_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
