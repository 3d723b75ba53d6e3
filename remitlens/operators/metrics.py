"""Reusable analytic operators: share of total, segment rate, scored top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions.numeric import round_ratio


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def grand_totals(df: DataFrame, *values: str) -> Column:
    """The sums of ``values`` over the whole of ``df``: one struct, by a scalar
    subquery.

    Two levels: each task sums its rows, one task sums the tasks' sums; the
    struct is handed to every task, so the rows of ``df`` stay where they are,
    whatever their number. The subquery names every column of ``df``: nothing
    below it is pruned away, so it has the shuffles of the main plan and reuses
    them, and over an aggregate the input is read once.
    """
    same = F.max(F.struct(*[F.col(c) for c in df.columns])).alias("same_columns")
    return df.agg(F.struct(*[F.sum(v).alias(v) for v in values], same).alias("totals")).scalar()


def with_totals(df: DataFrame, out: str, *values: str) -> DataFrame:
    """``df`` with the struct of the sums of ``values`` as column ``out``, bound
    once, so the subquery is planned once."""
    return df.withColumn(out, grand_totals(df, *values))


def share_of_total(df: DataFrame, value: str, out: str, scale: int = 1, as_percent: bool = True) -> DataFrame:
    """Add ``out`` = value / sum(value over all rows), rounded exactly.

    As a percentage (``100 * v / total``) with ``scale`` digits, else a
    fraction with ``scale`` digits. A zero total gives NULL. See
    ``grand_totals``: safe for any number of rows, no row is moved.
    """
    totals = f"__total_{out}"
    # parts of signed amounts can exceed their total
    share = round_ratio(value, f"{totals}.{value}", scale, factor=100 if as_percent else 1)
    return with_totals(df, totals, value).withColumn(out, share).drop(totals)


def segment_rate(
    df: DataFrame,
    segment: Sequence[str],
    flag: Column,
    total_name: str = "total_claims",
    flagged_name: str = "denied_claims",
) -> DataFrame:
    """Rows and flagged rows per segment (``count(*)`` and ``sum(case flag 1 else 0)``).

    A NULL flag counts as not flagged. Partial aggregation runs before the
    shuffle, so a hot segment costs one row per input partition.
    """
    return df.groupBy(*segment).agg(
        F.count(F.lit(1)).alias(total_name),
        F.sum(F.when(flag, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(flagged_name),
    )


def scored_top_k(
    df: DataFrame,
    score: Column,
    k: int,
    tiebreak: Sequence[str | Column] = (),
    rank_name: str = "rank",
) -> DataFrame:
    """The ``k`` rows with the highest ``score`` and their rank 1..k.

    NULL scores rank last; ties are broken by ``tiebreak`` ascending. The limit
    comes first (each partition keeps its own top k, then one merge of at most
    k rows per partition), so the ranking window only ever sees k rows.
    """
    order = [score.desc_nulls_last()] + [c.asc_nulls_first() for c in _cols(tiebreak)]
    top = df.orderBy(*order).limit(k)
    return top.withColumn(rank_name, F.row_number().over(Window.orderBy(*order)).cast("int"))
