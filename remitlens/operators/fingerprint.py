"""Multiset fingerprints: whether two columns hold the same values, equally often.

The fingerprint of a column does not depend on the order of the rows: their
number, the exact sum of one 64-bit hash and the exclusive or of another. Each
task sends one row. Equal multisets have equal fingerprints; different ones have
different fingerprints but for a chance of about 2**-64 and less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint(column: str) -> list[Column]:
    """Aggregates (rows, hash_sum, hash_xor) of a column; NULL is a value."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(column).cast("decimal(20,0)")).alias("hash_sum"),
        F.bit_xor(F.xxhash64(F.lit("second"), F.col(column))).alias("hash_xor"),
    ]


def same_values(left: DataFrame, right: DataFrame, column: str) -> bool:
    """Whether both frames hold the same multiset in ``column``. One job."""
    sides = [df.agg(*fingerprint(column)) for df in (left, right)]
    one, two = sides[0].unionByName(sides[1]).collect()
    return tuple(one) == tuple(two)
