"""Uniqueness of many key columns in two rounds.

Round one never moves a key: each task hashes its keys (one scan of a table for
all its key columns), keeps the different 64-bit hashes sorted, and sends them
packed, one binary per bucket of hashes, eight bytes a key. The tasks that
receive a bucket find hashes that two tasks had, or one task twice. Round two
groups exactly, and only the rows whose hash is such a suspect; where there are
none, which is the normal case, it does not run.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.session import ensure_checkpoint_dir

# task functions are shipped by value: workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hashes of a column that a task holds before it sends them.
HELD = 1 << 20


def _pack(first: int, bucket_bits: int):
    """Packs the hash columns of a table, numbered from ``first``."""

    def packed(name: int, hashes: list[np.ndarray]) -> Iterator[tuple]:
        found, count = np.unique(np.concatenate(hashes).view(np.uint64), return_counts=True)
        edges = np.searchsorted(found >> np.uint64(64 - bucket_bits), np.arange((1 << bucket_bits) + 1))
        for bucket, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if b > a:
                yield name, bucket, found[a:b].tobytes(), found[a:b][count[a:b] > 1].tobytes()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["name", "bucket", "seen", "twice"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for i in range(batch.num_columns):
                own = batch.column(i).drop_null()
                if len(own):
                    held.setdefault(first + i, []).append(np.asarray(own))
                    if sum(map(len, held[first + i])) >= HELD:
                        yield batch_of(list(packed(first + i, held.pop(first + i))))
        rows = [r for name, hashes in held.items() for r in packed(name, hashes)]
        if rows:
            yield batch_of(rows)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes seen twice. Rows come by name and bucket."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)

    for (name, _), own in groupby(rows(), key=lambda r: r[:2]):
        seen, twice = [], []
        for r in own:
            seen.append(np.frombuffer(r[2], np.uint64))
            twice.append(np.frombuffer(r[3], np.uint64))
        every = np.sort(np.concatenate(seen))
        suspect = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *twice])).view(np.int64)
        if len(suspect):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(suspect), name, np.int32)), pa.array(suspect)], names=["name", "hash"])


def suspects(spark: SparkSession, tables: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(name, hash): hashes that more than one non-NULL value or row of a
    column has. Columns are numbered through the tables in order."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (n - 1).bit_length())
    parts, first = None, 0
    for df, columns in tables:
        hashes = df.select(*[F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(f"h{i}") for i, c in enumerate(columns)])
        own = hashes.mapInArrow(_pack(first, bits), "name int, bucket int, seen binary, twice binary")
        parts = own if parts is None else parts.unionByName(own)
        first += len(columns)
    dealt = parts.repartition(n, "name", "bucket").sortWithinPartitions("name", "bucket")
    return dealt.mapInArrow(_meet, "name int, hash long")


def repeated_values(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> dict[tuple[str, str], DataFrame | None]:
    """For each (table, column) the frame (value, n) of non-NULL values that
    occur more than once, or None where round one has shown that there is none.

    Runs one job: round one, over all tables at once; suspects are counted by
    column. A frame of suspects is lazy, exact, and reads its table again.
    """
    names = [(t, c) for t, (_, columns) in tables.items() for c in columns]
    if not names:
        return {}
    # kept: each column with suspects reads them again
    ensure_checkpoint_dir(spark)
    found = suspects(spark, list(tables.values())).checkpoint()
    # one row a column: the number of names bounds what comes to the driver
    hit = {r["name"] for r in found.groupBy("name").agg(F.count(F.lit(1))).collect()}
    out: dict[tuple[str, str], DataFrame | None] = {}
    for i, (table, column) in enumerate(names):
        if i not in hit:
            out[table, column] = None
            continue
        own = found.where(F.col("name") == i).select("hash")
        rows = tables[table][0].select(F.col(column).alias("value")).where(F.col("value").isNotNull()).withColumn("hash", F.xxhash64("value"))
        out[table, column] = (
            rows.join(own, "hash", "left_semi").groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        )
    return out
