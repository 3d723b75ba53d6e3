"""Cutting lineage on shared storage."""

from __future__ import annotations

import gc
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in ``spark.checkpoint.dir``.

    A reliable checkpoint: every executor can read it, a lost executor costs
    nothing, and the files go with the last reference when the session cleans
    checkpoints.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Give back the disk of finished steps.

    Spark deletes shuffle and checkpoint files once the driver has collected
    the frames that made them, which a driver with free memory puts off. Called
    between the phases of a long job; a frame in use keeps its files.
    """
    gc.collect()
    # Py4J tells the JVM of dropped frames from a thread that wakes once a
    # second; what still waits then would outlive this collection
    waiting = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    while waiting:
        try:
            task = waiting.pop()
        except IndexError:
            break
        if not isinstance(task, tuple):
            waiting.append(task)
            break
        task[0].garbage_collect_object(task[1], False)
    spark.sparkContext._jvm.System.gc()


class Shipped:
    """An object of this package for tasks (``value``).

    A broadcast names the class of an object, so workers would import the
    package; here the bytes carry the class, and workers need no copy.
    """

    def __init__(self, spark: SparkSession, own: object):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(own))
        self._own = None

    def __getstate__(self) -> dict:
        return {"_bytes": self._bytes, "_own": None}

    @property
    def value(self):
        if self._own is None:
            self._own = cloudpickle.loads(self._bytes.value)
        return self._own


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Bits of the bitmap of a key filter.
SLOTS = 1 << 23


def slot_of(column: str) -> Column:
    """The bit of a key in a bitmap of keys."""
    return F.pmod(F.xxhash64(column), F.lit(SLOTS))


def key_bitmap(keys: DataFrame, column: str):
    """A shared bitmap of the keys, of a fixed size however many they are."""
    words = (
        keys.select(slot_of(column).alias("s"))
        .groupBy(F.floor(F.col("s") / 32).alias("w"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(s % 32 AS int)))").alias("b"))
        .toPandas()
    )
    bits = np.zeros(SLOTS // 32, np.int64)
    bits[words["w"].to_numpy(dtype=np.int64)] = words["b"].to_numpy(dtype=np.int64)
    return keys.sparkSession.sparkContext.broadcast(bits.astype(np.uint32))


def in_bitmap(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 5] >> (slots & 31).astype(np.uint32)) & 1 == 1


def key_filter(keys: DataFrame, column: str) -> Callable[[str], Column]:
    """A condition that holds for rows whose key is in ``keys``, and for few
    others while the keys are few against SLOTS. It only spares rows a shuffle:
    a join or the caller's own check decides."""
    shared = key_bitmap(keys, column)

    @F.pandas_udf("boolean")
    def may(s: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(shared.value, s.to_numpy(dtype=np.int64)))

    return lambda c: may(slot_of(c))
