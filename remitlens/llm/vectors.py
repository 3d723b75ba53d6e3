"""What the two vector searches share: rows that take part, and stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.scratch import partitions
from remitlens.session import ensure_checkpoint_dir


def usable(vector: str) -> Column:
    """Vectors that are not null and hold only finite components, some at all."""
    finite = F.forall(
        F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


@contextmanager
def stored_by(df: DataFrame, key: str) -> Iterator[DataFrame]:
    """``df`` as a table bucketed on ``key`` in the shared folder, so that each
    round of a search joins it where it lies. Table and files go at the end."""
    spark = df.sparkSession
    name = f"remitlens_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    buckets = partitions(df)
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
