"""Session settings used by tests and the bench.

Library functions never change session settings; they only read them. The
builder below is what a job script would use when it owns the session.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the jobs of this package at any scale:
#  - AQE re-plans joins at runtime (a dimension that turns out small becomes a
#    broadcast; a hot join key is split by the skew-join rule) and coalesces
#    small shuffle partitions.
#  - ANSI mode makes bad casts and decimal overflow errors instead of NULLs.
#  - UTC session time zone keeps dates identical to other engines.
#  - Size-based broadcasts stop at 1 MB: a larger side is cheaper to
#    sort-merge in parallel than to collect, hash on one thread and copy to
#    every executor (on 1000 executors a 10 MB broadcast ships 10 GB). No join
#    of the claim library carries a hint.
#  - A larger cache of compiled whole-stage code: the model graph has many
#    stages, and recompiling them on every run of a long-lived session costs
#    more than the memory.
DEFAULT_CONF = {
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "remitlens",
    extra_conf: dict[str, str] | None = None,
    local_driver_memory: str = "8g",
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # in local mode the driver JVM runs every task; its 1 GB default heap
        # makes 8 concurrent tasks spill and collect garbage
        conf["spark.driver.memory"] = local_driver_memory
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; it is read from
    the session and used as is (and required: a cluster session without it is
    an error). Only in local mode with nothing configured (unit tests) is a
    fresh scratch folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is invisible to other executors
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before checkpointing on a cluster")
        configured = tempfile.mkdtemp(prefix="remitlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
