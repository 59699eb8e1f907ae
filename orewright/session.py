"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Runtime settings the operators count on. Nothing here depends on the size of the
# machine: partition counts and memory stay with whoever starts the session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the aggregate above then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task sorts and sums what it reads of an exchange, in some forty times the memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}
# Given bytes for which an exchange starts with one more partition; small ones are put together again.
PARTITION_BYTES = 4 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def spread(spark: SparkSession, given_bytes: int) -> SparkSession:
    """Let exchanges start with partitions by the input's size where that is more than the session's: a task's share stays as it is."""
    key, wanted = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", given_bytes // PARTITION_BYTES
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(key, str(wanted))
    else:
        spark.conf.unset(key)
    return spark


def local_session(cores: int | str = 8, name: str = "orewright") -> SparkSession:
    """A local session for tests and the bench, with a working folder of its own unless one is configured."""
    shared = SparkConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="orewright-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", shared)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared one that ``spark.checkpoint.dir`` names.

    A missing setting is an error on any master: no folder of one machine stands in for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/orewright/{purpose}-{uuid.uuid4().hex}"
