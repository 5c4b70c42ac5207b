"""Spark session defaults and the folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings the plans count on: sizes measured at run time decide
# broadcasts, and an oversized join partition (one hot key) is split.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# While DataFrames run that are executed only once: their shuffle files go as soon as they have ended, not when the
# driver next collects its garbage.
ONCE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# While models are built: a join whose one side has no partition above this many shuffled bytes hashes that side, so
# neither is sorted (a larger or skewed partition leaves the join as it is); rows of up to so many table partitions
# are written by one task without being sorted by partition first. A task reads no more than so many bytes, as rows of
# text tables take a hundred times as much memory when they are sorted, and what doesn't fit goes to disk.
BUILD_CONF = {
    **ONCE_CONF,
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.files.maxPartitionBytes": "4MB",
}


def build_conf(spark: SparkSession) -> dict[str, str]:
    """The settings of a build; where the session has smaller reads of its own, they stay."""
    key = "spark.sql.files.maxPartitionBytes"
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return BUILD_CONF | {key: min(BUILD_CONF[key], spark.conf.get(key), key=in_bytes)}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "quarrystone") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_runtime_conf(spark)


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def conf_set(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings for the time of a block; what the session had before is put back."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for tables written between two steps.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only a
    session on one machine, as in tests, gets a local folder where that is unset.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
