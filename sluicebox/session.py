"""Spark session with the settings the library relies on."""

from __future__ import annotations

from math import ceil

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Runtime settings, applied only where the cluster or spark-submit has not chosen a value.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also the size of the files the session mart is written in.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Lets raw files written with nanosecond timestamps be opened; see sources.raw.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def build_session(app_name: str = "sluicebox", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    # Recording the Python line of every column expression takes longer than building the plans themselves.
    builder = SparkSession.builder.appName(app_name).config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for name, value in DEFAULTS.items():
        if not submitted.contains(name):
            spark.conf.set(name, value)
    return spark


# Input per shuffle partition, and the number of partitions at which the blocks of a shuffle become the larger problem.
PARTITION_BYTES = 256 * 1024**2
MOST_PARTITIONS = 100_000


def partitions_for(input_bytes: int, at_least: int) -> int:
    return max(at_least, min(ceil(input_bytes / PARTITION_BYTES), MOST_PARTITIONS))


_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Holds the number of partitions that was set here, to tell it from one set by the user.
_SIZED = "sluicebox.shuffle.sized"


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Start shuffles with partitions in proportion to the files of some tables; the loaders call this.

    Only file sizes are read. Adaptive execution merges the partitions that turn out small, so a high start costs little,
    while too few would spill. The number of shuffle partitions set by the user is kept as the least, and an initial
    number set by the user is left alone. Each call replaces what the last one set, see ``unsized_shuffles``.
    """
    own = spark.conf.get(_SIZED, None)
    if spark.conf.get(_INITIAL, None) not in (None, own):
        return int(spark.conf.get(_INITIAL))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([*paths])
    input_bytes = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first().bytes
    partitions = partitions_for(input_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(_INITIAL, str(partitions))
    spark.conf.set(_SIZED, str(partitions))
    return partitions


def unsized_shuffles(spark: SparkSession) -> None:
    """Take back what ``size_shuffles`` has set."""
    if spark.conf.get(_SIZED, None):
        spark.conf.unset(_INITIAL)
        spark.conf.unset(_SIZED)
