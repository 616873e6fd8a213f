"""Parquet and CSV outputs, and the stored session mart."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from time import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.config import MART_DATE

_PUBLISHED = "published"
_CSV = {"header": True, "emptyValue": "", "escape": '"'}


def publish(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] | None = None) -> None:
    """Write a table as a new version below ``path``, and make it the one that is read once it is complete.

    A job that fails leaves the last version as it was, and readers of an older version can go on. Older versions stay
    until ``remove_old_versions``. ``write`` stores the table in a folder, as plain Parquet if it is not given.
    """
    version = f"version-{uuid.uuid4().hex}"
    if write:
        write(df, f"{path}/{version}")
    else:
        df.write.parquet(f"{path}/{version}")
    published = df.sparkSession.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
    published.coalesce(1).write.mode("append").parquet(f"{path}/{_PUBLISHED}")


def _last_version(spark: SparkSession, path: str) -> str:
    published = spark.read.schema("version string, published_at timestamp").parquet(f"{path}/{_PUBLISHED}")
    return published.agg(F.max(F.struct("published_at", "version")).alias("last")).first().last.version


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The version of a table that was published last."""
    return spark.read.parquet(f"{path}/{_last_version(spark, path)}")


def _files(spark: SparkSession, path: str) -> tuple:
    """A path as the file system knows it, and that file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_old_versions(spark: SparkSession, path: str, older_than: timedelta) -> list[str]:
    """Delete versions last written to longer ago than this, failed writes too, but never the one published last.

    Returns their names. A reader of one of them fails, so the age has to be longer than any job that reads the table.
    """
    last, (place, files) = _last_version(spark, path), _files(spark, path)
    removed = []
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("version-") and name != last and status.getModificationTime() < (time() - older_than.total_seconds()) * 1000:
            files.delete(status.getPath(), True)
            removed.append(name)
    return sorted(removed)


def write_parquet(df: DataFrame, path: str) -> None:
    """Publish a table, to be read with ``read_published``; it takes the place of the last one when it is complete."""
    publish(df, path)


def write_report_csv(report: DataFrame, path: str) -> None:
    """Write a report of a few rows as a folder with one CSV file with a header, in the report's row order."""
    report.coalesce(1).write.mode("overwrite").options(**_CSV).csv(path)


def write_csv_file(report: DataFrame, path: str) -> None:
    """The same as one file at ``path``. It is written beside it first and moved when it is complete."""
    spark = report.sparkSession
    beside, files = _files(spark, f"{path}-{uuid.uuid4().hex}")
    report.coalesce(1).write.options(**_CSV).csv(beside.toString())
    (part,) = [status.getPath() for status in files.listStatus(beside) if status.getPath().getName().startswith("part-")]
    place, _ = _files(spark, path)
    files.delete(place, True)
    if not files.rename(part, place):
        raise OSError(f"cannot move the report to {path}")
    files.delete(beside, True)


def _by_day(mart: DataFrame, path: str) -> None:
    """Rebalancing gathers each day into a few files of the advisory size, and splits a day that is larger than that."""
    dated = mart.withColumn(MART_DATE, F.to_date("first_seen_at"))
    dated.hint("rebalance", F.col(MART_DATE)).write.partitionBy(MART_DATE).parquet(path)


def write_mart(mart: DataFrame, path: str) -> None:
    """Publish the session mart, stored by day of the first event."""
    publish(mart, path, _by_day)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The version of the mart that was published last."""
    return read_published(spark, path)
