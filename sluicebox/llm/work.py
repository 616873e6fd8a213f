"""Written intermediate tables, in the folder that the driver and all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.sources.scratch import new_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back: later jobs neither recompute it nor lose it with an executor."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_file_order(df: DataFrame) -> DataFrame:
    """The rows of a table read from Parquet files, files by name and rows as they lie in them; partitions are in order.

    A scan alone reads the largest splits first and puts those of several files into one partition.
    """
    file = df.metadataColumn("_metadata")  # also where the table has a column of that name
    part = F.regexp_extract(file["file_name"], r"^part-(\d+)", 1).try_cast("long")  # as names, 100000 is before 99999
    place, taken = {}, {name.lower() for name in df.columns}
    for name, column in (("part", part), ("file", file["file_path"]), ("row", file["row_index"])):
        while name in taken:
            name += "_"
        place[name] = column
    placed = df.select("*", *[column.alias(name) for name, column in place.items()])
    return placed.repartitionByRange(*place).sortWithinPartitions(*place).drop(*place)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, Python gets at most ``rows`` rows at a time, for rows that are large. Only what is written counts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
