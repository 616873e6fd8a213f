"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row of every key: the smallest one by the other columns in their order, NULLs last.

    Spark limits the rank below the shuffle too: however many copies a key has, each input task sends one row of it.
    Rows with a NULL key are copies of each other.
    """
    others = [F.asc_nulls_last(name) for name in df.columns if name not in keys]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*others))
    return df.withColumn("nth", nth).where("nth = 1").drop("nth")
