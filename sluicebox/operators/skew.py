"""Joins on a key that may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_side(df: DataFrame, key: str, *measures: Column) -> DataFrame:
    """Aggregate to one row per key, as the unique side of a join whose other side may be skewed.

    Adaptive execution splits a hot partition only if both inputs of the join come straight out of a shuffle. An
    aggregate on the join key alone would be joined where it lies, without one. Grouping by the key together with its
    hash gives the same groups but another partitioning, so the join adds its own shuffle to this side, which has one
    row per key, and the hot partition of the other side can be cut into as many pieces as its size asks for.
    """
    grouped = df.groupBy(key, F.xxhash64(key).alias("key_hash"))
    unique = grouped.agg(*measures) if measures else df.select(key, F.xxhash64(key).alias("key_hash")).distinct()
    return unique.drop("key_hash")


def with_key_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``. Rows without a key never match."""
    return df.join(unique_side(other, key), key, "left_semi")
