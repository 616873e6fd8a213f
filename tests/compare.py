"""Run a registered query in Spark and its SQL in DuckDB, and compare whole results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry_point


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _sort_key(row: tuple) -> list:
    return [(value is not None, str(value)) for value in row]


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()), key=_sort_key)


def rows_of_duckdb(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return sorted(names), sorted(rows, key=_sort_key)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> list[str]:
    """What differs; values must be equal to the last bit and of the same Python type."""
    spark_names, spark_rows = rows_of_spark(entry_point.queries()[name](spark, sf_dir))
    duck_names, duck_rows = rows_of_duckdb(con, entry_point.oracle_sql()[name])
    if spark_names != duck_names:
        return [f"columns {spark_names} and {duck_names}"]
    if len(spark_rows) != len(duck_rows):
        return [f"{len(spark_rows)} and {len(duck_rows)} rows"]
    found = []
    for left, right in zip(spark_rows, duck_rows, strict=True):
        for column, a, b in zip(spark_names, left, right, strict=True):
            both_nan = isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b)
            if not both_nan and (type(a) is not type(b) or a != b):
                found.append(f"{column}: {a!r} and {b!r}")
    return found
