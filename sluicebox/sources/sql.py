"""SQL over the registered tables and models."""

from __future__ import annotations

from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def query(spark: SparkSession, sql: str, params: dict[str, Any] | None = None) -> DataFrame:
    """Run a statement; ``:name`` markers take their values from ``params``."""
    return spark.sql(sql, args=params or {})


def run_sql_file(spark: SparkSession, path: str | Path) -> DataFrame:
    return spark.sql(Path(path).read_text(encoding="utf-8").strip().removesuffix(";"))
