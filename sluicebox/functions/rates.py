"""Ratios, guards and thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """Double ratio; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Double ratio; 0 when the denominator is zero or NULL."""
    return F.coalesce(ratio_or_null(numerator, denominator), F.lit(0.0))


def average_or_zero(total: Column, count: Column) -> Column:
    """``total / count`` where anything was counted, else 0."""
    return F.when(count > 0, ratio_or_null(total, count)).otherwise(F.lit(0.0))


def drop_off(rate: Column) -> Column:
    return F.lit(1.0) - rate


def at_least_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0).cast("bigint"))


def at_most_one(rate: Column) -> Column:
    return F.least(rate, F.lit(1.0))


def threshold_status(share: Column, limits: tuple[float, float]) -> Column:
    """PASS, WARNING or FAIL; a share that equals a limit has reached it."""
    warn, fail = limits
    return F.when(share >= fail, "FAIL").when(share >= warn, "WARNING").otherwise("PASS")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)
