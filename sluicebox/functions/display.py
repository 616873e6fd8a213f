"""Numbers as display text.

``format_number`` rounds the exact binary value half to even, so the last digit does not depend on how the
double happens to print.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"


def plain_number(value: Column, decimals: int) -> Column:
    """Fixed decimals, no thousands separators."""
    return F.translate(F.format_number(value, decimals), ",", "")


def percent(fraction: Column, decimals: int = 2) -> Column:
    return F.concat(plain_number(fraction * 100, decimals), F.lit("%"))


def money(amount: Column, decimals: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, decimals))


def grouped_count(count: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(count, 0)


def dash_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(DASH))
