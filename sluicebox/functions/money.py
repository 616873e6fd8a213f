"""Money totals that are the same for every order of the rows.

Amounts are doubles. Those below ``OUTSIDE`` are summed as decimals. The others, which are NaN, infinite or absurdly
large, are summed as doubles beside them, so a total with one of them is what a sum of doubles gives: NaN, infinity or
about the large amount.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicebox.config import MONEY_TYPE, OUTSIDE_MONEY


def _inside(amount: Column) -> Column:
    return F.abs(amount) < OUTSIDE_MONEY


def exact(amount: Column) -> Column:
    """The amount as a decimal; NULL if it is outside what the decimal holds."""
    return F.when(_inside(amount), amount.cast(MONEY_TYPE))


def outside(amount: Column) -> Column:
    """The amount if no decimal holds it, else NULL."""
    return F.when(~_inside(amount), amount)


def total(exact_total: Column, outside_total: Column) -> Column:
    """Double of both sums; NULL if nothing was summed."""
    inside = exact_total.cast("double")
    return F.when(outside_total.isNull(), inside).otherwise(F.coalesce(inside, F.lit(0.0)) + outside_total)


def exact_sum(amount: Column) -> Column:
    """Total of a double column."""
    return total(F.sum(exact(amount)), F.sum(outside(amount)))
