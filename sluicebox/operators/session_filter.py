"""Filters on the session mart."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.config import DEVICE_OPTIONS, MART_DATE, SOURCE_OPTIONS

Day = str | date | None


def _all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def session_filter(
    start_date: Day = None,
    end_date: Day = None,
    sources: Iterable[str | None] | None = None,
    devices: Iterable[str | None] | None = None,
) -> Column:
    """Condition on a session's first event, first-touch source and device.

    The end date is inclusive. A missing argument, or a list with nothing in it, sets no condition.
    """
    conditions = []
    if start_date is not None:
        conditions.append(F.col("first_seen_at") >= F.lit(str(start_date)).cast("timestamp_ntz"))
    if end_date is not None:
        day_after = F.lit(str(end_date)).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
        conditions.append(F.col("first_seen_at") < day_after)
    for column, choices in (("traffic_source", sources), ("device", devices)):
        if isinstance(choices, str):
            raise TypeError(f"{column} takes a list of values, not the text {choices!r}")
        wanted = [choice for choice in choices or () if choice]
        if wanted:
            conditions.append(F.col(column).isin(wanted))
    return _all_of(conditions)


def filter_sessions(
    mart: DataFrame,
    start_date: Day = None,
    end_date: Day = None,
    sources: Iterable[str | None] | None = None,
    devices: Iterable[str | None] | None = None,
) -> DataFrame:
    """Apply :func:`session_filter`; on a stored mart also skip the date partitions that cannot match.

    Sessions are filtered after they are built: a condition on raw events would cut sessions at the date bounds.
    """
    kept = mart.where(session_filter(start_date, end_date, sources, devices))
    if MART_DATE in mart.columns:
        if start_date is not None:
            kept = kept.where(F.col(MART_DATE) >= F.lit(str(start_date)).cast("timestamp_ntz").cast("date"))
        if end_date is not None:
            last = F.lit(str(end_date)).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY - INTERVAL 1 MICROSECOND")
            kept = kept.where(F.col(MART_DATE) <= last.cast("date"))
    return kept


def dashboard_filter(
    mart: DataFrame,
    date_range: tuple[Day, ...] = (),
    sources: Iterable[str] = (),
    devices: Iterable[str] = (),
) -> DataFrame:
    """Filter by what is picked on a dashboard: no choice means every option, half a date range the full range."""
    start, end = date_range if len(date_range) == 2 else (None, None)
    if isinstance(sources, str) or isinstance(devices, str):
        raise TypeError("sources and devices are lists of values, not text")
    picked_sources, picked_devices = list(sources), list(devices)
    return filter_sessions(mart, start, end, picked_sources or SOURCE_OPTIONS, picked_devices or DEVICE_OPTIONS)
