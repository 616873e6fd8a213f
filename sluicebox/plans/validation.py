"""Funnel of the raw tables, before any cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.functions.display import percent
from sluicebox.sources.raw import RawTables


def raw_funnel_validation(raw: RawTables) -> DataFrame:
    """Distinct sessions by stage as they were recorded, with conversions as text.

    All stages are counted together: distinct pairs of stage and session, then one count per stage.
    """
    sessions = {
        "total": raw.traffic_logs,
        "cart": raw.cart_actions.where(F.col("action") == "add_to_cart"),
        "checkout": raw.checkout_events,
        "purchase": raw.orders.where(F.col("order_status") == "paid"),
    }
    seen = [df.select(F.lit(stage).alias("stage"), "session_id") for stage, df in sessions.items()]
    pairs = reduce(DataFrame.union, seen).where(F.col("session_id").isNotNull()).distinct()
    counts = pairs.agg(*[F.count_if(F.col("stage") == stage).alias(stage) for stage in sessions])

    total, cart, checkout, purchase = (F.col(stage) for stage in sessions)
    rows = (
        ("Total sessions", total, None),
        ("Product-view sessions", total, total),
        ("Add-to-cart sessions", cart, total),
        ("Checkout sessions", checkout, cart),
        ("Purchase sessions", purchase, checkout),
    )
    return counts.select(F.inline(F.array(*[_stage_row(*row, total) for row in rows])))


def _stage_row(label: str, count: Column, previous: Column | None, total: Column) -> Column:
    def share_of(base: Column) -> Column:
        return percent(count / F.greatest(base, F.lit(1)))

    return F.struct(
        F.lit(label).alias("Stage"),
        count.alias("Sessions"),
        (F.lit(None).cast("string") if previous is None else share_of(previous)).alias("Conversion from previous"),
        share_of(total).alias("Cumulative conversion"),
    )
