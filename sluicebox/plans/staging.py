"""Staging models: raw tables with types set, labels filled, invalid rows out and tracking copies merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.config import CART_ACTIONS, CART_KEY, CHECKOUT_STATUSES, ORDER_STATUSES, TRAFFIC_KEY, UNKNOWN_SOURCE
from sluicebox.functions.rates import flag
from sluicebox.operators.dedup import keep_first
from sluicebox.operators.skew import with_key_in
from sluicebox.sources.raw import key_columns

def _event_time() -> Column:
    # NULL for text that is no time; the quality report counts such rows.
    return F.col("timestamp").try_cast("timestamp_ntz").alias("timestamp")


def _nanos(df: DataFrame, key: tuple[str, ...]) -> tuple[str, ...]:
    return key_columns(df, key)[len(key) :]


def _merged(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return keep_first(df, key_columns(df, key)).drop(*_nanos(df, key))


def stg_traffic(traffic_logs: DataFrame) -> DataFrame:
    """Product views. A missing source is labelled; double-fired views count once."""
    typed = traffic_logs.select(
        "session_id",
        "user_id",
        _event_time(),
        F.coalesce("traffic_source", F.lit(UNKNOWN_SOURCE)).alias("traffic_source"),
        "device",
        "product_id_viewed",
        *_nanos(traffic_logs, TRAFFIC_KEY),
    )
    return _merged(typed, TRAFFIC_KEY)


def valid_cart_actions(cart_actions: DataFrame) -> DataFrame:
    known = cart_actions.where(F.col("action").isin(*CART_ACTIONS))
    return known.select("session_id", "user_id", _event_time(), "action", "product_id", *_nanos(known, CART_KEY))


def stg_cart_actions(cart_actions: DataFrame) -> DataFrame:
    """Valid cart events. A retried event counts once; the same product at another time is another event."""
    return _merged(valid_cart_actions(cart_actions), CART_KEY)


def valid_checkout_events(checkout_events: DataFrame) -> DataFrame:
    known = checkout_events.where(F.col("checkout_status").isin(*CHECKOUT_STATUSES))
    return known.select(
        "checkout_id",
        "session_id",
        "user_id",
        _event_time(),
        "checkout_status",
        F.col("cart_value").try_cast("double").alias("cart_value"),
    )


def stg_checkout_events(checkout_events: DataFrame, traffic_logs: DataFrame) -> DataFrame:
    """Valid checkout events of sessions that have traffic. Failed payments stay: they are the leakage signal.

    Merging copies of traffic never removes a session, so the raw traffic already tells which sessions have some.
    """
    return with_key_in(valid_checkout_events(checkout_events), traffic_logs, "session_id")


def stg_orders(orders: DataFrame) -> DataFrame:
    """Order lines with a valid status and non-negative revenue, with net revenue and a paid flag."""
    gross, discount = F.col("gross_revenue").try_cast("double"), F.col("discount_applied").try_cast("double")
    valid = orders.where(F.col("order_status").isin(*ORDER_STATUSES) & (gross >= 0))
    return valid.select(
        "order_id",
        "session_id",
        "user_id",
        _event_time(),
        gross.alias("gross_revenue"),
        discount.alias("discount_applied"),
        "product_id",
        "order_status",
        (gross - discount).alias("net_revenue"),
        flag(F.col("order_status") == "paid").alias("is_paid"),
    )
