"""The session mart: one row per session, the source of every report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicebox.config import ORDER_STATUSES
from sluicebox.functions.money import exact, outside, total
from sluicebox.operators.skew import unique_side
from sluicebox.plans.staging import (
    stg_cart_actions,
    stg_checkout_events,
    stg_orders,
    stg_traffic,
    valid_cart_actions,
    valid_checkout_events,
)
from sluicebox.sources.raw import RawTables, register_raw

# A session's order status is the alphabetically last one. Its rank keeps that order and, being a number, keeps the
# aggregation by session in hash tables.
_STATUSES = ", ".join(f"'{status}'" for status in sorted(ORDER_STATUSES))


def session_visits(views: DataFrame) -> DataFrame:
    """Staged views by session and user: first and last view, first-touch source and device, distinct products.

    First touch is the earliest view; of views at the same time, the one of the first product.

    Views are first counted by session, user and all three labels, in hash tables, so that a hot session is as many rows as
    it has different labels. Only these are sorted, and only twice: to number the products, and to find the first touch.
    """
    product, session = F.col("product_id_viewed"), ("session_id", "user_id")
    labelled = views.groupBy(*session, product, "traffic_source", "device").agg(
        F.min("timestamp").alias("first_view"), F.max("timestamp").alias("last_view"), F.expr("max(int(timestamp IS NULL)) AS untimed")
    )
    # A view without a time comes before all others.
    earliest = [F.desc("untimed"), F.expr("IF(untimed = 0, first_view, NULL)")]
    order = [*earliest, product.asc_nulls_last(), "traffic_source", F.col("device").asc_nulls_last()]
    whole = Window.partitionBy(*session)
    numbered = labelled.withColumn("nth_product", F.dense_rank().over(whole.orderBy(product.asc_nulls_last())))
    ranked = numbered.withColumn("nth", F.row_number().over(whole.orderBy(*order))).withColumns(
        {
            "first_seen_at": F.min("first_view").over(whole),
            "last_seen_at": F.max("last_view").over(whole),
            "products_viewed": F.coalesce(F.max(F.when(product.isNotNull(), F.col("nth_product"))).over(whole), F.lit(0)).cast("bigint"),
        }
    )
    first = ranked.where("nth = 1")
    return first.select(*session, "first_seen_at", "last_seen_at", "traffic_source", "device", "products_viewed")


def _cart_part(cart: DataFrame) -> DataFrame:
    """Cart events by session and product; a product counts once per action however often it was added."""
    products = cart.groupBy("session_id", "product_id").agg(
        F.expr("max(int(action = 'add_to_cart')) AS added"), F.expr("max(int(action = 'remove_from_cart')) AS removed")
    )
    return products.selectExpr(
        "session_id",
        "added AS added_to_cart",
        "IF(product_id IS NULL, 0, added) AS products_added",
        "IF(product_id IS NULL, 0, removed) AS products_removed",
    )


def _checkout_part(checkout: DataFrame) -> DataFrame:
    return checkout.selectExpr(
        "session_id",
        "1 AS reached_checkout",
        "int(checkout_status = 'payment_attempted') AS payment_attempted",
        "int(checkout_status = 'payment_failed') AS payment_failed",
        "cart_value",
    )


def _order_part(orders: DataFrame) -> DataFrame:
    """Order lines with the amounts of paid ones, as decimals and what no decimal holds."""
    paid = F.col("is_paid") == 1
    amounts = [
        F.when(paid, part(F.col(amount))).alias(f"{name}_{part.__name__}")
        for name, amount in _AMOUNTS.items()
        for part in (exact, outside)
    ]
    return orders.select(
        "session_id",
        F.col("is_paid").alias("purchased"),
        *amounts,
        F.expr(f"int(array_position(array({_STATUSES}), order_status)) AS status_rank"),
    )


_LARGEST = ("added_to_cart", "reached_checkout", "payment_attempted", "payment_failed", "purchased", "status_rank", "cart_value")
# By the mart's column: the column of an order line.
_AMOUNTS = {"gross_revenue": "gross_revenue", "discount": "discount_applied", "net_revenue": "net_revenue"}
_SUMMED = ("products_added", "products_removed", *[f"{name}_{part}" for name in _AMOUNTS for part in ("exact", "outside")])


def session_activity(cart: DataFrame, checkout: DataFrame, orders: DataFrame) -> DataFrame:
    """Cart, checkout and order measures by session, from one shuffle of all three instead of one each.

    Every measure is a maximum or a sum that ignores NULLs, so the sources can be stacked and aggregated together.
    """
    parts = [_cart_part(cart), _checkout_part(checkout), _order_part(orders)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    largest = [F.expr(f"max({name}) AS {name}") for name in _LARGEST]
    summed = [F.expr(f"sum({name}) AS {name}") for name in _SUMMED]
    return unique_side(stacked, "session_id", *largest, *summed).withColumnRenamed("cart_value", "max_cart_value")


def fct_sessions(raw: RawTables) -> DataFrame:
    """Sessions with what happened in them; activity of sessions without traffic is left out.

    Two staging steps change nothing here and are skipped with their shuffles. Cart copies: flags and distinct
    products ignore them. Checkout events without traffic: the left join from sessions drops them.
    """
    visits = session_visits(stg_traffic(raw.traffic_logs))
    activity = session_activity(
        valid_cart_actions(raw.cart_actions), valid_checkout_events(raw.checkout_events), stg_orders(raw.orders)
    )
    amounts = [
        F.coalesce(total(F.col(f"{name}_exact"), F.col(f"{name}_outside")), F.lit(0.0)).alias(name) for name in _AMOUNTS
    ]
    return visits.join(activity, "session_id", "left").select(
        *visits.columns,
        F.expr("coalesce(added_to_cart, 0) AS added_to_cart"),
        F.expr("coalesce(products_added, 0L) AS products_added"),
        F.expr("coalesce(products_removed, 0L) AS products_removed"),
        F.expr("coalesce(reached_checkout, 0) AS reached_checkout"),
        F.expr("coalesce(payment_attempted, 0) AS payment_attempted"),
        F.expr("coalesce(payment_failed, 0) AS payment_failed"),
        F.expr("coalesce(purchased, 0) AS purchased"),
        *amounts,
        F.expr(f"get(array({_STATUSES}), status_rank - 1) AS order_status"),
    )


def register_models(spark: SparkSession, raw: RawTables) -> DataFrame:
    """Register raw tables, staging models and the mart as views; returns the mart."""
    register_raw(raw)
    mart = fct_sessions(raw)
    models = {
        "stg_traffic": stg_traffic(raw.traffic_logs),
        "stg_cart_actions": stg_cart_actions(raw.cart_actions),
        "stg_checkout_events": stg_checkout_events(raw.checkout_events, raw.traffic_logs),
        "stg_orders": stg_orders(raw.orders),
        "fct_sessions": mart,
    }
    for name, model in models.items():
        model.createOrReplaceTempView(name)
    return mart
