"""Small hand-made raw tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from sluicebox.sources.raw import SCHEMAS, RawTables


def at(text: str) -> datetime:
    return datetime.fromisoformat(text if " " in text or "T" in text else f"{text} 12:00:00")


def table(spark: SparkSession, name: str, rows: list[dict]):
    schema = SCHEMAS[name]
    values = [tuple(at(r[f]) if f == "timestamp" and isinstance(r.get(f), str) else r.get(f) for f in schema.names) for r in rows]
    return spark.createDataFrame(values, schema)


def view(session, when="2024-01-01 10:00:00", product="p1", source="Meta", device="mobile", user="u1"):
    return dict(
        session_id=session, user_id=user, timestamp=when, traffic_source=source, device=device, product_id_viewed=product
    )


def cart(session, when="2024-01-01 10:05:00", product="p1", action="add_to_cart", user="u1"):
    return dict(session_id=session, user_id=user, timestamp=when, action=action, product_id=product)


def checkout(session, when="2024-01-01 10:10:00", status="checkout_started", value=10.0, user="u1"):
    return dict(
        checkout_id=f"co_{session}", session_id=session, user_id=user, timestamp=when, checkout_status=status, cart_value=value
    )


def order(session, when="2024-01-01 10:20:00", gross=10.0, discount=0.0, status="paid", order_id=None, product="p1", user="u1"):
    return dict(
        order_id=order_id or f"o_{session}",
        session_id=session,
        user_id=user,
        timestamp=when,
        gross_revenue=gross,
        discount_applied=discount,
        product_id=product,
        order_status=status,
    )


def shop(spark: SparkSession, traffic=(), carts=(), checkouts=(), orders=()) -> RawTables:
    return RawTables(
        table(spark, "traffic_logs", list(traffic)),
        table(spark, "cart_actions", list(carts)),
        table(spark, "checkout_events", list(checkouts)),
        table(spark, "orders", list(orders)),
    )


def nested_shop(spark: SparkSession) -> RawTables:
    """Twenty sessions; eight add to cart, five check out, three buy."""
    names = [f"s{i:02d}" for i in range(20)]
    return shop(
        spark,
        [view(s, user=f"u{s}") for s in names],
        [cart(s) for s in names[:8]],
        [checkout(s) for s in names[:5]],
        [order(s, gross=30.0, discount=3.0) for s in names[:3]],
    )
