from datetime import datetime

from pyspark.sql import Row
from pyspark.sql import functions as F

from shop import cart, checkout, order, shop, table, view
from sluicebox.plans import staging


def test_traffic_labels_missing_source_and_merges_double_fires(spark):
    raw = shop(spark, [view("s1", source=None), view("s1", source=None), view("s1", product="p2")])
    rows = staging.stg_traffic(raw.traffic_logs).orderBy("product_id_viewed").collect()
    assert [(r.product_id_viewed, r.traffic_source) for r in rows] == [("p1", "Unknown"), ("p2", "Meta")]
    assert rows[0].timestamp == datetime(2024, 1, 1, 10)


def test_dedup_survivor_does_not_depend_on_input_order(spark):
    copies = [view("s1", user="u2", device=None), view("s1", user="u1", device=None), view("s1", user="u1", device="tablet")]
    for rows in (copies, copies[::-1]):
        kept = staging.stg_traffic(shop(spark, rows).traffic_logs).collect()
        assert [(r.user_id, r.device) for r in kept] == [("u1", "tablet")]


def test_null_keys_are_copies_of_each_other(spark):
    raw = shop(spark, [view("s1", product=None), view("s1", product=None)])
    assert staging.stg_traffic(raw.traffic_logs).count() == 1


def test_cart_keeps_the_same_product_at_another_time(spark):
    raw = shop(
        spark,
        carts=[
            cart("s1", when="2024-01-01 10:00:00"),
            cart("s1", when="2024-01-01 10:00:00"),
            cart("s1", when="2024-01-01 10:01:00"),
            cart("s1", when="2024-01-01 10:00:00", action="cart_ping"),
        ],
    )
    assert staging.stg_cart_actions(raw.cart_actions).count() == 2


def test_checkout_needs_traffic_and_a_valid_status_and_keeps_copies(spark):
    raw = shop(
        spark,
        [view("s1"), view("s1", product="p2")],
        checkouts=[checkout("s1"), checkout("s1"), checkout("s1", status="bogus"), checkout("s2"), checkout(None)],
    )
    rows = staging.stg_checkout_events(raw.checkout_events, raw.traffic_logs).collect()
    assert [r.session_id for r in rows] == ["s1", "s1"]


def test_orders_keep_orphans_and_drop_invalid_negative_and_missing_revenue(spark):
    raw = shop(
        spark,
        orders=[
            order("s1", gross=10.0, discount=2.5),
            order("s_orphan", status="refunded"),
            order("s1", status="unknwon"),
            order("s1", status=None),
            order("s1", gross=-1.0),
            order("s1", gross=None),
            order("s1", gross=0.0, discount=None),
        ],
    )
    rows = staging.stg_orders(raw.orders).select("session_id", "gross_revenue", "net_revenue", "is_paid").collect()
    assert sorted(rows, key=lambda r: (r.session_id, r.gross_revenue)) == [
        Row(session_id="s1", gross_revenue=0.0, net_revenue=None, is_paid=1),
        Row(session_id="s1", gross_revenue=10.0, net_revenue=7.5, is_paid=1),
        Row(session_id="s_orphan", gross_revenue=10.0, net_revenue=10.0, is_paid=0),
    ]


def test_timestamps_with_a_zone_become_utc_wall_clock(spark):
    instant = F.expr("TIMESTAMP'2024-01-01 23:30:00+00:00'")
    stamped = table(spark, "traffic_logs", [view("s1")]).withColumn("timestamp", instant)
    assert staging.stg_traffic(stamped).first().timestamp == datetime(2024, 1, 1, 23, 30)
