import random
from datetime import datetime, timedelta

import duckdb
import pytest

import oracle_queries
from compare import rows_of_duckdb, rows_of_spark
from shop import cart, checkout, order, shop, view
from sluicebox.plans import reports
from sluicebox.plans.mart import fct_sessions, register_models
from sluicebox.sources.raw import SCHEMAS
from sluicebox.sources.sql import query


def one(spark, **tables):
    rows = fct_sessions(shop(spark, **tables)).collect()
    assert len(rows) == 1
    return rows[0]


def test_columns_and_types(spark):
    mart = fct_sessions(shop(spark))
    assert mart.dtypes == list({
        "session_id": "string",
        "user_id": "string",
        "first_seen_at": "timestamp_ntz",
        "last_seen_at": "timestamp_ntz",
        "traffic_source": "string",
        "device": "string",
        "products_viewed": "bigint",
        "added_to_cart": "int",
        "products_added": "bigint",
        "products_removed": "bigint",
        "reached_checkout": "int",
        "payment_attempted": "int",
        "payment_failed": "int",
        "purchased": "int",
        "gross_revenue": "double",
        "discount": "double",
        "net_revenue": "double",
        "order_status": "string",
    }.items())


def test_first_touch_is_the_earliest_view_even_without_source(spark):
    row = one(
        spark,
        traffic=[
            view("s1", "2024-01-01 10:00:01", source="Meta", device="desktop"),
            view("s1", "2024-01-01 10:00:00", source=None, device="mobile", product="p9"),
        ],
    )
    assert (row.traffic_source, row.device, row.products_viewed) == ("Unknown", "mobile", 2)
    assert (row.first_seen_at, row.last_seen_at) == (datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 0, 1))


def test_session_with_views_only(spark):
    row = one(spark, traffic=[view("s1")])
    assert (row.added_to_cart, row.products_added, row.products_removed) == (0, 0, 0)
    assert (row.reached_checkout, row.payment_attempted, row.payment_failed, row.purchased) == (0, 0, 0, 0)
    assert (row.gross_revenue, row.discount, row.net_revenue, row.order_status) == (0.0, 0.0, 0.0, None)


def test_cart_counts_products_once_and_keeps_the_flag_after_removal(spark):
    row = one(
        spark,
        traffic=[view("s1")],
        carts=[
            cart("s1", "2024-01-01 10:00:00"),
            cart("s1", "2024-01-01 10:01:00"),
            cart("s1", "2024-01-01 10:02:00", product="p2"),
            cart("s1", "2024-01-01 10:03:00", action="remove_from_cart"),
            cart("s1", "2024-01-01 10:04:00", product="p2", action="remove_from_cart"),
            cart("s1", "2024-01-01 10:05:00", product=None),
        ],
    )
    assert (row.added_to_cart, row.products_added, row.products_removed) == (1, 2, 2)


def test_cart_event_without_product_sets_the_flag_only(spark):
    row = one(spark, traffic=[view("s1")], carts=[cart("s1", product=None)])
    assert (row.added_to_cart, row.products_added) == (1, 0)


def test_refunded_and_paid_lines_in_one_session(spark):
    row = one(
        spark,
        traffic=[view("s1")],
        orders=[order("s1", gross=20.0, discount=2.0), order("s1", gross=99.0, status="refunded")],
    )
    assert (row.purchased, row.gross_revenue, row.discount, row.net_revenue) == (1, 20.0, 2.0, 18.0)
    assert row.order_status == "refunded"


def test_cancelled_only(spark):
    row = one(spark, traffic=[view("s1")], orders=[order("s1", status="cancelled")])
    assert (row.purchased, row.gross_revenue, row.order_status) == (0, 0.0, "cancelled")


def test_failed_payment(spark):
    row = one(spark, traffic=[view("s1")], checkouts=[checkout("s1", status="payment_failed")])
    assert (row.reached_checkout, row.payment_attempted, row.payment_failed) == (1, 0, 1)


def test_activity_without_traffic_leaves_no_trace(spark):
    row = one(
        spark, traffic=[view("s1")], carts=[cart("s2")], checkouts=[checkout("s2")], orders=[order("s2"), order("s_orphan")]
    )
    assert (row.session_id, row.added_to_cart, row.reached_checkout, row.purchased) == ("s1", 0, 0, 0)


def test_repeated_order_lines_all_count(spark):
    row = one(spark, traffic=[view("s1")], orders=[order("s1", gross=10.1), order("s1", gross=10.1), order("s1", gross=0.2)])
    assert row.gross_revenue == 20.4


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("amounts", "expected"),
    [
        ([1e15, 0.5], 1e15 + 0.5),
        ([1.23456], 1.23456),
        ([0.00004] * 1000, 0.04),
        ([float("nan"), 1.0], float("nan")),
        ([float("inf"), 1.0], float("inf")),
        ([1e25], 1e25),
    ],
    ids=str,
)
def test_amounts_are_neither_cut_nor_dropped(spark, ansi, amounts, expected):
    """Totals of the mart, the headline, the days and the segments are what a sum of doubles gives, up to its rounding."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        raw = shop(spark, [view("s1"), view("s2")], orders=[order("s1", gross=a, order_id=f"o{i}") for i, a in enumerate(amounts)])
        mart = fct_sessions(raw)
        row = mart.where("session_id = 's1'").first()
        found = [row.gross_revenue, row.net_revenue, reports.headline(mart).first().aov]
        found += [reports.revenue_metrics(mart).first().gross_revenue, reports.daily_trend(mart).first().revenue]
        found += [reports.segment_performance(mart, "device").first().revenue]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert row.purchased == 1 and found == pytest.approx([expected] * len(found), rel=1e-15, nan_ok=True)


def test_two_users_in_one_session_give_two_rows(spark):
    mart = fct_sessions(shop(spark, [view("s1", user="u1"), view("s1", user="u2", product="p2")], orders=[order("s1")]))
    assert [(r.user_id, r.purchased) for r in mart.orderBy("user_id").collect()] == [("u1", 1), ("u2", 1)]


def test_models_are_available_to_sql(spark):
    register_models(spark, shop(spark, [view("s1"), view("s1")], orders=[order("s1")]))
    assert query(spark, "SELECT count(*) AS n FROM traffic_logs").first().n == 2
    assert query(spark, "SELECT count(*) AS n FROM stg_traffic").first().n == 1
    bought = query(spark, "SELECT session_id FROM fct_sessions WHERE purchased = :bought", {"bought": 1})
    assert [r.session_id for r in bought.collect()] == ["s1"]


def _random_tables(seed: int) -> dict[str, list[dict]]:
    """Few keys, so that copies, ties, shared sessions and NULLs meet often."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1, 23, 59, 57)

    def some(*values):
        return rng.choice(values)

    def common():
        when = start + timedelta(seconds=rng.randrange(6))
        return dict(session_id=some("a", "b", "c", "d", "e", None), user_id=some("u1", "u2", None), timestamp=when)

    return {
        "traffic_logs": [
            common() | dict(traffic_source=some("Meta", "Google", None), device=some("mobile", "tablet", None), product_id_viewed=some("p1", "p2", None))
            for _ in range(120)
        ],
        "cart_actions": [
            common() | dict(action=some("add_to_cart", "remove_from_cart", "ping", None), product_id=some("p1", "p2", None))
            for _ in range(80)
        ],
        "checkout_events": [
            common()
            | dict(checkout_id="c", checkout_status=some("checkout_started", "payment_attempted", "payment_failed", "x"), cart_value=some(1.5, None))
            for _ in range(25)
        ],
        "orders": [
            common()
            | dict(
                order_id=some("o1", "o2", "o3", None),
                gross_revenue=some(10.1, 0.2, 7.77, -3.0, None),
                discount_applied=some(0.1, 0.0, None),
                product_id="p1",
                order_status=some("paid", "cancelled", "refunded", "unknwon", None),
            )
            for _ in range(40)
        ],
    }


@pytest.mark.parametrize("seed", range(4))
def test_mart_equals_plain_sql_on_random_tables(spark, seed):
    """Shared sessions, copies by different users, ties in time and NULLs everywhere."""
    tables = _random_tables(seed)
    con = duckdb.connect()
    frames = {}
    for name, rows in tables.items():
        columns = SCHEMAS[name].names
        values = [tuple(row[column] for column in columns) for row in rows]
        frames[name] = spark.createDataFrame(values, SCHEMAS[name])
        kinds = {"timestamp": "TIMESTAMP", "gross_revenue": "DOUBLE", "discount_applied": "DOUBLE", "cart_value": "DOUBLE"}
        target = "shop_orders" if name == "orders" else name
        con.execute(f"CREATE TABLE {target} ({', '.join(f'{chr(34)}{c}{chr(34)} {kinds.get(c, 'VARCHAR')}' for c in columns)})")
        con.executemany(f"INSERT INTO {target} VALUES ({', '.join('?' * len(columns))})", values)
    raw = shop(spark).__class__(**frames)
    assert rows_of_spark(fct_sessions(raw)) == rows_of_duckdb(con, oracle_queries.models_sql("fct_sessions"))
