from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

import oracle_queries
from shop import cart, checkout, nested_shop, order, shop, view
from sluicebox.config import REPORT_COLUMNS, REPORT_ORDER
from sluicebox.functions.rates import threshold_status
from sluicebox.plans import quality
from sluicebox.plans.validation import raw_funnel_validation
from sluicebox.sources.event_log import load_event_log
from sluicebox.sources.raw import RawTables, load_raw


def test_duplicate_cart(spark):
    noon, later = datetime(2025, 6, 7, 12), datetime(2025, 6, 7, 12, 0, 1)
    tripled = [("visit", noon, "remove_from_cart", "lamp")] * 3
    others = [("visit", later, "remove_from_cart", "lamp"), ("visit", noon, "add_to_cart", "lamp"), (None, noon, None, None)]
    df = spark.createDataFrame(tripled + others, ["session_id", "timestamp", "action", "product_id"])
    row = quality.check_duplicate_cart(df).first()
    assert (row.Value, row.Detail) == (2, "33.33% of cart rows")


def test_missing_source(spark):
    df = spark.range(1250).selectExpr("IF(id % 25 = 7, NULL, concat('source', id % 3)) AS traffic_source")
    row = quality.check_missing_source(df).first()
    assert (row.Value, row.Unit, row.Status, row.Detail) == (4.0, "percent", "WARNING", "50 rows with NULL source")


def test_negative_revenue(spark):
    df = spark.range(-4, 4).selectExpr("IF(id = 3, NULL, id / 8) AS gross_revenue")
    row = quality.check_negative_revenue(df).first()
    assert (row.Value, row.Status) == (4, "FAIL")


def test_invalid_order_status(spark):
    df = spark.range(400).selectExpr("CASE id WHEN 9 THEN 'PAID' WHEN 99 THEN 'lost' ELSE 'cancelled' END AS order_status")
    row = quality.check_invalid_order_status(df).first()
    assert (row.Value, row.Status, row.Detail) == (2, "WARNING", "Values seen: ['PAID', 'lost']")


def test_invalid_order_status_lists_five_values_and_counts_null(spark):
    statuses = ["g", "f", "e", "d", "c", "b", "b", None, "paid"]
    df = spark.createDataFrame([(s,) for s in statuses], "order_status string")
    row = quality.check_invalid_order_status(df).first()
    assert (row.Value, row.Detail) == (8, "Values seen: ['b', 'c', 'd', 'e', 'f']")
    apostrophe = spark.createDataFrame([("it's",)], "order_status string")
    assert quality.check_invalid_order_status(apostrophe).first().Detail == "Values seen: [\"it's\"]"
    valid = quality.check_invalid_order_status(df.where("order_status = 'paid'")).first()
    assert (valid.Value, valid.Status, valid.Detail) == (0, "PASS", "Values seen: []")


def test_duplicate_order_ids(spark):
    df = spark.range(30).selectExpr("CASE WHEN id < 4 THEN 'first' WHEN id < 6 THEN NULL ELSE concat('n', id) END AS order_id")
    row = quality.check_duplicate_order_ids(df).first()
    assert (row.Value, row.Status) == (4, "FAIL")


def test_duplicate_traffic(spark):
    raw = shop(spark, [view("s1"), view("s1", user="u2"), view("s1", product="p2"), view("s2", product=None), view("s2", product=None)])
    row = quality.check_duplicate_traffic(raw.traffic_logs).first()
    assert (row.Value, row.Status, row.Detail) == (2, "FAIL", "40.00% of traffic rows")


def test_orphan_orders_count_order_ids_once(spark):
    raw = shop(
        spark,
        checkouts=[checkout("s1"), checkout("s1")],
        orders=[
            order("s1", order_id="a"),
            order("x", order_id="b"),
            order("x", order_id="b"),
            order("y", order_id="b"),
            order("s1", order_id="c"),
            order("z", order_id="c"),
            order("z", order_id=None) | {"order_id": None},
        ],
    )
    row = quality.check_orphan_orders(raw.orders, raw.checkout_events).first()
    assert (row.Value, row.Status, row.Detail) == (2, "FAIL", "66.67% of orders")


def test_orphan_orders_without_checkout_data(spark):
    raw = shop(spark, orders=[order("s1")])
    assert tuple(quality.check_orphan_orders(raw.orders, raw.checkout_events).first())[1:] == (0, "count", "PASS", "")


def test_orphan_cart(spark):
    raw = shop(spark, [view("s1"), view("s1", product="p2")], [cart("s1"), cart("s2"), cart("s2"), cart("s1", product="p2")])
    row = quality.check_orphan_cart(raw.cart_actions, raw.traffic_logs).first()
    assert (row.Value, row.Status, row.Detail) == (2, "FAIL", "50.00% of cart events")


def test_purchase_before_checkout_counts_sessions_of_any_status(spark):
    raw = shop(
        spark,
        checkouts=[checkout("s1", "2024-01-01 10:00:00"), checkout("s1", "2024-01-01 12:00:00"), checkout("s2"), checkout("s3")],
        orders=[
            order("s1", "2024-01-01 09:00:00", status="cancelled"),
            order("s1", "2024-01-01 09:30:00"),
            order("s2", "2024-01-01 10:10:00"),
            order("s4", "2024-01-01 01:00:00"),
        ],
    )
    row = quality.check_purchase_before_checkout(raw.orders, raw.checkout_events).first()
    assert (row.Value, row.Status) == (1, "FAIL") and row.Detail.startswith("Impossible sequence")
    nothing = quality.check_purchase_before_checkout(raw.orders, raw.checkout_events.limit(0)).first()
    assert tuple(nothing)[1:] == (0, "count", "PASS", "")


def test_thresholds_are_reached_at_equality(spark):
    shares = spark.createDataFrame([(0.0049,), (0.005,), (0.0499,), (0.05,)], "share double")
    status = shares.select(threshold_status(F.col("share"), (0.005, 0.05)).alias("s")).collect()
    assert [row.s for row in status] == ["PASS", "WARNING", "WARNING", "FAIL"]


def _singles(raw):
    return [tuple(check().first()) for check in quality._single_checks(raw).values()]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_report_holds_every_single_check_in_order(spark, folder):
    raw = load_event_log(spark, f"/root/testdata/{folder}")
    report = quality.run_all_checks(raw)
    assert tuple(report.columns) == REPORT_COLUMNS
    rows = [tuple(row) for row in report.collect()]
    assert [row[0] for row in rows] == list(REPORT_ORDER)
    assert rows == _singles(raw)


def test_report_on_empty_tables(spark):
    raw = shop(spark)
    rows = [tuple(row) for row in quality.run_all_checks(raw).collect()]
    assert rows == _singles(raw)
    assert {row[3] for row in rows} == {"PASS"} and {row[1] for row in rows} == {0.0}


def test_report_with_nulls_equals_single_checks(spark):
    raw = shop(
        spark,
        [view("s1"), view(None), view(None)],
        [cart(None), cart("s9"), cart("s9")],
        [checkout("s1"), checkout(None)],
        [order(None), order("s1", status=None), order("s1", order_id="x") | {"order_id": None}, order("s1", gross=None)],
    )
    assert [tuple(row) for row in quality.run_all_checks(raw).collect()] == _singles(raw)


def test_a_check_that_cannot_run_becomes_a_fail_row(spark):
    raw = shop(spark, [view("s1")], [cart("s1")], [checkout("s1")], [order("s1")])
    broken = RawTables(raw.traffic_logs.drop("traffic_source"), raw.cart_actions, raw.checkout_events, raw.orders.drop("order_status"))
    rows = {row.Metric: row for row in quality.run_all_checks(broken).collect()}
    assert list(rows) == list(REPORT_ORDER)
    for metric in ("Missing traffic source", "Invalid order status"):
        assert (rows[metric].Value, rows[metric].Status) == (None, "FAIL")
        assert rows[metric].Detail.startswith("Check error: ")
    assert rows["Duplicate traffic rows"].Status == rows["Negative revenue"].Status == "PASS"


def test_values_of_another_kind_fail_their_check_only(spark):
    raw = shop(spark, [view("s1")], [cart("s1")], [checkout("s1")], [order("s1", gross=-1.0), order("s2")])
    mistyped = raw.orders.withColumns({"gross_revenue": F.lit("12,50"), "timestamp": F.lit("yesterday")})
    broken = RawTables(raw.traffic_logs, raw.cart_actions, raw.checkout_events, mistyped)
    expected = {row.Metric: tuple(row) for row in quality.run_all_checks(raw).collect()}
    rows = [tuple(row) for row in quality.run_all_checks(broken).collect()]
    assert [row[0] for row in rows] == list(REPORT_ORDER) and rows == _singles(broken)
    for row in rows:
        if row[0] in ("Negative revenue", "Purchase before checkout"):
            assert row[1] is None and row[3] == "FAIL" and row[4].startswith("Check error: 2 values are no ")
        else:
            assert row == expected[row[0]]


def test_report_reads_checkout_twice_and_orders_three_times(spark, tmp_path):
    for name, df in nested_shop(spark).items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    plan = quality.run_all_checks(load_raw(spark, str(tmp_path)))._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation [" in line]
    assert sum("cart_value" in line for line in scans) <= 2
    assert sum("gross_revenue" in line for line in scans) <= 3


@pytest.mark.parametrize("check", ["dq_orphan_orders", "dq_orphan_cart", "dq_purchase_before_checkout", "dq_duplicate_order_ids"])
def test_checks_with_null_sessions_equal_sql(spark, tmp_path, check):
    raw = shop(
        spark,
        [view("s1"), view(None)],
        [cart(None), cart("s1"), cart("s9")],
        [checkout("s1"), checkout(None)],
        [order(None, order_id="a"), order("s1", order_id="b"), order("s7", order_id="c")],
    )
    single = dict(zip(quality.REPORT_ORDER, quality._single_checks(raw).values(), strict=True))
    con = duckdb.connect()
    names = {"traffic_logs": "traffic_logs", "cart_actions": "cart_actions", "checkout_events": "checkout_events", "orders": "shop_orders"}
    for name, df in raw.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        con.execute(f"CREATE VIEW {names[name]} AS SELECT * FROM read_parquet('{tmp_path}/{name}/*.parquet')")
    expected = con.execute(oracle_queries._CHECKS[check]).fetchone()
    con.close()
    assert tuple(single[expected[0]]().first()) == expected


def test_raw_validation(spark):
    raw = shop(
        spark,
        [view("s1"), view("s2"), view("s2", product="p2"), view("s3"), view("s4")],
        [cart("s1"), cart("s2"), cart("s3", action="remove_from_cart")],
        [checkout("s1", status="bogus"), checkout("x1"), checkout("x2")],
        [order("orphan"), order("s1", status="cancelled")],
    )
    assert [tuple(row) for row in raw_funnel_validation(raw).collect()] == [
        ("Total sessions", 4, None, "100.00%"),
        ("Product-view sessions", 4, "100.00%", "100.00%"),
        ("Add-to-cart sessions", 2, "50.00%", "50.00%"),
        ("Checkout sessions", 3, "150.00%", "75.00%"),
        ("Purchase sessions", 1, "33.33%", "25.00%"),
    ]


def test_raw_validation_of_empty_tables(spark):
    assert [tuple(row)[1:] for row in raw_funnel_validation(shop(spark)).collect()] == [(0, None, "0.00%")] + [(0, "0.00%", "0.00%")] * 4


def _two_files_each(spark, folder, raw):
    for name, table in raw.items():
        table.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
        table.coalesce(1).write.mode("append").parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("broken", ["traffic_logs", "cart_actions", "checkout_events", "orders"])
def test_a_damaged_file_fails_the_checks_that_read_it_only(spark, tmp_path, broken):
    readers = {
        "traffic_logs": {"Duplicate traffic rows", "Missing traffic source", "Cart events without session"},
        "cart_actions": {"Duplicate cart rows", "Cart events without session"},
        "checkout_events": {"Orders without checkout", "Purchase before checkout"},
        "orders": {"Negative revenue", "Invalid order status", "Orders without checkout", "Duplicate order IDs", "Purchase before checkout"},
    }
    _two_files_each(spark, tmp_path, nested_shop(spark))
    raw = load_raw(spark, str(tmp_path))
    expected = {row.Metric: tuple(row) for row in quality.run_all_checks(raw).collect()}
    last = sorted((tmp_path / f"{broken}.parquet").glob("part-*"))[-1]
    last.write_bytes(last.read_bytes()[:40])
    for crc in (tmp_path / f"{broken}.parquet").glob(".*.crc"):
        crc.unlink()
    rows = [tuple(row) for row in quality.report_despite_errors(raw).collect()]
    assert [row[0] for row in rows] == list(REPORT_ORDER)
    failed = {row[0] for row in rows if row[1] is None}
    assert failed == readers[broken]
    for row in rows:
        if row[0] in failed:
            assert row[3] == "FAIL" and row[4].startswith("Check error: ") and "\n" not in row[4]
        else:
            assert row == expected[row[0]]


def test_a_report_without_errors_is_one_job(spark, monkeypatch):
    raw = nested_shop(spark)
    expected = quality.run_all_checks(raw).collect()
    monkeypatch.setattr(quality, "_single_checks", lambda raw: {})
    assert quality.report_despite_errors(raw).collect() == expected
