"""What the physical plans must keep: pushed filters, pruned columns, merged copies, splittable joins."""

import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from shop import nested_shop
from sluicebox.operators.skew import unique_side, with_key_in
from sluicebox.plans import reports, staging
from sluicebox.plans.mart import fct_sessions, session_visits
from sluicebox.plans.quality import check_duplicate_traffic, check_orphan_orders
from sluicebox.sources.raw import SCHEMAS, RawTables, load_raw
from sluicebox.sources.sinks import read_mart, write_mart

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_plan_texts(spark):
    with settings(spark, spark__sql__maxMetadataStringLength=10_000, spark__sql__debug__maxToStringFields=1_000):
        yield


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    for name, df in nested_shop(spark).items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return load_raw(spark, folder)


@pytest.mark.parametrize("name", sorted(entry_point.shop_queries()))
def test_no_cross_join_no_python_and_no_hand_set_broadcast(spark, name):
    query = entry_point.queries()[name](spark, SF_DIR)
    plan = query._jdf.queryExecution().optimizedPlan().toString() + plan_of(query)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoop|Join Cross|Python|Pandas|strategy=broadcast", plan)


def test_status_and_revenue_filters_reach_the_scan(spark, stored):
    plan = plan_of(staging.stg_orders(stored.orders))
    assert "PushedFilters" in plan and "In(order_status" in plan and "GreaterThanOrEqual(gross_revenue,0.0)" in plan


def test_a_report_reads_only_the_columns_it_needs(spark, stored):
    plan = plan_of(reports.funnel_headline(fct_sessions(stored)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    orders = next(s for s in schemas if "order_status" in s)
    cart = next(s for s in schemas if "action" in s)
    assert {c.split(":")[0] for c in orders.split(",")} == {"session_id", "gross_revenue", "order_status"}
    assert {c.split(":")[0] for c in cart.split(",")} == {"session_id", "action", "product_id"}


def test_date_bounds_need_traffic_only(spark, stored):
    plan = plan_of(reports.date_bounds(fct_sessions(stored)))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_the_mart_aggregates_in_hash_tables(spark, stored):
    """Beside the merging of copies, traffic is sorted twice, as labels of sessions instead of views."""
    plan = plan_of(fct_sessions(stored))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    views, traffic = plan_of(staging.stg_traffic(stored.traffic_logs)), plan_of(session_visits(staging.stg_traffic(stored.traffic_logs)))
    assert traffic.count("Sort [") == views.count("Sort [") + 2
    assert traffic.rindex("Sort [") > traffic.index("HashAggregate")


def test_headline_builds_the_mart_once(spark, stored):
    assert plan_of(reports.headline(fct_sessions(stored))).count("FileScan") == 4
    assert plan_of(reports.revenue_metrics(fct_sessions(stored))).count("FileScan") == 4


def test_copies_are_merged_below_the_shuffle(spark, stored):
    window = plan_of(staging.stg_traffic(stored.traffic_logs))
    assert window.index("WindowGroupLimit") < window.index("Exchange") < window.rindex("WindowGroupLimit")
    counted = plan_of(check_duplicate_traffic(stored.traffic_logs))
    assert counted.count("HashAggregate(keys=[session_id") == 2


def _skewed(spark, rows=60_000):
    """A third of all rows has one key."""
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("session_id"),
        F.concat(F.lit("user"), F.col("id"), F.lit("x" * 20)).alias("user_id"),
        "id",
    )


# Sizes at which the tables above count as large, and no table is small enough to broadcast.
_SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2.0",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "32k",
    "spark__sql__adaptive__coalescePartitions__minPartitionSize": "16k",
}


def _executed_plan(df) -> str:
    df.collect()
    return plan_of(df)


def test_hot_key_of_a_membership_join_is_split(spark, tmp_path):
    _skewed(spark).repartition(8).write.parquet(f"{tmp_path}/events")
    events = spark.read.parquet(f"{tmp_path}/events")
    known = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("session_id"))
    with settings(spark, **_SMALL):
        kept = with_key_in(events, known, "session_id").select(F.max(F.length("user_id")), F.count("*").alias("n"))
        assert "SortMergeJoin(skew=true)" in _executed_plan(kept)
        assert kept.first().n == 20_000 + 20_000


def test_session_shared_by_a_third_of_all_users_is_split_in_the_mart(spark, tmp_path):
    traffic = _skewed(spark).selectExpr(
        "session_id",
        "user_id",
        "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, id) AS timestamp",
        "'Meta' AS traffic_source",
        "'mobile' AS device",
        "'p' AS product_id_viewed",
    )
    carts = _skewed(spark).selectExpr(
        "session_id", "user_id", "TIMESTAMP_NTZ'2024-01-01' AS timestamp", "'add_to_cart' AS action", "'p' AS product_id"
    )
    traffic.repartition(8).write.parquet(f"{tmp_path}/traffic")
    carts.repartition(8).write.parquet(f"{tmp_path}/carts")
    raw = RawTables(
        spark.read.parquet(f"{tmp_path}/traffic"),
        spark.read.parquet(f"{tmp_path}/carts"),
        spark.createDataFrame([], SCHEMAS["checkout_events"]),
        spark.createDataFrame([], SCHEMAS["orders"]),
    )
    with settings(spark, **_SMALL):
        mart = fct_sessions(raw).select(F.max(F.length("user_id")), F.sum("added_to_cart").alias("added"))
        assert "SortMergeJoin(skew=true)" in _executed_plan(mart)
        assert mart.first().added == 60_000


def test_hot_session_of_orphan_orders_is_split(spark, tmp_path):
    _skewed(spark).selectExpr("session_id", "user_id AS order_id", "1.0D AS gross_revenue", "'paid' AS order_status").repartition(
        8
    ).write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders")
    checkout = spark.range(60_000).where("id % 3 > 0").select(F.concat(F.lit("k"), F.col("id")).alias("session_id"))
    with settings(spark, **_SMALL):
        check = check_orphan_orders(orders, checkout)
        assert "SortMergeJoin(skew=true)" in _executed_plan(check)
        assert check.first().Value == 20_000


def test_a_large_day_of_the_stored_mart_is_split_and_a_small_one_is_one_file(spark, tmp_path):
    traffic = spark.range(60_000).selectExpr(
        "concat('s', id) AS session_id",
        "concat('u', id) AS user_id",
        "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(IF(id % 3 = 0, 0, int(id % 40)), 0, 0, 0) AS timestamp",
        "'Meta' AS traffic_source",
        "'mobile' AS device",
        "concat('p', id) AS product_id_viewed",
    )
    traffic.repartition(8).write.parquet(f"{tmp_path}/traffic")
    empty = [spark.createDataFrame([], SCHEMAS[name]) for name in ("cart_actions", "checkout_events", "orders")]
    sizes = _SMALL | {"spark__sql__adaptive__advisoryPartitionSizeInBytes": "96k", "spark__sql__shuffle__partitions": "400"}
    with settings(spark, **sizes):
        write_mart(fct_sessions(RawTables(spark.read.parquet(f"{tmp_path}/traffic"), *empty)), f"{tmp_path}/mart")
    files = {day.name: len(list(day.glob("*.parquet"))) for day in Path(f"{tmp_path}/mart").glob("version-*/first_seen_date=*")}
    assert files.pop("first_seen_date=2024-01-01") > 1
    assert len(files) == 39 and set(files.values()) == {1}
    assert read_mart(spark, f"{tmp_path}/mart").count() == 60_000


def test_unique_side_has_one_row_per_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    assert sorted(unique_side(df, "k").collect(), key=str) == sorted(df.select("k").distinct().collect(), key=str)
    summed = unique_side(df, "k", F.sum("v").alias("v")).collect()
    assert sorted((row.k or "", row.v) for row in summed) == [("", 7), ("a", 3)]
