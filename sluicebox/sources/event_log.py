"""Raw shop tables derived from a generic ``events`` table.

Every event becomes a row of exactly one table; one of an unknown type, or of none, is traffic. The remainders below give rows their attributes, and a second copy or
a defect where the rules ask for one; none of them drops a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicebox.session import size_shuffles
from sluicebox.sources.raw import SCHEMAS, RawTables, read_parquet
from sluicebox.sources.sinks import publish, read_published

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
# Event types with a table of their own.
_CART_TYPE, _CHECKOUT_TYPE, _ORDER_TYPE = "click", "error", "purchase"

_BASE = (
    "event_id",
    "event_type",
    "value",
    "ts AS timestamp",
    "user_id AS uid",
    "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
    "concat('sess_', user_id, '_', CAST(ts AS DATE)) AS session_id",
    "concat('usr_', user_id) AS user_id",
)

_SKU = "concat('SKU', 1000 + k % 40)"

_TRAFFIC = (
    "session_id",
    "user_id",
    "timestamp",
    """CASE WHEN event_id % 26 = 0 THEN NULL
            WHEN uid % 3 = 0 THEN 'Meta' WHEN uid % 3 = 1 THEN 'Google' ELSE 'Direct' END AS traffic_source""",
    "CASE WHEN uid % 20 < 12 THEN 'mobile' WHEN uid % 20 < 19 THEN 'desktop' ELSE 'tablet' END AS device",
    f"{_SKU} AS product_id_viewed",
)

_CART = (
    "session_id",
    "user_id",
    "timestamp",
    "CASE WHEN k % 17 = 5 THEN 'cart_ping' WHEN k % 8 = 0 THEN 'remove_from_cart' ELSE 'add_to_cart' END AS action",
    f"{_SKU} AS product_id",
)

_CHECKOUT = (
    "concat('co_', session_id) AS checkout_id",
    "session_id",
    "user_id",
    "timestamp",
    """CASE WHEN k % 10 = 9 THEN 'bogus' WHEN k % 3 = 0 THEN 'checkout_started'
            WHEN k % 3 = 1 THEN 'payment_attempted' ELSE 'payment_failed' END AS checkout_status""",
    "value AS cart_value",
)

_ORDERS = (
    "concat('ord_', CASE WHEN event_id % 20 = 1 THEN event_id - 1 ELSE event_id END) AS order_id",
    "CASE WHEN event_id % 48 = 0 THEN concat('sess_orphan_', event_id) ELSE session_id END AS session_id",
    "user_id",
    "timestamp",
    "CASE WHEN event_id % 100 = 7 THEN -value ELSE value END AS gross_revenue",
    """CASE WHEN k % 4 = 0 THEN CAST(CAST(value AS DECIMAL(18, 2)) * CAST('0.1' AS DECIMAL(2, 1)) AS DOUBLE)
            ELSE 0.0D END AS discount_applied""",
    f"{_SKU} AS product_id",
    """CASE WHEN k % 25 = 3 THEN 'unknwon' WHEN k % 20 = 1 THEN 'cancelled' WHEN k % 33 = 2 THEN 'refunded'
            ELSE 'paid' END AS order_status""",
)


def load_event_log(spark: SparkSession, directory: str) -> RawTables:
    path = f"{directory}/events.parquet"
    size_shuffles(spark, path)
    return shop_tables(read_parquet(spark, path, EVENTS_SCHEMA))


def _with_copies(events: DataFrame, every: int) -> DataFrame:
    """Repeat each event whose id is a multiple of ``every``, in one pass over the events."""
    return events.selectExpr("*", f"explode(array_repeat(1, IF(event_id % {every} = 0, 2, 1))) AS copy")


def shop_tables(events: DataFrame) -> RawTables:
    base = events.selectExpr(*_BASE)
    other = f"event_type IS NULL OR event_type NOT IN ('{_CART_TYPE}', '{_CHECKOUT_TYPE}', '{_ORDER_TYPE}')"
    return RawTables(
        traffic_logs=_with_copies(base.where(other), 83).selectExpr(*_TRAFFIC),
        cart_actions=_with_copies(base.where(f"event_type = '{_CART_TYPE}'"), 56).selectExpr(*_CART),
        checkout_events=base.where(f"event_type = '{_CHECKOUT_TYPE}'").selectExpr(*_CHECKOUT),
        orders=base.where(f"event_type = '{_ORDER_TYPE}'").selectExpr(*_ORDERS),
    )


_COLUMNS = {"traffic_logs": _TRAFFIC, "cart_actions": _CART, "checkout_events": _CHECKOUT, "orders": _ORDERS}
_TYPES = {_CART_TYPE: "cart_actions", _CHECKOUT_TYPE: "checkout_events", _ORDER_TYPE: "orders"}
# The tag that tells in which table a stored row belongs.
_TAG = "raw_table"


def _named(column: str) -> tuple[str, str]:
    """The name of a column above, and its expression."""
    expression, _, name = column.rpartition(" AS ")
    return name, expression or name


def tagged_events(events: DataFrame) -> DataFrame:
    """The rows of all raw tables from one pass over the events, each with the name of its table.

    A column that several tables have has the value of the row's own table; one that it doesn't have is NULL.
    """
    kinds = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in _TYPES.items())
    tag = f"CASE event_type {kinds} ELSE 'traffic_logs' END"
    copies = "CASE raw_table WHEN 'traffic_logs' THEN IF(event_id % 83 = 0, 2, 1) WHEN 'cart_actions' THEN IF(event_id % 56 = 0, 2, 1) ELSE 1 END"
    base = events.selectExpr(*_BASE).selectExpr("*", f"{tag} AS {_TAG}")
    base = base.selectExpr("*", f"explode(array_repeat(1, {copies})) AS copy")
    found: dict[str, list[str]] = {}
    for table, columns in _COLUMNS.items():
        for name, expression in map(_named, columns):
            found.setdefault(name, []).append(f"WHEN '{table}' THEN {expression}")
    return base.selectExpr(_TAG, *[f"CASE {_TAG} {' '.join(cases)} END AS {name}" for name, cases in found.items()])


def stage_event_log(spark: SparkSession, directory: str, path: str) -> RawTables:
    """Store the raw tables of an event log below ``path``, from one pass over it, and read them from there.

    Each table is a folder of its own, so a query reads the tables and columns it needs, and the events are taken apart
    only once however many queries follow.
    """
    source = f"{directory}/events.parquet"
    size_shuffles(spark, source)
    tagged = tagged_events(read_parquet(spark, source, EVENTS_SCHEMA))
    publish(tagged, path, lambda df, to: df.write.partitionBy(_TAG).parquet(to))
    stored = read_published(spark, path)
    return RawTables(**{table: stored.where(F.col(_TAG) == table).select(*SCHEMAS[table].names) for table in _COLUMNS})
