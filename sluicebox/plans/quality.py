"""Data-quality checks on the raw tables. They report issues and remove nothing.

A check has two parts: a measurement, which is an aggregation, and a verdict, which turns the numbers into one report
row. The report takes several verdicts from one measurement, so that each raw table is read as few times as possible.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.config import (
    CART_KEY,
    DUPLICATE_CART,
    DUPLICATE_CART_LIMITS,
    DUPLICATE_ORDER_IDS,
    DUPLICATE_ORDER_IDS_DETAIL,
    DUPLICATE_ORDER_ID_LIMITS,
    DUPLICATE_TRAFFIC,
    DUPLICATE_TRAFFIC_LIMITS,
    INVALID_STATUS,
    INVALID_STATUS_LIMITS,
    MISSING_SOURCE,
    MISSING_SOURCE_LIMITS,
    NEGATIVE_REVENUE,
    NEGATIVE_REVENUE_DETAIL,
    ORDER_STATUSES,
    ORPHAN_CART,
    ORPHAN_CART_LIMITS,
    ORPHAN_ORDERS,
    ORPHAN_ORDER_LIMITS,
    PURCHASE_BEFORE_CHECKOUT,
    PURCHASE_BEFORE_CHECKOUT_DETAIL,
    REPORT_COLUMNS,
    REPORT_ORDER,
    TRAFFIC_KEY,
)
from sluicebox.functions.display import grouped_count, percent
from sluicebox.functions.rates import flag, threshold_status
from sluicebox.operators.skew import unique_side
from sluicebox.sources.raw import RawTables, key_columns

# What Spark raises when a plan is made or run.
_RUN_TIME_ERRORS = (PySparkException, Py4JJavaError)

# Verdicts


def _row(metric: str, value: Column, status: Column, detail: Column, unit: str = "count") -> Column:
    return F.struct(
        F.lit(metric).alias("Metric"),
        value.cast("double").alias("Value"),
        F.lit(unit).alias("Unit"),
        status.alias("Status"),
        detail.alias("Detail"),
    )


def _share(part: str, total: str) -> Column:
    return F.col(part) / F.greatest(F.col(total), F.lit(1))


def _fail_if_any(count: Column) -> Column:
    return F.when(count == 0, "PASS").otherwise("FAIL")


def _share_verdict(metric: str, part: str, total: str, limits: tuple[float, float], of_what: str) -> Column:
    share = _share(part, total)
    return _row(metric, F.col(part), threshold_status(share, limits), F.concat(percent(share), F.lit(f" of {of_what}")))


def _duplicate_traffic_verdict() -> Column:
    return _share_verdict(DUPLICATE_TRAFFIC, "traffic_copies", "traffic_rows", DUPLICATE_TRAFFIC_LIMITS, "traffic rows")


def _duplicate_cart_verdict() -> Column:
    return _share_verdict(DUPLICATE_CART, "cart_copies", "cart_rows", DUPLICATE_CART_LIMITS, "cart rows")


def _missing_source_verdict() -> Column:
    share = _share("no_source_rows", "traffic_rows")
    detail = F.concat(grouped_count(F.col("no_source_rows")), F.lit(" rows with NULL source"))
    return _row(MISSING_SOURCE, share * 100, threshold_status(share, MISSING_SOURCE_LIMITS), detail, "percent")


def _unless_unreadable(verdict: Column, unreadable: Column, what: str) -> Column:
    """The verdict, or a FAIL without a value if some values could not be read."""
    detail = F.concat(F.lit("Check error: "), grouped_count(unreadable), F.lit(f" values are no {what}"))
    parts = [verdict[name] for name in REPORT_COLUMNS]
    failed = [parts[0], F.lit(None).cast("double"), parts[2], F.lit("FAIL"), detail]
    return F.struct(
        *[F.when(unreadable > 0, b).otherwise(a).alias(name) for name, a, b in zip(REPORT_COLUMNS, parts, failed, strict=True)]
    )


def _negative_revenue_verdict() -> Column:
    count = F.col("negative_rows")
    verdict = _row(NEGATIVE_REVENUE, count, _fail_if_any(count), F.lit(NEGATIVE_REVENUE_DETAIL))
    return _unless_unreadable(verdict, F.col("unreadable_amounts"), "numbers")


def _invalid_status_verdict(orders: DataFrame) -> Column:
    status = threshold_status(_share("invalid_rows", "order_rows"), INVALID_STATUS_LIMITS)
    return _row(INVALID_STATUS, F.col("invalid_rows"), status, F.concat(F.lit("Values seen: "), _values_seen(orders)))


def _orphan_orders_verdict() -> Column:
    # Without any checkout data nothing can be said about orders.
    known = F.col("checkout_rows") > 0
    share = _share("orphan_order_ids", "order_ids")
    return _row(
        ORPHAN_ORDERS,
        F.when(known, F.col("orphan_order_ids")).otherwise(0),
        F.when(known, threshold_status(share, ORPHAN_ORDER_LIMITS)).otherwise("PASS"),
        F.when(known, F.concat(percent(share), F.lit(" of orders"))).otherwise(""),
    )


def _orphan_cart_verdict() -> Column:
    return _share_verdict(ORPHAN_CART, "orphan_cart_rows", "cart_rows", ORPHAN_CART_LIMITS, "cart events")


def _duplicate_order_ids_verdict() -> Column:
    status = threshold_status(_share("order_id_copies", "order_rows"), DUPLICATE_ORDER_ID_LIMITS)
    return _row(DUPLICATE_ORDER_IDS, F.col("order_id_copies"), status, F.lit(DUPLICATE_ORDER_IDS_DETAIL))


def _purchase_before_checkout_verdict() -> Column:
    count = F.col("early_sessions")
    compared = (F.col("order_rows") > 0) & (F.col("checkout_rows") > 0)
    detail = F.when(compared, PURCHASE_BEFORE_CHECKOUT_DETAIL).otherwise("")
    verdict = _row(PURCHASE_BEFORE_CHECKOUT, count, _fail_if_any(count), detail)
    return _unless_unreadable(verdict, F.col("unreadable_times"), "times")


# Measurements


def _total(expression: Column) -> Column:
    """Sum that is 0 over no rows."""
    return F.coalesce(F.sum(expression), F.lit(0))


def _rows_and_copies(df: DataFrame, keys: tuple[str, ...], rows: str, copies: str) -> DataFrame:
    """Row count, and how many rows repeat the key of another one. NULL keys are equal."""
    per_key = df.groupBy(*key_columns(df, keys)).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(_total(F.col("n")).alias(rows), _total(F.col("n") - 1).alias(copies))


def _missing_source(traffic: DataFrame) -> DataFrame:
    return traffic.agg(
        F.count(F.lit(1)).alias("traffic_rows"), F.count_if(F.col("traffic_source").isNull()).alias("no_source_rows")
    )


def _unreadable(column: str, kind: str) -> Column:
    """Whether a value is there but not of its kind, as can be in a column of text."""
    return F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()


def _negative() -> Column:
    return F.col("gross_revenue").try_cast("double") < 0


def _amounts(negative: str = "negative", unreadable: str = "unreadable") -> list[Column]:
    return [
        F.count_if(_negative()).alias(negative),
        F.count_if(_unreadable("gross_revenue", "double")).alias(unreadable),
    ]


def _invalid() -> Column:
    return ~F.coalesce(F.col("order_status").isin(*ORDER_STATUSES), F.lit(False))


def _values_seen(orders: DataFrame) -> Column:
    """The five alphabetically first invalid statuses as list text. NULL counts as invalid but has no text."""
    status = F.col("order_status")

    def quoted(value: Column) -> Column:
        quote = F.when(value.contains("'"), '"').otherwise("'")
        return F.concat(quote, value, quote)

    values = orders.where(_invalid() & status.isNotNull()).select(status).distinct().orderBy(status).limit(5)
    listed = F.transform(F.array_sort(F.collect_list(status)), quoted)
    return values.agg(F.concat(F.lit("["), F.array_join(listed, ", "), F.lit("]"))).scalar()


def _orphan_cart(cart: DataFrame, traffic: DataFrame) -> DataFrame:
    """Cart rows of sessions without traffic. Both tables are counted by session together, which needs no join."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    views = traffic.select("session_id", one.alias("views"), zero.alias("cart_rows"))
    events = cart.select("session_id", zero.alias("views"), one.alias("cart_rows"))
    sessions = views.union(events).groupBy("session_id").agg(F.max("views").alias("views"), F.sum("cart_rows").alias("n"))
    return sessions.agg(
        _total(F.col("n")).alias("cart_rows"), _total(F.when(F.col("views") == 0, F.col("n"))).alias("orphan_cart_rows")
    )


def _orders_by_id(orders: DataFrame, checkout: DataFrame) -> DataFrame:
    """Orders by id, with their row counts and whether any row has a session without checkout."""
    session = "session_id"
    sessions = unique_side(checkout, session).withColumnRenamed(session, "checkout_session").withColumn("known", F.lit(True))
    marked = orders.join(sessions, F.col(session).eqNullSafe(F.col("checkout_session")), "left")
    return marked.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"),
        *_amounts(),
        F.count_if(_invalid()).alias("invalid"),
        F.max(flag(F.col("known").isNull())).alias("orphan"),
    )


def _orphan_orders(orders: DataFrame, checkout: DataFrame) -> DataFrame:
    by_id = _orders_by_id(orders, checkout).where(F.col("order_id").isNotNull())
    measured = by_id.agg(F.count(F.lit(1)).alias("order_ids"), _total(F.col("orphan")).alias("orphan_order_ids"))
    return _side_by_side(measured, checkout.limit(1).agg(F.count(F.lit(1)).alias("checkout_rows")))


def _side_by_side(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two measurements of one row each, with different columns, as one row."""
    both = one.unionByName(other, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns])


def _first_times(orders: DataFrame, checkout: DataFrame) -> DataFrame:
    """Sessions whose first order is earlier than their first checkout event, from one shuffle of both tables."""
    never = F.lit(None).cast("timestamp_ntz")
    time, unreadable = F.col("timestamp").try_cast("timestamp_ntz"), flag(_unreadable("timestamp", "timestamp_ntz"))
    ordered = orders.select(
        "session_id", time.alias("ordered"), never.alias("checked_out"), F.lit(1).alias("order"), unreadable.alias("unreadable")
    )
    checked = checkout.select("session_id", never, time, F.lit(0), unreadable)
    sessions = ordered.union(checked).groupBy("session_id").agg(
        F.min("ordered").alias("first_order"),
        F.min("checked_out").alias("first_checkout"),
        F.sum("order").alias("orders"),
        F.sum("unreadable").alias("unreadable"),
        F.count(F.lit(1)).alias("n"),
    )
    early = F.col("session_id").isNotNull() & (F.col("first_order") < F.col("first_checkout"))
    return sessions.agg(
        F.count_if(early).alias("early_sessions"),
        _total(F.col("unreadable")).alias("unreadable_times"),
        _total(F.col("orders")).alias("order_rows"),
        _total(F.col("n") - F.col("orders")).alias("checkout_rows"),
    )


def _report(measured: DataFrame, *verdicts: Column) -> DataFrame:
    return measured.select(F.inline(F.array(*verdicts)))


# Checks


def check_duplicate_traffic(traffic: DataFrame) -> DataFrame:
    return _report(_rows_and_copies(traffic, TRAFFIC_KEY, "traffic_rows", "traffic_copies"), _duplicate_traffic_verdict())


def check_duplicate_cart(cart: DataFrame) -> DataFrame:
    return _report(_rows_and_copies(cart, CART_KEY, "cart_rows", "cart_copies"), _duplicate_cart_verdict())


def check_missing_source(traffic: DataFrame) -> DataFrame:
    return _report(_missing_source(traffic), _missing_source_verdict())


def check_negative_revenue(orders: DataFrame) -> DataFrame:
    return _report(orders.agg(*_amounts("negative_rows", "unreadable_amounts")), _negative_revenue_verdict())


def check_invalid_order_status(orders: DataFrame) -> DataFrame:
    counts = orders.agg(F.count(F.lit(1)).alias("order_rows"), F.count_if(_invalid()).alias("invalid_rows"))
    return _report(counts, _invalid_status_verdict(orders))


def check_orphan_orders(orders: DataFrame, checkout: DataFrame) -> DataFrame:
    return _report(_orphan_orders(orders, checkout), _orphan_orders_verdict())


def check_orphan_cart(cart: DataFrame, traffic: DataFrame) -> DataFrame:
    return _report(_orphan_cart(cart, traffic), _orphan_cart_verdict())


def check_duplicate_order_ids(orders: DataFrame) -> DataFrame:
    return _report(_rows_and_copies(orders, ("order_id",), "order_rows", "order_id_copies"), _duplicate_order_ids_verdict())


def check_purchase_before_checkout(orders: DataFrame, checkout: DataFrame) -> DataFrame:
    return _report(_first_times(orders, checkout), _purchase_before_checkout_verdict())


# The report


def _single_checks(raw: RawTables) -> dict[str, Callable[[], DataFrame]]:
    traffic, cart, checkout, orders = raw.traffic_logs, raw.cart_actions, raw.checkout_events, raw.orders
    return {
        DUPLICATE_TRAFFIC: lambda: check_duplicate_traffic(traffic),
        DUPLICATE_CART: lambda: check_duplicate_cart(cart),
        MISSING_SOURCE: lambda: check_missing_source(traffic),
        NEGATIVE_REVENUE: lambda: check_negative_revenue(orders),
        INVALID_STATUS: lambda: check_invalid_order_status(orders),
        ORPHAN_ORDERS: lambda: check_orphan_orders(orders, checkout),
        ORPHAN_CART: lambda: check_orphan_cart(cart, traffic),
        DUPLICATE_ORDER_IDS: lambda: check_duplicate_order_ids(orders),
        PURCHASE_BEFORE_CHECKOUT: lambda: check_purchase_before_checkout(orders, checkout),
    }


def _browsing_checks(raw: RawTables) -> DataFrame:
    """The four checks on traffic and cart from one pass over each table.

    Both are counted by their duplicate key, then the counts by session.
    """
    traffic = raw.traffic_logs.groupBy(*key_columns(raw.traffic_logs, TRAFFIC_KEY)).agg(
        F.count(F.lit(1)).alias("views"), F.count_if(F.col("traffic_source").isNull()).alias("no_source")
    )
    cart = raw.cart_actions.groupBy(*key_columns(raw.cart_actions, CART_KEY)).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    views = traffic.select(
        "session_id", "views", (F.col("views") - 1).alias("view_copies"), "no_source", zero.alias("n"), zero.alias("copies")
    )
    events = cart.select("session_id", zero, zero, zero, "n", F.col("n") - 1)
    names = ("views", "view_copies", "no_source", "n", "copies")
    sessions = views.union(events).groupBy("session_id").agg(*[F.sum(name).alias(name) for name in names])
    measured = sessions.agg(
        _total(F.col("views")).alias("traffic_rows"),
        _total(F.col("view_copies")).alias("traffic_copies"),
        _total(F.col("no_source")).alias("no_source_rows"),
        _total(F.col("n")).alias("cart_rows"),
        _total(F.col("copies")).alias("cart_copies"),
        _total(F.when(F.col("views") == 0, F.col("n"))).alias("orphan_cart_rows"),
    )
    return _report(
        measured, _duplicate_traffic_verdict(), _duplicate_cart_verdict(), _missing_source_verdict(), _orphan_cart_verdict()
    )


def _order_checks(raw: RawTables) -> DataFrame:
    """The four checks on order rows from one pass over the orders, and the sequence check from one over both tables.

    The invalid values that the report lists take another pass over the orders.
    """
    named = F.col("order_id").isNotNull()
    measured = _orders_by_id(raw.orders, raw.checkout_events).agg(
        _total(F.col("n")).alias("order_rows"),
        _total(F.col("n") - 1).alias("order_id_copies"),
        _total(F.col("negative")).alias("negative_rows"),
        _total(F.col("unreadable")).alias("unreadable_amounts"),
        _total(F.col("invalid")).alias("invalid_rows"),
        F.count_if(named).alias("order_ids"),
        _total(F.when(named, F.col("orphan"))).alias("orphan_order_ids"),
    )
    return _report(
        _side_by_side(measured.drop("order_rows"), _first_times(raw.orders, raw.checkout_events)),
        _negative_revenue_verdict(),
        _invalid_status_verdict(raw.orders),
        _orphan_orders_verdict(),
        _duplicate_order_ids_verdict(),
        _purchase_before_checkout_verdict(),
    )


_GROUPS = (
    (_browsing_checks, (DUPLICATE_TRAFFIC, DUPLICATE_CART, MISSING_SOURCE, ORPHAN_CART)),
    (_order_checks, (NEGATIVE_REVENUE, INVALID_STATUS, ORPHAN_ORDERS, DUPLICATE_ORDER_IDS, PURCHASE_BEFORE_CHECKOUT)),
)
_REPORT_SCHEMA = "Metric string, Value double, Unit string, Status string, Detail string"


def _error_row(metric: str, error: Exception) -> tuple:
    """A FAIL with the first line of what went wrong."""
    text = error.java_exception.getMessage() if isinstance(error, Py4JJavaError) else str(error)
    return metric, None, "count", "FAIL", f"Check error: {(text or type(error).__name__).splitlines()[0]}"


def run_all_checks(raw: RawTables) -> DataFrame:
    """The nine checks as one report in fixed order, not evaluated yet.

    A check that cannot run on these tables, for want of a column or because values are not of their kind, is reported as
    a FAIL row and leaves the others as they are. For errors that only show when a table is read, such as a damaged file,
    see ``report_despite_errors``.
    """
    singles = _single_checks(raw)
    parts: list[DataFrame] = []
    for group, metrics in _GROUPS:
        try:
            parts.append(group(raw))
        except AnalysisException:
            for metric in metrics:
                try:
                    parts.append(singles[metric]())
                except AnalysisException as error:
                    parts.append(raw.orders.sparkSession.createDataFrame([_error_row(metric, error)], _REPORT_SCHEMA))
    rows = reduce(DataFrame.unionByName, parts)
    position = F.array_position(F.array(*[F.lit(metric) for metric in REPORT_ORDER]), F.col("Metric"))
    return rows.orderBy(position).select(*REPORT_COLUMNS)


def report_despite_errors(raw: RawTables) -> DataFrame:
    """The report of ``run_all_checks``, evaluated, whatever goes wrong while a table is read.

    As long as nothing fails it is the one job of that report. Else each group of checks runs alone, and the checks of a
    group that fails one by one: those that don't need what is broken give their values, the others a FAIL row with the
    error.
    """
    try:
        rows = [tuple(row) for row in run_all_checks(raw).collect()]
    except _RUN_TIME_ERRORS:
        singles, found = _single_checks(raw), {}
        for group, metrics in _GROUPS:
            try:
                found |= {row.Metric: tuple(row) for row in group(raw).collect()}
            except _RUN_TIME_ERRORS:
                for metric in metrics:
                    try:
                        found[metric] = tuple(singles[metric]().first())
                    except _RUN_TIME_ERRORS as error:
                        found[metric] = _error_row(metric, error)
        rows = [found[metric] for metric in REPORT_ORDER]
    return raw.orders.sparkSession.createDataFrame(rows, _REPORT_SCHEMA)
