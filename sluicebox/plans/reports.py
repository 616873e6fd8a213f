"""Reports on the session mart.

Each report is one aggregation of the mart. Filters are put on the mart first, see operators.session_filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.config import DEFAULT_RELATIVE_IMPROVEMENT, FUNNEL_STAGES, LEAKAGE_ALERT_THRESHOLD, SEGMENT_DIMENSIONS
from sluicebox.functions.money import exact_sum
from sluicebox.functions.rates import (
    at_least_zero,
    at_most_one,
    average_or_zero,
    drop_off,
    ratio_or_null,
    ratio_or_zero,
)

def _bought() -> Column:
    return F.col("purchased") == 1


def _aov() -> Column:
    return average_or_zero(F.col("gross_revenue"), F.col("paid_order_lines"))


def _totals(mart: DataFrame) -> DataFrame:
    """One row with every count and amount the headline reports need. Unused ones are pruned."""
    return mart.agg(
        F.expr("count(1) AS product_view_sessions"),
        F.expr("sum(added_to_cart) AS add_to_cart_sessions"),
        F.expr("sum(reached_checkout) AS checkout_sessions"),
        F.expr("sum(purchased) AS purchase_sessions"),
        *_paid_totals(),
    )


def _paid_totals() -> list[Column]:
    amounts = [exact_sum(F.when(_bought(), F.col(name))).alias(name) for name in ("gross_revenue", "discount", "net_revenue")]
    # Sessions with a purchase, under the name the reports have always given this number.
    return [F.count_if(_bought()).alias("paid_order_lines"), *amounts]


def _purchase_rate() -> Column:
    return ratio_or_zero(F.col("purchase_sessions"), F.col("checkout_sessions"))


def _abandoned() -> Column:
    return F.col("checkout_sessions") - F.col("purchase_sessions")


# Figures derived from the totals. Rates of nothing are 0. Abandoned sessions stop at 0, abandoned revenue does not.
_DERIVED = {
    "atc_rate": lambda: ratio_or_zero(F.col("add_to_cart_sessions"), F.col("product_view_sessions")),
    "checkout_rate": lambda: ratio_or_zero(F.col("checkout_sessions"), F.col("add_to_cart_sessions")),
    "purchase_rate": _purchase_rate,
    "overall_conversion": lambda: ratio_or_zero(F.col("purchase_sessions"), F.col("product_view_sessions")),
    "checkout_drop_off": lambda: drop_off(_purchase_rate()),
    "abandoned_checkout_sessions": lambda: at_least_zero(_abandoned()),
    "aov": _aov,
    "estimated_abandoned_revenue": lambda: _abandoned() * _aov(),
}
_FUNNEL = tuple(key for _, key in FUNNEL_STAGES)
_REVENUE = ("gross_revenue", "discount", "net_revenue", "paid_order_lines")


def headline(mart: DataFrame, *names: str) -> DataFrame:
    """Funnel counts and rates, revenue, average order value and abandoned revenue in one row, zeros if there are none."""
    # Only NULL becomes 0; a total that is not a number stays one.
    totals = _totals(mart)
    totals = totals.select(*[F.coalesce(name, F.lit(0)).alias(name) for name in totals.columns])
    wanted = names or (*_FUNNEL, *_REVENUE, *_DERIVED)
    return totals.select(*[_DERIVED[name]().alias(name) if name in _DERIVED else F.col(name) for name in wanted])


def funnel_headline(mart: DataFrame) -> DataFrame:
    rates = ("atc_rate", "checkout_rate", "purchase_rate", "overall_conversion")
    return headline(mart, *_FUNNEL, *rates, "checkout_drop_off", "abandoned_checkout_sessions")


def revenue_headline(mart: DataFrame) -> DataFrame:
    return headline(mart, *_REVENUE, "aov", "estimated_abandoned_revenue")


def funnel_metrics(mart: DataFrame) -> DataFrame:
    """The funnel as four rows. Rates of nothing are NULL."""
    # Counts of an empty mart are NULL here, the number of sessions included.
    views = F.when(F.col("product_view_sessions") > 0, F.col("product_view_sessions"))
    counts = [views] + [F.col(key) for _, key in FUNNEL_STAGES[1:]]
    stages = []
    for position, (label, _) in enumerate(FUNNEL_STAGES):
        first = position == 0
        from_previous = F.lit(None).cast("double") if first else ratio_or_null(counts[position], counts[position - 1])
        stages.append(
            F.struct(
                F.lit(label).alias("stage"),
                counts[position].alias("sessions"),
                from_previous.alias("conv_from_previous"),
                drop_off(from_previous).alias("drop_off"),
                (F.lit(1.0) if first else ratio_or_null(counts[position], views)).alias("cumulative_conversion"),
            )
        )
    return _totals(mart).select(F.inline(F.array(*stages)))


def revenue_metrics(mart: DataFrame) -> DataFrame:
    """Revenue, average order value and abandoned revenue. Amounts of nothing are NULL, abandoned may be negative."""
    totals = mart.agg(
        F.expr("sum(reached_checkout) AS checkout_sessions"),
        F.expr("sum(purchased) AS purchase_sessions"),
        F.expr("count(DISTINCT CASE WHEN purchased = 1 THEN session_id END) AS paid_sessions"),
        *_paid_totals(),
    )
    return totals.select(
        "checkout_sessions",
        "purchase_sessions",
        _abandoned().alias("abandoned_checkout_sessions"),
        "paid_order_lines",
        "paid_sessions",
        "gross_revenue",
        "discount",
        "net_revenue",
        _aov().alias("aov"),
        (_abandoned() * _aov()).alias("estimated_abandoned_revenue"),
    )


def _group_measures() -> dict[str, Column]:
    sessions, carts = F.count(F.lit(1)), F.sum("added_to_cart")
    checkouts, purchases = F.sum("reached_checkout"), F.sum("purchased")
    return {
        "sessions": sessions,
        "orders": purchases,
        "revenue": exact_sum(F.col("gross_revenue")),
        "atc_rate": ratio_or_null(carts, sessions),
        "checkout_rate": ratio_or_null(checkouts, carts),
        "purchase_rate": ratio_or_null(purchases, checkouts),
        "conversion_rate": ratio_or_null(purchases, sessions),
    }


def _by_day(mart: DataFrame, measures: dict[str, Column]) -> DataFrame:
    day = F.to_date("first_seen_at").cast("timestamp_ntz").alias("day")
    return mart.groupBy(day).agg(*[measure.alias(name) for name, measure in measures.items()]).orderBy("day")


def daily_trend(mart: DataFrame) -> DataFrame:
    """Sessions, purchases, revenue and conversion by day of the session's first event."""
    measures = _group_measures()
    return _by_day(mart, {name: measures[name] for name in ("sessions", "orders", "revenue", "conversion_rate")})


def daily_performance(mart: DataFrame) -> DataFrame:
    """The daily trend with every stage rate and the average order value, NULL on days without a purchase."""
    bought = F.when(_bought(), F.col("gross_revenue"))
    aov = ratio_or_null(exact_sum(bought), F.count(bought))
    measures = _group_measures()
    names = ("sessions", "orders", "revenue", "aov", "atc_rate", "checkout_rate", "purchase_rate", "conversion_rate")
    return _by_day(mart, {name: measures.get(name, aov) for name in names})


def segment_performance(mart: DataFrame, dimension: str) -> DataFrame:
    """Performance by first-touch source or by device, largest segment first."""
    if dimension not in SEGMENT_DIMENSIONS:
        raise ValueError(f"Unsupported dimension: {dimension}")
    measures = _group_measures()
    measures["aov"] = average_or_zero(measures["revenue"], measures["orders"])
    segments = mart.groupBy(F.col(dimension).alias("segment"))
    return segments.agg(*[measure.alias(name) for name, measure in measures.items()]).orderBy(F.desc("sessions"), "segment")


def device_comparison(mart: DataFrame) -> DataFrame:
    """Purchase rates of mobile and desktop side by side; no row unless both occur."""

    def of(device: str, column: str) -> Column:
        return F.sum(F.when(F.col("device") == device, F.col(column)))

    rates = mart.agg(
        *[
            ratio_or_null(of(device, "purchased"), of(device, "reached_checkout")).alias(f"{device}_purchase_rate")
            for device in ("mobile", "desktop")
        ],
        *[F.count_if(F.col("device") == device).alias(f"{device}_sessions") for device in ("mobile", "desktop")],
    )
    both = rates.where((F.col("mobile_sessions") > 0) & (F.col("desktop_sessions") > 0))
    return both.select("mobile_purchase_rate", "desktop_purchase_rate")


def scenario_figures(relative_improvement: float) -> dict[str, Column]:
    """The scenario's figures from those of the headline."""
    current = F.col("purchase_rate")
    new = at_most_one(current * F.lit(1.0 + relative_improvement))
    additional = F.col("checkout_sessions") * (new - current)
    return {
        "current_rate": current,
        "new_rate": new,
        "additional_purchases": additional,
        "incremental_revenue": additional * F.col("aov"),
    }


def checkout_scenario(mart: DataFrame, relative_improvement: float = DEFAULT_RELATIVE_IMPROVEMENT) -> DataFrame:
    """What a relative rise of the purchase rate would bring. The raised rate stops at 1."""
    figures = scenario_figures(relative_improvement)
    return headline(mart, "purchase_rate", "checkout_sessions", "aov").select(*[figure.alias(name) for name, figure in figures.items()])


def date_bounds(mart: DataFrame) -> DataFrame:
    """First and last day with a session."""
    return mart.agg(
        F.to_date(F.min("first_seen_at")).alias("min_date"), F.to_date(F.max("first_seen_at")).alias("max_date")
    )


def kpi_row(mart: DataFrame) -> DataFrame:
    headings = {
        "gross_revenue": "revenue",
        "paid_order_lines": "paid_orders",
        "product_view_sessions": "sessions",
        "overall_conversion": "conversion",
    }
    return headline(mart, *headings, "aov", "estimated_abandoned_revenue").withColumnsRenamed(headings)


def leakage_alert(mart: DataFrame) -> DataFrame:
    """Whether more than the tolerated share of checkout sessions ends without a purchase."""
    lost = F.col("checkout_drop_off")
    return headline(mart, "checkout_drop_off").select(
        lost, F.lit(LEAKAGE_ALERT_THRESHOLD).alias("threshold"), (lost > LEAKAGE_ALERT_THRESHOLD).alias("alert")
    )
