from datetime import date, datetime

import pytest

from shop import checkout, nested_shop, order, shop, view
from sluicebox.operators.session_filter import dashboard_filter, filter_sessions
from sluicebox.plans import reports, tables
from sluicebox.plans.mart import fct_sessions


@pytest.fixture(scope="module")
def nested(spark):
    mart = fct_sessions(nested_shop(spark)).cache()
    yield mart
    mart.unpersist()


@pytest.fixture(scope="module")
def views_only(spark):
    return fct_sessions(shop(spark, [view("s1"), view("s2")]))


def test_nested_funnel_is_monotonic_with_rates_in_the_unit_interval(nested):
    row = reports.funnel_headline(nested).first()
    assert (row.product_view_sessions, row.add_to_cart_sessions, row.checkout_sessions, row.purchase_sessions) == (20, 8, 5, 3)
    for rate in (row.atc_rate, row.checkout_rate, row.purchase_rate, row.overall_conversion):
        assert 0.0 <= rate <= 1.0
    assert row.checkout_drop_off == 1.0 - 0.6
    assert row.abandoned_checkout_sessions == 2


def test_funnel_rows(nested):
    rows = [tuple(row) for row in reports.funnel_metrics(nested).collect()]
    assert rows == [
        ("Product View", 20, None, None, 1.0),
        ("Add to Cart", 8, 0.4, 0.6, 0.4),
        ("Checkout", 5, 0.625, 0.375, 0.25),
        ("Purchase", 3, 0.6, 0.4, 0.15),
    ]


def test_revenue_formulas(nested):
    row = reports.revenue_headline(nested).first()
    assert (row.gross_revenue, row.discount, row.net_revenue, row.paid_order_lines) == (90.0, 9.0, 81.0, 3)
    assert row.aov == row.gross_revenue / row.paid_order_lines == 30.0
    assert row.estimated_abandoned_revenue == (5 - 3) * row.aov
    full = reports.revenue_metrics(nested).first()
    assert (full.abandoned_checkout_sessions, full.paid_sessions, full.aov) == (2, 3, 30.0)


def test_scenario_is_a_relative_improvement(nested):
    row = reports.checkout_scenario(nested, 0.05).first()
    assert row.new_rate == pytest.approx(row.current_rate * 1.05, rel=1e-12)
    assert row.additional_purchases == pytest.approx(5 * (row.new_rate - row.current_rate), rel=1e-12)
    assert row.incremental_revenue == pytest.approx(row.additional_purchases * 30.0, rel=1e-12)


def test_scenario_rate_stops_at_one(nested):
    row = reports.checkout_scenario(nested, 0.9).first()
    assert (row.current_rate, row.new_rate, row.additional_purchases) == (0.6, 1.0, 2.0)


def test_zero_denominators(views_only):
    rows = [tuple(row)[2:] for row in reports.funnel_metrics(views_only).collect()]
    assert rows == [(None, None, 1.0), (0.0, 1.0, 0.0), (None, None, 0.0), (None, None, 0.0)]
    row = reports.headline(views_only).first()
    assert (row.checkout_rate, row.purchase_rate, row.checkout_drop_off, row.aov) == (0.0, 0.0, 1.0, 0.0)
    assert reports.leakage_alert(views_only).first().alert is True
    daily = reports.daily_performance(views_only).first()
    assert (daily.aov, daily.checkout_rate, daily.purchase_rate, daily.conversion_rate) == (None, None, None, 0.0)
    segment = reports.segment_performance(views_only, "device").first()
    assert (segment.aov, segment.checkout_rate) == (0.0, None)
    assert tables.segment_display(views_only, "device").first()["Checkout rate"] == "—"


def test_no_sessions(nested):
    nothing = filter_sessions(nested, sources=["none"])
    row = reports.headline(nothing).first()
    assert set(row.asDict().values()) == {0, 0.0, 1.0}
    assert row.checkout_drop_off == 1.0
    assert reports.checkout_scenario(nothing).first().incremental_revenue == 0.0
    assert reports.daily_trend(nothing).count() == 0
    assert reports.segment_performance(nothing, "device").count() == 0
    assert reports.device_comparison(nothing).count() == 0
    assert [row.sessions for row in reports.funnel_metrics(nothing).collect()] == [None] * 4
    full = reports.revenue_metrics(nothing).first()
    assert (full.checkout_sessions, full.gross_revenue, full.paid_order_lines, full.aov) == (None, None, 0, 0.0)


def test_abandoned_is_clamped_for_people_but_not_in_the_revenue_report(spark):
    mart = fct_sessions(shop(spark, [view("s1"), view("s2")], orders=[order("s1"), order("s2")]))
    assert reports.funnel_headline(mart).first().abandoned_checkout_sessions == 0
    full = reports.revenue_metrics(mart).first()
    assert (full.abandoned_checkout_sessions, full.estimated_abandoned_revenue) == (-2, -20.0)
    assert reports.revenue_headline(mart).first().estimated_abandoned_revenue == -20.0


def test_session_over_midnight_counts_on_its_first_day(spark):
    raw = shop(spark, [view("s1", "2024-01-01 23:59:00")], orders=[order("s1", "2024-01-02 00:10:00")])
    rows = reports.daily_trend(fct_sessions(raw)).collect()
    assert [(r.day, r.sessions, r.orders, r.revenue) for r in rows] == [(datetime(2024, 1, 1), 1, 1, 10.0)]


def test_daily_aov_is_over_purchasing_sessions(spark):
    raw = shop(spark, [view("s1"), view("s2"), view("s3")], orders=[order("s1", gross=10.0), order("s2", gross=20.0)])
    row = reports.daily_performance(fct_sessions(raw)).first()
    assert (row.sessions, row.orders, row.revenue, row.aov) == (3, 2, 30.0, 15.0)


def test_segments_are_ordered_by_size_then_name(spark):
    raw = shop(spark, [view("s1"), view("s2", source="Google"), view("s3", source=None), view("s4", source="Google")])
    rows = reports.segment_performance(fct_sessions(raw), "traffic_source").collect()
    assert [(r.segment, r.sessions) for r in rows] == [("Google", 2), ("Meta", 1), ("Unknown", 1)]


def test_unsupported_dimension(nested):
    with pytest.raises(ValueError, match="product"):
        reports.segment_performance(nested, "product")


def test_device_comparison_needs_both_devices(spark):
    both = shop(spark, [view("s1"), view("s2", device="desktop")], checkouts=[checkout("s1")], orders=[order("s1")])
    row = reports.device_comparison(fct_sessions(both)).first()
    assert (row.mobile_purchase_rate, row.desktop_purchase_rate) == (1.0, None)
    assert tables.device_message(fct_sessions(both)).first().message == (
        "Mobile checkout→purchase rate is 100.00%, compared with — on desktop."
    )
    assert reports.device_comparison(fct_sessions(shop(spark, [view("s1")]))).count() == 0


def test_date_bounds(spark):
    mart = fct_sessions(shop(spark, [view("s1", "2024-01-03 00:00:00"), view("s2", "2024-01-05 23:59:59")]))
    assert tuple(reports.date_bounds(mart).first()) == (date(2024, 1, 3), date(2024, 1, 5))
    assert tuple(reports.date_bounds(filter_sessions(mart, sources=["none"])).first()) == (None, None)


def test_alert_message(views_only, nested):
    assert tables.leakage_message(views_only).first().message == (
        "Critical checkout leakage: 100.0% of checkout sessions do not convert."
    )
    assert tables.leakage_message(nested).count() == 0


def test_display_tables(nested):
    assert [tuple(row) for row in tables.funnel_display(nested).collect()] == [
        ("Product View", 20, "—", "—"),
        ("Add to Cart", 8, "40.0%", "60.0%"),
        ("Checkout", 5, "62.5%", "37.5%"),
        ("Purchase", 3, "60.0%", "40.0%"),
    ]
    assert tuple(tables.kpi_display(nested).first()) == ("$90.00", "3", "20", "15.00%", "$30.00", "$60.00")
    assert tuple(tables.scenario_display(nested).first()) == ("60.00%", "63.00%", "0", "$4.50")
    assert tables.segment_display(nested, "traffic_source").columns[0] == "Traffic Source"
    figures = {row.Figure: row.Value for row in tables.headline_report(nested).collect()}
    assert figures["Overall conversion"] == "15.00%" and figures["AOV"] == "$30.00" and len(figures) == 14


@pytest.mark.parametrize(
    ("filters", "kept"),
    [
        ({}, ["a", "b", "c", "d"]),
        ({"start_date": "2024-01-02"}, ["b", "c", "d"]),
        ({"end_date": date(2024, 1, 2)}, ["a", "b"]),
        ({"start_date": date(2024, 1, 2), "end_date": "2024-01-02"}, ["b"]),
        ({"sources": ["Meta", None, ""]}, ["a", "d"]),
        ({"sources": [None, ""]}, ["a", "b", "c", "d"]),
        ({"sources": []}, ["a", "b", "c", "d"]),
        ({"sources": iter(["Unknown"])}, ["c"]),
        ({"devices": ["mobile"]}, ["a", "b"]),
        ({"devices": ["mobile", "tablet", "desktop"]}, ["a", "b", "c"]),
        ({"sources": ["Meta"], "devices": ["tablet"]}, []),
    ],
)
def test_filters(spark, filters, kept):
    mart = fct_sessions(
        shop(
            spark,
            [
                view("a", "2024-01-01 23:59:59"),
                view("b", "2024-01-02 23:59:59", source="Google"),
                view("c", "2024-01-03 00:00:00", source=None, device="tablet"),
                view("d", "2024-01-04 00:00:00", device=None),
            ],
        )
    )
    assert sorted(row.session_id for row in filter_sessions(mart, **filters).collect()) == kept


def test_dashboard_defaults(spark):
    mart = fct_sessions(shop(spark, [view("a"), view("b", device=None), view("c", source="Email"), view("d", "2024-02-01 00:00:00")]))

    def kept(**choices):
        return sorted(row.session_id for row in dashboard_filter(mart, **choices).collect())

    assert kept() == ["a", "d"]
    assert kept(date_range=("2024-01-15",)) == ["a", "d"]
    assert kept(date_range=("2024-01-15", "2024-02-01")) == ["d"]
    assert kept(sources=["Google"]) == []
