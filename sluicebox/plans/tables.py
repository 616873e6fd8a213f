"""Reports as display tables: formatted text under the headings people read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.config import (
    DEFAULT_RELATIVE_IMPROVEMENT,
    DEVICE_MESSAGE,
    FUNNEL_FIGURES,
    FUNNEL_HEADINGS,
    FUNNEL_STAGES,
    KPI_HEADINGS,
    LEAKAGE_MESSAGE,
    REVENUE_FIGURES,
    SCENARIO_HEADINGS,
    SEGMENT_HEADINGS,
)
from sluicebox.functions.display import dash_if_null, grouped_count, money, percent, plain_number
from sluicebox.functions.rates import drop_off
from sluicebox.plans import reports


def _headed(values: list[Column], headings: tuple[str, ...]) -> list[Column]:
    return [value.alias(heading) for value, heading in zip(values, headings, strict=True)]


def _sentence(parts: tuple[str, ...], *values: Column) -> Column:
    """The fixed parts with the values between them."""
    return F.concat(*[piece for part, value in zip(parts, (*values, F.lit("")), strict=True) for piece in (F.lit(part), value)])


def funnel_display(mart: DataFrame) -> DataFrame:
    """The funnel with percents of one decimal; the first stage has no predecessor."""
    rates = (None, F.col("atc_rate"), F.col("checkout_rate"), F.col("purchase_rate"))

    def text(rate: Column | None) -> Column:
        return dash_if_null(F.lit(None).cast("string") if rate is None else percent(rate, 1))

    rows = [
        F.struct(*_headed([F.lit(label), F.col(key), text(rate), text(None if rate is None else drop_off(rate))], FUNNEL_HEADINGS))
        for (label, key), rate in zip(FUNNEL_STAGES, rates, strict=True)
    ]
    wanted = [key for _, key in FUNNEL_STAGES] + ["atc_rate", "checkout_rate", "purchase_rate"]
    return reports.headline(mart, *wanted).select(F.inline(F.array(*rows)))


def segment_display(mart: DataFrame, dimension: str) -> DataFrame:
    rates = ("atc_rate", "checkout_rate", "purchase_rate", "conversion_rate")
    formatted = {name: dash_if_null(percent(F.col(name))) for name in rates}
    formatted |= {name: money(F.col(name)) for name in ("revenue", "aov")}
    headings = {"segment": dimension.replace("_", " ").title()} | SEGMENT_HEADINGS
    return reports.segment_performance(mart, dimension).withColumns(formatted).withColumnsRenamed(headings)


def kpi_display(mart: DataFrame) -> DataFrame:
    values = [
        money(F.col("revenue")),
        grouped_count(F.col("paid_orders")),
        grouped_count(F.col("sessions")),
        percent(F.col("conversion")),
        money(F.col("aov")),
        money(F.col("estimated_abandoned_revenue")),
    ]
    return reports.kpi_row(mart).select(*_headed(values, KPI_HEADINGS))


def _scenario_texts(figures: dict[str, Column]) -> list[Column]:
    return [
        percent(figures["current_rate"]),
        percent(figures["new_rate"]),
        plain_number(figures["additional_purchases"], 0),
        money(figures["incremental_revenue"]),
    ]


def scenario_display(mart: DataFrame, relative_improvement: float = DEFAULT_RELATIVE_IMPROVEMENT) -> DataFrame:
    scenario = reports.checkout_scenario(mart, relative_improvement)
    texts = _scenario_texts({name: F.col(name) for name in scenario.columns})
    return scenario.select(*_headed(texts, SCENARIO_HEADINGS))


def leakage_message(mart: DataFrame) -> DataFrame:
    """The alert as a sentence; no row while there is nothing to warn of."""
    lost = percent(F.col("checkout_drop_off"), 1)
    return reports.leakage_alert(mart).where("alert").select(_sentence(LEAKAGE_MESSAGE, lost).alias("message"))


def device_message(mart: DataFrame) -> DataFrame:
    mobile, desktop = (dash_if_null(percent(F.col(f"{device}_purchase_rate"))) for device in ("mobile", "desktop"))
    return reports.device_comparison(mart).select(_sentence(DEVICE_MESSAGE, mobile, desktop).alias("message"))


def headline_report(mart: DataFrame, relative_improvement: float = DEFAULT_RELATIVE_IMPROVEMENT) -> DataFrame:
    """Funnel, revenue and scenario figures as text, one figure per row."""
    none = F.lit(None).cast("string")
    counts = [grouped_count(F.col(key)) for _, key in FUNNEL_STAGES]
    rates = [none, *[percent(F.col(name)) for name in ("atc_rate", "checkout_rate", "purchase_rate")], none, none]
    funnel = [*counts, percent(F.col("overall_conversion")), percent(F.col("checkout_drop_off"))]
    revenue = [money(F.col(name)) for name in ("gross_revenue", "net_revenue", "aov", "estimated_abandoned_revenue")]
    scenario = _scenario_texts(reports.scenario_figures(relative_improvement))
    rows = [("Funnel", *row) for row in zip(FUNNEL_FIGURES, funnel, rates, strict=True)]
    rows += [("Revenue", figure, value, none) for figure, value in zip(REVENUE_FIGURES, revenue, strict=True)]
    rows += [("Scenario", figure, value, none) for figure, value in zip(SCENARIO_HEADINGS, scenario, strict=True)]
    structs = [
        F.struct(F.lit(s).alias("Section"), F.lit(f).alias("Figure"), value.alias("Value"), rate.alias("Rate"))
        for s, f, value, rate in rows
    ]
    return reports.headline(mart).select(F.inline(F.array(*structs)))
