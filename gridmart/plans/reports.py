"""The data behind the report pages: one query per chart or row of cards."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.fixed_values import REPORTING_THROUGH
from gridmart.plans import measures as m
from gridmart.plans import views
from gridmart.plans.warehouse import Star


def cards(*single_rows: DataFrame) -> DataFrame:
    """One-row results as rows ``(card, value)``."""
    return reduce(
        DataFrame.unionByName, [df.unpivot([], df.columns, "card", "value") for df in single_rows]
    )


def executive_cards(star: Star, period: Column) -> DataFrame:
    shown = [m.TOTAL_RETAIL_SALES, m.TOTAL_REVENUE, m.AVERAGE_PRICE, m.CUSTOMERS_LATEST_MONTH]
    return cards(m.evaluate(views.retail_kpi(star), shown, where=period))


def price_trend(star: Star, period: Column) -> DataFrame:
    return m.evaluate(views.retail_kpi(star), [m.AVERAGE_PRICE], ["full_date"], period)


def sales_and_generation_trend(star: Star, period: Column) -> DataFrame:
    sums = [
        m.total("retail_sales", "retail_sales_mwh"),
        m.total("generation", "generation_mwh"),
    ]
    return m.evaluate(views.retail_generation_kpi(star), sums, ["full_date"], period)


def category_trend(star: Star, period: Column) -> DataFrame:
    by = ["full_date", "energy_category"]
    return m.evaluate(views.generation_mix(star), [m.TOTAL_GENERATION], by, period)


def state_cards(star: Star, period: Column) -> DataFrame:
    shown = [m.TOTAL_RETAIL_SALES, m.AVERAGE_PRICE, m.TOTAL_GENERATION, m.GENERATION_SURPLUS]
    return cards(m.evaluate(views.state_months(star), shown, where=period))


def state_comparison(star: Star, period: Column) -> DataFrame:
    """States with retail rows, with what they generate beyond their sales."""
    shown = [m.TOTAL_RETAIL_SALES, m.AVERAGE_PRICE, m.GENERATION_SURPLUS, m.total("retail_rows", "retail_rows")]
    found = m.evaluate(views.state_months(star), shown, ["state_code"], period)
    return found.where("retail_rows > 0").drop("retail_rows")


def sector_comparison(star: Star, period: Column) -> DataFrame:
    shown = [m.SECTOR_REVENUE, m.SECTOR_SALES, m.SECTOR_AVERAGE_PRICE]
    return m.evaluate(views.sector_kpi(star), shown, ["sector_name"], period)


def sector_trend(star: Star, period: Column) -> DataFrame:
    by = ["full_date", "sector_name"]
    return m.evaluate(views.sector_kpi(star), [m.SECTOR_SALES], by, period)


_SHARES = [m.FOSSIL_SHARE, m.NUCLEAR_SHARE, m.RENEWABLE_SHARE]


def mix_cards(star: Star, period: Column) -> DataFrame:
    shown = [m.TOTAL_GENERATION, *_SHARES]
    return cards(m.evaluate(views.generation_mix(star), shown, where=period))


def generation_by_source(star: Star, period: Column) -> DataFrame:
    """Per source; the category of a source is unique, so grouping by both keeps the sources."""
    by = ["energy_category", "energy_source_name"]
    return m.evaluate(views.generation_mix(star), [m.TOTAL_GENERATION], by, period)


def generation_by_category(star: Star, period: Column) -> DataFrame:
    by = ["energy_category"]
    return m.evaluate(views.generation_mix(star), [m.TOTAL_GENERATION], by, period)


def share_trend(star: Star, period: Column) -> DataFrame:
    return m.evaluate(views.generation_mix(star), _SHARES, ["full_date"], period)


def weather_cards(star: Star, period: Column) -> DataFrame:
    shown = [m.AVERAGE_TEMPERATURE, m.TOTAL_RETAIL_SALES, m.AVERAGE_CDD, m.AVERAGE_HDD]
    return cards(m.evaluate(views.weather_demand_kpi(star), shown, where=period))


def weather_scatter(star: Star, period: Column) -> DataFrame:
    return views.weather_demand_kpi(star).where(period).select(
        "state_code",
        "full_date",
        "avg_temperature",
        "cooling_degree_days",
        "heating_degree_days",
        "sales_mwh",
    )


def weather_by_quarter(star: Star, period: Column) -> DataFrame:
    shown = [m.AVERAGE_TEMPERATURE, m.AVERAGE_CDD, m.AVERAGE_HDD, m.TOTAL_RETAIL_SALES]
    quarters = views.weather_demand_kpi(star).withColumn("quarter", F.quarter("full_date"))
    return m.evaluate(quarters, shown, ["year", "quarter"], period)


REPORTS: dict[str, Callable[[Star, Column], DataFrame]] = {
    "executive_cards": executive_cards,
    "price_trend": price_trend,
    "sales_and_generation_trend": sales_and_generation_trend,
    "category_trend": category_trend,
    "state_cards": state_cards,
    "state_comparison": state_comparison,
    "sector_comparison": sector_comparison,
    "sector_trend": sector_trend,
    "mix_cards": mix_cards,
    "generation_by_source": generation_by_source,
    "generation_by_category": generation_by_category,
    "share_trend": share_trend,
    "weather_cards": weather_cards,
    "weather_scatter": weather_scatter,
    "weather_by_quarter": weather_by_quarter,
}


def report(name: str, star: Star, through: dt.date = REPORTING_THROUGH) -> DataFrame:
    """A report over the months up to ``through``."""
    return REPORTS[name](star, F.col("full_date") <= F.lit(through))
