"""Measures: named aggregates over a view, for any grouping and filter the caller picks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.fixed_values import REPORTING_THROUGH


Totals = Callable[[str], Column]


@dataclass(frozen=True)
class Measure:
    """A name, what it adds up in the rows, and how its value comes from the totals.

    Sums of sums are sums, so a measure can be evaluated over any number of levels. With
    ``latest_of`` it is the sum of that column in the newest month, see ``evaluate``.
    """

    name: str
    sums: Callable[[], Mapping[str, Column]]
    value: Callable[[Totals], Column]
    latest_of: str | None = None


def _sum_of(column: str) -> Callable[[], Mapping[str, Column]]:
    return lambda: {column: F.col(column)}


def total(name: str, column: str, factor: int = 1) -> Measure:
    return Measure(name, _sum_of(column), lambda t: t(column) * factor if factor != 1 else t(column))


def mean(name: str, column: str) -> Measure:
    known = f"known {column}"
    return Measure(
        name,
        lambda: {column: F.col(column), known: F.when(F.col(column).isNotNull(), 1)},
        lambda t: t(column) / t(known),
    )


def latest(name: str, column: str) -> Measure:
    return Measure(name, dict, lambda t: t(column), latest_of=column)


def price(name: str) -> Measure:
    # Weighted by sales; a mean of monthly prices would weigh small months like large ones.
    return Measure(
        name,
        lambda: {c: F.col(c) for c in ("revenue_thousand_dollars", "sales_mwh")},
        lambda t: F.try_divide(t("revenue_thousand_dollars") * 100, t("sales_mwh")),
    )


def _category(name: str) -> dict[str, Column]:
    return {name: F.when(F.col("energy_category") == name, F.col("generation_mwh"))}


def category(name: str, energy_category: str) -> Measure:
    return Measure(name, lambda: _category(energy_category), lambda t: t(energy_category))


def share(name: str, energy_category: str) -> Measure:
    return Measure(
        name,
        lambda: {**_category(energy_category), "generation_mwh": F.col("generation_mwh")},
        lambda t: F.try_divide(t(energy_category), t("generation_mwh")),
    )


# On the retail KPI view.
TOTAL_RETAIL_SALES = total("total_retail_sales", "sales_mwh")
TOTAL_REVENUE = total("total_revenue", "revenue_thousand_dollars", 1000)
AVERAGE_PRICE = price("average_electricity_price")
CUSTOMERS_LATEST_MONTH = latest("customers_latest_month", "customer_count")
SALES_PREVIOUS_YEAR = total("retail_sales_previous_year", "sales_mwh_previous_year")
SALES_YOY = Measure(
    "retail_sales_yoy",
    lambda: {c: F.col(c) for c in ("sales_mwh", "sales_mwh_previous_year")},
    # Rows without a prior year count in the first sum only.
    lambda t: F.try_divide(
        t("sales_mwh") - t("sales_mwh_previous_year"), t("sales_mwh_previous_year")
    ),
)

# On the generation mix view.
TOTAL_GENERATION = total("total_generation", "generation_mwh")
RENEWABLE_GENERATION = category("renewable_generation", "Renewable")
FOSSIL_GENERATION = category("fossil_generation", "Fossil")
NUCLEAR_GENERATION = category("nuclear_generation", "Nuclear")
RENEWABLE_SHARE = share("renewable_share", "Renewable")
FOSSIL_SHARE = share("fossil_share", "Fossil")
NUCLEAR_SHARE = share("nuclear_share", "Nuclear")

# On the retail and generation view.
GENERATION_SURPLUS = total("generation_surplus", "generation_minus_retail_mwh")

# On the sector view.
SECTOR_SALES = total("sector_sales", "sales_mwh")
SECTOR_REVENUE = total("sector_revenue", "revenue_thousand_dollars", 1000)
SECTOR_AVERAGE_PRICE = price("sector_average_price")

# On the weather and demand view.
AVERAGE_TEMPERATURE = mean("average_temperature", "avg_temperature")
AVERAGE_CDD = mean("average_monthly_cdd", "cooling_degree_days")
AVERAGE_HDD = mean("average_monthly_hdd", "heating_degree_days")


def evaluate(
    view: DataFrame,
    measures: Sequence[Measure],
    by: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """The measures per group of ``by``, over the rows that pass ``where``, in one pass over them.

    What the measures add up is summed once, whatever the number of measures that use it. With a
    latest-month measure the sums are made by group and month first; the group's totals are sums of
    these, and the newest month's sums are picked from them. Every level combines before its shuffle.
    """
    rows = view if where is None else view.where(where)
    parts: dict[str, Column] = {}
    for measure in measures:
        parts |= measure.sums()
    place = {part: f"_sum_{i}" for i, part in enumerate(parts)}
    months = dict.fromkeys(m.latest_of for m in measures if m.latest_of)
    newest = {column: f"_newest_{i}" for i, column in enumerate(months)}
    if not months:
        sums = rows.groupBy(*by).agg(*[F.sum(parts[p]).alias(place[p]) for p in parts] or [F.count(F.lit(1))])
    else:
        of_month = {column: f"_of_month_{i}" for i, column in enumerate(months)}
        monthly = rows.withColumn("_month", F.col("full_date")).groupBy(*by, "_month").agg(
            *[F.sum(parts[p]).alias(place[p]) for p in parts],
            *[F.sum(c).alias(name) if c not in by else F.first(c).alias(name) for c, name in of_month.items()],
        )
        sums = monthly.groupBy(*by).agg(
            *[F.sum(place[p]).alias(place[p]) for p in parts],
            *[F.max_by(of_month[c], "_month").alias(newest[c]) for c in months],
        )
    return sums.select(
        *by,
        *[
            m.value(lambda part, m=m: F.col(newest[part] if m.latest_of else place[part])).alias(m.name)
            for m in measures
        ],
    )


def reporting_period(df: DataFrame, through=REPORTING_THROUGH) -> DataFrame:
    """Rows up to the end of the last complete year."""
    return df.where(F.col("full_date") <= F.lit(through))
