import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridmart.fixed_values import TOTAL_PRODUCER
from gridmart.plans import measures as m
from gridmart.plans import reports, views
from gridmart.plans.warehouse import Star
from gridmart.schemas import DIMENSIONS, FACTS

from conftest import tuples

STATES = [(1, "AL", "Alabama"), (2, "DC", "District of Columbia"), (3, "TX", "Texas")]
SECTORS = [(1, "Commercial"), (2, "Residential"), (3, "Total")]
SOURCES = [(1, "Coal"), (2, "Nuclear"), (3, "Peat"), (4, "Pumped Storage"), (5, "Total"), (6, "Wind")]
PRODUCERS = [(1, "Utility"), (2, TOTAL_PRODUCER)]


def key(year, month):
    return year * 10000 + month * 100 + 1


def sold(date_key, state, sector, sales, revenue=10.0, customers=5.0, price=2.0):
    return (date_key, state, sector, revenue, sales, customers, price, "Final")


def made(date_key, state, producer, source, mwh):
    return (date_key, state, producer, source, mwh, "Final")


@pytest.fixture
def star(spark):
    def make(retail=(), generation=(), climate=()):
        days = sorted({row[0] for row in (*retail, *generation, *climate)})
        dates = [
            (d, dt.date(d // 10000, d // 100 % 100, 1), d // 10000, d // 100 % 100, "") for d in days
        ]
        rows = {
            "dim_date": dates,
            "dim_state": STATES,
            "dim_sector": SECTORS,
            "dim_energy_source": SOURCES,
            "dim_producer_type": PRODUCERS,
            "fact_retail": list(retail),
            "fact_generation": list(generation),
            "fact_climate": list(climate),
        }
        schemas = {**DIMENSIONS, **{f"fact_{d}": s for d, s in FACTS.items()}}
        return Star(lambda name: spark.createDataFrame(rows[name], schemas[name]))

    return make


JAN = key(2020, 1)


def test_totals_and_components_stay_apart(star):
    s = star(
        retail=[sold(JAN, 1, 1, 60.0), sold(JAN, 1, 2, 40.0), sold(JAN, 1, 3, 100.0)],
        generation=[
            made(JAN, 1, p, e, mwh)
            for p in (1, 2)
            for e, mwh in ((1, 7.0), (6, 3.0), (5, 10.0))
        ],
    )
    assert tuples(views.retail_detail(s), "sector_name", "sales_mwh") == [
        ("Commercial", 60.0), ("Residential", 40.0),
    ]
    assert tuples(views.retail_total(s), "state_name", "year", "month", "sales_mwh") == [
        ("Alabama", 2020, 1, 100.0)
    ]
    assert tuples(views.generation_detail(s), "producer_type_name", "energy_source_name") == [
        ("Utility", "Coal"), ("Utility", "Wind"),
    ]
    assert tuples(views.generation_total(s), "generation_mwh") == [(10.0,)]
    assert tuples(views.generation_mix(s), "energy_source_name", "energy_category", "generation_mwh") == [
        ("Coal", "Fossil", 7.0), ("Wind", "Renewable", 3.0),
    ]


def test_left_joins_keep_retail_rows(star):
    s = star(
        retail=[sold(JAN, 1, 3, 100.0), sold(JAN, 2, 3, 50.0)],
        generation=[made(JAN, 1, 2, 5, 130.0), made(JAN, 3, 2, 5, 9.0)],
        climate=[(JAN, 1, 61.5, 1.0, 2.0, 3.0), (JAN, 3, 70.0, 1.0, 2.0, 3.0)],
    )
    assert tuples(views.demand_weather(s), "state_code", "sales_mwh", "avg_temperature") == [
        ("AL", 100.0, 61.5), ("DC", 50.0, None),
    ]
    assert tuples(views.climate_monthly(s), "state_code") == [("AL",), ("TX",)]
    columns = ("state_code", "retail_sales_mwh", "generation_mwh", "generation_minus_retail_mwh")
    assert tuples(views.retail_generation(s), *columns) == [
        ("AL", 100.0, 130.0, 30.0), ("DC", 50.0, None, None),
    ]


def test_shares_with_negative_and_zero_totals(star):
    s = star(
        generation=[
            *[made(JAN, 1, 2, e, mwh) for e, mwh in ((6, 150.0), (4, -50.0), (3, 100.0))],
            *[made(JAN, 3, 2, e, mwh) for e, mwh in ((6, 50.0), (4, -50.0))],
        ]
    )
    columns = ("state_code", "energy_category", "classified_generation_mwh", "generation_share_pct")
    assert tuples(views.generation_share(s), *columns) == [
        ("AL", "Other", 200.0, 50.0),
        ("AL", "Renewable", 200.0, 75.0),
        ("AL", "Storage", 200.0, -25.0),
        ("TX", "Renewable", 0.0, None),
        ("TX", "Storage", 0.0, None),
    ]


def test_previous_year_counts_rows_not_months(star):
    """With one month missing, the row twelve up is thirteen months back."""
    months = [key(2019, m) for m in range(1, 13) if m != 6] + [key(2020, m) for m in (1, 2)]
    s = star(retail=[sold(d, 1, 3, float(d % 10000)) for d in months])
    got = {
        r.full_date: (r.sales_mwh, r.sales_mwh_previous_year) for r in views.retail_kpi(s).collect()
    }
    assert got[dt.date(2020, 1, 1)] == (101.0, None)  # the thirteenth row is February
    assert got[dt.date(2020, 2, 1)] == (201.0, 101.0)


def test_change_is_null_without_a_prior_value(star):
    months = [key(2019, m) for m in range(1, 13)] + [key(2020, m) for m in (1, 2, 3)]
    sales = [100.0, 0.0, None, *[1.0] * 9, 150.0, 5.0, 5.0]
    s = star(retail=[sold(d, 1, 3, v, price=4.0) for d, v in zip(months, sales)])
    got = {(r.year, r.month): (r.sales_yoy_pct, r.price_yoy_pct) for r in views.retail_kpi(s).collect()}
    assert got[2020, 1] == (50.0, 0.0)
    assert got[2020, 2] == (None, 0.0) and got[2020, 3] == (None, 0.0)
    assert got[2019, 12] == (None, None)


def test_one_window_for_all_offsets(star):
    s = star(retail=[sold(JAN, 1, 3, 1.0)])
    plan = views.retail_kpi(s)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


def test_views_have_names_for_sql(spark, star):
    s = star(retail=[sold(JAN, 1, 3, 100.0)])
    views.register_views(s)
    assert len(views.VIEWS) == 15
    assert spark.sql("select sum(sales_mwh) from vw_RetailKPI").first()[0] == 100.0


def test_filters_on_dimensions(star):
    s = star(retail=[sold(key(y, 1), st, 3, 1.0) for y in (2019, 2020) for st in (1, 3)])
    kpi = views.retail_kpi(s)
    texas = views.filtered(views.retail_kpi, s, states=F.col("state_name") == "Texas", dates=F.col("year") > 2019)
    assert tuples(texas, "state_code", "year") == [("TX", 2020)]
    assert texas.columns and set(texas.columns) == set(kpi.columns)
    assert views.filtered(views.retail_kpi, s).count() == 4


# --- measures ------------------------------------------------------------------------


@pytest.fixture
def two_states(star):
    return star(
        retail=[
            sold(key(2019, 12), 1, 3, 100.0, revenue=10.0, customers=7.0),
            sold(key(2020, 1), 1, 3, 300.0, revenue=90.0, customers=8.0),
            sold(key(2019, 12), 3, 3, 50.0, revenue=5.0, customers=4.0),
        ],
        generation=[made(JAN, 1, 2, e, mwh) for e, mwh in ((1, 30.0), (2, 50.0), (6, 20.0), (5, 100.0))],
    )


def one(df):
    return df.first().asDict()


def test_retail_measures(two_states):
    kpi = views.retail_kpi(two_states)
    shown = [m.TOTAL_RETAIL_SALES, m.TOTAL_REVENUE, m.AVERAGE_PRICE, m.CUSTOMERS_LATEST_MONTH,
             m.SALES_PREVIOUS_YEAR, m.SALES_YOY]
    assert one(m.evaluate(kpi, shown)) == {
        "total_retail_sales": 450.0,
        "total_revenue": 105_000.0,
        "average_electricity_price": pytest.approx(105 * 100 / 450),
        "customers_latest_month": 8.0,  # January only, where Texas has no row
        "retail_sales_previous_year": None,
        "retail_sales_yoy": None,
    }
    by_state = m.evaluate(kpi, [m.CUSTOMERS_LATEST_MONTH], ["state_code"])
    assert tuples(by_state) == [("AL", 8.0), ("TX", 4.0)]  # each state has its own newest month
    december = m.evaluate(kpi, shown, where=F.col("full_date") < dt.date(2020, 1, 1))
    assert one(december)["customers_latest_month"] == 11.0
    by_date = m.evaluate(kpi, [m.CUSTOMERS_LATEST_MONTH], ["full_date"])
    assert tuples(by_date, "customers_latest_month") == [(11.0,), (8.0,)]
    nothing = m.evaluate(kpi, shown, where=F.lit(False))
    assert set(one(nothing).values()) == {None}


def test_change_counts_rows_without_prior_year_once(star):
    months = [key(2019, n) for n in range(1, 13)] + [key(2020, 1)]
    s = star(retail=[sold(d, 1, 3, 10.0) for d in months[:-1]] + [sold(months[-1], 1, 3, 15.0)])
    got = one(m.evaluate(views.retail_kpi(s), [m.SALES_YOY]))
    assert got["retail_sales_yoy"] == (135.0 - 10.0) / 10.0


def test_generation_measures(two_states):
    mix = views.generation_mix(two_states)
    shown = [m.TOTAL_GENERATION, m.RENEWABLE_GENERATION, m.FOSSIL_GENERATION, m.NUCLEAR_GENERATION,
             m.RENEWABLE_SHARE, m.FOSSIL_SHARE, m.NUCLEAR_SHARE]
    assert tuple(m.evaluate(mix, shown).first()) == (100.0, 20.0, 30.0, 50.0, 0.2, 0.3, 0.5)
    surplus = m.evaluate(views.retail_generation_kpi(two_states), [m.GENERATION_SURPLUS])
    assert surplus.first()[0] == 100.0 - 300.0


def test_sector_measures(star):
    s = star(retail=[sold(JAN, st, 1, 100.0, revenue=st * 1.0) for st in (1, 3)])
    shown = [m.SECTOR_REVENUE, m.SECTOR_SALES, m.SECTOR_AVERAGE_PRICE]
    got = tuples(m.evaluate(views.sector_kpi(s), shown, ["sector_name"]))
    assert got == [("Commercial", 4000.0, 200.0, 2.0)]


def test_reports_stop_at_the_reporting_period(two_states):
    until = dt.date(2019, 12, 31)
    cards = dict(tuples(reports.report("executive_cards", two_states, until)))
    assert cards["total_retail_sales"] == 150.0 and cards["customers_latest_month"] == 11.0
    assert tuples(reports.report("price_trend", two_states, until), "full_date") == [
        (dt.date(2019, 12, 1),)
    ]
    everything = reports.report("state_comparison", two_states)
    assert tuples(everything, "state_code", "total_retail_sales") == [("AL", 400.0), ("TX", 50.0)]
    for name in reports.REPORTS:
        reports.report(name, two_states).schema


def test_latest_month_does_not_touch_other_measures(spark):
    rows = [(dt.date(2020, m, 1), "AL", s, v, c) for m, s, v, c in ((1, "a", 10.0, 1.0), (2, "a", 20.0, 2.0), (2, "b", 30.0, 4.0))]
    view = spark.createDataFrame(rows, "full_date date, state_code string, sector_name string, sales_mwh double, customer_count double")
    mixed = [m.mean("average", "sales_mwh"), m.CUSTOMERS_LATEST_MONTH, m.SECTOR_SALES]
    assert tuple(m.evaluate(view, mixed).first()) == (20.0, 6.0, 60.0)
    assert tuples(m.evaluate(view, mixed, ["sector_name"])) == [("a", 15.0, 2.0, 30.0), ("b", 30.0, 4.0, 30.0)]
