"""The fifteen analytical views over the star, as SQL.

The same text serves twice: over the tables of a :class:`Star` it gives a DataFrame, and over the
tables of a database it is a view of the session catalog, which every session sees and which reads
whatever a later load has added.

Filters on total rows and joins between facts work on the surrogate keys. The key of a total member
is looked up once as a scalar, so that it reaches the scan of the fact as a filter; facts are sorted
by these keys within a month, and the scan passes over the pages of other members. The calendar and
state columns are added last, to the rows that are left. Dimensions are stored tables that Spark
broadcasts while they are small.
"""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.fixed_values import (
    ENERGY_CATEGORIES,
    OTHER_CATEGORY,
    TOTAL_PRODUCER,
    TOTAL_SECTOR,
    TOTAL_SOURCE,
)
from gridmart.plans.warehouse import REGISTERED, Star, Warehouse
from gridmart.schemas import CLIMATE_METRICS, RETAIL_METRICS

STATE_MONTH = ("full_date", "year", "month", "state_code", "state_name")
MONTHS_PER_YEAR = 12
SALES_FIRST = ("sales_mwh", "revenue_thousand_dollars", *RETAIL_METRICS[2:])


def _described(rows: str, *columns: str) -> str:
    """Calendar and state columns, then ``columns``; table names stay open, in braces."""
    return (
        f"select {', '.join([*STATE_MONTH, *columns])} from ({rows}) as rows "
        "join {dim_date} using (date_key) join {dim_state} using (state_key)"
    )


def _key(dimension: str, member: str) -> str:
    """The key of a member, as a scalar; null while there is none."""
    return f"(select max({dimension}_key) from {{dim_{dimension}}} where {dimension}_name = '{member}')"


_TOTAL_SOURCE_KEY = f"coalesce({_key('energy_source', TOTAL_SOURCE)}, -1)"


def _percent(part: str, whole: str) -> str:
    """Null where the whole is zero or unknown."""
    return f"case when {whole} <> 0 then 100D * ({part}) / {whole} end"


# --- rows of one fact, on keys -------------------------------------------------

#: One row per month and state.
RETAIL_TOTALS = (
    f"select date_key, state_key, {', '.join(RETAIL_METRICS)}, data_status "
    f"from {{fact_retail}} where sector_key = {_key('sector', TOTAL_SECTOR)}"
)
RETAIL_SECTORS = (
    f"select * from {{fact_retail}} join {{dim_sector}} using (sector_key) where sector_name <> '{TOTAL_SECTOR}'"
)
#: One row per month and state.
GENERATION_TOTALS = (
    "select date_key, state_key, generation_mwh, data_status from {fact_generation} "
    f"where producer_type_key = {_key('producer_type', TOTAL_PRODUCER)} "
    f"and energy_source_key = {_key('energy_source', TOTAL_SOURCE)}"
)
ENERGY_SOURCES = (
    "select energy_source_key, energy_source_name, case "
    + " ".join(
        f"when energy_source_name in ({', '.join(repr(m) for m in members)}) then '{category}'"
        for category, members in ENERGY_CATEGORIES.items()
    )
    + f" else '{OTHER_CATEGORY}' end as energy_category "
    f"from {{dim_energy_source}} where energy_source_name <> '{TOTAL_SOURCE}'"
)
#: Sources of the total producer, so that no generation counts twice.
MIX = (
    "select date_key, state_key, energy_source_name, energy_category, generation_mwh "
    f"from {{fact_generation}} join ({ENERGY_SOURCES}) as sources using (energy_source_key) "
    f"where producer_type_key = {_key('producer_type', TOTAL_PRODUCER)}"
)
CATEGORIES = (
    "select date_key, state_key, energy_category, sum(generation_mwh) as generation_mwh "
    f"from ({MIX}) as mix group by date_key, state_key, energy_category"
)

# --- analytical views -----------------------------------------------------------

#: Producers and sources without the total rows of either.
_DETAILS = (
    "select * from {fact_generation} join {dim_producer_type} using (producer_type_key) "
    "join {dim_energy_source} using (energy_source_key) "
    f"where producer_type_name <> '{TOTAL_PRODUCER}' and energy_source_name <> '{TOTAL_SOURCE}'"
)
#: Retail totals with the weather; a state without climate rows keeps its sales.
_WEATHER = f"select * from ({RETAIL_TOTALS}) as retail left join {{fact_climate}} using (date_key, state_key)"
#: Retail totals with generation totals and their difference.
_BOTH = (
    "select date_key, state_key, retail.sales_mwh as retail_sales_mwh, generation.generation_mwh, "
    "generation.generation_mwh - retail.sales_mwh as generation_minus_retail_mwh "
    f"from ({RETAIL_TOTALS}) as retail left join ({GENERATION_TOTALS}) as generation using (date_key, state_key)"
)

# --- KPI views --------------------------------------------------------------------

#: Share of each category in its month and state. The window sees one row per category.
_SHARES = (
    f"select *, {_percent('generation_mwh', 'classified_generation_mwh')} as generation_share_pct from ("
    "select *, sum(generation_mwh) over (partition by date_key, state_key) as classified_generation_mwh "
    f"from ({CATEGORIES}) as categories) as shares"
)
#: Retail totals beside the row twelve months up. The offset counts rows of the state, not calendar
#: months. A window holds one row per month of a state, so it does not grow with the source rows.
_YEARS = (
    f"select *, {_percent('sales_mwh - sales_mwh_previous_year', 'sales_mwh_previous_year')} as sales_yoy_pct, "
    f"{_percent('avg_price_cents_per_kwh - avg_price_previous_year', 'avg_price_previous_year')} as price_yoy_pct from ("
    f"select *, lag(sales_mwh, {MONTHS_PER_YEAR}) over (partition by state_key order by date_key) as sales_mwh_previous_year, "
    f"lag(avg_price_cents_per_kwh, {MONTHS_PER_YEAR}) over (partition by state_key order by date_key) as avg_price_previous_year "
    f"from ({RETAIL_TOTALS}) as totals) as years"
)

#: Per month and state the retail totals, the mix of the total producer and what is generated beyond the sales. Each fact is
#: read once: its rows are marked with what they count for and meet in one aggregate.
_STATE_MONTHS = (
    "select date_key, state_key, sum(retail_rows) as retail_rows, sum(sales_mwh) as sales_mwh, "
    "sum(revenue_thousand_dollars) as revenue_thousand_dollars, sum(source_mwh) as generation_mwh, "
    "sum(all_mwh) - sum(sales_mwh) as generation_minus_retail_mwh from ("
    "select date_key, state_key, 1 as retail_rows, sales_mwh, revenue_thousand_dollars, "
    f"cast(null as double) as source_mwh, cast(null as double) as all_mwh from ({RETAIL_TOTALS}) as retail "
    "union all select date_key, state_key, null, null, null, "
    f"case when energy_source_key <> {_TOTAL_SOURCE_KEY} then generation_mwh end, "
    f"case when energy_source_key = {_TOTAL_SOURCE_KEY} then generation_mwh end "
    f"from {{fact_generation}} where producer_type_key = {_key('producer_type', TOTAL_PRODUCER)}"
    ") as marked group by date_key, state_key"
)
STATE_MONTHS = _described(
    _STATE_MONTHS,
    "retail_rows",
    "sales_mwh",
    "revenue_thousand_dollars",
    "generation_mwh",
    "generation_minus_retail_mwh",
)

VIEW_SQL: dict[str, str] = {
    "vw_RetailDetail": _described(RETAIL_SECTORS, "sector_name", *RETAIL_METRICS, "data_status"),
    "vw_RetailTotal": _described(RETAIL_TOTALS, *RETAIL_METRICS, "data_status"),
    "vw_GenerationDetail": _described(
        _DETAILS, "producer_type_name", "energy_source_name", "generation_mwh", "data_status"
    ),
    "vw_GenerationTotal": _described(GENERATION_TOTALS, "generation_mwh", "data_status"),
    "vw_ClimateMonthly": _described("select * from {fact_climate}", *CLIMATE_METRICS),
    "vw_DemandWeather": _described(_WEATHER, *SALES_FIRST, *CLIMATE_METRICS),
    "vw_RetailGeneration": _described(
        _BOTH, "retail_sales_mwh", "generation_mwh", "generation_minus_retail_mwh"
    ),
    "vw_EnergySourceClassification": ENERGY_SOURCES,
    "vw_GenerationMix": _described(MIX, "energy_source_name", "energy_category", "generation_mwh"),
    "vw_GenerationCategoryMonthly": _described(CATEGORIES, "energy_category", "generation_mwh"),
    "vw_GenerationShare": _described(
        _SHARES,
        "energy_category",
        "generation_mwh",
        "classified_generation_mwh",
        "generation_share_pct",
    ),
    "vw_RetailKPI": _described(
        _YEARS,
        *SALES_FIRST,
        "sales_mwh_previous_year",
        "avg_price_previous_year",
        "sales_yoy_pct",
        "price_yoy_pct",
    ),
    "vw_SectorKPI": _described(RETAIL_SECTORS, "sector_name", *SALES_FIRST),
}
VIEW_SQL["vw_WeatherDemandKPI"] = VIEW_SQL["vw_DemandWeather"]
VIEW_SQL["vw_RetailGenerationKPI"] = VIEW_SQL["vw_RetailGeneration"]


def over_star(sql: str, star: Star) -> DataFrame:
    """The rows of a text whose open table names are those of the star."""
    names = {name for _, name, _, _ in Formatter().parse(sql) if name}
    frames = {name: getattr(star, name) for name in sorted(names)}
    return next(iter(frames.values())).sparkSession.sql(sql, **frames)


def _view(name: str) -> Callable[[Star], DataFrame]:
    def build(star: Star) -> DataFrame:
        return over_star(VIEW_SQL[name], star)

    build.__name__ = build.__qualname__ = name
    return build


VIEWS: dict[str, Callable[[Star], DataFrame]] = {name: _view(name) for name in VIEW_SQL}

retail_detail = VIEWS["vw_RetailDetail"]
retail_total = VIEWS["vw_RetailTotal"]
generation_detail = VIEWS["vw_GenerationDetail"]
generation_total = VIEWS["vw_GenerationTotal"]
climate_monthly = VIEWS["vw_ClimateMonthly"]
demand_weather = VIEWS["vw_DemandWeather"]
retail_generation = VIEWS["vw_RetailGeneration"]
energy_source_classification = VIEWS["vw_EnergySourceClassification"]
generation_mix = VIEWS["vw_GenerationMix"]
generation_category_monthly = VIEWS["vw_GenerationCategoryMonthly"]
generation_share = VIEWS["vw_GenerationShare"]
retail_kpi = VIEWS["vw_RetailKPI"]
sector_kpi = VIEWS["vw_SectorKPI"]
weather_demand_kpi = VIEWS["vw_WeatherDemandKPI"]
retail_generation_kpi = VIEWS["vw_RetailGenerationKPI"]


def state_months(star: Star) -> DataFrame:
    """What reports show of a state beside each other: retail, generation and their difference."""
    return over_star(STATE_MONTHS, star)


def register_views(star: Star) -> SparkSession:
    """Make all views available to ``spark.sql`` of this session under their names."""
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)
    spark = star.dim_date.sparkSession
    spark.conf.set(REGISTERED, ",".join(VIEWS))  # loads of this session refresh these and no others
    return spark


def publish_views(wh: Warehouse) -> None:
    """Create the tables of the star and the views in the warehouse's database, for all sessions.

    The tables are external and know their partitions; loads of a warehouse with a database add
    theirs, so a view has their rows from then on, in every session and without a call.
    """
    if not wh.database:
        raise ValueError("The warehouse has no database")
    wh.create()
    tables = {name: f"{wh.database}.{name}" for name in wh.star_tables()}
    for name, sql in VIEW_SQL.items():
        wh.spark.sql(f"create or replace view {wh.database}.{name} as {sql.format(**tables)}")


#: Rows of a month depend on older months, so a filter on dates leaves those in.
LOOKS_BACK = {retail_kpi}


def filtered(
    view: Callable[[Star], DataFrame],
    star: Star,
    *,
    states: Column | None = None,
    dates: Column | None = None,
) -> DataFrame:
    """A view over the states and dates that pass filters on the dimensions.

    The filters go along the relationships from the dimensions to the facts before the view is
    built, so that joins, windows and scans see no other states, and no month folders but those of
    the dates. A view that looks back reads all months up to the last of the dates.
    """
    days = star.dim_date if dates is None else star.dim_date.where(dates)
    places = star.dim_state if states is None else star.dim_state.where(states)

    def read(name: str) -> DataFrame:
        if name in ("dim_date", "dim_state"):
            return days if name == "dim_date" else places
        rows = getattr(star, name)
        if not name.startswith("fact_"):
            return rows
        if dates is not None and view in LOOKS_BACK:
            rows = rows.where(F.col("date_key") <= days.select(F.max("date_key")).scalar())
        elif dates is not None:
            rows = rows.join(days.select("date_key"), "date_key", "left_semi")
        if states is not None:
            rows = rows.join(places.select("state_key"), "state_key", "left_semi")
        return rows

    return view(Star(read))
