"""Sample input: order tables mapped to the shape of the three staging datasets.

Nations play the states, market segments the sectors, return flags the producer types and part
types the energy sources. Nation 24 plays the district without a climate record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.fixed_values import DC_CODE, TOTAL_PRODUCER, TOTAL_SECTOR, TOTAL_SOURCE
from gridmart.functions.dates import month_of
from gridmart.schemas import STAGING

DC_NATION = 24
FIRST_PRELIMINARY_YEAR = 2001

SECTOR_OF_SEGMENT = {
    "AUTOMOBILE": "Transportation",
    "BUILDING": "Commercial",
    "FURNITURE": "Commercial",
    "HOUSEHOLD": "Residential",
    "MACHINERY": "Industrial",
}
SOURCE_OF_TYPE = {
    "ECONOMY": "Wind",
    "LARGE": "Coal",
    "MEDIUM": "Natural Gas",
    "SMALL": "Nuclear",
    "PROMO": "Pumped Storage",
    "STANDARD": "Standard Blend",  # in no energy category
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _mapped(column: str, names: dict[str, str]) -> Column:
    return F.coalesce(
        *[F.when(F.col(column) == key, value) for key, value in names.items()], F.col(column)
    )


def _state(nation: str) -> Column:
    code = F.lpad(F.col(nation).cast("string"), 2, "0")
    return F.when(F.col(nation) == DC_NATION, DC_CODE).otherwise(code)


def _cents(column: str) -> Column:
    """An amount with two decimals as a whole number, so that sums do not depend on the order."""
    return F.rint(F.col(column) * 100).cast("long")


def _wide(whole: Column) -> Column:
    """A whole number to be summed without overflow, however many rows share a key."""
    return whole.cast("decimal(18,0)")


def _amount(total: Column, decimals: int) -> Column:
    return (total.cast("decimal(38,4)") / F.lit(10**decimals).cast("decimal(6,0)")).cast("double")


def _as_staging(rows: DataFrame, dataset: str) -> DataFrame:
    year = F.year("period")
    return rows.withColumns(
        {
            "year": year.cast("long"),
            "month": F.month("period").cast("long"),
            "data_status": F.when(year < FIRST_PRELIMINARY_YEAR, "Final").otherwise("Preliminary"),
        }
    ).select(*STAGING[dataset].fieldNames())


def retail_staging(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per month, state and sector, with total rows.

    Lines are summed per order and orders per customer and month before each join, so a customer
    or order with very many rows shrinks before it is shuffled. After that every customer is one
    row per month, and a count of rows is the count of distinct customers.
    """
    per_order = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(_wide(_cents("l_extendedprice") * (100 - _cents("l_discount")))).alias("revenue"),
            F.sum(_cents("l_quantity")).alias("quantity"),
        )
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        month_of(F.col("o_orderdate")).alias("period"),
    )
    per_customer = (
        per_order.join(orders, "l_orderkey")
        .groupBy(F.col("o_custkey").alias("c_custkey"), "period")
        .agg(F.sum("revenue").alias("revenue"), F.sum("quantity").alias("quantity"))
    )
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        _state("c_nationkey").alias("state_code"),
        _mapped("c_mktsegment", SECTOR_OF_SEGMENT).alias("sector"),
    )
    per_sector = (
        per_customer.join(customers, "c_custkey")
        .groupBy("period", "state_code", "sector")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("quantity").alias("quantity"),
            F.count(F.lit(1)).alias("customers"),
        )
    )
    with_totals = per_sector.groupingSets(
        [["period", "state_code", "sector"], ["period", "state_code"]],
        "period", "state_code", "sector",
    ).agg(
        F.grouping("sector").alias("is_total"),
        (_amount(F.sum("revenue"), 4) / 1000).alias("revenue_thousand_dollars"),
        _amount(F.sum("quantity"), 2).alias("sales_mwh"),
        F.sum("customers").cast("double").alias("customer_count"),
    )
    return _as_staging(
        with_totals.withColumns(
            {
                "sector": F.when(F.col("is_total") == 1, TOTAL_SECTOR).otherwise(F.col("sector")),
                "avg_price_cents_per_kwh": F.try_divide(
                    F.col("revenue_thousand_dollars") * 100, F.col("sales_mwh")
                ),
            }
        ),
        "retail",
    )


def generation_staging(spark: SparkSession, folder: str) -> DataFrame:
    """Quantities per month, state, producer and source, with the total rows of both.

    Lines meet parts and suppliers first and are summed once, by state: a sum by supplier before
    would keep most of the rows and cost a shuffle. Pumped storage takes energy in and counts negative.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        month_of(F.col("l_shipdate")).alias("period"),
        F.col("l_returnflag").alias("producer_type"),
        _cents("l_quantity").alias("quantity"),
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        _mapped("p_type", SOURCE_OF_TYPE).alias("energy_source"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), _state("s_nationkey").alias("state_code")
    )
    signed = F.when(
        F.col("energy_source") == SOURCE_OF_TYPE["PROMO"], -F.col("quantity")
    ).otherwise(F.col("quantity"))
    leaf = (
        lines.join(parts, "l_partkey")
        .join(suppliers, "l_suppkey")
        .groupBy("period", "state_code", "producer_type", "energy_source")
        .agg(F.sum(signed).alias("quantity"))
    )
    month, split = ["period", "state_code"], ["producer_type", "energy_source"]
    with_totals = leaf.groupingSets(
        [[*month, *split], [*month, split[0]], [*month, split[1]], month], *month, *split
    ).agg(
        F.grouping("producer_type").alias("all_producers"),
        F.grouping("energy_source").alias("all_sources"),
        _amount(F.sum("quantity"), 2).alias("generation_mwh"),
    )
    return _as_staging(
        with_totals.withColumns(
            {
                "producer_type": F.when(F.col("all_producers") == 1, TOTAL_PRODUCER).otherwise(
                    F.col("producer_type")
                ),
                "energy_source": F.when(F.col("all_sources") == 1, TOTAL_SOURCE).otherwise(
                    F.col("energy_source")
                ),
            }
        ),
        "generation",
    )


def climate_staging(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly figures per state from order prices; no temperature in February."""
    customers = (
        table(spark, folder, "customer")
        .where(F.col("c_nationkey") != DC_NATION)
        .select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    )
    # Summed once, by state: a sum by customer and month before would keep most of the orders.
    per_state = (
        table(spark, folder, "orders")
        .join(customers, "o_custkey")
        .groupBy("n_nationkey", month_of(F.col("o_orderdate")).alias("period"))
        .agg(
            (_amount(F.sum(_wide(_cents("o_totalprice"))), 2) / F.count(F.lit(1)) / 10000).alias("mean_price"),
            F.count(F.lit(1)).alias("orders"),
            F.max("o_totalprice").alias("heating_degree_days"),
            F.min("o_totalprice").alias("precipitation"),
        )
    )
    named = per_state.join(table(spark, folder, "nation"), "n_nationkey").withColumns(
        {
            "noaa_state_code": F.lpad(F.col("n_nationkey").cast("string"), 3, "0"),
            "state_code": _state("n_nationkey"),
            "state_name": F.col("n_name"),
            "avg_temperature": F.when(F.month("period") != 2, F.col("mean_price")),
            "cooling_degree_days": F.col("orders") * F.lit(10.0),
        }
    )
    return _as_staging(named, "climate")


SAMPLE = {
    "climate": climate_staging,
    "retail": retail_staging,
    "generation": generation_staging,
}
