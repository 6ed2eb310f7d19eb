"""Table schemas, grains and partition columns of the staging area and the star."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_DATE, _LONG, _INT, _SHORT = T.DateType(), T.LongType(), T.IntegerType(), T.ShortType()
_TEXT, _NUM = T.StringType(), T.DoubleType()

DATASETS = ("climate", "retail", "generation")

CLIMATE_METRICS = (
    "avg_temperature",
    "cooling_degree_days",
    "heating_degree_days",
    "precipitation",
)
RETAIL_METRICS = (
    "revenue_thousand_dollars",
    "sales_mwh",
    "customer_count",
    "avg_price_cents_per_kwh",
)

STAGING = {
    "climate": _schema(
        ("period", _DATE),
        ("year", _LONG),
        ("month", _LONG),
        ("noaa_state_code", _TEXT),
        ("state_code", _TEXT),
        ("state_name", _TEXT),
        *[(metric, _NUM) for metric in CLIMATE_METRICS],
    ),
    "retail": _schema(
        ("period", _DATE),
        ("year", _LONG),
        ("month", _LONG),
        ("state_code", _TEXT),
        ("sector", _TEXT),
        *[(metric, _NUM) for metric in RETAIL_METRICS],
        ("data_status", _TEXT),
    ),
    "generation": _schema(
        ("period", _DATE),
        ("year", _LONG),
        ("month", _LONG),
        ("state_code", _TEXT),
        ("producer_type", _TEXT),
        ("energy_source", _TEXT),
        ("generation_mwh", _NUM),
        ("data_status", _TEXT),
    ),
}

# One row per combination of these columns.
GRAIN = {
    "climate": ("state_code", "year", "month"),
    "retail": ("state_code", "year", "month", "sector"),
    "generation": ("state_code", "year", "month", "producer_type", "energy_source"),
}

# Columns the gate requires to be present in every staging row.
REQUIRED = {
    "climate": ("period", "state_code"),
    "retail": ("period", "state_code", "sector"),
    "generation": ("period", "state_code", "producer_type", "energy_source"),
}

DIMENSIONS = {
    "dim_date": _schema(
        ("date_key", _INT),
        ("full_date", _DATE),
        ("year", _SHORT),
        ("month", _SHORT),
        ("month_name", _TEXT),
    ),
    "dim_state": _schema(("state_key", _INT), ("state_code", _TEXT), ("state_name", _TEXT)),
    "dim_sector": _schema(("sector_key", _INT), ("sector_name", _TEXT)),
    "dim_energy_source": _schema(("energy_source_key", _INT), ("energy_source_name", _TEXT)),
    "dim_producer_type": _schema(("producer_type_key", _INT), ("producer_type_name", _TEXT)),
}

FACTS = {
    "climate": _schema(
        ("date_key", _INT),
        ("state_key", _INT),
        *[(metric, _NUM) for metric in CLIMATE_METRICS],
    ),
    "retail": _schema(
        ("date_key", _INT),
        ("state_key", _INT),
        ("sector_key", _INT),
        *[(metric, _NUM) for metric in RETAIL_METRICS],
        ("data_status", _TEXT),
    ),
    "generation": _schema(
        ("date_key", _INT),
        ("state_key", _INT),
        ("producer_type_key", _INT),
        ("energy_source_key", _INT),
        ("generation_mwh", _NUM),
        ("data_status", _TEXT),
    ),
}

FACT_GRAIN = {
    "climate": ("date_key", "state_key"),
    "retail": ("date_key", "state_key", "sector_key"),
    "generation": ("date_key", "state_key", "producer_type_key", "energy_source_key"),
}

# The order of a fact's rows within a month: first the keys that views filter by.
FACT_ORDER = {
    "climate": ("state_key",),
    "retail": ("sector_key", "state_key"),
    "generation": ("producer_type_key", "energy_source_key", "state_key"),
}

# One row of a spreadsheet: sheet name, zero-based row number, cell texts.
SHEET_ROWS = _schema(("sheet", _TEXT), ("row_idx", _LONG), ("cells", T.ArrayType(_TEXT)))
