"""Labels derived from names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart.fixed_values import DC_CODE, DC_NAME, ENERGY_CATEGORIES, OTHER_CATEGORY


def sheet_status(sheet: Column) -> Column:
    """Data status a sheet name announces; a preliminary sheet wins over a final one."""
    name = F.upper(sheet)
    return (
        F.when(name.contains("PRELIMINARY"), "Preliminary")
        .when(name.contains("FINAL"), "Final")
        .otherwise("Unknown")
    )


def energy_category(source: Column) -> Column:
    named = [F.when(source.isin(*members), c) for c, members in ENERGY_CATEGORIES.items()]
    return F.coalesce(*named, F.lit(OTHER_CATEGORY))


def state_label(code: Column, climate_name: Column) -> Column:
    """DC has no climate record, so its name comes from a rule."""
    return F.when(code == DC_CODE, DC_NAME).otherwise(climate_name)
