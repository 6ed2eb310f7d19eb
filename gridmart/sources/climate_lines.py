"""Statewide climate text: one line holds a state, an element, a year and twelve monthly values.

Characters 1-3 are the state code, 4-6 the element, 7-10 the year; the values follow, split by blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.fixed_values import (
    CLIMATE_ELEMENT,
    CLIMATE_MISSING,
    CLIMATE_STATES,
    DEFAULT_MIN_YEAR,
)
from gridmart.functions.numbers import is_number
from gridmart.functions.text import strip

BAD_NUMBER = "invalid numeric value"
_WHOLE = r"^\s*[+-]?\d+\s*$"


def climate_states(spark: SparkSession) -> DataFrame:
    """The fixed lookup of 50 states."""
    return spark.createDataFrame(
        list(CLIMATE_STATES), "noaa_state_code string, state_code string, state_name string"
    )


def checked_lines(
    lines: DataFrame, metric: str, *, min_year: int = DEFAULT_MIN_YEAR
) -> DataFrame:
    """Lines of one metric with the fields cut out and the first broken rule in ``problem``.

    Length, year and element are checked in every line, so that a wrong file is noticed; the
    values only in lines that are kept: a state of the lookup, not before ``min_year``. ``wrong`` has
    the month and text of the first value that is no number.
    """
    if metric not in CLIMATE_ELEMENT:
        raise ValueError(f"Unsupported metric: {metric}")
    value = F.col("value")
    year_text = F.substring(value, 7, 4)
    cut = lines.where(value.rlike(r"\S")).select(
        value.alias("line"),
        F.lit(metric).alias("metric"),
        F.substring(value, 1, 3).alias("noaa_state_code"),
        F.substring(value, 4, 3).alias("element"),
        F.when(year_text.rlike(_WHOLE), strip(year_text).cast("long")).alias("year"),
        F.split(strip(F.substring(value, 11, 1 << 30)), r"\s+").alias("values"),
    )
    kept = F.col("noaa_state_code").isin(*[code for code, _, _ in CLIMATE_STATES]) & (
        F.col("year") >= min_year
    )
    problem = (
        F.when(F.length("line") < 10, "record shorter than 10 characters")
        .when(F.col("year").isNull(), "invalid year")
        .when(F.col("element") != CLIMATE_ELEMENT[metric], "unexpected element")
        .when(~kept, None)
        .when(F.size("values") != 12, "not 12 monthly values")
        .when(~F.forall("values", is_number), BAD_NUMBER)
    )
    numbered = F.transform("values", lambda text, i: F.struct((i + 1).alias("month"), text.alias("value")))
    wrong = F.get(F.filter(numbered, lambda x: ~is_number(x.value)), F.lit(0))
    checked = cut.select("*", kept.alias("kept"), problem.alias("problem"))
    return checked.withColumn("wrong", F.when(F.col("problem") == BAD_NUMBER, wrong))


def monthly_values(checked: DataFrame) -> DataFrame:
    """One row per state, year and month of the sound lines; the missing-value mark is null."""
    return (
        checked.where("kept and problem is null")
        .select(
            "metric",
            "noaa_state_code",
            "year",
            F.posexplode("values").alias("position", "text"),
        )
        .select(
            "metric",
            "noaa_state_code",
            "year",
            (F.col("position") + 1).cast("long").alias("month"),
            _without_mark(F.col("metric"), F.col("text").try_cast("double")).alias("value"),
        )
    )


def _without_mark(metric: Column, value: Column) -> Column:
    marked = F.lit(False)
    for name, mark in CLIMATE_MISSING.items():
        marked = marked | ((metric == name) & (value == mark))
    return F.when(~marked, value)


def with_state_names(rows: DataFrame) -> DataFrame:
    """State abbreviation and name from the lookup; rows of other codes are dropped."""
    return rows.join(F.broadcast(climate_states(rows.sparkSession)), "noaa_state_code")
