"""Raw inputs to curated months."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridmart.fixed_values import (
    CLIMATE_FILE_PREFIX,
    DEFAULT_MIN_YEAR,
    NATIONAL_STATE,
    RAW_FOLDER,
    RAW_WORKBOOK,
    RETAIL_COLUMNS,
    RETAIL_SHEET,
    RETAIL_SKIP_ROWS,
    SECTORS,
)
from gridmart.functions.dates import month_start
from gridmart.functions.labels import sheet_status
from gridmart.functions.numbers import to_number, to_whole
from gridmart.functions.text import strip
from gridmart.operators.checks import duplicates, first_rows
from gridmart.operators.merge import merge_metrics
from gridmart.schemas import CLIMATE_METRICS, GRAIN, RETAIL_METRICS, SHEET_ROWS, STAGING
from gridmart.session import own_scratch, spill
from gridmart.sources.climate_lines import checked_lines, monthly_values, with_state_names
from gridmart.sources.files import latest_input, named_input
from gridmart.sources.sheets import cell, find_headers, read_by_header, sheet_problems
from gridmart.sources.tables import write_curated


# --- climate ----------------------------------------------------------------


def climate_lines(
    lines: Mapping[str, DataFrame], *, min_year: int = DEFAULT_MIN_YEAR
) -> DataFrame:
    """The checked lines of all four metrics."""
    if sorted(lines) != sorted(CLIMATE_METRICS):
        raise ValueError(f"Expected the metrics {list(CLIMATE_METRICS)}, got {sorted(lines)}")
    return reduce(
        DataFrame.unionByName,
        [checked_lines(lines[m], m, min_year=min_year) for m in CLIMATE_METRICS],
    )


def climate_months(values: DataFrame) -> DataFrame:
    """Monthly values of all metrics to one row per state and month, with ``copies``.

    Months without any observation, such as the months to come, are dropped.
    """
    merged = merge_metrics(values, ("noaa_state_code", "year", "month"), CLIMATE_METRICS)
    return with_state_names(merged.where("copies > 0")).select(
        month_start(F.col("year"), F.col("month")).alias("period"), "*"
    ).select(*STAGING["climate"].fieldNames(), "copies")


def climate_frame(
    lines: Mapping[str, DataFrame], *, min_year: int = DEFAULT_MIN_YEAR
) -> DataFrame:
    """Text lines per metric to checked climate rows; broken input raises ``ValueError``.

    The text is read once and the rows are written once; what is wrong with lines and rows is
    observed on the way and looked at before anybody gets the rows. Only where no row is left, and
    with it what was observed, the lines are read once more.
    """
    broken, repeated = Observation(), Observation()
    is_broken, is_repeated = F.col("problem").isNotNull(), F.col("copies") > 1
    wrong = F.format_string(" '%s' in month %d", "wrong.value", "wrong.month")
    place = F.when(F.col("wrong").isNotNull(), wrong).otherwise("")
    told = F.concat("problem", place, F.lit(" of "), "metric", F.lit(" in line "), "line")
    figures = [F.count_if(is_broken).alias("n"), F.min(F.when(is_broken, told)).alias("first")]
    checked = climate_lines(lines, min_year=min_year).where(F.col("kept") | is_broken)
    rows = climate_months(monthly_values(checked.observe(broken, *figures))).observe(
        repeated,
        F.count_if(is_repeated).alias("n"),
        F.min(F.when(is_repeated, F.to_json(F.struct(*GRAIN["climate"])))).alias("first"),
    )
    frame = spill(rows, "climate")
    some = not frame.isEmpty()
    found = broken.get if some else checked.agg(*figures).first().asDict()
    if found["n"]:
        raise ValueError(f"{found['n']} broken climate lines, such as {found['first']!r}")
    if some and repeated.get["n"]:
        raise ValueError(f"Duplicate climate rows, such as {repeated.get['first']}")
    return frame.drop("copies")


# --- retail -----------------------------------------------------------------


def retail_rows(sheet_rows: DataFrame, *, min_year: int = DEFAULT_MIN_YEAR) -> DataFrame:
    """The wide sheet, one row per state and month, to one row per sector as well.

    Notes below the table have no year and month; values that are no numbers become null.
    """
    wide = (
        sheet_rows.where(F.col("sheet") == RETAIL_SHEET)
        .where(F.col("row_idx") >= RETAIL_SKIP_ROWS)
        .select(
            to_whole(cell(0)).alias("year"),
            to_whole(cell(1)).alias("month"),
            cell(2).alias("state_code"),
            strip(cell(3)).alias("data_status"),
            "cells",
        )
        .na.drop("any", subset=["year", "month", "state_code"])
        .where(F.col("year") >= min_year)
    )
    per_sector = [
        F.struct(
            F.lit(sector).alias("sector"),
            *[
                to_number(cell(4 + 4 * place + offset)).alias(metric)
                for offset, metric in enumerate(RETAIL_METRICS)
            ],
        )
        for place, sector in enumerate(SECTORS)
    ]
    return wide.select(
        month_start(F.col("year"), F.col("month")).alias("period"),
        "year",
        "month",
        strip(F.col("state_code")).alias("state_code"),
        "data_status",
        F.inline(F.array(*per_sector)),
    ).select(*STAGING["retail"].fieldNames())


def retail_frame(sheet_rows: DataFrame, *, min_year: int = DEFAULT_MIN_YEAR) -> DataFrame:
    """The checked rows of the wide sheet; a missing or too narrow sheet raises ``ValueError``.

    A sheet is as wide as the widest of its rows below the titles, which the scan observes.
    """
    shape = Observation()
    below = F.col("row_idx") >= RETAIL_SKIP_ROWS
    sheet = sheet_rows.where(F.col("sheet") == RETAIL_SHEET).observe(
        shape,
        F.count(F.lit(1)).alias("rows"),
        F.max(F.when(below, F.size("cells"))).alias("columns"),
    )
    frame = spill(retail_rows(sheet, min_year=min_year), "retail")
    if not shape.get["rows"]:
        raise ValueError(f"The workbook has no sheet {RETAIL_SHEET!r}")
    if (shape.get["columns"] or 0) < RETAIL_COLUMNS:
        raise ValueError(
            f"Sheet {RETAIL_SHEET!r} has {shape.get['columns'] or 0} columns, needed are {RETAIL_COLUMNS}"
        )
    check_rows(frame, "retail")
    return frame


# --- generation -------------------------------------------------------------


def generation_rows(
    sheet_rows: DataFrame, headers: DataFrame, *, min_year: int = DEFAULT_MIN_YEAR
) -> DataFrame:
    """All data sheets to generation rows. National rows are dropped, negative values kept."""
    named = read_by_header(sheet_rows, headers)
    complete = named.select(
        to_whole(F.col("year")).alias("year"),
        to_whole(F.col("month")).alias("month"),
        strip(F.col("state_code")).alias("state_code"),
        strip(F.col("producer_type")).alias("producer_type"),
        strip(F.col("energy_source")).alias("energy_source"),
        to_number(F.col("generation_mwh")).alias("generation_mwh"),
        sheet_status(F.col("sheet")).alias("data_status"),
    ).na.drop("any")
    return (
        complete.where(F.col("year") >= min_year)
        .where(F.upper("state_code") != NATIONAL_STATE)
        .withColumn("period", month_start(F.col("year"), F.col("month")))
        .select(*STAGING["generation"].fieldNames())
    )


def generation_frame(sheet_rows: DataFrame, *, min_year: int = DEFAULT_MIN_YEAR) -> DataFrame:
    headers = spill(find_headers(sheet_rows), "headers")
    problems = sheet_problems(sheet_rows, headers)
    if not problems.isEmpty():
        raise ValueError(f"Unreadable generation sheets: {first_rows(problems)}")
    if headers.isEmpty():
        raise ValueError("No generation data found")
    frame = spill(generation_rows(sheet_rows, headers, min_year=min_year), "generation")
    check_rows(frame, "generation")
    return frame


# --- checks -----------------------------------------------------------------

ALLOWED_MEMBERS = {"retail": {"sector": SECTORS}}


def check_rows(frame: DataFrame, dataset: str) -> None:
    """Raise ``ValueError`` on a repeated grain, a month outside 1-12 or an unknown member.

    All rules look at columns of the grain, so one pass with one shuffle answers them; rows are
    looked up only for the message of a rule that is broken.
    """
    grain = GRAIN[dataset]
    bad_month = ~F.col("month").between(1, 12)
    unknown = {
        column: ~F.col(column).isin(*names)
        for column, names in ALLOWED_MEMBERS.get(dataset, {}).items()
    }
    found = (
        frame.groupBy(*grain)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.count_if(F.col("copies") > 1).alias("repeated"),
            F.count_if(bad_month).alias("bad_month"),
            *[F.count_if(rows).alias(f"unknown_{column}") for column, rows in unknown.items()],
        )
        .first()
    )
    if found.repeated:
        raise ValueError(f"Duplicate {dataset} rows: {first_rows(duplicates(frame, grain))}")
    if found.bad_month:
        raise ValueError(f"Month outside 1-12 in {dataset}: {first_rows(frame.where(bad_month))}")
    for column, rows in unknown.items():
        if found[f"unknown_{column}"]:
            members = frame.where(rows).select(column).distinct()
            raise ValueError(f"Unexpected {column} in {dataset}: {first_rows(members)}")


# --- jobs -------------------------------------------------------------------


def job_figures() -> list[Column]:
    """What a finished ingest reports of its rows. A month is a bit of a map, of the months since year 1000."""
    month = F.col("year") * 12 + F.col("month") - 12_000
    return [
        F.count(F.lit(1)).alias("rows_written"),
        F.date_format(F.max("period"), "yyyy-MM").alias("max_period"),
        F.bitmap_construct_agg(F.pmod(month, F.lit(32_768))).alias("months"),
    ]


def job_result(frame: DataFrame) -> DataFrame:
    """Rows, newest month and number of monthly folders of a frame."""
    return frame.agg(*job_figures()).select(
        F.lit("success").alias("status"),
        "rows_written",
        "max_period",
        F.bitmap_count("months").alias("partitions_written"),
    )


def publish(frame: DataFrame, curated: str, dataset: str) -> DataFrame:
    """Write the months of a checked frame and return its result row; an empty frame is an error.

    The figures are those of the rows that were written, taken while they were.
    """
    if frame.isEmpty():
        raise ValueError(f"No {dataset} rows to write")
    spark, written = frame.sparkSession, Observation()
    write_curated(frame, curated, dataset, observe=(written, job_figures()))
    found = written.get
    folders = int.from_bytes(found["months"]).bit_count()
    row = ("success", found["rows_written"], found["max_period"], folders)
    return spark.createDataFrame(
        [row], "status string, rows_written long, max_period string, partitions_written long"
    )


def read_sheet_rows(spark: SparkSession, raw: str, dataset: str) -> DataFrame:
    """The rows of a workbook, stored as a Parquet table of sheet rows under its name."""
    path = named_input(spark, f"{raw}/{RAW_FOLDER[dataset]}", RAW_WORKBOOK[dataset])
    return spark.read.schema(SHEET_ROWS).parquet(path)


def ingest_climate(
    spark: SparkSession, raw: str, curated: str, min_year: int = DEFAULT_MIN_YEAR
) -> DataFrame:
    folder = f"{raw}/{RAW_FOLDER['climate']}"
    lines = {
        metric: spark.read.text(latest_input(spark, folder, prefix))
        for metric, prefix in CLIMATE_FILE_PREFIX.items()
    }
    with own_scratch(spark):
        return publish(climate_frame(lines, min_year=min_year), curated, "climate")


def ingest_retail(
    spark: SparkSession, raw: str, curated: str, min_year: int = DEFAULT_MIN_YEAR
) -> DataFrame:
    rows = read_sheet_rows(spark, raw, "retail")
    with own_scratch(spark):
        return publish(retail_frame(rows, min_year=min_year), curated, "retail")


def ingest_generation(
    spark: SparkSession, raw: str, curated: str, min_year: int = DEFAULT_MIN_YEAR
) -> DataFrame:
    rows = read_sheet_rows(spark, raw, "generation")
    with own_scratch(spark):
        return publish(generation_frame(rows, min_year=min_year), curated, "generation")


INGEST = {
    "climate": ingest_climate,
    "retail": ingest_retail,
    "generation": ingest_generation,
}
