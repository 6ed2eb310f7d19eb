"""The registered queries: each runs library code over the whole sample tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.sample import warehouse
from gridmart.fixed_values import (
    CLIMATE_ELEMENT,
    CLIMATE_FILE_PREFIX,
    CLIMATE_MISSING,
    CURATED_FOLDER,
    NOTES_SHEET,
    RAW_FOLDER,
    RAW_WORKBOOK,
    RETAIL_SHEET,
    SECTORS,
)
from gridmart.operators import checks
from gridmart.operators.gate import gate_report, validate_staging
from gridmart.operators.merge import full_outer_merge, merge_metrics
from gridmart.plans import ingest, measures, reports, views
from gridmart.plans.pipeline import run_pipeline
from gridmart.plans.staging import reload_dataset, staging_watermark
from gridmart.plans.warehouse import (
    STAGED_BY,
    Warehouse,
    fact_delta,
    fact_watermark,
    keyed_members,
    load_dimensions,
    load_fact,
    staged_members,
    state_members,
)
from gridmart.schemas import (
    CLIMATE_METRICS,
    DATASETS,
    DIMENSIONS,
    FACT_GRAIN,
    GRAIN,
    RETAIL_METRICS,
)
from gridmart.session import new_scratch, spill
from gridmart.sources import tables
from gridmart.sources.climate_lines import checked_lines, monthly_values, with_state_names
from gridmart.sources.files import latest_input
from gridmart.sources.star_schema import SAMPLE, table
from gridmart.streaming.alerts import alert_windows, write_alerts

Query = Callable[[SparkSession, str], DataFrame]

FIRST_MONTH = dt.date(1995, 1, 1)
LAST_FULL_MONTH = dt.date(2000, 12, 1)
REPORT_THROUGH = dt.date(2000, 12, 31)


# --- presentation ---------------------------------------------------------------


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text and whole numbers in one width, so that both engines agree."""

    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, T.IntegralType):
            return column.cast("long").alias(field.name)
        return column

    return df.select(*[shown(field) for field in df.schema])


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Sums of fractions depend on the order of rows in the last digits; cut those off."""
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})


def labelled(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("dataset"), "*") for name, df in frames.items()],
    )


# --- raw inputs made from the sample ------------------------------------------------


def nation(code: str = "noaa_state_code") -> Column:
    return F.col(code).cast("int")


def raw_lines(climate: DataFrame, metric: str, state: Column) -> DataFrame:
    """Fixed-width lines of one metric, with the missing-value mark for absent months."""
    mark = F.lit(str(CLIMATE_MISSING[metric]))
    by_month = (
        climate.withColumn("state", F.lpad(state.cast("string"), 3, "0"))
        .groupBy("state", "year")
        .pivot("month", list(range(1, 13)))
        .agg(F.max(metric))
    )
    values = [F.coalesce(F.col(str(m)).cast("string"), mark) for m in range(1, 13)]
    return by_month.select(
        "year",
        F.concat(
            "state", F.lit(CLIMATE_ELEMENT[metric]), F.col("year").cast("string"), F.lit("   "),
            F.concat_ws("  ", *values),
        ).alias("value"),
    )


def all_raw_lines(spark: SparkSession, sf_dir: str, state: Column) -> dict[str, DataFrame]:
    climate = warehouse(spark, sf_dir).staging("climate")
    return {metric: raw_lines(climate, metric, state) for metric in CLIMATE_METRICS}


def raw_retail_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide sheet: titles, one row per month and state, a note."""
    retail = warehouse(spark, sf_dir).staging("retail")
    wide = (
        retail.groupBy("year", "month", "state_code", "data_status")
        .pivot("sector", list(SECTORS))
        .agg(*[F.max(metric).alias(metric) for metric in RETAIL_METRICS])
    )
    numbers = [F.col(f"{sector}_{metric}") for sector in SECTORS for metric in RETAIL_METRICS]
    cells = [
        F.col("year").cast("double").cast("string"),
        F.col("month").cast("string"),
        F.concat(F.lit(" "), F.col("state_code"), F.lit(" ")),
        F.col("data_status"),
        *[F.coalesce(number.cast("string"), F.lit(".")) for number in numbers],
        F.lit("beyond the table"),
    ]
    data = wide.select(
        F.lit(RETAIL_SHEET).alias("sheet"),
        (F.monotonically_increasing_id() + 3).alias("row_idx"),
        F.array(*cells).alias("cells"),
    )
    around = spark.createDataFrame(
        [
            (RETAIL_SHEET, 0, ["Sales to ultimate customers"]),
            (RETAIL_SHEET, 1, ["Year", "Month", "State", "Data Status"]),
            (RETAIL_SHEET, 2, ["2001", "1", "XX"]),
            (RETAIL_SHEET, 1 << 40, ["Notes: totals may not add up", None, None]),
            ("Other sheet", 5, ["1999", "1", "XX", "Final"]),
        ],
        data.schema,
    )
    return data.unionByName(around)


def raw_generation_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sheet per year. Final ones start with the header; preliminary ones have a title above
    it and the columns in another order. National rows come on top of the states."""
    states = warehouse(spark, sf_dir).staging("generation")
    national = (
        states.groupBy("year", "month", "producer_type", "energy_source", "data_status")
        .agg(F.sum("generation_mwh").alias("generation_mwh"))
        .withColumn("state_code", F.lit(" US-Total"))
    )
    rows = states.drop("period").unionByName(national).select(
        F.concat(F.col("year").cast("string"), F.lit("_"), F.col("data_status")).alias("sheet"),
        (F.monotonically_increasing_id() + 100).alias("row_idx"),
        F.array(*[F.col(c).cast("string") for c in FINAL_COLUMNS]).alias("final"),
        F.array(*[F.col(c).cast("string") for c in PRELIMINARY_COLUMNS]).alias("preliminary"),
    )
    is_final = F.col("sheet").endswith("Final")
    data = rows.select(
        "sheet", "row_idx", F.when(is_final, F.col("final")).otherwise(F.col("preliminary")).alias("cells")
    )
    names = F.when(is_final, F.array(*[F.lit(HEADER_TEXT[c]) for c in FINAL_COLUMNS])).otherwise(
        F.array(*[F.lit(HEADER_TEXT[c]) for c in PRELIMINARY_COLUMNS])
    )
    headers = data.select("sheet").distinct().select(
        "sheet",
        F.when(is_final, 0).otherwise(4).cast("long").alias("row_idx"),
        names.alias("cells"),
    )
    around = spark.createDataFrame(
        [(NOTES_SHEET, 0, ["Wind", "Wind turbines"]), (NOTES_SHEET, 200, ["2001", "1", "XX"])],
        data.schema,
    )
    return data.unionByName(headers).unionByName(around)


FINAL_COLUMNS = ("year", "month", "state_code", "producer_type", "energy_source", "generation_mwh")
PRELIMINARY_COLUMNS = (
    "state_code", "year", "month", "generation_mwh", "energy_source", "producer_type"
)
HEADER_TEXT = {
    "year": "YEAR",
    "month": " Month ",
    "state_code": "STATE",
    "producer_type": "TYPE OF\nPRODUCER",
    "energy_source": "ENERGY SOURCE ",
    "generation_mwh": "GENERATION\n(Megawatthours)",
}


# --- reshapes and parsing ---------------------------------------------------------


def climate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    climate = warehouse(spark, sf_dir).staging("climate")
    keys = ["period", "year", "month", "noaa_state_code", "state_code", "state_name"]
    long = climate.unpivot(keys, list(CLIMATE_METRICS), "metric", "value")
    return merge_metrics(long, keys, CLIMATE_METRICS).where("copies = 1").drop("copies")


def climate_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    climate = warehouse(spark, sf_dir).staging("climate")
    keys = ["state_code", "year", "month"]
    # Whole inputs; each metric begins and ends a year later than the one before it.
    return full_outer_merge(
        [
            climate.withColumn("year", F.col("year") + later).select(*keys, metric)
            for later, metric in enumerate(CLIMATE_METRICS)
        ],
        keys,
    )


def retail_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.retail_rows(raw_retail_sheet(spark, sf_dir), min_year=1995)


def min_year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.retail_rows(raw_retail_sheet(spark, sf_dir), min_year=1998)


def fixed_width_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = all_raw_lines(spark, sf_dir, nation() + 1)
    return ingest.climate_frame(lines, min_year=1995)


def write_raw_climate(spark: SparkSession, sf_dir: str) -> str:
    """Two versions of each climate file; the older one has other values."""
    raw = new_scratch(spark, "raw")
    climate = warehouse(spark, sf_dir).staging("climate")
    older = climate.withColumns({m: F.col(m) / 2 for m in CLIMATE_METRICS})
    for metric, prefix in CLIMATE_FILE_PREFIX.items():
        for version, rows in (("20010804", older), ("20010904", climate)):
            path = f"{raw}/{RAW_FOLDER['climate']}/{prefix}v1.0.0-{version}"
            raw_lines(rows, metric, nation() + 1).select("value").write.text(path)
    return raw


def latest_file_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{write_raw_climate(spark, sf_dir)}/{RAW_FOLDER['climate']}"
    path = latest_input(spark, folder, CLIMATE_FILE_PREFIX["avg_temperature"])
    return monthly_values(checked_lines(spark.read.text(path), "avg_temperature", min_year=1995))


def ingest_climate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = new_scratch(spark, "curated")
    ingest.ingest_climate(spark, write_raw_climate(spark, sf_dir), curated, min_year=1995)
    return tables.read_curated(spark, curated, "climate")


def write_raw_workbook(rows: DataFrame, raw: str, dataset: str) -> None:
    rows.write.parquet(f"{raw}/{RAW_FOLDER[dataset]}/{RAW_WORKBOOK[dataset]}")


def ingest_retail_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, curated = new_scratch(spark, "raw"), new_scratch(spark, "curated")
    write_raw_workbook(raw_retail_sheet(spark, sf_dir), raw, "retail")
    ingest.ingest_retail(spark, raw, curated, min_year=1995)
    return tables.read_curated(spark, curated, "retail")


def ingest_generation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, curated = new_scratch(spark, "raw"), new_scratch(spark, "curated")
    write_raw_workbook(raw_generation_sheets(spark, sf_dir), raw, "generation")
    ingest.ingest_generation(spark, raw, curated, min_year=1995)
    return tables.read_curated(spark, curated, "generation")


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files of all datasets through to the facts, and what each month of them holds then."""
    raw = write_raw_climate(spark, sf_dir)
    write_raw_workbook(raw_retail_sheet(spark, sf_dir), raw, "retail")
    write_raw_workbook(raw_generation_sheets(spark, sf_dir), raw, "generation")
    root = new_scratch(spark, "warehouse")
    run_pipeline(spark, raw, new_scratch(spark, "curated"), root, 1995, FIRST_MONTH)
    wh = Warehouse(spark, root)
    measured = {"climate": "precipitation", "retail": "sales_mwh", "generation": "generation_mwh"}
    return labelled(
        {
            dataset: wh.fact(dataset)
            .groupBy("date_key")
            .agg(
                F.count(F.lit(1)).alias("fact_rows"),
                F.count(column).alias("known_values"),
                F.round(F.sum(column), 3).alias("total"),
            )
            for dataset, column in measured.items()
        }
    )


def ingest_line_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, year = F.col("value"), F.col("year")
    damaged = (
        F.when(year == 1995, F.substring(value, 1, 8))
        .when(year == 1996, F.concat(F.substring(value, 1, 6), F.lit("199x"), F.expr("substring(value, 11)")))
        .when(year == 1997, F.concat(F.substring(value, 1, 3), F.lit("099"), F.expr("substring(value, 7)")))
        .when(year == 1998, F.regexp_replace(value, r"\s+\S+$", ""))
        .when(year == 1999, F.regexp_replace(value, r"\s(\S+)$", " 12d"))
        .otherwise(value)
    )
    lines = {
        metric: rows.select(damaged.alias("value"))
        for metric, rows in all_raw_lines(spark, sf_dir, nation() * 3).items()
    }
    checked = ingest.climate_lines(lines, min_year=1995)
    return checked.where("problem is not null").groupBy("metric", "problem").agg(
        F.count(F.lit(1)).alias("lines")
    )


def sheet_header_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spill(raw_generation_sheets(spark, sf_dir), "workbook")
    return ingest.generation_frame(rows, min_year=1995)


def noaa_state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    climate = warehouse(spark, sf_dir).staging("climate")
    codes = climate.select(
        "period", "precipitation", F.lpad((nation() * 3).cast("string"), 3, "0").alias("noaa_state_code")
    )
    return with_state_names(codes)


def reporting_period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpi = views.retail_kpi(warehouse(spark, sf_dir).star())
    return measures.reporting_period(kpi, REPORT_THROUGH)


# --- curated months -----------------------------------------------------------------


def doubled_sales(rows: DataFrame, months: Column) -> DataFrame:
    return rows.withColumn(
        "sales_mwh", F.when(months, F.col("sales_mwh") * 2).otherwise(F.col("sales_mwh"))
    )


def curated_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = new_scratch(spark, "curated")
    tables.write_curated(warehouse(spark, sf_dir).staging("retail"), curated, "retail")
    return tables.read_curated(spark, curated, "retail")


def curated_overwrite_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = new_scratch(spark, "curated")
    retail = warehouse(spark, sf_dir).staging("retail")
    tables.write_curated(retail, curated, "retail")
    march = retail.where((F.col("year") == 2000) & (F.col("month") == 3))
    tables.write_curated(doubled_sales(march, F.lit(True)), curated, "retail")
    return tables.read_curated(spark, curated, "retail")


def job_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    return labelled({d: ingest.job_result(wh.staging(d)) for d in DATASETS})


def month_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = warehouse(spark, sf_dir).staging("retail").agg(F.min("period"), F.max("period")).first()
    return tables.months(spark, *span).withColumn(
        "folder", tables.month_folder("curated", "retail", F.col("period"))
    )


# --- incremental loads ------------------------------------------------------------


def staging_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    found = [(d, staging_watermark(wh, d, FIRST_MONTH)) for d in DATASETS]
    return spark.createDataFrame(found, "dataset string, watermark date")


def fact_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    found = [(d, fact_watermark(wh, d)) for d in DATASETS]
    return spark.createDataFrame(found, "dataset string, watermark long")


def staging_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load months up to the last full year, correct two of them, load the rest.

    The correction of the watermark month arrives, that of an older month does not.
    """
    curated = new_scratch(spark, "curated")
    wh = Warehouse(spark, new_scratch(spark, "warehouse"))
    wh.create()
    retail = warehouse(spark, sf_dir).staging("retail")
    corrected = F.col("period").isin(dt.date(2000, 6, 1), LAST_FULL_MONTH)
    until_then = retail.where(F.col("period") <= LAST_FULL_MONTH)
    tables.write_curated(doubled_sales(until_then, corrected), curated, "retail")
    reload_dataset(wh, curated, "retail", LAST_FULL_MONTH, FIRST_MONTH)
    tables.write_curated(retail, curated, "retail")
    newest = retail.agg(F.max("period")).first()[0]
    reload_dataset(wh, curated, "retail", newest, FIRST_MONTH)
    return wh.staging("retail")


def staging_reload_misfiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest folder has rows of an older month; they stay in it and the older month stays whole."""
    curated = new_scratch(spark, "curated")
    wh = Warehouse(spark, new_scratch(spark, "warehouse"))
    wh.create()
    retail = warehouse(spark, sf_dir).staging("retail")
    newest = retail.agg(F.max("period")).first()[0]
    astray = (F.col("period") == newest) & (F.col("sector") == "Commercial")
    tables.write_curated(retail.where(F.col("period") <= LAST_FULL_MONTH), curated, "retail")
    reload_dataset(wh, curated, "retail", LAST_FULL_MONTH, FIRST_MONTH)
    misfiled = F.when(astray, F.lit(dt.date(2000, 6, 1))).otherwise(F.col("period"))
    tables.write_curated(retail.withColumn("period", misfiled), curated, "retail")
    reload_dataset(wh, curated, "retail", newest, FIRST_MONTH)
    return wh.staging("retail")


def staging_reload_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reload of all months from the newest staged one on, of which one cannot be read: what was staged stays."""
    curated = new_scratch(spark, "curated")
    wh = Warehouse(spark, new_scratch(spark, "warehouse"))
    wh.create()
    retail = warehouse(spark, sf_dir).staging("retail")
    tables.write_curated(retail.where(F.col("period") <= LAST_FULL_MONTH), curated, "retail")
    reload_dataset(wh, curated, "retail", LAST_FULL_MONTH, FIRST_MONTH)
    tables.write_curated(doubled_sales(retail, F.lit(True)), curated, "retail")
    newest = retail.agg(F.max("period")).first()[0]
    folder = f"{curated}/{CURATED_FOLDER['retail']}/year={newest.year}/month={newest.month:02d}"
    retail.limit(1).select("sector").write.mode("overwrite").text(folder)  # no Parquet file
    try:
        reload_dataset(wh, curated, "retail", newest, FIRST_MONTH)
    except Exception:
        return wh.staging("retail")
    raise AssertionError("The unreadable month was not noticed")


def view_in_other_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of the session catalog, read in a session that was there before the second load."""
    retail = warehouse(spark, sf_dir).staging("retail")
    wh = Warehouse(spark, new_scratch(spark, "warehouse"), f"gridmart_{uuid.uuid4().hex[:12]}")
    views.publish_views(wh)
    climate = warehouse(spark, sf_dir).staging("climate")
    tables.write_partitioned(climate, wh.path("stg", "climate"), STAGED_BY, GRAIN["climate"], "overwrite")
    other = spark.newSession()
    for rows in (retail.where(F.col("period") <= LAST_FULL_MONTH), retail):
        restage(wh, rows)
        load_dimensions(wh)
        load_fact(wh, "retail")
        found = other.sql(f"select * from {wh.database}.vw_RetailTotal")
        found.count()
    return found


def rejected_ingests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken raw inputs of every kind: each is refused, and the curated rows are those of before."""
    wh, curated = warehouse(spark, sf_dir), new_scratch(spark, "curated")
    for dataset in DATASETS:
        tables.write_curated(wh.staging(dataset), curated, dataset)
    lines = all_raw_lines(spark, sf_dir, nation() + 1)
    retail = spill(raw_retail_sheet(spark, sf_dir), "retail-sheet")
    sheets = spill(raw_generation_sheets(spark, sf_dir), "generation-sheets")
    is_data = (F.col("sheet") == RETAIL_SHEET) & (F.size("cells") > 20)

    def month_13(rows: DataFrame, which: Column, place: int) -> DataFrame:
        cells = F.transform("cells", lambda x, i: F.when(i == place, F.lit("13")).otherwise(x))
        return rows.withColumn("cells", F.when(which, cells).otherwise(F.col("cells")))

    final_data = F.col("sheet").endswith("Final") & (F.col("row_idx") >= 100)
    temperature = lines["avg_temperature"]
    cases: dict[tuple[str, str], Callable[[], DataFrame]] = {
        ("climate", "repeated grain"): lambda: ingest.climate_frame({**lines, "avg_temperature": temperature.unionByName(temperature)}, min_year=1995),
        ("climate", "unknown metric"): lambda: checked_lines(temperature, "wind", min_year=1995),
        ("climate", "metric left out"): lambda: ingest.climate_frame({"avg_temperature": temperature}, min_year=1995),
        ("climate", "no rows"): lambda: ingest.climate_frame(lines, min_year=2100),
        ("retail", "repeated grain"): lambda: ingest.retail_frame(retail.unionByName(retail.where(is_data)), min_year=1995),
        ("retail", "month 13"): lambda: ingest.retail_frame(month_13(retail, is_data, 1), min_year=1995),
        ("retail", "no sheet"): lambda: ingest.retail_frame(retail.where(F.col("sheet") != RETAIL_SHEET), min_year=1995),
        ("retail", "too few columns"): lambda: ingest.retail_frame(retail.withColumn("cells", F.slice("cells", 1, 20)), min_year=1995),
        ("retail", "no rows"): lambda: ingest.retail_frame(retail, min_year=2100),
        ("retail", "no month column"): lambda: wh.staging("retail").drop("month"),
        ("generation", "repeated grain"): lambda: ingest.generation_frame(sheets.unionByName(sheets.where(F.col("row_idx") >= 100)), min_year=1995),
        ("generation", "month 13"): lambda: ingest.generation_frame(month_13(sheets, final_data, 1), min_year=1995),
        ("generation", "no rows"): lambda: ingest.generation_frame(sheets, min_year=2100),
    }

    def refused(dataset: str, frame: Callable[[], DataFrame]) -> str:
        try:
            ingest.publish(frame(), curated, dataset)
        except ValueError:
            return "refused"
        return "published"

    told = [(d, rule, refused(d, frame)) for (d, rule), frame in cases.items()]
    # Rows without a month, and no rows at all, replace nothing.
    for d in DATASETS:
        rows = wh.staging(d)
        tables.write_months(rows.withColumn("month", F.lit(None).cast("long")), f"{curated}/{CURATED_FOLDER[d]}")
        tables.write_months(rows.where("false"), f"{curated}/{CURATED_FOLDER[d]}")
    left = checks.row_counts({d: tables.read_curated(spark, curated, d) for d in DATASETS})
    return spark.createDataFrame(told, "dataset string, rule string, outcome string").join(left, "dataset")


def early_retail(retail: DataFrame) -> DataFrame:
    """Rows up to the last full year: one sector of an older month and the total rows of the
    last month are missing, and the sales of the last month are too high."""
    period, sector = F.col("period"), F.col("sector")
    late = (period == dt.date(2000, 6, 1)) & (sector == "Commercial")
    unfinished = (period == LAST_FULL_MONTH) & (sector == "Total")
    rows = retail.where((period <= LAST_FULL_MONTH) & ~late & ~unfinished)
    return doubled_sales(rows, period == LAST_FULL_MONTH)


def loaded_with(spark: SparkSession, retail: DataFrame) -> Warehouse:
    """A new warehouse with these retail rows in staging and, at their grain, in the fact."""
    wh = Warehouse(spark, new_scratch(spark, "warehouse"))
    wh.create()
    restage(wh, retail)
    load_dimensions(wh)
    load_fact(wh, "retail")
    return wh


def restage(wh: Warehouse, retail: DataFrame) -> None:
    tables.write_partitioned(
        retail, wh.path("stg", "retail"), by=STAGED_BY, sort=GRAIN["retail"], mode="overwrite"
    )


def named_retail(rows: DataFrame, wh: Warehouse) -> DataFrame:
    star = wh.star()
    return (
        rows.join(star.dim_date, "date_key")
        .join(star.dim_state, "state_key")
        .join(star.dim_sector, "sector_key")
        .select(
            F.col("full_date").alias("period"),
            "state_code",
            F.col("sector_name").alias("sector"),
            "sales_mwh",
        )
    )


def fact_incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    retail = warehouse(spark, sf_dir).staging("retail")
    wh = loaded_with(spark, early_retail(retail))
    restage(wh, retail)
    load_dimensions(wh)
    return named_retail(fact_delta(wh, "retail"), wh)


def fact_after_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    retail = warehouse(spark, sf_dir).staging("retail")
    wh = loaded_with(spark, early_retail(retail))
    restage(wh, retail)
    load_dimensions(wh)
    load_fact(wh, "retail")
    return named_retail(wh.fact("retail"), wh)


def dim_state_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States join in two loads; the second one numbers on and leaves the first alone."""
    frames = warehouse(spark, sf_dir).all_staging()
    members = state_members(staged_members(frames)).join(
        frames["retail"].select("state_code").distinct(), "state_code", "left_semi"
    )
    none = spark.createDataFrame([], DIMENSIONS["dim_state"])
    first = keyed_members(members.where("state_code >= '12'"), none, "state_code", "state_key")
    second = keyed_members(members, first, "state_code", "state_key")
    return first.unionByName(second).select("state_key", "state_code")


def fact_rerun_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    loaded = checks.row_counts({d: wh.fact(d) for d in DATASETS})
    to_add = checks.row_counts({d: fact_delta(wh, d) for d in DATASETS})
    return loaded.withColumnRenamed("row_count", "fact_rows").join(
        to_add.withColumnRenamed("row_count", "rows_to_add"), "dataset"
    )


# --- quality gate and validation ------------------------------------------------------


def broken_staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Staging with faults of every kind in each dataset."""
    frames = warehouse(spark, sf_dir).all_staging()

    def blank(column: str, rows: Column) -> Column:
        return F.when(~rows, F.col(column)).alias(column)

    year, month = F.col("year"), F.col("month")
    climate = frames["climate"].withColumns(
        {
            "period": blank("period", month == 3),
            "year": blank("year", year == 1997),
            "state_code": blank("state_code", month == 5),
        }
    )
    sound = frames["retail"]
    retail = sound.withColumns(
        {
            "month": F.when(year == 1998, month + 12).otherwise(month),
            "sector": blank("sector", F.col("sector") == "Industrial"),
        }
    ).unionByName(sound.where(year == 1996))
    generation = frames["generation"].withColumns(
        {
            "year": F.when(month == 7, year + 1).otherwise(year),
            "energy_source": blank("energy_source", F.col("energy_source") == "Coal"),
        }
    )
    return {"climate": climate, "retail": retail, "generation": generation}


def unexpected_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = warehouse(spark, sf_dir).all_staging()
    sectors = spark.createDataFrame([(s,) for s in SECTORS if s != "Transportation"], "name string")
    found = {
        "sector": checks.unexpected(frames["retail"], "sector", sectors),
        "state_code": checks.unexpected(
            frames["retail"], "state_code", frames["climate"].select("state_code").distinct()
        ),
    }
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(column).alias("member_of"), F.col(column).alias("member"))
            for column, df in found.items()
        ],
    )


def staging_duplicates(dataset: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = warehouse(spark, sf_dir).staging(dataset)
        return checks.duplicates(rows.unionByName(rows.where("month = 3")), GRAIN[dataset])

    return run


def fact_duplicates(dataset: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = warehouse(spark, sf_dir).fact(dataset)
        twice = rows.unionByName(rows.where("date_key div 100 % 100 = 3"))
        return checks.duplicates(twice, FACT_GRAIN[dataset], "cnt")

    return run


# --- views, measures, reports ------------------------------------------------------------


def view(build: Callable) -> Query:
    return lambda spark, sf_dir: build(warehouse(spark, sf_dir).star())


def measured(build: Callable, shown: list, by: Sequence[str], **digits: int) -> Query:
    return lambda spark, sf_dir: rounded(
        measures.evaluate(build(warehouse(spark, sf_dir).star()), shown, by), **digits
    )


def report(name: str, **digits: int) -> Query:
    return lambda spark, sf_dir: rounded(
        reports.report(name, warehouse(spark, sf_dir).star(), REPORT_THROUGH), **digits
    )


def card_digits(name: str, digits: dict[str, int]) -> Query:
    """Cards of different size are cut at different digits."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shown = F.col("value")
        for card, places in digits.items():
            shown = F.when(F.col("card") == card, F.round("value", places)).otherwise(shown)
        return report(name)(spark, sf_dir).withColumn("value", shown)

    return run


def dim_filtered_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = warehouse(spark, sf_dir).star()
    return views.filtered(
        views.retail_kpi,
        star,
        states=F.col("state_name").isin("NATION_3", "NATION_7", "District of Columbia"),
        dates=F.col("year") == 1999,
    )


# --- alerts ---------------------------------------------------------------------------------


def is_failure() -> Column:
    return F.col("event_type") == "error"


def alert_windows_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_windows(table(spark, sf_dir, "events"), is_failure(), "event_type")


def alert_windows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows from a stream that reads all events there are; open ones are left out.

    Each shuffle partition keeps a state store, so the stream gets one per core and not the
    session's number.
    """
    schema = table(spark, sf_dir, "events").schema
    streaming = spark.newSession()
    streaming.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    # The pattern is part of the path, so that a folder of part files is read like a single file.
    runs = streaming.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    out = new_scratch(spark, "alerts")
    alerts = alert_windows(runs, is_failure(), "event_type")
    write_alerts(alerts, f"{out}/rows", f"{out}/progress").awaitTermination()
    return spark.read.schema(alerts.schema).parquet(f"{out}/rows")


# --- registry ----------------------------------------------------------------------------------


def staged(dataset: str) -> Query:
    return lambda spark, sf_dir: SAMPLE[dataset](spark, sf_dir)


def of_warehouse(read: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: read(warehouse(spark, sf_dir))


M = measures

_QUERIES: dict[str, Query] = {
    **{f"stg_{dataset}": staged(dataset) for dataset in DATASETS},
    "climate_merge": climate_merge,
    "climate_full_outer": climate_full_outer,
    "retail_unpivot": retail_unpivot,
    "min_year_filter": min_year_filter,
    "fixed_width_parse": fixed_width_parse,
    "ingest_climate_files": ingest_climate_files,
    "ingest_retail_files": ingest_retail_files,
    "ingest_generation_files": ingest_generation_files,
    "pipeline_run": pipeline_run,
    "latest_file_pick": latest_file_pick,
    "ingest_line_violations": ingest_line_violations,
    "sheet_header_map": sheet_header_map,
    "noaa_state_lookup": noaa_state_lookup,
    "reporting_period_filter": reporting_period_filter,
    "curated_roundtrip": curated_roundtrip,
    "curated_overwrite_month": curated_overwrite_month,
    "job_result": job_result,
    "month_sequence": month_sequence,
    **{name: of_warehouse(lambda wh, name=name: wh.dimension(name)) for name in DIMENSIONS},
    **{f"fact_{d}": of_warehouse(lambda wh, d=d: wh.fact(d)) for d in DATASETS},
    "staging_watermarks": staging_watermarks,
    "fact_watermarks": fact_watermarks,
    "staging_reload": staging_reload,
    "staging_reload_misfiled": staging_reload_misfiled,
    "staging_reload_failed": staging_reload_failed,
    "rejected_ingests": rejected_ingests,
    "view_in_other_session": view_in_other_session,
    "fact_incremental_delta": fact_incremental_delta,
    "fact_after_increment": fact_after_increment,
    "fact_rerun_delta": fact_rerun_delta,
    "dim_state_increment": dim_state_increment,
    "dq_report": of_warehouse(lambda wh: gate_report(wh.all_staging())),
    "dq_report_broken": lambda spark, sf_dir: gate_report(broken_staging(spark, sf_dir)),
    "dq_report_empty": of_warehouse(
        lambda wh: gate_report({**wh.all_staging(), "retail": wh.staging("retail").where("sales_mwh < 0")})
    ),
    "dq_pass": of_warehouse(lambda wh: validate_staging(wh.all_staging())),
    "unexpected_members": unexpected_members,
    "val_row_counts": of_warehouse(lambda wh: checks.row_counts(wh.all_staging())),
    "val_period_ranges": of_warehouse(lambda wh: checks.period_ranges(wh.all_staging())),
    **{f"val_dup_stg_{d}": staging_duplicates(d) for d in DATASETS},
    **{f"val_dup_fact_{d}": fact_duplicates(d) for d in DATASETS},
    **{name: view(build) for name, build in views.VIEWS.items()},
    "dim_filtered_view": dim_filtered_view,
    "mea_retail_by_state": measured(
        views.retail_kpi,
        [
            M.TOTAL_RETAIL_SALES,
            M.TOTAL_REVENUE,
            M.AVERAGE_PRICE,
            M.CUSTOMERS_LATEST_MONTH,
            M.SALES_PREVIOUS_YEAR,
            M.SALES_YOY,
        ],
        ["state_code"],
        total_revenue=4,
        average_electricity_price=6,
    ),
    "mea_customers_latest": measured(
        views.retail_kpi, [M.CUSTOMERS_LATEST_MONTH], ["state_code", "year"]
    ),
    "mea_yoy": measured(
        views.retail_kpi, [M.TOTAL_RETAIL_SALES, M.SALES_PREVIOUS_YEAR, M.SALES_YOY], ["year"]
    ),
    "mea_generation_by_state": measured(
        views.generation_mix,
        [
            M.TOTAL_GENERATION,
            M.RENEWABLE_GENERATION,
            M.FOSSIL_GENERATION,
            M.NUCLEAR_GENERATION,
            M.RENEWABLE_SHARE,
            M.FOSSIL_SHARE,
            M.NUCLEAR_SHARE,
        ],
        ["state_code"],
    ),
    "mea_surplus_by_state": measured(
        views.retail_generation_kpi, [M.GENERATION_SURPLUS], ["state_code"]
    ),
    "mea_sector": measured(
        views.sector_kpi,
        [M.SECTOR_REVENUE, M.SECTOR_AVERAGE_PRICE],
        ["state_code", "sector_name"],
        sector_revenue=4,
        sector_average_price=6,
    ),
    "rep_executive_cards": card_digits(
        "executive_cards", {"total_revenue": 4, "average_electricity_price": 6}
    ),
    "rep_price_trend": report("price_trend", average_electricity_price=6),
    "rep_sales_and_generation_trend": report("sales_and_generation_trend"),
    "rep_category_trend": report("category_trend"),
    "rep_state_cards": card_digits("state_cards", {"average_electricity_price": 6}),
    "rep_state_comparison": report("state_comparison", average_electricity_price=6),
    "rep_sector_comparison": report(
        "sector_comparison", sector_revenue=4, sector_average_price=6
    ),
    "rep_sector_trend": report("sector_trend"),
    "rep_mix_cards": report("mix_cards"),
    "rep_generation_by_source": report("generation_by_source"),
    "rep_generation_by_category": report("generation_by_category"),
    "rep_share_trend": report("share_trend"),
    "rep_weather_cards": card_digits(
        "weather_cards",
        {"average_temperature": 6, "average_monthly_cdd": 6, "average_monthly_hdd": 6},
    ),
    "rep_weather_scatter": report("weather_scatter"),
    "rep_weather_by_quarter": report(
        "weather_by_quarter", average_temperature=6, average_monthly_cdd=6, average_monthly_hdd=6
    ),
    "alert_windows_batch": alert_windows_batch,
    "alert_windows_stream": alert_windows_stream,
}


def queries() -> dict[str, Query]:
    def shown(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(spark, sf_dir))

    return {name: shown(query) for name, query in _QUERIES.items()}
