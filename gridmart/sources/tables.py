"""Partitioned Parquet tables: curated months, staging, dimensions and facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.fixed_values import CURATED_FOLDER
from gridmart.schemas import GRAIN, STAGING


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    sort: Sequence[str],
    mode: str,
    *,
    gather: bool = True,
    observe: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Write ``df`` under ``path`` with one folder per value of ``by``.

    ``mode="overwrite"`` replaces only the folders that ``df`` has rows for. ``gather`` rebalances
    the rows, so that folders do not fill up with small files from every task; adaptive execution
    cuts a folder that is too large for one task. Rows that come from a table with the same folders
    are together already and need no shuffle. ``observe`` takes figures of the rows in the tasks that
    write them, after the last shuffle, so that a repeated task does not count twice.
    """
    rows = df.hint("rebalance", *[F.col(name) for name in by]) if gather else df
    rows = rows.sortWithinPartitions(*by, *[name for name in sort if name not in by])
    if observe:
        rows = rows.observe(observe[0], *observe[1])
    (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def create_table(
    spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ()
) -> None:
    """An empty table at ``path``, unless there is one."""
    writer = spark.createDataFrame([], schema).coalesce(1).write.mode("ignore")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def write_months(
    df: DataFrame,
    path: str,
    sort: Sequence[str] = (),
    observe: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Write ``year=YYYY/month=MM`` folders, replacing those that ``df`` has rows for.

    Rows without a year or month belong to no folder and are left out.
    """
    missing = sorted({"year", "month"} - set(df.columns))
    if missing:
        raise ValueError(f"Missing partition columns: {missing}")
    dated = df.na.drop("any", subset=["year", "month"]).withColumn(
        "month", F.lpad(F.col("month").cast("string"), 2, "0")
    )
    write_partitioned(dated, path, by=("year", "month"), sort=sort, mode="overwrite", observe=observe)


def write_curated(
    df: DataFrame,
    base: str,
    dataset: str,
    observe: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    # 'period' is the same in all rows of a folder and sorts like the grain inside it.
    write_months(df, f"{base}/{CURATED_FOLDER[dataset]}", sort=GRAIN[dataset], observe=observe)


def read_curated(spark: SparkSession, base: str, dataset: str) -> DataFrame:
    return read_table(spark, f"{base}/{CURATED_FOLDER[dataset]}", STAGING[dataset])


def months(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """All months from ``first`` through ``last`` as column ``period``."""
    return spark.range(1).select(
        F.explode(F.expr(f"sequence(date'{first}', date'{last}', interval 1 month)")).alias("period")
    )


def month_folder(base: str, dataset: str, period: F.Column) -> F.Column:
    return F.concat(
        F.lit(f"{base}/{CURATED_FOLDER[dataset]}/year="),
        F.year(period).cast("string"),
        F.lit("/month="),
        F.lpad(F.month(period).cast("string"), 2, "0"),
    )


def read_curated_months(
    spark: SparkSession, base: str, dataset: str, first: dt.date, last: dt.date
) -> DataFrame:
    """The named months only; a month without a folder is an error, not an empty result."""
    folders = months(spark, first, last).select(
        month_folder(base, dataset, F.col("period")).alias("folder")
    )
    paths = [row.folder for row in folders.collect()]  # one per calendar month
    return (
        spark.read.schema(STAGING[dataset])
        .option("basePath", f"{base}/{CURATED_FOLDER[dataset]}")
        .parquet(*paths)
        .select(*STAGING[dataset].fieldNames())
    )
