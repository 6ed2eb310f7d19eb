"""The whole run: three ingests, staging, warehouse."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from gridmart.fixed_values import BOOTSTRAP_PERIOD, DEFAULT_MIN_YEAR
from gridmart.plans.ingest import INGEST
from gridmart.plans.staging import load_staging
from gridmart.plans.warehouse import Warehouse, load_warehouse


def run_pipeline(
    spark: SparkSession,
    raw: str,
    curated: str,
    warehouse: str,
    min_year: int = DEFAULT_MIN_YEAR,
    start: dt.date = BOOTSTRAP_PERIOD,
    database: str | None = None,
) -> DataFrame:
    """Ingest the datasets side by side, then load staging up to the months they report.

    With a ``database`` the star's tables are there too, and the views of
    :func:`gridmart.plans.views.publish_views` follow the load.
    """

    def ingest(dataset: str) -> tuple[str, str]:
        return dataset, INGEST[dataset](spark, raw, curated, min_year).first().max_period

    with ThreadPoolExecutor(len(INGEST)) as pool:
        max_periods = dict(pool.map(ingest, INGEST))
    wh = Warehouse(spark, warehouse, database)
    load_staging(wh, curated, max_periods, start)
    return load_warehouse(wh)
