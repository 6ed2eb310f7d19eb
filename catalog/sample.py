"""A warehouse loaded from the sample tables, shared by the queries of a session."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from gridmart.plans.warehouse import STAGED_BY, Warehouse, load_warehouse
from gridmart.schemas import DATASETS, GRAIN
from gridmart.session import new_scratch
from gridmart.sources.star_schema import SAMPLE
from gridmart.sources.tables import write_partitioned

_loaded: dict[tuple[str, str], Warehouse] = {}
_lock = threading.Lock()


def build_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Stage the three datasets and load the star, in a folder of its own."""
    wh = Warehouse(spark, new_scratch(spark, "warehouse"))
    wh.create()

    def stage(dataset: str) -> None:
        write_partitioned(
            SAMPLE[dataset](spark, sf_dir),
            wh.path("stg", dataset),
            by=STAGED_BY,
            sort=GRAIN[dataset],
            mode="overwrite",
        )

    with ThreadPoolExecutor(len(DATASETS)) as pool:
        list(pool.map(stage, DATASETS))
    load_warehouse(wh)
    return wh


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of ``sf_dir``; built at the first call of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _loaded:
            _loaded[key] = build_warehouse(spark, sf_dir)
        return _loaded[key]
