"""Reload of staging months from the stored high-water mark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from gridmart.fixed_values import BOOTSTRAP_PERIOD
from gridmart.functions.dates import as_period
from gridmart.plans.warehouse import STAGED_BY, Warehouse
from gridmart.schemas import DATASETS, GRAIN
from gridmart.sources.folders import (
    Folders,
    drop_exchange,
    exchange_folders,
    finish_exchanges,
    new_exchange,
    partition_values,
)
from gridmart.sources.tables import months, read_curated_months, write_partitioned


def staging_watermark(wh: Warehouse, dataset: str, start: dt.date = BOOTSTRAP_PERIOD) -> dt.date:
    """Newest staged month, or ``start`` while there is none. The folders' names say it; no file is opened."""
    staged = partition_values(wh.spark, wh.path("stg", dataset), STAGED_BY)
    return max((dt.date.fromisoformat(period) for _, _, period in staged if period), default=start)


def reload_dataset(
    wh: Warehouse, curated: str, dataset: str, newest: dt.date, start: dt.date = BOOTSTRAP_PERIOD
) -> None:
    """Replace the staged months from the watermark through ``newest``, both included.

    The watermark month comes again, since it may have been incomplete; older months stay as
    they are. With ``newest`` before the watermark nothing happens. A month is what the curated
    folder says: a row of another period stays in its folder, for the gate to report, and touches
    no other month; a folder without rows leaves none staged.

    The new rows are written beside the table first. Only when all of them are there the months'
    folders are exchanged, by name: a load that fails, at whatever point, leaves the staged months
    as they were. What a process that died has left of its exchange is finished or dropped first.
    """
    tables = Folders(wh.spark, wh.path("stg", "").rstrip("/"))
    finish_exchanges(tables, dataset)
    watermark = staging_watermark(wh, dataset, start)
    if watermark > newest:
        return
    replaced = months(wh.spark, watermark, newest).collect()  # one per calendar month
    exchange = new_exchange(tables, dataset)
    try:
        write_partitioned(
            read_curated_months(wh.spark, curated, dataset, watermark, newest),
            f"{tables.root}/{exchange}/new",
            by=STAGED_BY,
            sort=GRAIN[dataset],
            mode="append",
            gather=False,
        )
    except Exception:
        drop_exchange(tables, exchange)
        raise
    folders = [f"year={m.period.year}/month={m.period.month}" for m in replaced]
    exchange_folders(tables, dataset, exchange, folders)


def load_staging(
    wh: Warehouse,
    curated: str,
    max_periods: Mapping[str, str | dt.date],
    start: dt.date = BOOTSTRAP_PERIOD,
) -> None:
    """Reload all datasets in order. Each commits by itself; the first error stops the rest."""
    wh.create()
    for dataset in DATASETS:
        reload_dataset(wh, curated, dataset, as_period(max_periods[dataset]), start)
