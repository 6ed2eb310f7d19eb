"""The star: tables, dimension loads, fact loads."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.dates import date_key, key_to_date
from gridmart.functions.labels import state_label
from gridmart.operators.gate import validate_staging
from gridmart.operators.keys import number_rows
from gridmart.schemas import DATASETS, DIMENSIONS, FACT_GRAIN, FACT_ORDER, FACTS, STAGING
from gridmart.session import own_scratch, spill
from gridmart.sources.folders import Folders, partition_values
from gridmart.sources.tables import create_table, read_table, write_partitioned


#: Staging folders: the curated folder that a row came from, then the month that the row itself names.
STAGED_BY = ("year", "month", "period")
#: Every load adds folders of its own, below those of the months in facts, and never a file to a folder that is there.
LOAD = "load"
#: Setting of a session: the temporary views that its loads refresh.
REGISTERED = "gridmart.registered.views"


class Star:
    """The dimensions and facts by name, each read when it is first used."""

    def __init__(self, read: Callable[[str], DataFrame]):
        self._read = read

    def __getattr__(self, name: str) -> DataFrame:
        if not name.startswith(("dim_", "fact_")):
            raise AttributeError(name)
        setattr(self, name, self._read(name))
        return self.__dict__[name]


@dataclass(frozen=True)
class Warehouse:
    """Eleven Parquet tables under one folder, and in ``database`` if there is one.

    Staging is partitioned by year and month of the load, the replaced ranges, and by ``period``;
    facts by ``date_key`` and load, dimensions by load. So watermarks are read from folder names,
    and range filters choose folders. Within a month facts are sorted by the keys that views filter
    by. In the database facts and dimensions are external tables that know their partitions.
    """

    spark: SparkSession
    root: str
    database: str | None = None

    def path(self, area: str, name: str) -> str:
        return f"{self.root}/{area}/{name}"

    def star_tables(self) -> dict[str, tuple[T.StructType, tuple[str, ...]]]:
        """Schema and partition columns of dimensions and facts."""
        return {
            **{name: (schema, (LOAD,)) for name, schema in DIMENSIONS.items()},
            **{f"fact_{name}": (schema, ("date_key", LOAD)) for name, schema in FACTS.items()},
        }

    def create(self) -> None:
        """Create the tables that do not exist yet."""
        tables = [
            *[(self.path("stg", name), schema, STAGED_BY) for name, schema in STAGING.items()],
            *[
                (self.path("dw", name), T.StructType([*schema, T.StructField(LOAD, T.LongType())]), by)
                for name, (schema, by) in self.star_tables().items()
            ],
        ]
        with ThreadPoolExecutor(len(tables)) as pool:
            list(pool.map(lambda table: create_table(self.spark, *table), tables))
        if self.database:
            self._register()

    def _register(self) -> None:
        self.spark.sql(f"create database if not exists {self.database}")
        for name, (schema, by) in self.star_tables().items():
            if self.spark.catalog.tableExists(f"{self.database}.{name}"):
                continue
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"create table {self.database}.{name} ({columns}, {LOAD} bigint) using parquet "
                f"partitioned by ({', '.join(by)}) location '{self.path('dw', name)}'"
            )
            self._add_partitions(name, by, partition_values(self.spark, self.path("dw", name), by))

    def _add_partitions(self, name: str, by: tuple[str, ...], values: list[tuple]) -> None:
        """One statement, so that readers see all folders of a load or none."""
        if values:
            parts = " ".join(
                f"partition ({', '.join(f'{c} = {v}' for c, v in zip(by, row, strict=True))})"
                for row in values
            )
            self.spark.sql(f"alter table {self.database}.{name} add if not exists {parts}")

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows to a dimension or fact, in new folders."""
        schema, by = self.star_tables()[name]
        load = time.time_ns() // 1000
        path = self.path("dw", name)
        write_partitioned(
            rows.select(*schema.fieldNames()).withColumn(LOAD, F.lit(load)),
            path,
            by=by,
            sort=FACT_ORDER.get(name.removeprefix("fact_"), ()),
            mode="append",
            gather=name.startswith("fact_"),
        )
        if self.database:
            pattern = "/".join(f"{c}={load if c == LOAD else '*'}" for c in by)
            new = Folders(self.spark, path).matching(pattern)
            self._add_partitions(name, by, [tuple(p.split("=", 1)[1] for p in x.split("/")) for x in new])

    def staging(self, dataset: str) -> DataFrame:
        return read_table(self.spark, self.path("stg", dataset), STAGING[dataset])

    def all_staging(self) -> dict[str, DataFrame]:
        return {dataset: self.staging(dataset) for dataset in DATASETS}

    def dimension(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path("dw", name), DIMENSIONS[name])

    def fact(self, dataset: str) -> DataFrame:
        return read_table(self.spark, self.path("dw", f"fact_{dataset}"), FACTS[dataset])

    def star(self) -> Star:
        return Star(
            lambda name: self.dimension(name)
            if name in DIMENSIONS
            else self.fact(name.removeprefix("fact_"))
        )


# --- dimensions ---------------------------------------------------------------


MEMBER_COLUMNS = {
    "climate": {"dim_date": "period", "dim_state": "state_code"},
    "retail": {"dim_date": "period", "dim_state": "state_code", "dim_sector": "sector"},
    "generation": {
        "dim_date": "period",
        "dim_state": "state_code",
        "dim_energy_source": "energy_source",
        "dim_producer_type": "producer_type",
    },
}


def staged_members(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The members of all dimensions as rows ``(dimension, member, label)``.

    Each dataset is scanned once, whatever the number of its dimensions, and repeated members
    fall together before the shuffle. The label is the state name of the climate rows.
    """
    no_label = F.lit(None).cast("string")

    def pairs(dataset: str) -> DataFrame:
        def label(dimension: str) -> Column:
            named = dataset == "climate" and dimension == "dim_state"
            return F.col("state_name") if named else no_label

        members = [
            F.struct(
                F.lit(dimension).alias("dimension"),
                F.col(column).cast("string").alias("member"),
                label(dimension).alias("label"),
            )
            for dimension, column in MEMBER_COLUMNS[dataset].items()
        ]
        return frames[dataset].select(F.inline(F.array(*members)))

    return (
        reduce(DataFrame.unionByName, [pairs(dataset) for dataset in DATASETS])
        .where("member is not null")
        .groupBy("dimension", "member")
        .agg(F.max("label").alias("label"))
    )


def date_members(periods: DataFrame) -> DataFrame:
    """Calendar rows of the months in the only column."""
    day = F.col("full_date")
    return periods.toDF("full_date").where("full_date is not null").distinct().select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).cast("short").alias("year"),
        F.month(day).cast("short").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
    )


def state_members(members: DataFrame) -> DataFrame:
    return members.where("dimension = 'dim_state'").select(
        F.col("member").alias("state_code"),
        state_label(F.col("member"), F.col("label")).alias("state_name"),
    )


def name_members(members: DataFrame, dimension: str, name: str) -> DataFrame:
    return members.where(F.col("dimension") == dimension).select(F.col("member").alias(name))


def new_members(members: DataFrame, existing: DataFrame, natural: str) -> DataFrame:
    return members.join(existing.select(natural), natural, "left_anti")


def keyed_members(members: DataFrame, existing: DataFrame, natural: str, key: str) -> DataFrame:
    """The members not in ``existing`` yet, numbered on from its highest key.

    The first load numbers members in the order of their names; later ones leave old keys alone.
    """
    highest = existing.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    return number_rows(new_members(members, existing, natural), natural, key, highest)


def load_dates(wh: Warehouse, periods: DataFrame) -> None:
    new = new_members(date_members(periods), wh.dimension("dim_date"), "date_key")
    if not new.isEmpty():  # a rerun leaves no empty files behind
        wh.append("dim_date", new)


def load_names(wh: Warehouse, name: str, members: DataFrame, natural: str, key: str) -> None:
    existing = wh.dimension(name)
    if not new_members(members, existing, natural).isEmpty():
        wh.append(name, keyed_members(members, existing, natural, key))


def load_dimensions(wh: Warehouse) -> None:
    """Add members that are new in staging; existing rows are never changed.

    The members of all dimensions are collected in one pass and written down. The five tables do
    not depend on each other, so their small jobs run side by side.
    """
    with own_scratch(wh.spark):
        _load_members(wh, spill(staged_members(wh.all_staging()), "members"))


def _load_members(wh: Warehouse, members: DataFrame) -> None:
    named = {
        "dim_state": (state_members(members), "state_code", "state_key"),
        **{
            dimension: (name_members(members, dimension, f"{name}_name"), f"{name}_name", f"{name}_key")
            for dimension, name in (
                ("dim_sector", "sector"),
                ("dim_energy_source", "energy_source"),
                ("dim_producer_type", "producer_type"),
            )
        },
    }

    def load(name: str) -> None:
        with own_scratch(wh.spark):
            if name == "dim_date":
                months = members.where("dimension = 'dim_date'")
                load_dates(wh, months.select(F.col("member").cast("date")))
            else:
                load_names(wh, name, *named[name])

    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        list(pool.map(load, DIMENSIONS))


# --- facts --------------------------------------------------------------------


def fact_watermark(wh: Warehouse, dataset: str) -> int:
    """Newest loaded month, 0 for an empty fact. The folders' names say it; no file is opened."""
    loaded = partition_values(wh.spark, wh.path("dw", f"fact_{dataset}"), ("date_key",))
    return max((int(key) for (key,) in loaded if key), default=0)


def star_rows(staged: DataFrame, star: Star, dataset: str) -> DataFrame:
    """Staging rows with surrogate keys; rows without a dimension member are dropped.

    The dimensions are stored tables, so Spark knows their size and broadcasts them while they
    are small.
    """
    rows = staged.drop("year", "month").join(
        star.dim_date.select("date_key", F.col("full_date").alias("period")), "period"
    ).join(star.dim_state.select("state_key", "state_code"), "state_code")
    if dataset == "retail":
        rows = rows.join(star.dim_sector.withColumnRenamed("sector_name", "sector"), "sector")
    elif dataset == "generation":
        rows = rows.join(
            star.dim_producer_type.withColumnRenamed("producer_type_name", "producer_type"),
            "producer_type",
        ).join(
            star.dim_energy_source.withColumnRenamed("energy_source_name", "energy_source"),
            "energy_source",
        )
    return rows.select(*FACTS[dataset].fieldNames())


def fact_delta(wh: Warehouse, dataset: str, staged: DataFrame | None = None) -> DataFrame:
    """Rows to append: not older than the watermark and not in the fact at its grain.

    Values of rows that are loaded already never change. Months above the watermark have no rows in
    the fact, so theirs go as they are; only the watermark's month is compared, on both sides read
    by itself. Older months are not looked at.
    """
    star = wh.star()
    rows = wh.staging(dataset) if staged is None else staged
    watermark = fact_watermark(wh, dataset)
    if not watermark:
        return star_rows(rows, star, dataset)
    month = F.lit(key_to_date(watermark))
    grain = [name for name in FACT_GRAIN[dataset] if name != "date_key"]
    loaded = getattr(star, f"fact_{dataset}").where(F.col("date_key") == watermark)
    again = star_rows(rows.where(F.col("period") == month), star, dataset).join(
        loaded.select(*grain), grain, "left_anti"
    )
    new = star_rows(rows.where(F.col("period") > month), star, dataset)
    return new.unionByName(again)


def refresh_views(spark: SparkSession) -> None:
    """Let the temporary views that this session has registered see the files that a load has added."""
    for name in filter(None, spark.conf.get(REGISTERED, "").split(",")):
        if spark.catalog.tableExists(name):
            spark.catalog.refreshTable(name)


def load_fact(wh: Warehouse, dataset: str) -> None:
    """Append the new months and rows of a dataset."""
    append_fact(wh, dataset)
    refresh_views(wh.spark)


def append_fact(wh: Warehouse, dataset: str, *, add_dates: bool = True) -> None:
    """Append the new rows of a dataset, after its new months unless those are there for sure.

    The rows are brought together by month, so that a backfill leaves few files in each.
    """
    if add_dates:
        load_dates(wh, wh.staging(dataset).select("period"))
    wh.append(f"fact_{dataset}", fact_delta(wh, dataset))


def load_facts(wh: Warehouse) -> None:
    """Load all facts after the dimensions. They do not depend on each other."""
    with ThreadPoolExecutor(len(FACTS)) as pool:
        list(
            pool.map(
                lambda dataset: append_fact(wh, dataset, add_dates=False),
                ("retail", "generation", "climate"),
            )
        )
    refresh_views(wh.spark)


def load_warehouse(wh: Warehouse) -> DataFrame:
    """Gate, dimensions, facts. Safe to repeat: a second run adds nothing."""
    passed = validate_staging(wh.all_staging())
    load_dimensions(wh)
    load_facts(wh)
    return passed
