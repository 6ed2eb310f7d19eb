"""Plans that matter with much data, checked with the sizes of Spark's rules turned down."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from gridmart.plans import measures as m
from gridmart.plans import reports, views
from gridmart.plans.warehouse import STAGED_BY, Warehouse, fact_delta, load_dimensions, load_fact
from gridmart.schemas import GRAIN
from gridmart.sources import star_schema
from gridmart.sources.tables import write_partitioned

from conftest import climate_row, generation_row, retail_row

SF = "/root/testdata/sf0.001"

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
SMALL_SKEW = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "8",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    """Rows in order, and the plan as it was run."""
    rows = sorted(str(row) for row in df.collect())
    return rows, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def hot_tables(spark, tmp_path):
    """The sample with a third of the lines on one part, supplier and order."""
    for name in ("nation", "customer", "supplier", "part", "orders"):
        star_schema.table(spark, SF, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    lines = star_schema.table(spark, SF, "lineitem")
    third = [F.xxhash64("l_shipdate", "l_extendedprice", F.lit(c)) % 3 == 0 for c in range(3)]
    hot = lines.withColumns(
        {
            column: F.when(rows, F.lit(1).cast("long")).otherwise(F.col(column))
            for column, rows in zip(("l_partkey", "l_suppkey", "l_orderkey"), third)
        }
    )
    hot.repartition(6).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_a_hot_part_is_split(spark, hot_tables):
    want, _ = executed(star_schema.generation_staging(spark, hot_tables))
    with settings(spark, {**NO_BROADCAST, **SMALL_SKEW}):
        got, plan = executed(star_schema.generation_staging(spark, hot_tables))
    assert got == want
    assert "SortMergeJoin(skew=true) [l_partkey" in plan


def test_a_hot_order_shrinks_before_its_join(spark, hot_tables):
    want, _ = executed(star_schema.retail_staging(spark, hot_tables))
    with settings(spark, {**NO_BROADCAST, **SMALL_SKEW}):
        got, plan = executed(star_schema.retail_staging(spark, hot_tables))
    assert got == want
    assert "skew=true" not in plan  # one row per order is left, whatever its number of lines


@pytest.fixture
def loaded(spark, staging, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    wh.create()
    states = ["AL"] * 4 + ["TX"]
    rows = {
        "climate": [climate_row(2020, m, s) for m in (1, 2) for s in ("AL", "TX")],
        "retail": [
            retail_row(2020, m, s, f"{sector}-{i}", sales=float(i))
            for m in (1, 2) for i, s in enumerate(states * 20) for sector in ("Total", "Other")
        ],
        "generation": [
            generation_row(2020, m, s, "P", f"Source {i}")
            for m in (1, 2) for i, s in enumerate(states * 20)
        ],
    }
    for dataset, values in rows.items():
        write_partitioned(
            staging(dataset, values), wh.path("stg", dataset), STAGED_BY, GRAIN[dataset], "overwrite"
        )
    load_dimensions(wh)
    return wh


@pytest.mark.parametrize("dataset", ["climate", "retail", "generation"])
def test_dimensions_too_large_to_broadcast_give_the_same_rows(spark, loaded, dataset):
    staged = loaded.staging(dataset)
    want, _ = executed(fact_delta(loaded, dataset))
    assert len(want) == staged.count()
    with settings(spark, {**NO_BROADCAST, **SMALL_SKEW}):
        got, plan = executed(fact_delta(loaded, dataset))
    assert got == want and "BroadcastHashJoin" not in plan


def test_views_read_only_what_they_need(spark, loaded):
    load_fact(loaded, "retail")
    star = loaded.star()
    trend = views.retail_kpi(star).groupBy("full_date").agg(F.sum("sales_mwh"))
    plan = trend._jdf.queryExecution().executedPlan().toString()
    fact = next(line for line in plan.splitlines() if "FileScan" in line and "sector_key" in line and "date_key" in line)
    assert "revenue_thousand_dollars" not in fact and "customer_count" not in fact
    january = views.retail_total(star).where("full_date = date'2020-01-01'")
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()  # the calendar filter reaches the month folders


def scans(plan, table):
    return [line for line in plan.splitlines() if "FileScan" in line and f"/{table}" in line]


@pytest.fixture(autouse=True)
def whole_paths(spark):
    with settings(spark, {"spark.sql.maxMetadataStringLength": "5000"}):
        yield


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def whole(loaded):
    for dataset in ("climate", "retail", "generation"):
        load_fact(loaded, dataset)
    return loaded


def test_new_months_are_not_compared(spark, whole, staging):
    rows = [retail_row(2020, m, "AL", "Total") for m in (2, 3)]
    write_partitioned(staging("retail", rows), whole.path("stg", "retail"), STAGED_BY, GRAIN["retail"], "overwrite")
    load_dimensions(whole)
    with settings(spark, NO_BROADCAST):
        plan = planned(fact_delta(whole, "retail"))
        new = planned(fact_delta(whole, "retail", whole.staging("retail").where("period > date'2020-02-01'")))
    assert plan.count("LeftAnti") == 1
    # Months above the watermark go through the joins with the dimensions only: no shuffle by grain, no fact.
    before = plan[: plan.index("LeftAnti")]
    assert "hashpartitioning(state_key" not in before and "fact_retail" not in before
    assert "fact_retail" not in new


RELATED = [views.retail_kpi, views.sector_kpi, views.generation_mix, views.generation_share, views.weather_demand_kpi, views.retail_generation_kpi]


@pytest.mark.parametrize("view", RELATED, ids=lambda v: v.__name__)
def test_dimension_filters_reach_the_facts(whole, view):
    star = whole.star()
    dates, states = F.col("month") == 2, F.col("state_code") == "TX"
    found = views.filtered(view, star, states=states, dates=dates)
    want = view(star).where((F.month("full_date") == 2) & states)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.select(*found.columns).collect()))
    plan = planned(views.filtered(view, star, dates=F.col("full_date") == "2020-02-01"))
    facts = scans(plan, "dw/fact_")
    assert facts
    for scan in facts:
        pruned = scan[scan.index("PartitionFilters") :]
        assert "dynamicpruning" in pruned or "Subquery" in pruned or "date_key" in pruned.split("PushedFilters")[0]


def test_totals_pass_over_the_pages_of_other_members(spark, staging, tmp_path):
    """The key of the total reaches the scan, and rows of other sectors are not decoded."""
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    wh.create()
    rows = [retail_row(2020, 1, f"S{i:04d}", s) for i in range(3000) for s in ("Total", "Residential", "Commercial", "Industrial")]
    options = {"parquet.page.row.count.limit": "1000", "parquet.block.row.count.limit": "3000"}
    conf = spark._jsc.hadoopConfiguration()
    for key, value in options.items():
        conf.set(key, value)
    try:
        write_partitioned(staging("retail", rows), wh.path("stg", "retail"), STAGED_BY, GRAIN["retail"], "overwrite")
        load_dimensions(wh)
        load_fact(wh, "retail")
    finally:
        for key in options:
            conf.unset(key)
    read = {}
    for name, frame in (("all", wh.fact("retail")), ("totals", views.retail_total(wh.star()))):
        spark.sparkContext._jvm.System.gc()
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan()
        read[name] = max(
            int(x.metrics().apply("numOutputRows").value())
            for x in leaves(plan) if "fact_retail" in x.toString()
        )
    assert read == {"all": 12_000, "totals": 3_000}


def leaves(plan):
    """The scans of a plan that has run, those of finished stages too."""
    if "AdaptiveSparkPlan" in plan.getClass().getSimpleName():
        return leaves(plan.executedPlan())
    if "QueryStage" in plan.getClass().getSimpleName():
        return leaves(plan.plan())
    children = plan.children()
    found = [leaf for i in range(children.size()) for leaf in leaves(children.apply(i))]
    return found or [plan]


def test_measures_and_reports_read_each_fact_once(whole):
    star = whole.star()
    shown = [m.TOTAL_RETAIL_SALES, m.CUSTOMERS_LATEST_MONTH, m.AVERAGE_PRICE]
    assert len(scans(planned(m.evaluate(views.retail_kpi(star), shown, ["state_code"])), "dw/fact_retail")) == 1
    for name in ("state_cards", "state_comparison"):
        plan = planned(reports.report(name, star))
        assert [len(scans(plan, f"dw/fact_{d}")) for d in ("retail", "generation")] == [1, 1]
