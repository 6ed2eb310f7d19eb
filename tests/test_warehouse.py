import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from gridmart.fixed_values import CURATED_FOLDER
from gridmart.operators.gate import DQError
from gridmart.operators.keys import number_rows
from gridmart.plans.staging import load_staging, reload_dataset, staging_watermark
from gridmart.plans.warehouse import (
    STAGED_BY,
    Warehouse,
    fact_delta,
    fact_watermark,
    load_dimensions,
    load_fact,
    load_warehouse,
)
from gridmart.plans.views import publish_views, register_views
from gridmart.schemas import GRAIN
from gridmart.sources.folders import Folders, finish_exchanges, new_exchange
from gridmart.sources.tables import write_curated, write_partitioned

from conftest import climate_row, generation_row, retail_row, tuples

JAN, FEB, MAR = (dt.date(2010, m, 1) for m in (1, 2, 3))


@pytest.fixture
def wh(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.create()
    return warehouse


def stage(wh, staging, **rows):
    for dataset, values in rows.items():
        write_partitioned(
            staging(dataset, values), wh.path("stg", dataset), STAGED_BY, GRAIN[dataset], "overwrite"
        )


def sales(wh):
    star = wh.star()
    named = wh.fact("retail").join(star.dim_state, "state_key").join(star.dim_sector, "sector_key")
    return tuples(named, "date_key", "state_code", "sector_name", "sales_mwh")


# --- surrogate keys ---------------------------------------------------------------


def test_numbers_run_through_all_ranges(spark):
    names = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the ranges apart
    try:
        keyed = number_rows(names.repartition(4), "name", "key", 10)
        got = [(row.name, row.key) for row in keyed.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [key for _, key in sorted(got)] == list(range(11, 5011))


# --- staging ------------------------------------------------------------------------


def curate(staging, base, months, factor=1.0):
    rows = [retail_row(m.year, m.month, "AL", "Total", sales=m.month * factor) for m in months]
    write_curated(staging("retail", rows), base, "retail")


def staged_sales(wh):
    return tuples(wh.staging("retail"), "month", "sales_mwh")


def test_reload_from_the_watermark(spark, staging, wh, tmp_path):
    base = str(tmp_path / "curated")
    assert staging_watermark(wh, "retail") == JAN
    curate(staging, base, [JAN, FEB])
    reload_dataset(wh, base, "retail", FEB)
    assert staged_sales(wh) == [(1, 1.0), (2, 2.0)]
    # All months change: the watermark month and later ones arrive, the older one stays.
    curate(staging, base, [JAN, FEB, MAR], factor=10.0)
    reload_dataset(wh, base, "retail", MAR)
    assert staged_sales(wh) == [(1, 1.0), (2, 20.0), (3, 30.0)]
    # Again: nothing new. Before the watermark: nothing at all.
    reload_dataset(wh, base, "retail", MAR)
    reload_dataset(wh, base, "retail", FEB)
    assert staged_sales(wh) == [(1, 1.0), (2, 20.0), (3, 30.0)]


def test_a_missing_month_is_an_error_and_changes_nothing(staging, wh, tmp_path):
    base = str(tmp_path / "curated")
    curate(staging, base, [JAN, MAR])
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        reload_dataset(wh, base, "retail", MAR)
    assert staged_sales(wh) == []


def test_datasets_before_a_failure_stay_loaded(spark, staging, wh, tmp_path):
    base = str(tmp_path / "curated")
    write_curated(staging("climate", [climate_row(2010, 1, "AL")]), base, "climate")
    newest = {"climate": "2010-01", "retail": "2010-01", "generation": "2010-01"}
    with pytest.raises(AnalysisException):
        load_staging(wh, base, newest)  # no retail months
    assert wh.staging("climate").count() == 1 and wh.staging("generation").count() == 0


def break_month(base, month):
    """A curated month that no reader can open."""
    folder = Path(base) / CURATED_FOLDER["retail"] / f"year=2010/month={month:02d}"
    for file in folder.iterdir():
        file.unlink()
    (folder / "part-0.parquet").write_text("not a table")


def leftovers(wh):
    return [p.name for p in (Path(wh.root) / "stg").glob("_*")]


def test_a_load_that_fails_leaves_the_staged_months(spark, staging, wh, tmp_path):
    base = str(tmp_path / "curated")
    curate(staging, base, [JAN, FEB])
    reload_dataset(wh, base, "retail", FEB, JAN)
    curate(staging, base, [JAN, FEB, MAR], factor=10.0)
    break_month(base, 3)
    for _ in range(2):
        with pytest.raises(Exception, match="Parquet|parquet"):
            reload_dataset(wh, base, "retail", MAR, JAN)
        assert staged_sales(wh) == [(1, 1.0), (2, 2.0)] and leftovers(wh) == []
    curate(staging, base, [MAR], factor=10.0)
    reload_dataset(wh, base, "retail", MAR, JAN)
    assert staged_sales(wh) == [(1, 1.0), (2, 20.0), (3, 30.0)]


@pytest.mark.parametrize("fails_at", range(4))
def test_months_that_were_moved_are_put_back(staging, wh, tmp_path, monkeypatch, fails_at):
    base = str(tmp_path / "curated")
    curate(staging, base, [JAN, FEB])
    reload_dataset(wh, base, "retail", JAN, JAN)
    reload_dataset(wh, base, "retail", FEB, JAN)
    curate(staging, base, [FEB, MAR], factor=10.0)
    move, moves = Folders.move, []

    def failing(self, old, new):
        if "year=" in old:  # a month
            moves.append(old)
            if len(moves) == fails_at + 1:
                raise OSError("no more")
        move(self, old, new)

    monkeypatch.setattr(Folders, "move", failing)
    if fails_at < 3:  # February out, February in, March in
        with pytest.raises(OSError, match="no more"):
            reload_dataset(wh, base, "retail", MAR, JAN)
        assert staged_sales(wh) == [(1, 1.0), (2, 2.0)]
    else:
        reload_dataset(wh, base, "retail", MAR, JAN)
        assert staged_sales(wh) == [(1, 1.0), (2, 20.0), (3, 30.0)]
    assert leftovers(wh) == []


@pytest.mark.parametrize("dies_at", range(3))
def test_an_exchange_that_was_cut_off_is_finished(staging, wh, tmp_path, monkeypatch, dies_at):
    base = str(tmp_path / "curated")
    curate(staging, base, [JAN, FEB])
    reload_dataset(wh, base, "retail", FEB, JAN)
    curate(staging, base, [FEB, MAR], factor=10.0)
    move, moves = Folders.move, []

    class Death(BaseException):
        """Nothing that a program handles."""

    def dying(self, old, new):
        if "year=" in old:
            moves.append(old)
            if len(moves) == dies_at + 1:
                raise Death
        move(self, old, new)

    monkeypatch.setattr(Folders, "move", dying)
    with pytest.raises(Death):
        reload_dataset(wh, base, "retail", MAR, JAN)
    assert leftovers(wh)
    monkeypatch.setattr(Folders, "move", move)
    finish_exchanges(Folders(wh.spark, f"{wh.root}/stg"), "retail")
    assert staged_sales(wh) == [(1, 1.0), (2, 20.0), (3, 30.0)] and leftovers(wh) == []


def test_rows_beside_the_table_without_a_plan_are_dropped(staging, wh, tmp_path):
    base = str(tmp_path / "curated")
    curate(staging, base, [JAN])
    reload_dataset(wh, base, "retail", JAN, JAN)
    tables = Folders(wh.spark, f"{wh.root}/stg")
    exchange = new_exchange(tables, "retail")
    curate(staging, f"{wh.root}/stg/{exchange}/new", [FEB])
    reload_dataset(wh, base, "retail", JAN, JAN)
    assert staged_sales(wh) == [(1, 1.0)] and leftovers(wh) == []


def test_watermarks_open_no_file(staging, wh):
    stage(wh, staging, retail=[retail_row(2010, m, "AL", "Total") for m in (1, 2)])
    load_dimensions(wh)
    load_fact(wh, "retail")
    for file in [*Path(wh.root).rglob("date_key=20100101/*/*.parquet"), *Path(wh.root).rglob("month=1/*/*.parquet")]:
        file.write_text("not a table")
    assert staging_watermark(wh, "retail") == FEB
    assert fact_watermark(wh, "retail") == 20100201
    # Nor does a load touch older months.
    stage(wh, staging, retail=[retail_row(2010, m, "AL", "Total") for m in (2, 3)])
    with pytest.raises(Exception, match="parquet|Parquet"):
        wh.fact("retail").agg({"sales_mwh": "sum"}).collect()
    assert fact_delta(wh, "retail", wh.staging("retail").where("period >= date'2010-02-01'")).count() == 0  # March has no date yet
    assert staging_watermark(wh, "climate") == JAN and fact_watermark(wh, "climate") == 0


# --- dimensions -----------------------------------------------------------------------


def test_dimensions_grow_and_old_rows_stay(staging, wh):
    stage(
        wh,
        staging,
        climate=[climate_row(2010, 1, "AL", "Alabama"), climate_row(2010, 1, "TX", "Texas")],
        retail=[retail_row(2010, 1, s, "Total") for s in ("TX", "DC", "ZZ")],
        generation=[generation_row(2010, 3, "TX", "P", "Wind")],
    )
    load_dimensions(wh)
    first = tuples(wh.dimension("dim_state"))
    assert first == [(1, "AL", "Alabama"), (2, "DC", "District of Columbia"), (3, "TX", "Texas"), (4, "ZZ", None)]
    assert tuples(wh.dimension("dim_date")) == [
        (20100101, JAN, 2010, 1, "January"),
        (20100301, MAR, 2010, 3, "March"),
    ]
    load_dimensions(wh)
    assert tuples(wh.dimension("dim_state")) == first
    # A new state sorts first but is numbered last; a new name for ZZ comes too late.
    stage(wh, staging, climate=[climate_row(2010, 2, "AK", "Alaska"), climate_row(2010, 2, "ZZ", "Zed")])
    load_dimensions(wh)
    assert tuples(wh.dimension("dim_state")) == [*first, (5, "AK", "Alaska")]
    assert wh.dimension("dim_date").count() == 3


# --- facts ----------------------------------------------------------------------------


def test_facts_take_new_rows_from_the_watermark_on(staging, wh):
    stage(wh, staging, retail=[
        retail_row(2010, 1, "AL", "Total", sales=1.0),
        retail_row(2010, 2, "AL", "Total", sales=2.0),
    ])
    load_dimensions(wh)
    load_fact(wh, "retail")
    assert fact_watermark(wh, "retail") == 20100201
    assert fact_delta(wh, "retail").count() == 0
    # A late row in January, a changed value and a new row in February, a new month.
    stage(wh, staging, retail=[
        retail_row(2010, 1, "AL", "Total", sales=1.0),
        retail_row(2010, 1, "TX", "Total", sales=9.0),
        retail_row(2010, 2, "AL", "Total", sales=222.0),
        retail_row(2010, 2, "TX", "Total", sales=8.0),
        retail_row(2010, 3, "AL", "Total", sales=3.0),
    ])
    load_dimensions(wh)
    load_fact(wh, "retail")
    want = [
        (20100101, "AL", "Total", 1.0),
        (20100201, "AL", "Total", 2.0),
        (20100201, "TX", "Total", 8.0),
        (20100301, "AL", "Total", 3.0),
    ]
    assert sales(wh) == want
    load_fact(wh, "retail")
    assert sales(wh) == want


def test_rows_without_a_member_are_left_out_until_it_exists(staging, wh):
    stage(wh, staging, retail=[retail_row(2010, 1, "AL", "Total")])
    load_fact(wh, "retail")  # adds its dates, but there is no state or sector yet
    assert wh.dimension("dim_date").count() == 1 and wh.fact("retail").count() == 0
    load_dimensions(wh)
    load_fact(wh, "retail")
    assert wh.fact("retail").count() == 1


def test_whole_load_and_rerun(staging, wh):
    stage(
        wh,
        staging,
        climate=[climate_row(2010, 1, "AL")],
        retail=[retail_row(2010, 1, s, "Total") for s in ("AL", "DC")],
        generation=[generation_row(2010, 1, "AL", "P", s, mwh=-3.0) for s in ("Wind", "Coal")],
    )
    assert load_warehouse(wh).first().dq_status == "PASS"
    counts = {d: wh.fact(d).count() for d in ("climate", "retail", "generation")}
    assert counts == {"climate": 1, "retail": 2, "generation": 2}
    load_warehouse(wh)
    assert {d: wh.fact(d).count() for d in counts} == counts


def test_a_failed_gate_leaves_the_star_alone(staging, wh):
    stage(wh, staging, retail=[retail_row(2010, 1, "AL", "Total")] * 2)
    with pytest.raises(DQError):
        load_warehouse(wh)
    assert wh.dimension("dim_state").count() == 0 and wh.fact("retail").count() == 0


def test_reload_reads_only_the_newest_months(staging, wh):
    stage(wh, staging, retail=[retail_row(2010, m, "AL", "Total") for m in (1, 2, 3)])
    load_dimensions(wh)
    load_fact(wh, "retail")
    plan = fact_delta(wh, "retail")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "> 2010-03-01" in plan and "= 2010-03-01" in plan
    assert "= 20100301)" in plan


def test_a_misfiled_row_leaves_older_months_alone(spark, wh, staging, tmp_path):
    curated = str(tmp_path / "curated")
    rows = [retail_row(2010, 1, "AL", "Total"), retail_row(2010, 1, "TX", "Total"), retail_row(2010, 2, "AL", "Total")]
    write_curated(staging("retail", rows), curated, "retail")
    reload_dataset(wh, curated, "retail", FEB, JAN)
    misfiled = (JAN, 2010, 3, *retail_row(2010, 1, "GA", "Total")[3:])
    write_curated(staging("retail", [misfiled]), curated, "retail")
    for _ in range(2):  # a repeated reload adds nothing
        reload_dataset(wh, curated, "retail", MAR, JAN)
        assert tuples(wh.staging("retail"), "period", "month", "state_code") == sorted(
            [(JAN, 1, "AL"), (JAN, 1, "TX"), (FEB, 2, "AL"), (JAN, 3, "GA")], key=lambda r: tuple((False, str(v)) for v in r)
        )


def test_an_emptied_watermark_month_goes(spark, wh, staging, tmp_path):
    curated = str(tmp_path / "curated")
    rows = [retail_row(2010, 1, "AL", "Total"), retail_row(2010, 2, "AL", "Total")]
    write_curated(staging("retail", rows), curated, "retail")
    reload_dataset(wh, curated, "retail", FEB, JAN)
    Folders(spark, curated).delete(f"{CURATED_FOLDER['retail']}/year=2010/month=02")
    none = staging("retail", []).drop("year", "month")
    none.write.parquet(f"{curated}/{CURATED_FOLDER['retail']}/year=2010/month=02")
    reload_dataset(wh, curated, "retail", FEB, JAN)
    assert tuples(wh.staging("retail"), "period") == [(JAN,)]


def test_views_follow_later_loads(spark, wh, staging):
    stage(wh, staging, retail=[retail_row(2010, 1, "AL", "Total")])
    load_dimensions(wh)
    load_fact(wh, "retail")
    register_views(wh.star())
    count = "select count(*) from vw_RetailTotal"
    assert spark.sql(count).first()[0] == 1
    stage(wh, staging, retail=[retail_row(2010, 2, "AL", "Total")])
    load_dimensions(wh)
    load_fact(wh, "retail")
    assert spark.sql(count).first()[0] == 2


def test_views_of_the_database_are_current_in_every_session(spark, staging, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "warehouse"), f"energy_{tmp_path.name.replace('-', '_')}")
    publish_views(wh)
    other = spark.newSession()
    totals = f"select count(*), count(distinct state_code) from {wh.database}.vw_RetailTotal"
    details = f"select count(*) from {wh.database}.vw_SectorKPI"
    assert tuple(other.sql(totals).first()) == (0, 0)
    stage(wh, staging, retail=[retail_row(2010, 1, "AL", s) for s in ("Total", "Residential")])
    load_dimensions(wh)
    load_fact(wh, "retail")
    assert tuple(other.sql(totals).first()) == (1, 1) and other.sql(details).first()[0] == 1
    # More rows of the same month, of a new state, and a new month.
    stage(wh, staging, retail=[retail_row(2010, m, x, s) for m in (1, 2) for x in ("AL", "TX") for s in ("Total", "Residential")])
    load_dimensions(wh)
    load_fact(wh, "retail")
    for session in (other, spark, spark.newSession()):
        assert tuple(session.sql(totals).first()) == (4, 2)
    plan = other.sql(f"select * from {wh.database}.vw_RetailTotal where full_date = date'2010-02-01'")
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString().lower()
    # A database made later finds what is there.
    late = Warehouse(spark, wh.root, f"{wh.database}_late")
    publish_views(late)
    assert tuple(other.sql(totals.replace(wh.database, late.database)).first()) == (4, 2)
    for database in (wh.database, late.database):
        spark.sql(f"drop database {database} cascade")


def test_publishing_needs_a_database(wh):
    with pytest.raises(ValueError, match="database"):
        publish_views(wh)


def test_a_load_refreshes_the_registered_views_only(spark, wh, staging, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "own"))
    spark.read.parquet(str(tmp_path / "own")).createOrReplaceTempView("vw_mine")
    spark.range(1).write.mode("append").parquet(str(tmp_path / "own"))
    stage(wh, staging, retail=[retail_row(2010, 1, "AL", "Total")])
    load_dimensions(wh)
    register_views(wh.star())
    load_fact(wh, "retail")
    assert spark.table("vw_mine").count() == 1  # as it was registered
    spark.catalog.dropTempView("vw_mine")
