import duckdb
import pytest

import __spark_entry__ as entry
from catalog import oracle, queries
from check_oracle import TABLES, differs, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name",
    [
        "vw_RetailKPI", "vw_GenerationShare", "vw_RetailGeneration", "dim_state", "fact_retail",
        "retail_unpivot", "sheet_header_map", "fact_incremental_delta", "dq_report_broken",
        "mea_retail_by_state", "rep_weather_by_quarter", "alert_windows_batch",
    ],
)
def test_results_equal_the_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    left, right = rows_of(got.columns, got.collect()), rows_of(columns, cursor.fetchall())
    assert len(left) == len(right) > 0
    assert differs(left, right) in ("", "~")
