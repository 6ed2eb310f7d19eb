import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from gridmart.plans.ingest import job_result
from gridmart.sources.files import latest_input, named_input
from gridmart.sources.tables import (
    create_table,
    month_folder,
    months,
    read_curated,
    read_curated_months,
    write_curated,
    write_months,
)
from gridmart.schemas import FACTS

from conftest import retail_row, tuples

MINI = [(2025, 12, 10), (2025, 12, 20), (2026, 1, 30)]


def mini(spark, rows=MINI):
    return spark.createDataFrame(rows, "year long, month long, value long")


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.glob("year=*/month=*"))


def test_one_folder_per_month_with_padded_number(spark, tmp_path):
    write_months(mini(spark), str(tmp_path))
    assert folders(tmp_path) == ["year=2025/month=12", "year=2026/month=01"]
    one = spark.read.parquet(str(tmp_path / "year=2025/month=12"))
    assert tuples(one) == [(10,), (20,)]
    back = spark.read.schema("value long, year long, month long").parquet(str(tmp_path))
    assert tuples(back, "year", "month", "value") == sorted(MINI)


def test_rewriting_replaces_only_the_months_given(spark, tmp_path):
    write_months(mini(spark), str(tmp_path))
    write_months(mini(spark, [(2025, 12, 99)]), str(tmp_path))
    assert tuples(spark.read.parquet(str(tmp_path)), "value") == [(30,), (99,)]


def test_missing_partition_columns(spark, tmp_path):
    with pytest.raises(ValueError, match=r"Missing partition columns: \['month', 'year'\]"):
        write_months(mini(spark).select("value"), str(tmp_path))


def test_no_rows_write_nothing_and_leave_what_is_there(spark, tmp_path):
    write_months(mini(spark).where("false"), str(tmp_path))
    assert folders(tmp_path) == []
    write_months(mini(spark), str(tmp_path))
    write_months(mini(spark).where("false"), str(tmp_path))
    assert folders(tmp_path) == ["year=2025/month=12", "year=2026/month=01"]


def test_rows_without_a_month_belong_to_no_folder(spark, tmp_path):
    write_months(mini(spark, [*MINI, (2026, None, 1), (None, 1, 1)]), str(tmp_path))
    assert folders(tmp_path) == ["year=2025/month=12", "year=2026/month=01"]
    assert spark.read.parquet(str(tmp_path)).count() == 3


def test_a_month_with_most_of_the_rows_is_split(spark, tmp_path):
    """Rows of one month go to several tasks once they pass the size a task should have."""
    hot = spark.range(300_000).select(
        F.lit(2026).alias("year"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 12 + 1).alias("month"),
        F.sha2(F.col("id").cast("string"), 256).alias("value"),
    ).repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_months(hot, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = len(list((tmp_path / "year=2026" / "month=01").glob("part-*")))
    assert files > 1
    assert spark.read.parquet(str(tmp_path)).count() == 300_000


def test_curated_months(spark, staging, tmp_path):
    rows = [retail_row(2025, m, "AL", "Total", sales=float(m)) for m in (10, 11, 12)]
    write_curated(staging("retail", rows), str(tmp_path), "retail")
    base = str(tmp_path)
    assert folders(tmp_path / "eia" / "retail")[0] == "year=2025/month=10"
    assert tuples(read_curated(spark, base, "retail")) == sorted(rows)
    some = read_curated_months(spark, base, "retail", dt.date(2025, 11, 1), dt.date(2025, 12, 1))
    assert tuples(some, "month") == [(11,), (12,)]
    assert some.schema == read_curated(spark, base, "retail").schema
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_curated_months(spark, base, "retail", dt.date(2025, 12, 1), dt.date(2026, 1, 1))


def test_month_sequence(spark):
    paths = months(spark, dt.date(2025, 11, 1), dt.date(2026, 2, 1)).select(
        month_folder("base", "climate", F.col("period"))
    )
    assert [row[0] for row in paths.collect()] == [
        "base/climate/year=2025/month=11",
        "base/climate/year=2025/month=12",
        "base/climate/year=2026/month=01",
        "base/climate/year=2026/month=02",
    ]


def test_creating_a_table_twice_keeps_its_rows(spark, tmp_path):
    path = str(tmp_path / "fact")
    create_table(spark, path, FACTS["climate"], ("date_key",))
    assert spark.read.schema(FACTS["climate"]).parquet(path).count() == 0
    rows = spark.createDataFrame([(20260101, 1, 1.0, 2.0, 3.0, 4.0)], FACTS["climate"])
    rows.write.mode("append").partitionBy("date_key").parquet(path)
    create_table(spark, path, FACTS["climate"], ("date_key",))
    assert spark.read.schema(FACTS["climate"]).parquet(path).count() == 1


def test_job_result(staging):
    rows = [retail_row(2025, 12, "AL", s) for s in ("Total", "Residential")]
    frame = staging("retail", [*rows, retail_row(2026, 1, "AL", "Total")])
    assert job_result(frame).first().asDict() == {
        "status": "success",
        "rows_written": 3,
        "max_period": "2026-01",
        "partitions_written": 2,
    }


def test_choosing_inputs(spark, tmp_path):
    for name in (
        "a/climdiv-tmpcst-v1-20260804",
        "a/climdiv-tmpcst-v1-20260904",
        "a/climdiv-pcpnst-v1-20261004",
        "a/deep/generation_monthly.xlsx",
    ):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    # A version may also be a folder of part files.
    parts = tmp_path / "a" / "climdiv-cddcst-v1-20260904"
    parts.mkdir()
    (parts / "part-00000.txt").write_text("x")
    (parts / "part-00001.txt").write_text("y")
    folder = str(tmp_path / "a")
    assert latest_input(spark, folder, "climdiv-tmpcst-").endswith("tmpcst-v1-20260904")
    cooling = latest_input(spark, folder, "climdiv-cddcst-")
    assert cooling.endswith("cddcst-v1-20260904")
    assert tuples(spark.read.text(cooling)) == [("x",), ("y",)]
    assert named_input(spark, folder, "generation_monthly.xlsx").endswith("deep/generation_monthly.xlsx")
    with pytest.raises(FileNotFoundError):
        latest_input(spark, folder, "climdiv-hddcst-")
    with pytest.raises(FileNotFoundError):
        named_input(spark, folder, "generation_monthly")
    with pytest.raises(FileNotFoundError):
        latest_input(spark, str(tmp_path / "nowhere"), "climdiv-tmpcst-")
