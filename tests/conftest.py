import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridmart.schemas import STAGING  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Small tables on a local disk: no checksum files, no listing jobs.
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "1000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def climate_row(year, month, state, name="Somewhere", temp=50.0, cdd=1.0, hdd=2.0, rain=3.0):
    period = dt.date(year, month, 1)
    return (period, year, month, "001", state, name, temp, cdd, hdd, rain)


def retail_row(year, month, state, sector, sales=100.0, revenue=10.0, customers=5.0, price=None):
    period = dt.date(year, month, 1)
    price = revenue * 100 / sales if price is None and sales else price
    return (period, year, month, state, sector, revenue, sales, customers, price, "Final")


def generation_row(year, month, state, producer, source, mwh=10.0):
    return (dt.date(year, month, 1), year, month, state, producer, source, mwh, "Final")


@pytest.fixture
def staging(spark):
    """Make a staging frame from rows."""

    def make(dataset, rows):
        return spark.createDataFrame(rows, STAGING[dataset])

    return make


def tuples(df, *columns):
    return sorted(
        (tuple(row) for row in df.select(*(columns or df.columns)).collect()),
        key=lambda row: tuple((value is None, str(value)) for value in row),
    )
