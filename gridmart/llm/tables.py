"""Reading the given tables and keeping results that later jobs share."""

from __future__ import annotations

import ctypes
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from gridmart.session import spill as _spill


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df``, written once to the shared folder of the cluster and read from there."""
    return _spill(df, label)


def gathered(df: DataFrame, label: str) -> DataFrame:
    """As ``written``, for tables of ids and numbers: in few files, but two for each core at least.

    A file of a few rows costs more to make than to read; on a local disk Hadoop even starts processes for each.
    """
    spark = df.sparkSession
    files = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    return written(df.coalesce(files), label)


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as the other side of a join with all documents: always shuffled, never sent through the driver.

    It grows with the documents. The plan is then the same at all sizes, and what moves grows in proportion.
    """
    return df.hint("merge")


def in_tasks(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with a function of this library, which the executors get with the job.

    Workers wait for later tasks, so each gives the memory of its batches and arrays back when it is done: stages without
    them need the room.
    """
    _ship(df.sparkSession)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return df.mapInArrow(whole, schema)


def _ship(spark: SparkSession) -> None:
    """Send the library to the executors, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_gridmart_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    # Only the driver reads this file, to serve it; Spark removes the folder with the context.
    archive = Path(SparkFiles.getRootDirectory()) / "library" / "gridmart.zip"
    archive.parent.mkdir(exist_ok=True)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._gridmart_sent = True
