"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.session import spill


def number_rows(df: DataFrame, order: str, key: str, after: int) -> DataFrame:
    """``df`` with ``key`` counting on from ``after`` in the order of the unique column ``order``.

    Rows are sorted in ranges and numbered inside each range; a range starts where the one before
    it ends. So no task sees all rows. The ranges are written down first, since both the numbers
    and the starts depend on where the cuts fell.
    """
    ranges = spill(
        df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), f"keys-{key}"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))  # one row per range
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return (
        ranges.withColumn("_place", place)
        .join(starts, "_range")
        .withColumn(key, (F.col("_start") + F.col("_place") + after).cast("int"))
        .drop("_range", "_place", "_start")
    )
