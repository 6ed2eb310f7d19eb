"""Counts, ranges and duplicate reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stack(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("dataset"), "row_count"
            )
            for name, df in frames.items()
        ]
    )


def period_ranges(frames: Mapping[str, DataFrame]) -> DataFrame:
    return _stack(
        [
            df.agg(F.min("period").alias("min_period"), F.max("period").alias("max_period")).select(
                F.lit(name).alias("dataset"), "min_period", "max_period"
            )
            for name, df in frames.items()
        ]
    )


def duplicates(df: DataFrame, grain: Sequence[str], count_as: str = "duplicate_count") -> DataFrame:
    """Grains that occur more than once. Counting starts before the shuffle, so a grain with
    very many copies costs one row per task."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias(count_as)).where(F.col(count_as) > 1)


def unexpected(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Values of ``column`` that are not in the only column of ``allowed``."""
    names = allowed.toDF(column)
    return df.select(column).distinct().join(names, column, "left_anti")


def first_rows(df: DataFrame, limit: int = 5) -> str:
    """A few rows as text for an error message."""
    return "; ".join(str(row.asDict()) for row in df.limit(limit).collect())
