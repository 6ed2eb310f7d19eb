"""Gapless numbers over a whole table, without a task that sees all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.tables import written

_IN_TASK = 33  # bits of a row's place in its task, in the ids that Spark gives


def numbered(rows: DataFrame, order: Sequence[Column], into: str, label: str, within: Sequence[str] = ()) -> DataFrame:
    """``rows``, a stored table, with their number from 0 in the order ``order``, from 0 again for each value of ``within``.

    ``within`` are columns without nulls that lead ``order``. The rows are sorted in ranges and written down with their
    places; a range's first number comes from the counts of those before it, one row per range and value. Equal rows are
    told apart by where they were read, so a value that most rows share is cut into ranges like any other.
    """
    tie, place, range_, first, start = (f"_{x}_" + "_".join(rows.columns) for x in ("tie", "place", "range", "first", "start"))
    ranges = rows.withColumn(tie, F.monotonically_increasing_id()).orderBy(*order, tie).drop(tie)
    ranges = written(ranges.withColumn(place, F.monotonically_increasing_id()), label)
    ranges = ranges.withColumn(range_, F.shiftright(place, _IN_TASK))
    parts = ranges.groupBy(range_, *within).agg(F.min(place).alias(first), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(range_, *within, first, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(start))
    # One row for each task of the sort, and one more for each value of ``within``.
    found = ranges.join(F.broadcast(starts), [range_, *within])
    return found.select(*rows.columns, (F.col(place) - F.col(first) + F.col(start)).alias(into))
