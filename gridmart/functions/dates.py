"""Calendar expressions on the monthly grid."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(year: Column, month: Column) -> Column:
    """First day of the month; null for a month outside 1-12, so that checks can report it."""
    return F.when(
        month.between(1, 12), F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
    )


def month_of(moment: Column) -> Column:
    """First day of the month a date or timestamp falls in."""
    return F.trunc(moment.cast("date"), "month")


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + 1).cast("int")


def key_to_date(key: int) -> dt.date:
    return dt.date(key // 10000, key // 100 % 100, 1)


def as_period(value: str | dt.date) -> dt.date:
    """A month given as a date or as ``'YYYY-MM'``."""
    if isinstance(value, dt.date):
        return value.replace(day=1)
    year, month = value.split("-")[:2]
    return dt.date(int(year), int(month), 1)
