"""The quality gate in front of the warehouse load."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from gridmart.fixed_values import DQ_PASS
from gridmart.schemas import DATASETS, GRAIN, REQUIRED

# Rules in the order they are tested; each takes one code per dataset, in dataset order.
FIRST_CODE = 50001
RULES = ("empty", "null_required", "invalid_period", "duplicate_grain")
RULE_TEXT = {
    "empty": "staging is empty",
    "null_required": "required fields are null",
    "invalid_period": "year or month does not match the period",
    "duplicate_grain": "a grain occurs more than once",
}


def rule_code(dataset: str, rule: str) -> int:
    return FIRST_CODE + RULES.index(rule) * len(DATASETS) + DATASETS.index(dataset)


class DQError(ValueError):
    """A failed check, with its code."""

    def __init__(self, failed: Row):
        self.code, self.dataset, self.rule = failed.code, failed.dataset, failed.rule
        super().__init__(
            f"{self.code} {self.dataset}: {RULE_TEXT[self.rule]} ({failed.violations} found)"
        )


def _lacks_required(dataset: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(name).isNull() for name in REQUIRED[dataset]])


def _invalid_period() -> Column:
    year, month, period = F.col("year"), F.col("month"), F.col("period")
    return F.coalesce(
        year.isNull()
        | month.isNull()
        | (year != F.year(period))
        | (month != F.month(period))
        | ~month.between(1, 12),
        F.lit(False),
    )


def dataset_report(df: DataFrame, dataset: str) -> DataFrame:
    """Rows ``(code, dataset, rule, violations)`` of the four rules, from one scan and one
    shuffle on the grain. Null key values form a grain of their own."""
    counted = (
        df.groupBy(*GRAIN[dataset])
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(_lacks_required(dataset)).alias("lacking"),
            F.count_if(_invalid_period()).alias("invalid"),
        )
        .agg(
            F.count_if(F.col("rows") > 0).alias("grains"),
            F.coalesce(F.sum("lacking"), F.lit(0)).alias("null_required"),
            F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_period"),
            F.count_if(F.col("rows") > 1).alias("duplicate_grain"),
        )
        .withColumn("empty", (F.col("grains") == 0).cast("long"))
    )
    results = [
        F.struct(
            F.lit(rule_code(dataset, rule)).alias("code"),
            F.lit(dataset).alias("dataset"),
            F.lit(rule).alias("rule"),
            F.col(rule).alias("violations"),
        )
        for rule in RULES
    ]
    return counted.select(F.inline(F.array(*results)))


def gate_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The report of all datasets: twelve rows."""
    return reduce(DataFrame.unionByName, [dataset_report(frames[d], d) for d in DATASETS])


def validate_staging(frames: Mapping[str, DataFrame]) -> DataFrame:
    """A PASS row, or ``DQError`` for the failed rule with the lowest code."""
    report = gate_report(frames)
    failed = report.where("violations > 0").orderBy("code").first()
    if failed is not None:
        raise DQError(failed)
    return report.sparkSession.createDataFrame([DQ_PASS], "dq_status string, message string")
