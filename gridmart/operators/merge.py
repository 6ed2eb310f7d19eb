"""Merging metrics of the same grain side by side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_metrics(long: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Rows ``(keys, metric, value)`` to one column per metric, with ``copies`` per key.

    This is the chain of full outer joins of the metrics, in one shuffle. ``copies`` is the
    number of joined rows that have a value in any metric: the joined rows are all combinations
    of the rows of each metric, less those made of nulls alone. 0 means no observation, more
    than 1 a repeated key.
    """
    per_metric = []
    for metric in metrics:
        is_metric = F.col("metric") == metric
        per_metric += [
            F.max(F.when(is_metric, F.col("value"))).alias(metric),
            F.count_if(is_metric).alias(f"rows_{metric}"),
            F.count_if(is_metric & F.col("value").isNull()).alias(f"nulls_{metric}"),
        ]
    joined = [F.greatest(F.col(f"rows_{m}"), F.lit(1)) for m in metrics]
    empty = [F.when(F.col(f"rows_{m}") == 0, 1).otherwise(F.col(f"nulls_{m}")) for m in metrics]

    def product(factors):
        return reduce(lambda a, b: a * b, factors)

    return (
        long.groupBy(*keys)
        .agg(*per_metric)
        .select(*keys, *metrics, (product(joined) - product(empty)).alias("copies"))
    )


def full_outer_merge(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Chain of full outer joins on shared keys; repeated keys multiply."""
    return reduce(lambda left, right: left.join(right, list(keys), "full"), frames)
