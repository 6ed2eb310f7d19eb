"""Failed-run alerts: failures per name in sliding windows, in a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridmart.fixed_values import ALERT_EVERY, ALERT_SEVERITY, ALERT_THRESHOLD, ALERT_WINDOW


def alert_windows(
    runs: DataFrame,
    failed: Column,
    name: str,
    *,
    window: str = ALERT_WINDOW,
    every: str = ALERT_EVERY,
    threshold: int = ALERT_THRESHOLD,
) -> DataFrame:
    """Windows in which a name has at least ``threshold`` failures.

    ``runs`` has the time of each run in ``ts``. The same plan serves batch rows and a stream; on
    a stream a window is final once the watermark, one window length, has passed its end.
    Failures are counted per task before the shuffle.
    """
    failures = runs.where(failed).select(
        F.col("ts").cast("timestamp").alias("ts"), F.col(name).alias("name")
    )
    return (
        failures.withWatermark("ts", window)
        .groupBy(F.window("ts", window, every), "name")
        .agg(F.count(F.lit(1)).alias("failures"))
        .where(F.col("failures") >= threshold)
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "name",
            "failures",
            F.lit(ALERT_SEVERITY).alias("severity"),
        )
    )


def write_alerts(alerts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished windows to ``path``: all input there is now, then stop."""
    return (
        alerts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
