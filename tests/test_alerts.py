import datetime as dt
import random

from pyspark.sql import functions as F

from gridmart.streaming.alerts import alert_windows, write_alerts

from conftest import tuples

START = dt.datetime(2024, 1, 1, 8, 0)


def some_runs(count=200):
    random.seed(5)
    return [
        (START + dt.timedelta(seconds=random.randint(0, 6 * 3600)), random.choice(["a", "b"]),
         random.choice(["Failed", "Succeeded"]))
        for _ in range(count)
    ]


def counted(runs):
    """Failures per name and window, window by window."""
    found = {}
    for ts, name, status in runs:
        if status == "Failed":
            newest = ts.replace(minute=ts.minute // 5 * 5, second=0)
            for back in range(3):
                key = (newest - dt.timedelta(minutes=5 * back), name)
                found[key] = found.get(key, 0) + 1
    return found


def alerts_of(runs, **options):
    return alert_windows(runs, F.col("status") == "Failed", "name", **options)


def as_dict(df):
    return {(r.window_start, r.name): r.failures for r in df.collect()}


SCHEMA = "ts timestamp, name string, status string"


def test_windows_match_a_count_by_hand(spark):
    runs = some_runs()
    df = spark.createDataFrame(runs, SCHEMA)
    assert as_dict(alerts_of(df)) == counted(runs)
    several = {k: n for k, n in counted(runs).items() if n >= 3}
    assert as_dict(alerts_of(df, threshold=3)) == several
    row = alerts_of(df).first()
    assert row.window_end - row.window_start == dt.timedelta(minutes=15) and row.severity == 2


def test_stream_gives_the_closed_windows(spark, tmp_path):
    runs = some_runs()
    spark.createDataFrame(runs, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "runs"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "runs"))
    rows = str(tmp_path / "rows")

    def run():
        write_alerts(alerts_of(stream), rows, str(tmp_path / "progress")).awaitTermination()
        return spark.read.parquet(rows)

    newest = max(ts for ts, _, status in runs if status == "Failed")
    closed = {
        (start, name): n
        for (start, name), n in counted(runs).items()
        if start + dt.timedelta(minutes=15) <= newest - dt.timedelta(minutes=15)
    }
    assert as_dict(run()) == closed
    # A restart goes on from its progress and repeats nothing.
    later = [(newest + dt.timedelta(hours=3), "a", "Failed")]
    spark.createDataFrame(later, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "runs"))
    assert as_dict(run()) == counted(runs)
    assert run().count() == len(counted(runs))
    assert tuples(run(), "severity")[0] == (2,)
