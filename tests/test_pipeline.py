"""From raw files to the star, twice."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from gridmart.plans import views
from gridmart.plans.pipeline import run_pipeline
from gridmart.plans.warehouse import Warehouse
from gridmart.fixed_values import CLIMATE_ELEMENT, CLIMATE_FILE_PREFIX, CLIMATE_MISSING
from gridmart.schemas import SHEET_ROWS
from gridmart.session import scratch_root

from conftest import tuples


def write_raw(spark, raw, newest_month):
    """One state from January 2010 through ``newest_month``, and DC in the retail sheet."""
    months = range(1, newest_month + 1)
    for metric, prefix in CLIMATE_FILE_PREFIX.items():
        values = [str(m if m <= newest_month else CLIMATE_MISSING[metric]) for m in range(1, 13)]
        for version, first in (("20100101", "999"), ("20100201", values[0])):
            folder = raw / "noaa" / "climate"
            folder.mkdir(parents=True, exist_ok=True)
            text = f"001{CLIMATE_ELEMENT[metric]}2010  {'  '.join([first, *values[1:]])}\n"
            (folder / f"{prefix}v1-{version}").write_text(text)
    numbers = [str(n) for n in range(1, 21)]
    retail = [
        ("Monthly-States", 3 + 2 * m + i, ["2010", str(m), state, "Final", *numbers])
        for m in months
        for i, state in enumerate(("AL", "DC"))
    ]
    header = ["YEAR", "MONTH", "STATE", "TYPE OF PRODUCER", "ENERGY SOURCE", "GENERATION"]
    generation = [("2010_Final", 0, header)] + [
        ("2010_Final", 1 + m * 10 + i, ["2010", str(m), "AL", producer, source, mwh])
        for m in months
        for i, (producer, source, mwh) in enumerate(
            [
                ("Total Electric Power Industry", "Total", "10"),
                ("Total Electric Power Industry", "Wind", "14"),
                ("Total Electric Power Industry", "Pumped Storage", "-4"),
                ("Utility", "Wind", "14"),
            ]
        )
    ]
    for rows, name in ((retail, "eia/retail/HS861M_2010-current"), (generation, "eia/generation/generation_monthly")):
        frame = spark.createDataFrame(rows, SHEET_ROWS)
        frame.coalesce(1).write.mode("overwrite").parquet(str(raw / name))


def test_jobs_remove_their_scratch(spark, tmp_path):
    raw = tmp_path / "raw"
    write_raw(spark, raw, newest_month=2)
    before = set(in_scratch(spark))
    run_pipeline(spark, str(raw), str(tmp_path / "curated"), str(tmp_path / "warehouse"))
    assert set(in_scratch(spark)) == before
    (raw / "eia" / "retail").rename(tmp_path / "away")
    spark.createDataFrame([("Monthly-States", i, ["2010"]) for i in range(9)], SHEET_ROWS).write.parquet(
        str(raw / "eia" / "retail" / "HS861M_2010-current")
    )
    with pytest.raises(ValueError, match="has 1 columns, needed are 24"):
        run_pipeline(spark, str(raw), str(tmp_path / "curated"), str(tmp_path / "warehouse"))
    assert set(in_scratch(spark)) == before


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]", "local[8]", "local"])
def test_a_cluster_needs_a_shared_folder(master):
    settings = {"spark.sql.warehouse.dir": "/somewhere"}
    context = SimpleNamespace(getCheckpointDir=lambda: None, master=master, applicationId="app")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, other=None: settings.get(key, other)), sparkContext=context)
    if master.startswith("local") and "cluster" not in master:
        assert scratch_root(session) == "/somewhere/_scratch/gridmart-app"
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(session)
    settings["spark.checkpoint.dir"] = "hdfs://shared/"
    assert scratch_root(session) == "hdfs://shared/gridmart-app"


def in_scratch(spark):
    root = Path(scratch_root(spark).removeprefix("file:"))
    return [p.name for p in root.iterdir()] if root.exists() else []


def test_raw_to_star(spark, tmp_path):
    raw, curated, root = tmp_path / "raw", str(tmp_path / "curated"), str(tmp_path / "warehouse")
    write_raw(spark, raw, newest_month=2)
    assert run_pipeline(spark, str(raw), curated, root).first().dq_status == "PASS"
    wh = Warehouse(spark, root)

    def counts():
        return [wh.fact(d).count() for d in ("climate", "retail", "generation")]

    assert counts() == [2, 2 * 2 * 5, 2 * 4]
    star = wh.star()
    assert tuples(views.demand_weather(star), "state_code", "month", "sales_mwh", "avg_temperature") == [
        ("AL", 1, 18.0, 1.0), ("AL", 2, 18.0, 2.0), ("DC", 1, 18.0, None), ("DC", 2, 18.0, None),
    ]
    assert tuples(views.generation_share(star).where("month = 1"), "energy_category", "generation_share_pct") == [
        ("Renewable", 140.0), ("Storage", -40.0),
    ]
    # The same again adds nothing; a new month adds its rows.
    run_pipeline(spark, str(raw), curated, root)
    assert counts() == [2, 20, 8]
    write_raw(spark, raw, newest_month=3)
    run_pipeline(spark, str(raw), curated, root)
    assert counts() == [3, 30, 12]
