import pytest

from gridmart.plans.ingest import generation_frame, job_result, publish, retail_frame, retail_rows
from gridmart.schemas import SHEET_ROWS, STAGING
from gridmart.sources.sheets import find_headers, read_by_header
from gridmart.session import spill

from conftest import tuples


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), SHEET_ROWS)


# --- retail ---------------------------------------------------------------------


def retail(row_idx, *head, numbers=None, sheet="Monthly-States"):
    numbers = numbers or [str(n) for n in range(1, 21)]
    return (sheet, row_idx, [*head, *numbers])


def test_sectors_take_four_cells_each_in_order(spark):
    got = retail_rows(rows_of(spark, retail(3, "2020", "2", "AL", "Final")))
    assert got.columns == STAGING["retail"].fieldNames()
    values = tuples(got, "sector", "revenue_thousand_dollars", "sales_mwh", "customer_count",
                    "avg_price_cents_per_kwh")
    assert values == [
        ("Commercial", 5.0, 6.0, 7.0, 8.0),
        ("Industrial", 9.0, 10.0, 11.0, 12.0),
        ("Residential", 1.0, 2.0, 3.0, 4.0),
        ("Total", 17.0, 18.0, 19.0, 20.0),
        ("Transportation", 13.0, 14.0, 15.0, 16.0),
    ]


def test_retail_row_cases(spark):
    got = retail_rows(
        rows_of(
            spark,
            retail(2, "2020", "1", "AK", "Final"),  # above the table
            retail(3, "2020.0", "1", " AL ", " Final ", numbers=["."] * 20),
            retail(4, "2009", "12", "AL", "Final"),  # too old
            retail(5, "2020", "3", "AL", None),
            retail(6, "2020", "4", None, "Final"),
            ("Monthly-States", 7, ["Notes: see above"]),
            retail(8, "2020", "5", "AL", "Final", numbers=[str(n) for n in range(21)]),  # 25 cells
            ("Monthly-States", 9, ["2020", "6", "AL", "Final", "1", "2"]),  # short row
            retail(10, "2020", "7", "AL", "Final", sheet="Other"),
        )
    )
    assert sorted({row.month for row in got.collect()}) == [1, 3, 5, 6]
    first = got.where("month = 1").collect()
    assert len(first) == 5  # rows without any number stay
    assert {(r.year, r.state_code, r.data_status, r.sales_mwh) for r in first} == {
        (2020, "AL", "Final", None)
    }
    assert {r.data_status for r in got.where("month = 3").collect()} == {None}
    short = {r.sector: (r.revenue_thousand_dollars, r.customer_count) for r in got.where("month = 6").collect()}
    assert short["Residential"] == (1.0, None) and short["Total"] == (None, None)


def test_retail_checks(spark):
    with pytest.raises(ValueError, match="Duplicate retail rows"):
        retail_frame(rows_of(spark, *[retail(i, "2020", "1", "AL", "Final") for i in (3, 4)]))
    with pytest.raises(ValueError, match="Month outside 1-12"):
        retail_frame(rows_of(spark, retail(3, "2020", "13", "AL", "Final")))


def test_nothing_to_write_is_an_error(spark, tmp_path):
    empty = retail_frame(rows_of(spark, retail(3, "2009", "1", "AL", "Final")))
    with pytest.raises(ValueError, match="No retail rows"):
        publish(empty, str(tmp_path), "retail")
    assert list(tmp_path.iterdir()) == []


# --- generation -------------------------------------------------------------------

HEADER = ["YEAR", "MONTH", "STATE", "TYPE OF PRODUCER", "ENERGY SOURCE", "GENERATION (Megawatthours)"]


def test_headers_are_found_per_sheet(spark):
    got = generation_frame(
        rows_of(
            spark,
            ("2001_Final", 0, HEADER),
            ("2001_Final", 1, ["2020", "1", "AL", "P", "Wind", "-5.5"]),
            ("2024 Preliminary", 1, ["STATE of things"]),
            ("2024 Preliminary", 4, ["Generation\n(MWh)", None, " State", "Year ", "MONTH",
                                     "Energy\nSource", "Type of\nProducer"]),
            ("2024 Preliminary", 5, ["7", "", "AK ", "2021", "2.0", " Coal", "Q "]),
            ("Data", 14, HEADER),
            ("Data", 15, ["2020", "3", "AL", "P", "Wind", "1"]),
            ("Data", 16, ["2020", "3", "US-Total ", "P", "Wind", "1"]),
            ("Data", 17, ["2020", "3", "us-total", "P", "Wind", "1"]),
            ("Data", 18, ["2020", "4", "AL", "P", "Wind", "."]),
            ("Data", 19, ["2020", "4", "AL", "P", None, "1"]),
            ("Data", 20, ["2009", "4", "AL", "P", "Wind", "1"]),
            ("Data", 21, ["Source: a survey"]),
            ("EnergySource_Notes", 0, ["anything"]),
        )
    )
    assert got.columns == STAGING["generation"].fieldNames()
    assert tuples(got.drop("period")) == [
        (2020, 1, "AL", "P", "Wind", -5.5, "Final"),
        (2020, 3, "AL", "P", "Wind", 1.0, "Unknown"),
        (2021, 2, "AK", "Q", "Coal", 7.0, "Preliminary"),
    ]


def test_first_header_wins(spark):
    rows = rows_of(spark, ("S", 2, HEADER), ("S", 5, HEADER[::-1]), ("S", 6, ["2020", "1", "AL", "P", "W", "1"]))
    head = find_headers(rows).first()
    assert (head.header_idx, head.year_at, head.generation_mwh_at) == (2, 0, 5)


@pytest.mark.parametrize(
    "rows, message",
    [
        ([("S", 15, HEADER), ("S", 16, ["2020"])], "header row not found"),
        ([("S", 0, HEADER[:4])], "missing columns: energy_source, generation_mwh"),
        ([("S", 0, [*HEADER, "GENERATION again"])], "missing columns: generation_mwh"),
        ([("EnergySource_Notes", 0, ["x"])], "No generation data"),
    ],
)
def test_unreadable_sheets(spark, rows, message):
    with pytest.raises(ValueError, match=message):
        generation_frame(rows_of(spark, *rows))


def test_generation_checks(spark):
    row = ["2020", "1", "AL", "P", "Wind", "1"]
    with pytest.raises(ValueError, match="Duplicate generation rows"):
        generation_frame(rows_of(spark, ("S", 0, HEADER), ("S", 1, row), ("S", 2, row)))
    with pytest.raises(ValueError, match="Month outside 1-12"):
        generation_frame(rows_of(spark, ("S", 0, HEADER), ("S", 1, ["2020", "0", *row[2:]])))


def test_many_sheets_join_without_broadcast(spark):
    """Stored headers are broadcast below Spark's bound; beyond it the join shuffles, with the same rows."""
    rows = rows_of(
        spark,
        *[(f"S{i}", 0, HEADER) for i in range(5)],
        *[(f"S{i % 5}", 1 + i, ["2020", "1", f"{i}", "P", "W", "1"]) for i in range(40)],
    )
    headers = spill(find_headers(rows), "headers")
    joined = read_by_header(rows, headers)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    small = tuples(joined)
    bound = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(bound, "-1")
    try:
        joined = read_by_header(rows, headers)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert tuples(joined) == small and len(small) == 40
    finally:
        spark.conf.unset(bound)


def test_a_sheet_of_another_shape_is_an_error(spark):
    """The table has 24 columns, counted in the widest row below the titles."""
    narrow = [("Monthly-States", i, ["2020", "1", "AL", "Final", *["1"] * 16]) for i in (3, 4)]
    with pytest.raises(ValueError, match="has 20 columns, needed are 24"):
        retail_frame(rows_of(spark, *narrow))
    with pytest.raises(ValueError, match="has 0 columns"):
        retail_frame(rows_of(spark, ("Monthly-States", 0, ["Title"] * 30)))
    with pytest.raises(ValueError, match="no sheet 'Monthly-States'"):
        retail_frame(rows_of(spark, retail(3, "2020", "1", "AL", "Final", sheet="Other")))
    # One whole row is enough: the others are filled up with nothing.
    found = retail_frame(rows_of(spark, *narrow[:1], retail(5, "2020", "2", "AL", "Final")))
    assert found.where("month = 1 and sector = 'Total'").first().sales_mwh is None


def test_an_ingest_reports_what_it_wrote(spark, tmp_path):
    rows = [retail(3 + i, str(2020 + i // 12), str(1 + i % 12), s, "Final") for i in range(14) for s in ("AL", "TX")]
    found = publish(retail_frame(rows_of(spark, *rows)), str(tmp_path), "retail").first()
    assert tuple(found) == ("success", 14 * 2 * 5, "2021-02", 14)
    assert found.asDict() == job_result(retail_rows(rows_of(spark, *rows))).first().asDict()
