import datetime as dt

import pytest

from gridmart.operators import checks
from gridmart.operators.gate import DQError, dataset_report, gate_report, validate_staging

from conftest import climate_row, generation_row, retail_row, tuples

GOOD = {
    "climate": [climate_row(2020, m, "AL") for m in (1, 2)],
    "retail": [retail_row(2020, m, "AL", s) for m in (1, 2) for s in ("Total", "Residential")],
    "generation": [generation_row(2020, m, "AL", "P", s) for m in (1, 2) for s in ("Wind", "Coal")],
}


@pytest.fixture
def frames(staging):
    def make(**changed):
        return {d: staging(d, changed.get(d, rows)) for d, rows in GOOD.items()}

    return make


def put(rows, index, position, value):
    """A copy of ``rows`` with one cell changed."""
    changed = [list(row) for row in rows]
    changed[index][position] = value
    return [tuple(row) for row in changed]


def test_pass(frames):
    assert validate_staging(frames()).first().asDict() == {
        "dq_status": "PASS",
        "message": "All staging data quality checks passed.",
    }
    report = tuples(gate_report(frames()), "code", "violations")
    assert report == [(code, 0) for code in range(50001, 50013)]


CLIMATE, RETAIL, GENERATION = GOOD["climate"], GOOD["retail"], GOOD["generation"]


@pytest.mark.parametrize(
    "code, dataset, rows",
    [
        (50001, "climate", []),
        (50003, "generation", []),
        (50004, "climate", put(CLIMATE, 0, 4, None)),
        (50005, "retail", put(RETAIL, 0, 4, None)),
        (50005, "retail", put(RETAIL, 0, 0, None)),
        (50006, "generation", put(GENERATION, 0, 5, None)),
        (50007, "climate", put(CLIMATE, 0, 1, 2021)),
        (50008, "retail", put(RETAIL, 0, 2, None)),
        (50009, "generation", put(GENERATION, 0, 2, 13)),
        (50010, "climate", CLIMATE + CLIMATE[:1]),
        (50011, "retail", RETAIL + RETAIL[:1]),
        (50012, "generation", GENERATION + GENERATION[:1]),
    ],
)
def test_each_rule_has_its_code(frames, code, dataset, rows):
    with pytest.raises(DQError) as error:
        validate_staging(frames(**{dataset: rows}))
    assert (error.value.code, error.value.dataset) == (code, dataset)


def test_lowest_code_wins(frames):
    with pytest.raises(DQError) as error:
        validate_staging(frames(climate=CLIMATE + CLIMATE[:1], retail=[]))
    assert error.value.code == 50002


def test_a_missing_period_is_no_period_mismatch(staging):
    rows = put(CLIMATE, 0, 0, None)
    report = dict(tuples(dataset_report(staging("climate", rows), "climate"), "rule", "violations"))
    assert report == {"empty": 0, "null_required": 1, "invalid_period": 0, "duplicate_grain": 0}


def test_null_keys_form_one_grain(staging):
    rows = put(put(CLIMATE, 0, 4, None), 1, 4, None)
    rows = put(rows, 1, 2, 1)
    report = dict(tuples(dataset_report(staging("climate", rows), "climate"), "rule", "violations"))
    assert report["duplicate_grain"] == 1


def test_reports(spark, frames):
    parts = frames(retail=RETAIL + RETAIL[:2])
    assert tuples(checks.row_counts(parts)) == [("climate", 2), ("generation", 4), ("retail", 6)]
    first, last = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    assert tuples(checks.period_ranges(parts)) == [
        (d, first, last) for d in ("climate", "generation", "retail")
    ]
    twice = checks.duplicates(parts["retail"], ["state_code", "year", "month", "sector"])
    assert tuples(twice) == [("AL", 2020, 1, "Residential", 2), ("AL", 2020, 1, "Total", 2)]
    allowed = spark.createDataFrame([("Total",)], "name string")
    assert tuples(checks.unexpected(parts["retail"], "sector", allowed)) == [("Residential",)]
