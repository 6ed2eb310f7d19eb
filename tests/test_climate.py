import random

import pytest
from pyspark.sql import functions as F

from gridmart.fixed_values import CLIMATE_ELEMENT, CLIMATE_MISSING, CLIMATE_STATES
from gridmart.operators.merge import full_outer_merge, merge_metrics
from gridmart.plans.ingest import climate_frame
from gridmart.schemas import CLIMATE_METRICS, STAGING
from gridmart.sources.climate_lines import checked_lines, monthly_values

from conftest import tuples

TWELVE = "  1.0" * 12


def text(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def problem_of(spark, line, metric="avg_temperature", min_year=2010):
    row = checked_lines(text(spark, line), metric, min_year=min_year).first()
    return row.problem if row else "no row"


@pytest.mark.parametrize(
    "line, problem",
    [
        ("0010022026" + TWELVE, None),
        ("   \t ", "no row"),
        ("00100220", "record shorter than 10 characters"),
        ("001002abcd" + TWELVE, "invalid year"),
        ("0010252026" + TWELVE, "unexpected element"),
        ("1100252026" + TWELVE, "unexpected element"),  # checked in dropped lines, too
        ("0010021999", None),  # too old, values do not matter
        ("1100022026 1.0", None),  # no state, values do not matter
        ("0010022026" + "  1.0" * 11, "not 12 monthly values"),
        ("0010022026" + "  1.0" * 13, "not 12 monthly values"),
        ("0010022026", "not 12 monthly values"),
        ("0010022026" + "  1.0" * 11 + "  x", "invalid numeric value"),
        ("0010022026" + "  1.0" * 11 + "  12d", "invalid numeric value"),
    ],
)
def test_line_rules(spark, line, problem):
    assert problem_of(spark, line) == problem


def test_unknown_metric(spark):
    with pytest.raises(ValueError, match="Unsupported metric"):
        checked_lines(text(spark, ""), "wind")


def test_missing_value_marks_are_per_metric(spark):
    for metric in CLIMATE_METRICS:
        marks = " ".join(str(mark) for mark in (-9.99, -99.90, -9999.0))
        line = f"001{CLIMATE_ELEMENT[metric]}2026 {marks} " + " 7" * 9
        got = tuples(monthly_values(checked_lines(text(spark, line), metric)), "month", "value")
        kept = [None if m == CLIMATE_MISSING[metric] else m for m in (-9.99, -99.90, -9999.0)]
        by_month = dict(got)
        assert [by_month[1], by_month[2], by_month[3]] == kept
        assert by_month[12] == 7.0 and len(got) == 12


def build(spark, lines, **options):
    return climate_frame({m: text(spark, *lines.get(m, [])) for m in CLIMATE_METRICS}, **options)


def line(metric, year, values, code="001"):
    return f"{code}{CLIMATE_ELEMENT[metric]}{year}  " + "  ".join(str(v) for v in values)


def test_metrics_come_together_and_empty_months_go(spark):
    full = list(range(1, 13))
    partial = full[:8] + [-99.90] * 4
    rain = full[:9] + [-9.99] * 3
    got = build(
        spark,
        {
            "avg_temperature": [line("avg_temperature", 2026, partial)],
            "precipitation": [line("precipitation", 2026, rain)],
        },
    )
    assert got.columns == STAGING["climate"].fieldNames()
    rows = tuples(got, "month", "state_code", "state_name", "avg_temperature", "precipitation")
    assert len(rows) == 9  # month 9 has rain only, months 10-12 nothing
    assert (9, "AL", "Alabama", None, 9.0) in rows


def test_repeated_state_year_is_an_error(spark):
    twice = [line("avg_temperature", 2026, range(12))] * 2
    with pytest.raises(ValueError, match="Duplicate climate rows"):
        build(spark, {"avg_temperature": twice})


def test_broken_line_is_an_error_with_the_line(spark):
    with pytest.raises(ValueError, match="not 12 monthly values"):
        build(spark, {"avg_temperature": ["0010022026 1 2 3"]})


def test_min_year(spark):
    lines = [line("avg_temperature", year, range(12)) for year in (2009, 2010, 2011)]
    years = {row.year for row in build(spark, {"avg_temperature": lines}).collect()}
    assert years == {2010, 2011}
    years = {row.year for row in build(spark, {"avg_temperature": lines}, min_year=2011).collect()}
    assert years == {2011}


def test_merge_equals_chained_outer_joins(spark):
    """Random keys with repeated and null values: same rows, and ``copies`` counts them."""
    random.seed(7)
    metrics = ["a", "b", "c"]
    rows = {
        m: [(random.randint(1, 12), random.choice([None, 1.0, 2.0])) for _ in range(10)]
        for m in metrics
    }
    frames = [spark.createDataFrame(rows[m], f"k int, {m} double") for m in metrics]
    joined = full_outer_merge(frames, ["k"]).where("a is not null or b is not null or c is not null")
    want = {row.k: row["count"] for row in joined.groupBy("k").count().collect()}
    long = spark.createDataFrame(
        [(k, m, v) for m in metrics for k, v in rows[m]], "k int, metric string, value double"
    )
    merged = merge_metrics(long, ["k"], metrics)
    got = {row.k: row.copies for row in merged.collect()}
    assert {k: n for k, n in got.items() if n} == want
    single = [k for k, n in want.items() if n == 1]
    assert single, "the sample should have single rows"
    assert tuples(merged.where(F.col("k").isin(single)).drop("copies")) == tuples(
        joined.where(F.col("k").isin(single)).select("k", *metrics)
    )


def test_all_states_and_months_against_plain_python(spark):
    """A whole file per metric, parsed line by line in Python as well."""
    random.seed(3)
    lines, want = {}, {}
    for metric in CLIMATE_METRICS:
        lines[metric] = []
        for code in [c for c, _, _ in CLIMATE_STATES] + ["051", "110"]:
            for year in (2009, 2010, 2026):
                values = [
                    random.choice([CLIMATE_MISSING[metric], round(random.uniform(-50, 900), 2)])
                    for _ in range(12)
                ]
                lines[metric].append(line(metric, year, values, code))
                names = {c: (a, n) for c, a, n in CLIMATE_STATES}
                if code in names and year >= 2010:
                    for month, value in enumerate(values, start=1):
                        if value != CLIMATE_MISSING[metric]:
                            key = (year, month, code, *names[code])
                            want.setdefault(key, {})[metric] = value
    got = {
        (r.year, r.month, r.noaa_state_code, r.state_code, r.state_name): {
            m: r[m] for m in CLIMATE_METRICS if r[m] is not None
        }
        for r in build(spark, lines).collect()
    }
    assert got == want


def test_the_error_names_month_and_value(spark):
    values = [str(float(m)) for m in range(12)]
    values[6] = "7x"
    with pytest.raises(ValueError, match=r"invalid numeric value '7x' in month 7 of precipitation in line 0010012020"):
        build(spark, {"precipitation": ["0010012020" + "  " + "  ".join(values)]})
