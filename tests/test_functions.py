import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from gridmart.functions.dates import as_period, date_key, key_to_date, month_of, month_start
from gridmart.functions.labels import energy_category, sheet_status, state_label
from gridmart.functions.numbers import to_number, to_whole
from gridmart.functions.text import header_text, present, strip


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_lenient_numbers_match_pandas(spark):
    texts = [" 12.5 ", "12d", ".", "1,234", "1e3", "", "-7", "+.5", "5.", "abc", None, "1 2", "--1"]
    want = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    got = values(spark, texts, to_number(F.col("t")))
    assert [None if pd.isna(w) else w for w in want] == got


def test_words_that_read_as_floats_are_no_numbers(spark):
    assert values(spark, ["nan", "NaN", "inf", "Infinity"], to_number(F.col("t"))) == [None] * 4


def test_whole_numbers(spark):
    got = values(spark, ["2010.0", "2010", "2010.7", "x"], to_whole(F.col("t")))
    assert got == [2010, 2010, 2010, None]


def test_text(spark):
    assert values(spark, [" a\t\n"], strip(F.col("t"))) == ["a"]
    assert values(spark, [" Type of\nProducer "], header_text(F.col("t"))) == ["TYPE OF PRODUCER"]
    assert values(spark, ["", "NA", "0", None, "#N/A"], present(F.col("t"))) == [
        None, None, "0", None, None,
    ]


def test_dates(spark):
    df = spark.createDataFrame([(2026, 8), (2026, 13), (2026, 0)], "y long, m long")
    got = [row[0] for row in df.select(month_start(F.col("y"), F.col("m"))).collect()]
    assert got == [dt.date(2026, 8, 1), None, None]
    day = spark.sql("select timestamp_ntz'2026-08-17 23:00:00' as t, date'2026-08-01' as d")
    assert day.select(month_of(F.col("t"))).first()[0] == dt.date(2026, 8, 1)
    assert day.select(date_key(F.col("d"))).first()[0] == 20260801
    assert key_to_date(20260801) == dt.date(2026, 8, 1)
    assert as_period("2026-08") == as_period(dt.date(2026, 8, 17)) == dt.date(2026, 8, 1)


def test_labels(spark):
    sheets = ["2001_Final", "2024 preliminary (final for some)", "Data"]
    assert values(spark, sheets, sheet_status(F.col("t"))) == ["Final", "Preliminary", "Unknown"]
    sources = ["Wind", "Coal", "Nuclear", "Pumped Storage", "Other", "Hydroelectric Conventional"]
    assert values(spark, sources, energy_category(F.col("t"))) == [
        "Renewable", "Fossil", "Nuclear", "Storage", "Other", "Renewable",
    ]
    assert values(spark, ["DC", "AL"], state_label(F.col("t"), F.lit("named"))) == [
        "District of Columbia", "named",
    ]
