"""Spreadsheet rows ``(sheet, row_idx, cells)`` and the columns found in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.fixed_values import HEADER_REQUIRED, HEADER_SEARCH_ROWS, NOTES_SHEET
from gridmart.functions.text import header_text, present

# Column to fill -> the rule its header cell has to meet. The first rule that holds decides.
HEADER_RULES = {
    "year": lambda h: h == "YEAR",
    "month": lambda h: h == "MONTH",
    "state_code": lambda h: h == "STATE",
    "producer_type": lambda h: h.contains("TYPE OF PRODUCER"),
    "energy_source": lambda h: h.contains("ENERGY SOURCE"),
    "generation_mwh": lambda h: h.contains("GENERATION"),
}


def cell(position: int | Column) -> Column:
    """The cell at a zero-based position; null where the row is shorter or the cell blank."""
    return present(F.get("cells", F.lit(position) if isinstance(position, int) else position))


def data_sheets(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("sheet") != NOTES_SHEET)


def find_headers(rows: DataFrame) -> DataFrame:
    """One row per sheet that has a header: its row number and the position of every column.

    The header is the first of the leading rows that names all required columns. A position is
    null where no cell, or more than one, meets the rule.
    """
    named = F.transform("cells", header_text)
    required = F.array(*[F.lit(name) for name in HEADER_REQUIRED])
    headers = (
        data_sheets(rows)
        .where(F.col("row_idx") < HEADER_SEARCH_ROWS)
        .where(F.size(F.array_except(required, named)) == 0)
        .groupBy("sheet")
        .agg(F.min("row_idx").alias("header_idx"), F.min_by(named, "row_idx").alias("header"))
        .withColumn("header", F.transform("header", _column_for))
    )
    return headers.select(
        "sheet",
        "header_idx",
        *[_only_position(name).alias(f"{name}_at") for name in HEADER_RULES],
    )


def _column_for(header: Column) -> Column:
    return F.coalesce(*[F.when(rule(header), name) for name, rule in HEADER_RULES.items()])


def _only_position(name: str) -> Column:
    matches = F.size(F.filter("header", lambda h: h == name))
    return F.when(matches == 1, F.array_position("header", F.lit(name)).cast("int") - 1)


def sheet_problems(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Sheets without a header row or without one of the columns."""
    unnamed = (
        data_sheets(rows).select("sheet").distinct()
        .join(headers, "sheet", "left_anti")
        .select("sheet", F.lit("header row not found").alias("problem"))
    )
    lacking = F.array_compact(
        F.array(*[F.when(F.col(f"{name}_at").isNull(), F.lit(name)) for name in HEADER_RULES])
    )
    incomplete = headers.where(F.size(lacking) > 0).select(
        "sheet", F.concat(F.lit("missing columns: "), F.array_join(lacking, ", ")).alias("problem")
    )
    return unnamed.unionByName(incomplete)


def read_by_header(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Data rows of all sheets with the cells under the named columns.

    Headers that were written down have a size that Spark knows, so those of a few sheets go to all
    tasks; of very many sheets the join shuffles, and adaptive execution splits a sheet that holds
    most of the rows.
    """
    return (
        data_sheets(rows)
        .join(headers, "sheet")
        .where(F.col("row_idx") > F.col("header_idx"))
        .select("sheet", *[cell(F.col(f"{name}_at")).alias(name) for name in HEADER_RULES])
    )
