"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart.fixed_values import MISSING_CELLS

_WHITESPACE = " \t\n\r\f\x0b"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITESPACE))


def header_text(cell: Column) -> Column:
    """A header cell in the form the column rules compare: stripped, upper case, on one line."""
    return F.replace(F.upper(strip(cell)), F.lit("\n"), F.lit(" "))


def present(cell: Column) -> Column:
    """The cell, with the texts that mean "no value" as null."""
    return F.when(~cell.isin(*MISSING_CELLS), cell)
