"""Number parsing: lenient (bad text is null) and strict (bad text is reported)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart.functions.text import strip

# A bare cast also takes '12d' or 'nan', which are no numbers in the sources.
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def is_number(text: Column) -> Column:
    return text.rlike(_NUMBER)


def to_number(text: Column) -> Column:
    """The double a text stands for, or null."""
    return F.when(is_number(text), strip(text).try_cast("double"))


def to_whole(text: Column) -> Column:
    """The number cut to a whole one; ``'2010.0'`` is 2010."""
    return to_number(text).cast("long")
