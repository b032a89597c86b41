"""Small helpers for column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = " \t\n\x0b\f\r"  # the white space of all word rules here


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def has_word(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANK)) != ""
