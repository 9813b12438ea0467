"""Numbers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(text: Column) -> Column:
    """Double from text, null when it is not a number.

    Spark's cast reads a trailing type letter (``1d``, ``1.5f``); such text is not a number here.
    """
    typed = text.rlike(r"[0-9.][dDfF]\s*$")
    return F.when(~typed, nan_to_null(text.try_cast("double")))


def nan_to_null(value: Column) -> Column:
    """Missing floats arrive as NaN; the tables keep nulls."""
    return F.when(~F.isnan(value), value)
