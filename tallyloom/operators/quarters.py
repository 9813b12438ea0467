"""Cumulative quarterly figures to single quarters, growth and months.

``keys`` are the columns that tell one series from another (none for a national figure). Each
window holds the quarters of one year or the years of one quarter of a single series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _value_at_previous(value: str, partition: Sequence[str], step: str) -> Column:
    """Value at exactly one step back; null when that step is not in the data."""
    frame = Window.partitionBy(*partition).orderBy(step).rangeBetween(-1, -1)
    return F.first(value).over(frame)


def decumulate(
    df: DataFrame,
    value: str,
    name: str,
    keys: Sequence[str] = (),
    year: str = "year",
    quarter: str = "quarter",
) -> DataFrame:
    """Single-quarter figure: the cumulative one less that of the quarter before in the year.

    The first quarter is its own figure. A missing quarter leaves a null, never a difference
    across the gap.
    """
    before = _value_at_previous(value, [*keys, year], quarter)
    single = F.when(F.col(quarter) == 1, F.col(value)).otherwise(F.col(value) - before)
    return df.withColumn(name, single)


def year_on_year(
    df: DataFrame,
    value: str,
    name: str,
    keys: Sequence[str] = (),
    year: str = "year",
    quarter: str = "quarter",
    places: int = 1,
) -> DataFrame:
    """Growth in percent against the same quarter a year before, rounded half to even.

    Null when either side is missing or the base is 0.
    """
    before = _value_at_previous(value, [*keys, quarter], year)
    growth = (F.try_divide(F.col(value), before) - F.lit(1)) * F.lit(100)
    return df.withColumn(name, F.bround(growth, places))


def quarters_to_months(
    df: DataFrame,
    value: str,
    name: str,
    year: str = "year",
    quarter: str = "quarter",
) -> DataFrame:
    """Three monthly rows per quarter, each with a third of its value; other columns are carried."""
    last = F.col(quarter) * 3
    return (
        df.withColumn("month", F.explode(F.sequence(last - 2, last)))
        .withColumn(name, F.col(value) / F.lit(3.0))
        .withColumn("date", F.make_date(F.col(year), F.col("month"), F.lit(1)))
    )
