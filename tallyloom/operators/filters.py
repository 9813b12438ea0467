"""Date filters whose ends may be left open."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import schema


def date_range(
    df: DataFrame, column: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Rows of a date column with start <= date <= end. A plain comparison reaches the scan."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end))
    return df


def landed_range(
    df: DataFrame, column: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """``date_range`` over a column as it landed: it becomes a date, and a plain comparison reaches
    the scan also where it landed as text.

    All readable forms begin with the year, so text is compared by year at the scan and by day
    after it is parsed. Text that begins below the digits (white space) is left to the second.
    """
    if dict(df.dtypes)[column] == "string":
        text = schema.named(column)
        if start is not None:
            df = df.filter((text >= f"{start.year:04d}") | (text < "0"))
        if end is not None:
            df = df.filter(text < f"{end.year + 1:04d}")
    return date_range(schema.as_date(df, column), column, start, end)


def recent_range(
    as_of: dt.date, start: dt.date | None = None, end: dt.date | None = None, days: int = 30
) -> tuple[dt.date, dt.date]:
    """The range used when an end is not given: the ``days`` up to ``as_of``."""
    return start or as_of - dt.timedelta(days=days), end or as_of


def from_year(df: DataFrame, column: str, year: int | str | None) -> DataFrame:
    """Rows from the first day of a year on; all rows when no year is given."""
    return df if year is None else date_range(df, column, start=dt.date(int(year), 1, 1))
