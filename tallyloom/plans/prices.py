"""Daily bars: build, clean, indicators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import strip_exchange, strip_to_suffix
from tallyloom.operators import filters, keys, schema, series, unions
from tallyloom.plans import columns


def bars(
    adjusted: Mapping[str, DataFrame],
    as_of: dt.date | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Stock or fund bars of the first layout, one landed table per adjust type.

    All bars without a range. With ``as_of`` an end that is not given is filled from the 30 days up
    to that day.
    """
    tables = {}
    for adjust_type, raw in adjusted.items():
        renamed = _in_range(schema.rename(raw, columns.BARS_A), as_of, start, end)
        tables[adjust_type] = renamed.withColumn("symbol", strip_exchange(F.col("symbol")))
    return unions.tagged_union(tables, "adjust_type")


def bars_b(
    raw: DataFrame,
    as_of: dt.date | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Unadjusted stock bars of the second layout, under suffixed codes; the range as in ``bars``."""
    renamed = _in_range(schema.rename(raw, columns.BARS_B), as_of, start, end)
    return schema.tag(
        renamed.withColumn("symbol", strip_to_suffix(F.col("symbol"))), adjust_type="none"
    )


def _in_range(
    df: DataFrame, as_of: dt.date | None, start: dt.date | None, end: dt.date | None
) -> DataFrame:
    if as_of is not None:
        start, end = filters.recent_range(as_of, start, end)
    return filters.landed_range(df, "dt", start, end)


def spot_info(raw: DataFrame, code: str, as_of: dt.date) -> DataFrame:
    """The spot row of one fund, stamped with the day it was read."""
    renamed = schema.rename(raw, columns.SPOT)
    return schema.tag(keys.lookup(renamed, code), update_date=as_of)


def clean_prices(df: DataFrame) -> DataFrame:
    """Forward fill, limit outliers, then daily return and 5- and 20-row averages of the close."""
    clipped = series.clip_to_sigma(series.forward_fill(df))
    returns = series.daily_return(clipped)
    return series.moving_average(series.moving_average(returns, 5), 20)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded for reports and comparisons."""

    return df.selectExpr(
        *[f"round(`{name}`, {places}) as `{name}`" if dtype == "double" else f"`{name}`"
          for name, dtype in df.dtypes]
    )
