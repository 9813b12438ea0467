"""Dividend events and the dividend calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import calendar, schema
from tallyloom.plans import columns

EVENT_COLUMNS = (
    "symbol", "dividend", "ex_date", "record_date", "dividend_share_listing_date",
    "announcement_date",
)


def dividend_events(raw: DataFrame, done: str = columns.IMPLEMENTED) -> DataFrame:
    """Dividends that were carried out, dated by their record date."""
    carried_out = schema.rename(raw, columns.DIVIDENDS).filter(F.col("progress") == F.lit(done))
    return schema.keep_columns(carried_out, EVENT_COLUMNS).withColumn("date", F.col("record_date"))


def named_events(events: DataFrame, dimension: DataFrame) -> DataFrame:
    """Events with the stock name of the industry dimension, null where it is not listed."""
    return events.join(dimension.select("symbol", "stock_name"), "symbol", "left").select(
        "symbol", "stock_name", "date", "dividend"
    )


def dividend_calendar(events: DataFrame, dimension: DataFrame, months: int = 11) -> DataFrame:
    """Daily dividend, prior-year total, year-to-date total and rolling total per symbol."""
    return calendar.event_calendar(events, dimension, "dividend", months)


def repeated_symbols(dimension: DataFrame) -> DataFrame:
    """Symbols listed more than once in the dimension: their dividends count that many times."""
    return (
        dimension.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )
