"""National series: money supply and GDP."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import label_quarter, label_year, month_text_to_date
from tallyloom.operators import filters, quarters, schema
from tallyloom.plans import columns


def money_supply(raw: DataFrame, start_year: int | str | None = None) -> DataFrame:
    """Monthly money supply, newest first. The month is read as text: ``2024.10`` is October."""
    dated = schema.rename(raw, columns.MONEY_SUPPLY).withColumn(
        "date", month_text_to_date(F.col("date").cast("string"))
    )
    return filters.from_year(dated, "date", start_year).orderBy(F.col("date").desc())


def quarterly_gdp(raw: DataFrame) -> DataFrame:
    """Single-quarter GDP and its growth from cumulative rows; unknown labels are left out."""
    label = schema.named(columns.GDP_LABEL)
    cumulative = raw.select(
        label_year(label).try_cast("int").alias("year"),
        label_quarter(label).alias("quarter"),
        schema.named(columns.GDP_VALUE).cast("double").alias("cumulative"),
    ).filter("year is not null and quarter is not null")
    single = quarters.decumulate(cumulative, "cumulative", "quarter_gdp")
    return quarters.year_on_year(single, "quarter_gdp", "monthly_gdp_yoy")


def gdp_monthly(raw: DataFrame, start_year: int | str | None = None) -> DataFrame:
    """Monthly GDP, newest first. The start year is applied after the growth is known."""
    months = quarters.quarters_to_months(quarterly_gdp(raw), "quarter_gdp", "monthly_gdp")
    if start_year is not None:
        months = months.filter(F.col("year") >= int(start_year))
    return months.select(
        "date",
        F.col("year").cast("string").alias("year"),
        "month",
        "monthly_gdp",
        "monthly_gdp_yoy",
    ).orderBy(F.col("date").desc())
