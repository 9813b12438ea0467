"""National series and date functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.given import given
from tallyloom.catalog.registry import query
from tallyloom.catalog.stand_ins import GDP_SQL, MONEY, gdp_raw
from tallyloom.functions import (
    date_text,
    day_quarter,
    day_year,
    label_quarter,
    label_year,
    parse_date,
    quarter_end,
)
from tallyloom.operators import quarters
from tallyloom.plans import columns, macro


def _cumulative(spark: SparkSession, sf: str) -> DataFrame:
    raw = gdp_raw(spark, sf)
    return raw.select(
        label_year(F.col(columns.GDP_LABEL)).cast("int").alias("year"),
        label_quarter(F.col(columns.GDP_LABEL)).alias("quarter"),
        F.col(columns.GDP_VALUE).alias("cumulative"),
    )


@query("decumulate", f"with {GDP_SQL} select year, quarter, cumulative, quarter_gdp from single")
def decumulate(spark: SparkSession, sf: str) -> DataFrame:
    return quarters.decumulate(_cumulative(spark, sf), "cumulative", "quarter_gdp")


@query(
    "yoy_growth",
    f"with {GDP_SQL} select year, quarter, quarter_gdp, monthly_gdp_yoy from growth",
)
def yoy_growth(spark: SparkSession, sf: str) -> DataFrame:
    return macro.quarterly_gdp(gdp_raw(spark, sf)).select(
        "year", "quarter", "quarter_gdp", "monthly_gdp_yoy"
    )


_GDP_MONTHLY = f"""
with {GDP_SQL}
select make_date(year, quarter * 3 - 2 + m, 1) as date, cast(year as varchar) as year,
       cast(quarter * 3 - 2 + m as integer) as month, quarter_gdp / 3 as monthly_gdp, monthly_gdp_yoy
from (select *, unnest([0, 1, 2]) as m from growth)"""


@query("gdp_monthly", _GDP_MONTHLY)
def gdp_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return macro.gdp_monthly(gdp_raw(spark, sf), start_year=None)


@query("gdp_monthly_from_year", f"{_GDP_MONTHLY} where year >= 1996")
def gdp_monthly_from_year(spark: SparkSession, sf: str) -> DataFrame:
    """The months from a year on, with growth against the year before it."""
    return macro.gdp_monthly(gdp_raw(spark, sf), start_year="1996")


@query(
    "quarter_label",
    """
with labels as (
  select year(o_orderdate) || '年第' ||
         case when quarter(o_orderdate) = 1 then '1' else '1-' || quarter(o_orderdate) end
         || '季度' as label,
         cast(year(o_orderdate) as integer) as y, cast(quarter(o_orderdate) as integer) as quarter
  from orders
)
select label, cast(y as varchar) as year, quarter,
       cast(last_day(make_date(y, quarter * 3, 1)) as date) as quarter_end
from labels group by all
""",
)
def quarter_label(spark: SparkSession, sf: str) -> DataFrame:
    label = F.col(columns.GDP_LABEL)
    parsed = gdp_raw(spark, sf).select(
        label.alias("label"), label_year(label).alias("year"), label_quarter(label).alias("quarter")
    )
    return parsed.withColumn("quarter_end", quarter_end(F.col("year"), F.col("quarter")))


# Fixed mapping of the stand-in: which orders each aggregate of the money table adds up.
_MONEY_PARTS = {
    "m2": "true",
    "m1": "o_orderstatus = 'F'",
    "m0": "o_orderstatus = 'O'",
    "demand_deposit": "o_orderstatus = 'P'",
    "quasi_money": "o_orderpriority = '1-URGENT'",
    "time_deposit": "o_orderpriority = '2-HIGH'",
    "savings_deposit": "o_orderpriority = '3-MEDIUM'",
    "other_deposit": "o_orderpriority = '5-LOW'",
}
# Vendor names of the money table.
_MONEY_NAMES = {
    "m2": "货币和准货币（广义货币M2）",
    "m1": "货币(狭义货币M1)",
    "m0": "流通中现金(M0)",
    "demand_deposit": "活期存款",
    "quasi_money": "准货币",
    "time_deposit": "定期存款",
    "savings_deposit": "储蓄存款",
    "other_deposit": "其他存款",
}
_MONEY_SQL = ", ".join(
    f"cast(sum(case when {part} then cast(o_totalprice as decimal(18,2)) end) as double) as {name},"
    f" cast(count(case when {part} then 1 end) as double) as {name}_yoy"
    for name, part in _MONEY_PARTS.items()
)


@query(
    "money_supply",
    f"""
select make_date(year(o_orderdate), month(o_orderdate), 1) as date, {_MONEY_SQL}
from orders group by 1
""",
)
def money_supply(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per month under the vendor's column names, the month as text like 1997.3."""
    day = F.col("o_orderdate").cast("date")

    def added(part: str) -> Column:
        return F.sum(F.when(F.expr(part), F.col("o_totalprice").cast(MONEY))).cast("double")

    measures = []
    for name, part in _MONEY_PARTS.items():
        measures.append(added(part).alias(_MONEY_NAMES[name]))
        counted = F.count(F.when(F.expr(part), 1)).cast("double")
        measures.append(counted.alias(f"{_MONEY_NAMES[name]}同比增长"))
    month = F.concat(F.year(day).cast("string"), F.lit("."), F.month(day).cast("string"))
    raw = (
        given(spark, sf, "orders")
        .groupBy(month.alias("统计时间"))
        .agg(*measures)
    )
    return macro.money_supply(raw, start_year=None)


@query(
    "date_text_forms",
    """
select o_orderkey as id, strftime(o_orderdate, '%Y-%m-%d') as dashed,
       strftime(o_orderdate, '%Y%m%d') as compact
from orders
""",
)
def date_text_forms(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return given(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        date_text(day).alias("dashed"),
        date_text(day, compact=True).alias("compact"),
    )


@query(
    "date_parts",
    """
select o_orderkey as id, cast(year(o_orderdate) as integer) as year,
       cast(quarter(o_orderdate) as integer) as quarter
from orders
""",
)
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    landed = date_text(F.col("o_orderdate"), compact=True)
    return given(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        day_year(parse_date(landed)).alias("year"),
        day_quarter(F.col("o_orderdate")).alias("quarter"),
    )
