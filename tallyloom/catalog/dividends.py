"""Dividend events, totals and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.catalog.stand_ins import dividends_raw, stock_names
from tallyloom.operators import calendar
from tallyloom.plans import dividends

EVENTS_SQL = """
events_done as (
  select cast(o_custkey as varchar) as symbol, cast(o_orderdate as date) as date,
         cast(o_totalprice as decimal(18,2)) as dividend
  from orders where o_orderstatus = 'F'
)"""


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return dividends.dividend_events(dividends_raw(spark, sf), done="F")


def _calendar_sql(events: str) -> str:
    return f"""
with {events}, named as (
  select e.*, c.c_name as stock_name
  from events_done e left join customer c on e.symbol = cast(c.c_custkey as varchar)
), span as (
  select symbol, min(date) as lo, max(date) as hi, min(stock_name) as stock_name
  from named group by symbol
), days as (
  select symbol, stock_name, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date
  from span
), filled as (
  select d.*, year(d.date) as y, coalesce(n.dividend, 0) as dividend
  from days d left join named n on d.symbol = n.symbol and d.date = n.date
), yearly as (
  select symbol, year(date) as y, sum(dividend) as total from named group by 1, 2
)
select f.date, f.symbol, f.stock_name, cast(f.dividend as double) as dividend,
       cast(f.y as integer) as year,
       cast(coalesce(p.total, 0) as double) as last_year_total_dividend,
       cast(sum(f.dividend) over (partition by f.symbol, f.y order by f.date) as double)
         as current_year_total_dividend,
       cast(sum(f.dividend) over (partition by f.symbol order by f.date
            range between interval 11 month preceding and current row) as double)
         as rolling_12m_dividend
from filled f left join yearly p on f.symbol = p.symbol and f.y = p.y + 1
"""


@query("dividend_calendar", _calendar_sql(EVENTS_SQL))
def dividend_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return dividends.dividend_calendar(_events(spark, sf), stock_names(spark, sf))


@query(
    "dividend_calendar_crowded",
    _calendar_sql(EVENTS_SQL.replace("cast(o_orderdate as date)", "cast(date_trunc('quarter', o_orderdate) as date)")),
)
def dividend_calendar_crowded(spark: SparkSession, sf: str) -> DataFrame:
    """All events of a quarter on its first day: many days with several events."""
    raw = dividends_raw(spark, sf)
    crowded = raw.withColumn("股权登记日", F.trunc("股权登记日", "quarter"))
    events = dividends.dividend_events(crowded, done="F")
    return dividends.dividend_calendar(events, stock_names(spark, sf))


@query(
    "calendar_densify",
    f"""
with {EVENTS_SQL}
select symbol, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
from events_done group by symbol
""",
)
def calendar_densify(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.dense_calendar(calendar.symbol_span(_events(spark, sf)))


@query(
    "symbol_span",
    f"""
with {EVENTS_SQL}
select symbol, min(date) as first_date, max(date) as last_date from events_done group by symbol
""",
)
def symbol_span(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.symbol_span(_events(spark, sf))


@query(
    "yearly_total",
    f"""
with {EVENTS_SQL}
select symbol, cast(year(date) as integer) as year, cast(sum(dividend) as double) as total
from events_done group by 1, 2
""",
)
def yearly_total(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.yearly_total(_events(spark, sf)).withColumn("total", F.col("total").cast("double"))


@query(
    "prior_year_total",
    f"""
with {EVENTS_SQL}, yearly as (
  select symbol, cast(year(date) as integer) as year, sum(dividend) as total
  from events_done group by 1, 2
)
select a.symbol, a.year, cast(a.total as double) as total,
       cast(coalesce(b.total, 0) as double) as last_year_total
from yearly a left join yearly b on a.symbol = b.symbol and a.year = b.year + 1
""",
)
def prior_year_total(spark: SparkSession, sf: str) -> DataFrame:
    totals = calendar.prior_year_total(calendar.yearly_total(_events(spark, sf)))
    return totals.select(
        "symbol",
        "year",
        F.col("total").cast("double").alias("total"),
        F.col("last_year_total").cast("double").alias("last_year_total"),
    )


@query(
    "left_join_dim",
    f"""
with {EVENTS_SQL}
select e.symbol, c.c_name as stock_name, e.date, cast(e.dividend as double) as dividend
from events_done e left join customer c on e.symbol = cast(c.c_custkey as varchar)
""",
)
def left_join_dim(spark: SparkSession, sf: str) -> DataFrame:
    joined = dividends.named_events(_events(spark, sf), stock_names(spark, sf))
    return joined.withColumn("dividend", F.col("dividend").cast("double"))


@query(
    "filter_status",
    """
select cast(o_custkey as varchar) as symbol, cast(o_totalprice as double) as dividend,
       cast(o_orderdate as date) + 1 as ex_date, cast(o_orderdate as date) as record_date,
       cast(o_orderdate as date) + 2 as dividend_share_listing_date,
       cast(o_orderdate as date) - 30 as announcement_date, cast(o_orderdate as date) as date
from orders where o_orderstatus = 'F'
""",
)
def filter_status(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).withColumn("dividend", F.col("dividend").cast("double"))
