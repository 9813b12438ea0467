"""Daily bars: union, cleaning, indicators, checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.given import given
from tallyloom.catalog.registry import query
from tallyloom.catalog.stand_ins import BARS_SQL, bars_raw, code
from tallyloom.functions import date_text
from tallyloom.operators import quality, series
from tallyloom.plans import prices

AS_OF = dt.date(2024, 1, 31)

PRICES = ("open", "close", "high", "low")


def _bars(spark: SparkSession, sf: str) -> DataFrame:
    return prices.bars(bars_raw(spark, sf))


_FILL = ", ".join(
    f"last_value({name} ignore nulls) over so_far as {name}"
    for name in (*PRICES, "volume", "amount")
)
FILLED_SQL = f"""
{BARS_SQL}, filled as (
  select dt, symbol, adjust_type, {_FILL} from bars
  window so_far as (partition by symbol, adjust_type order by dt
                    rows between unbounded preceding and current row)
)"""

_CLIP = ", ".join(
    f"case when {name} is not null then least(greatest({name},"
    f" avg({name}) over whole - 3 * stddev_samp({name}) over whole),"
    f" avg({name}) over whole + 3 * stddev_samp({name}) over whole) end as {name}"
    for name in PRICES
)
CLIPPED_SQL = f"""
{FILLED_SQL}, clipped as (
  select dt, symbol, adjust_type, {_CLIP}, volume, amount from filled
  window whole as (partition by symbol, adjust_type)
)"""

_ROUND = ", ".join(f"round({name}, 6) as {name}" for name in (*PRICES, "volume", "amount"))
_RETURN = """round(close / nullif(lag(close) over by_day, 0) - 1, 6) as daily_return"""


def _average(rows: int) -> str:
    frame = (
        "over (partition by symbol, adjust_type order by dt"
        f" rows between {rows - 1} preceding and current row)"
    )
    return f"round(case when count(close) {frame} = {rows} then avg(close) {frame} end, 6) as ma{rows}"


_BY_DAY = "window by_day as (partition by symbol, adjust_type order by dt)"


@query(
    "tagged_union",
    f"with {BARS_SQL} select dt, symbol, open, close, high, low, volume, amount, adjust_type from bars",
)
def tagged_union(spark: SparkSession, sf: str) -> DataFrame:
    return _bars(spark, sf)


@query("forward_fill", f"with {FILLED_SQL} select * from filled")
def forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    return series.forward_fill(_bars(spark, sf))


@query(
    "clip_3sigma",
    f"with {CLIPPED_SQL} select dt, symbol, adjust_type, {_ROUND} from clipped",
)
def clip_3sigma(spark: SparkSession, sf: str) -> DataFrame:
    return prices.rounded(series.clip_to_sigma(series.forward_fill(_bars(spark, sf))))


@query(
    "daily_return",
    f"with {BARS_SQL} select dt, symbol, adjust_type, round(close, 6) as close, {_RETURN}"
    f" from bars {_BY_DAY}",
)
def daily_return(spark: SparkSession, sf: str) -> DataFrame:
    returns = series.daily_return(_bars(spark, sf))
    return prices.rounded(returns.select("dt", "symbol", "adjust_type", "close", "daily_return"))


@query(
    "moving_average",
    f"""with {FILLED_SQL}
select dt, symbol, adjust_type, round(close, 6) as close, {_average(5)}, {_average(20)} from filled""",
)
def moving_average(spark: SparkSession, sf: str) -> DataFrame:
    filled = series.forward_fill(_bars(spark, sf), ["close"])
    averaged = series.moving_average(series.moving_average(filled, 5), 20)
    return prices.rounded(averaged.select("dt", "symbol", "adjust_type", "close", "ma5", "ma20"))


@query(
    "price_clean",
    f"""with {CLIPPED_SQL}
select dt, symbol, adjust_type, {_ROUND}, {_RETURN}, {_average(5)}, {_average(20)}
from clipped {_BY_DAY}""",
)
def price_clean(spark: SparkSession, sf: str) -> DataFrame:
    return prices.rounded(prices.clean_prices(_bars(spark, sf)))


def _damaged(bars: DataFrame) -> DataFrame:
    """Bars with rules broken on purpose: swapped prices on Fridays, no volume on the tenth."""
    friday, tenth = F.dayofweek("dt") == 6, F.day("dt") == 10
    return bars.withColumns(
        {
            "high": F.when(friday, F.col("low") - 1).otherwise(F.col("high")),
            "volume": F.when(tenth, 0.0).otherwise(F.col("volume")),
        }
    )


DAMAGED_SQL = f"""
{BARS_SQL}, damaged as (
  select * replace (case when dayofweek(dt) = 5 then low - 1 else high end as high,
                    case when day(dt) = 10 then 0 else volume end as volume)
  from bars
)"""

_RULES = ("high>=close", "high>=open", "close>=low", "open>=low", "volume>0", "amount>0")


@query(
    "ohlc_violations",
    f"with {DAMAGED_SQL} "
    + " union all ".join(
        f"select symbol, adjust_type, dt, '{rule}' as rule from damaged"
        f" where not coalesce({rule}, false)"
        for rule in _RULES
    ),
)
def ohlc_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.ohlc_violations(_damaged(_bars(spark, sf)))


@query(
    "adjust_completeness",
    f"""with {BARS_SQL}, kept as (
  select * from bars where not (adjust_type = 'hfq' and day(dt) = 15)
)
select symbol, dt, count(*) as n_rows,
       cast(count(distinct adjust_type) as integer) as n_types,
       count(distinct adjust_type) = 2 as is_complete
from kept group by symbol, dt""",
)
def adjust_completeness(spark: SparkSession, sf: str) -> DataFrame:
    lost = (F.col("adjust_type") == "hfq") & (F.day("dt") == 15)
    return quality.adjust_completeness(_bars(spark, sf).filter(~lost))


@query(
    "validate_prices",
    f"""with {BARS_SQL}, partial as (
  select symbol, count(*) as n_rows,
         count(case when event = 'buyer' then close end) as n_values
  from (select b.*, case when cast(symbol as bigint) % 3 = 0 then 'silent' else 'buyer' end as event
        from bars b) group by symbol
), asked as (select printf('%06d', c_custkey) as symbol from customer)
select a.symbol, coalesce(p.n_rows, 0) as n_rows, coalesce(p.n_values, 0) > 0 as is_valid
from asked a left join partial p on a.symbol = p.symbol""",
)
def validate_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as the requested symbols; every third symbol has landed without any value."""
    silent = F.col("symbol").cast("long") % 3 == 0
    bars = _bars(spark, sf).select(
        "symbol", "adjust_type", "dt", F.when(~silent, F.col("close")).alias("close")
    )
    asked = given(spark, sf, "customer").select(
        code(F.col("c_custkey")).alias("symbol")
    )
    return quality.validate_prices(bars, asked)


@query(
    "filter_recent",
    f"with {BARS_SQL} select dt, symbol, close, adjust_type from bars"
    " where adjust_type = 'none' and dt between date '2023-12-21' and date '2024-01-20'",
)
def filter_recent(spark: SparkSession, sf: str) -> DataFrame:
    """Bars without a given range: the 30 days up to a fixed day."""
    recent = prices.bars({"none": bars_raw(spark, sf)["none"]}, as_of=dt.date(2024, 1, 20))
    return recent.select("dt", "symbol", "close", "adjust_type")


@query(
    "spot_info",
    """
select printf('%06d', p_partkey) as symbol, p_name as name, p_retailprice as current_price,
       cast(p_size as double) as volume, date '2024-01-31' as update_date
from part where p_partkey = 42
""",
)
def spot_info(spark: SparkSession, sf: str) -> DataFrame:
    """One fund of the spot table."""
    spot = given(spark, sf, "part").select(
        code(F.col("p_partkey")).alias("代码"),
        F.col("p_name").alias("名称"),
        F.col("p_retailprice").alias("最新价"),
        F.col("p_size").cast("double").alias("成交量"),
    )
    return prices.spot_info(spot, "000042", AS_OF)


_BARS_B = """
select cast(ts as date) as dt, printf('%06d', user_id) || '.SZ' as symbol,
       min_by(value, ts) as open, max_by(value, ts) as close, max(value) as high, min(value) as low,
       cast(count(*) as double) as volume, 'none' as adjust_type
from events{ranged}
group by user_id, cast(ts as date)
"""


def _second_layout(spark: SparkSession, sf: str) -> DataFrame:
    return (
        given(spark, sf, "events")
        .groupBy(
            F.concat(F.lit("sz"), code(F.col("user_id"))).alias("ts_code"),
            date_text(F.col("ts"), compact=True).alias("trade_date"),
        )
        .agg(
            F.min_by("value", "ts").alias("open"),
            F.max_by("value", "ts").alias("close"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.count(F.lit(1)).cast("double").alias("vol"),
        )
    )


@query("bars_b", _BARS_B.format(ranged=""))
def bars_b(spark: SparkSession, sf: str) -> DataFrame:
    """All bars of the second layout: suffixed codes, eight-digit dates."""
    return prices.bars_b(_second_layout(spark, sf))


@query("bars_b_range", _BARS_B.format(ranged=" where cast(ts as date) between date '2024-01-05' and date '2024-01-25'"))
def bars_b_range(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of the second layout in a given range."""
    return prices.bars_b(_second_layout(spark, sf), start=dt.date(2024, 1, 5), end=dt.date(2024, 1, 25))


@query(
    "bar_columns",
    """
select c.name, c.name in ('symbol', 'dt', 'open', 'close', 'high', 'low', 'volume', 'amount',
                          'adjust_type') as is_present,
       (select count(distinct (user_id, cast(ts as date))) * 2 from events) as n_rows
from (select unnest(['symbol', 'dt', 'open', 'close', 'high', 'low', 'volume', 'amount', 'amplitude',
                     'change_percent', 'change_amount', 'turnover_rate', 'adjust_type']) as name) c
""",
)
def bar_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Which columns of a complete bar the built bars have, and over how many rows."""
    bars = _bars(spark, sf)
    missing = quality.missing_columns(bars)
    names = F.explode(F.array(*[F.lit(name) for name in quality.BAR_COLUMNS]))
    counted = bars.agg(F.count(F.lit(1)).alias("n_rows")).select(names.alias("name"), "n_rows")
    return counted.select("name", (~F.col("name").isin(missing)).alias("is_present"), "n_rows")
