"""Per-symbol reference tables under their vendor column names."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.given import given
from tallyloom.catalog.registry import query
from tallyloom.catalog.stand_ins import code
from tallyloom.plans import companies


def _under_raw_names(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """``values`` under the raw names that are written out for them."""
    return df.select(*[value.alias(name) for name, value in values.items()])


def _valuation_raw(spark: SparkSession, sf: str) -> DataFrame:
    return _under_raw_names(
        given(spark, sf, "orders"),
        {
            "symbol": code(F.col("o_custkey")),
            "数据日期": F.col("o_orderdate"),
            "当日收盘价": F.col("o_totalprice"),
            "PE(TTM)": F.col("o_totalprice") / F.lit(16.0),
            "PE(静)": F.col("o_totalprice") / F.lit(8.0),
        },
    )


_VALUATION_SQL = """
select printf('%06d', o_custkey) as symbol, cast(o_orderdate as date) as date,
       o_totalprice as close_price, o_totalprice / 16 as pe_ttm, o_totalprice / 8 as pe_static
from orders where cast(o_orderdate as date)"""


@query(
    "filter_date_range",
    f"{_VALUATION_SQL} between date '1996-02-01' and date '1997-06-30'",
)
def filter_date_range(spark: SparkSession, sf: str) -> DataFrame:
    raw = _valuation_raw(spark, sf)
    return companies.valuation(raw, dt.date(1996, 2, 1), dt.date(1997, 6, 30))


@query("valuation", f"{_VALUATION_SQL} >= date '2000-01-01'")
def valuation(spark: SparkSession, sf: str) -> DataFrame:
    """Valuation with an open end."""
    return companies.valuation(_valuation_raw(spark, sf), dt.date(2000, 1, 1))


@query(
    "index_weights",
    """
select cast(l_shipdate as date) as date, l_returnflag || l_linestatus as index_code,
       printf('%06d', l_partkey) as stock_code, p.p_name as stock_name, l_discount as weight
from lineitem left join part p on l_partkey = p.p_partkey
""",
)
def index_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as index members, named by part."""
    lines = given(spark, sf, "lineitem").join(
        given(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"), "left"
    )
    raw = _under_raw_names(
        lines,
        {
            "日期": F.col("l_shipdate").cast("date"),
            "指数代码": F.concat("l_returnflag", "l_linestatus"),
            "成分券代码": code(F.col("l_partkey")),
            "成分券名称": F.col("p_name"),
            "权重(%)": F.col("l_discount"),
        },
    )
    return companies.index_weights(raw)


@query(
    "share_structure",
    """
select printf('%06d', o_custkey) as symbol, cast(o_orderdate as date) as change_date,
       o_totalprice as total_share, o_totalprice / 4 as share_restricted,
       o_orderpriority as change_reason
from orders
""",
)
def share_structure(spark: SparkSession, sf: str) -> DataFrame:
    raw = _under_raw_names(
        given(spark, sf, "orders"),
        {
            "symbol": code(F.col("o_custkey")),
            "变更日期": F.col("o_orderdate").cast("date"),
            "总股本": F.col("o_totalprice"),
            "流通受限股份": F.col("o_totalprice") / F.lit(4.0),
            "变动原因": F.col("o_orderpriority"),
        },
    )
    return companies.share_structure(raw)


@query(
    "company_info_b",
    """
select printf('%06d', c_custkey) || '.SZ' as stock_code, c_name as stock_name,
       c_acctbal as total_shares, c_mktsegment as industry, printf('%06d', c_custkey) as symbol,
       date '2024-01-31' as update_date
from customer
""",
)
def company_info_b(spark: SparkSession, sf: str) -> DataFrame:
    raw = _under_raw_names(
        given(spark, sf, "customer"),
        {
            "ts_code": F.concat(code(F.col("c_custkey")), F.lit(".SZ")),
            "name": F.col("c_name"),
            "total_share": F.col("c_acctbal"),
            "industry": F.col("c_mktsegment"),
            "symbol": code(F.col("c_custkey")),
        },
    )
    return companies.company_info_b(raw, dt.date(2024, 1, 31))


@query(
    "stock_indicators",
    """
with listed as (select printf('%06d', c_custkey) as symbol from customer order by 1 limit 500)
select symbol, trade_date, pe
from (select printf('%06d', o_custkey) as symbol, cast(o_orderdate as date) as trade_date,
             o_totalprice as pe from orders) o
where symbol in (select symbol from listed)
""",
)
def stock_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators of the first 500 codes of the list, the range the job is run with."""
    return companies.indicators(*_indicators_raw(spark, sf), 0, 500)


def _indicators_raw(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    raw = given(spark, sf, "orders").select(
        code(F.col("o_custkey")).alias("symbol"),
        F.col("o_orderdate").cast("date").alias("trade_date"),
        F.col("o_totalprice").alias("pe"),
    )
    return raw, given(spark, sf, "customer").select(code(F.col("c_custkey")).alias("symbol"))


@query(
    "stock_indicators_all",
    """
select printf('%06d', o_custkey) as symbol, cast(o_orderdate as date) as trade_date, o_totalprice as pe
from orders where o_custkey in (select c_custkey from customer)
""",
)
def stock_indicators_all(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators of all codes of the list."""
    return companies.indicators(*_indicators_raw(spark, sf))


@query(
    "index_weights_of_one",
    """
select cast(l_shipdate as date) as date, '000300' as index_code, printf('%06d', l_partkey) as stock_code,
       l_discount as weight
from lineitem where l_returnflag = 'R'
""",
)
def index_weights_of_one(spark: SparkSession, sf: str) -> DataFrame:
    """Members of one index, landed without its code."""
    raw = given(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_shipdate").cast("date").alias("日期"),
        code(F.col("l_partkey")).alias("成分券代码"),
        F.col("l_discount").alias("权重(%)"),
    )
    return companies.index_weights(raw, index_code="000300")
