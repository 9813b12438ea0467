"""Landed tables built from the given ones: same columns and shapes, whole tables, no sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.given import given
from tallyloom.functions import date_text

MONEY = "decimal(18,2)"


def code(key: Column) -> Column:
    """A key as a code of at least six digits."""
    text = key.cast("string")
    return F.lpad(text, F.greatest(F.lit(6), F.length(text)), F.lit("0"))


def dividends_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as dividend announcements; those with status F are the ones carried out."""
    day = F.col("o_orderdate").cast("date")
    return given(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("symbol"),
        F.col("o_totalprice").cast(MONEY).alias("派息"),
        F.col("o_orderstatus").alias("进度"),
        F.date_sub(day, 30).alias("公告日期"),
        F.date_add(day, 1).alias("除权除息日"),
        day.alias("股权登记日"),
        F.date_add(day, 2).alias("红股上市日"),
    )


def stock_names(spark: SparkSession, sf: str) -> DataFrame:
    return given(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("symbol"), F.col("c_name").alias("stock_name")
    )


# Factor that turns the stand-in's plain prices into those of each adjust type.
ADJUST_FACTORS = {"hfq": 1.5, "none": 1.0}


def bars_raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Events as daily bars per user by adjust type, with a price gap on one day of seven.

    Events are reduced on the map side: a user with very many events ends as one row per day.
    """
    daily = (
        given(spark, sf, "events")
        .groupBy("user_id", F.col("ts").cast("date").alias("日期"))
        .agg(
            F.expr("min_by(value, ts) as first"),
            F.expr("max_by(value, ts) as last"),
            F.expr("max(value) as top"),
            F.expr("min(value) as bottom"),
            F.expr("cast(count(1) as double) as `成交量`"),
            F.expr(f"cast(sum(cast(value as {MONEY})) as double) as `成交额`"),
        )
        .withColumns(
            {
                "股票代码": F.concat(
                    F.expr("if(user_id % 2 = 0, 'sh', 'sz')"), code(F.col("user_id"))
                ),
                "gap": F.expr("(user_id + day(`日期`)) % 7 = 0"),
            }
        )
    )
    names = {"first": "开盘", "last": "收盘", "top": "最高", "bottom": "最低"}
    return {
        adjust_type: daily.selectExpr(
            "`日期`",
            "`股票代码`",
            *[f"if(gap, null, {price} * {factor}D) as `{raw}`" for price, raw in names.items()],
            "`成交量`",
            "`成交额`",
        )
        for adjust_type, factor in ADJUST_FACTORS.items()
    }


BARS_SQL = """
raw as (
  select printf('%06d', user_id) as symbol, cast(ts as date) as dt,
         (user_id + day(cast(ts as date))) % 7 = 0 as gap,
         min_by(value, ts) as o, max_by(value, ts) as c, max(value) as h, min(value) as l,
         cast(count(*) as double) as volume,
         cast(sum(cast(value as decimal(18,2))) as double) as amount
  from events group by user_id, cast(ts as date)
), bars as (
  select dt, symbol, 'none' as adjust_type,
         case when not gap then o end as open, case when not gap then c end as close,
         case when not gap then h end as high, case when not gap then l end as low, volume, amount
  from raw
  union all
  select dt, symbol, 'hfq', case when not gap then o * 1.5::double end,
         case when not gap then c * 1.5::double end, case when not gap then h * 1.5::double end,
         case when not gap then l * 1.5::double end, volume, amount
  from raw
)"""


def industry_raw(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Customers in nations in regions in two groups: constituents and levels 3, 2 and 1."""
    nation, region = (given(spark, sf, name) for name in ("nation", "region"))
    group = F.concat(F.lit("GROUP_"), (F.col("r_regionkey") % 2).cast("string"))
    stocks = given(spark, sf, "customer").select(
        F.col("c_custkey").alias("序号"),
        F.concat(code(F.col("c_custkey")), F.lit(".SZ")).alias("股票代码"),
        F.col("c_name").alias("股票简称"),
        F.col("c_mktsegment").alias("申万1级"),
        F.col("c_mktsegment").alias("申万2级"),
        F.concat(F.lit("L3_"), F.col("c_nationkey").cast("string")).alias("申万3级行业代码"),
        F.col("c_acctbal").alias("价格"),
    )
    level_3 = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("L3_"), F.col("n_nationkey").cast("string")).alias("行业代码"),
        F.col("n_name").alias("行业名称"),
        F.col("r_name").alias("上级行业"),
    )
    level_2 = region.select(
        F.concat(F.lit("L2_"), F.col("r_regionkey").cast("string")).alias("行业代码"),
        F.col("r_name").alias("行业名称"),
        group.alias("上级行业"),
    )
    level_1 = region.select(
        F.concat(F.lit("L1_"), (F.col("r_regionkey") % 2).cast("string")).alias("行业代码"),
        group.alias("行业名称"),
    ).distinct()
    return stocks, level_3, level_2, level_1


def gdp_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per quarter, added up within the year, under cumulative labels."""
    day = F.col("o_orderdate").cast("date")
    quarterly = (
        given(spark, sf, "orders")
        .groupBy(F.year(day).alias("year"), F.quarter(day).alias("quarter"))
        .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("amount"))
    )
    span = F.when(F.col("quarter") == 1, "1").otherwise(
        F.concat(F.lit("1-"), F.col("quarter").cast("string"))
    )
    return quarterly.select(
        F.concat(F.col("year").cast("string"), F.lit("年第"), span, F.lit("季度")).alias("季度"),
        F.expr("cast(sum(amount) over (partition by year order by quarter) as double)").alias(
            "国内生产总值-绝对值"
        ),
    )


GDP_SQL = """
quarterly as (
  select cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as quarter,
         sum(cast(o_totalprice as decimal(18,2))) as amount
  from orders group by 1, 2
), cumulative as (
  select year, quarter,
         cast(sum(amount) over (partition by year order by quarter) as double) as value
  from quarterly
), single as (
  select a.year, a.quarter, a.value as cumulative,
         case when a.quarter = 1 then a.value else a.value - b.value end as quarter_gdp
  from cumulative a left join cumulative b on a.year = b.year and a.quarter = b.quarter + 1
), growth as (
  select a.*, round_even((a.quarter_gdp / nullif(b.quarter_gdp, 0) - 1) * 100, 1) as monthly_gdp_yoy
  from single a left join single b on a.year = b.year + 1 and a.quarter = b.quarter
)"""


def statements_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as statement rows of the second layout.

    Four of the flag pairs are the four report types, the other two are types nobody asks for. Each
    company type has a measure of its own, one date in seven is unreadable, and one measure is
    always missing.
    """
    flags = F.concat("l_returnflag", "l_linestatus")
    report_type = (
        F.when(flags == "RF", "1").when(flags == "RO", "2").when(flags == "AF", "6")
        .when(flags == "AO", "7").when(flags == "NF", "3").otherwise("4")
    )
    company_type = F.col("l_linenumber").cast("string")
    day = F.col("l_shipdate").cast("date")

    def only(wanted: str, measure: str) -> Column:
        return F.when(company_type == wanted, F.col(measure))

    return given(spark, sf, "lineitem").select(
        F.concat(code(F.col("l_orderkey")), F.lit(".SZ")).alias("ts_code"),
        date_text(day, compact=True).alias("ann_date"),
        date_text(F.date_sub(day, 30)).alias("f_ann_date"),
        F.when(F.dayofweek(day) == 1, "unknown")
        .otherwise(date_text(F.last_day(day), compact=True))
        .alias("end_date"),
        report_type.alias("report_type"),
        company_type.alias("comp_type"),
        F.col("l_extendedprice").alias("revenue"),
        only("2", "l_discount").alias("int_income"),
        only("3", "l_tax").alias("prem_earned"),
        only("4", "l_quantity").alias("n_sec_tb_income"),
        F.lit(None).cast("double").alias("prem_refund"),
        F.col("l_linestatus").alias("update_flag"),
    )


STATEMENTS_SQL = """
landed as (
  select printf('%06d', l_orderkey) || '.SZ' as symbol_full,
         cast(l_shipdate as date) as ann_date,
         cast(l_shipdate as date) - 30 as f_ann_date,
         case when dayofweek(l_shipdate) <> 0 then last_day(cast(l_shipdate as date)) end as end_date,
         case l_returnflag || l_linestatus when 'RF' then '1' when 'RO' then '2' when 'AF' then '6'
              when 'AO' then '7' when 'NF' then '3' else '4' end as report_type,
         cast(l_linenumber as varchar) as comp_type,
         l_extendedprice as revenue,
         case when l_linenumber = 2 then l_discount end as int_income,
         case when l_linenumber = 3 then l_tax end as prem_earned,
         case when l_linenumber = 4 then l_quantity end as n_sec_tb_income,
         cast(null as double) as prem_refund,
         l_linestatus as update_flag,
         printf('%06d', l_orderkey) as symbol
  from lineitem
), named as (
  select * replace (case report_type when '1' then '合并报表' when '2' then '单季合并'
                         when '6' then '母公司报表' when '7' then '母公司单季表' end as report_type)
  from landed where report_type in ('1', '2', '6', '7')
)"""


def facts_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as (symbol, item, value, ord) facts; a later fact replaces an earlier one."""
    key, money = F.col("c_custkey"), F.col("c_acctbal")
    shares = F.when(F.col("c_nationkey") == 3, "n/a").otherwise((key * 100).cast("string"))
    listed = F.when(F.col("c_nationkey") == 5, "2020x").otherwise(
        date_text(F.date_add(F.lit("2000-01-01").cast("date"), (key % 9000).cast("int")), compact=True)
    )
    pairs = [
        ("股票代码", code(key)),
        ("股票简称", F.lit("old name")),
        ("股票简称", F.col("c_name")),
        ("总股本", shares),
        ("流通股", (key * 60).cast("string")),
        ("总市值", money.cast(MONEY).cast("string")),
        ("流通市值", F.lit(None).cast("string")),
        ("行业", F.col("c_mktsegment")),
        ("上市时间", listed),
        ("地域", F.concat(F.lit("R"), F.col("c_nationkey").cast("string"))),
    ]
    rows = [
        F.struct(F.lit(item).alias("item"), value.alias("value"), F.lit(position).alias("ord"))
        for position, (item, value) in enumerate(pairs)
    ]
    return (
        given(spark, sf, "customer")
        .select(code(key).alias("symbol"), F.explode(F.array(*rows)).alias("fact"))
        .select("symbol", "fact.*")
    )


def codes(spark: SparkSession, sf: str) -> DataFrame:
    """Order keys spread over all six-digit codes, bare and with exchange text around them."""
    bare = code(F.pmod(F.col("o_orderkey") * 7919, F.lit(1000000)))
    return given(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        bare.alias("code"),
        F.concat(F.lit(" sh"), bare, F.lit("sz ")).alias("dressed"),
        F.when(F.col("o_orderstatus") == "F", F.concat(bare, F.lit(".SH")))
        .when(F.col("o_orderstatus") == "O", F.lit("none"))
        .otherwise(F.concat(F.lit("x"), F.substring(bare, 1, 3), F.lit("y"), bare))
        .alias("text"),
    )


CODES_SQL = """
codes as (
  select id, code, ' sh' || code || 'sz ' as dressed,
         case status when 'F' then code || '.SH' when 'O' then 'none'
              else 'x' || left(code, 3) || 'y' || code end as text
  from (select o_orderkey as id, o_orderstatus as status,
               printf('%06d', o_orderkey * 7919 % 1000000) as code from orders)
)"""
