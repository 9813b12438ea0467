"""Dimension joins, code lists, coverage, codes and SQL over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.given import given
from tallyloom.catalog.registry import query
from tallyloom.catalog.stand_ins import CODES_SQL, code, codes, facts_raw, industry_raw
from tallyloom.functions import (
    first_digits,
    full_symbol,
    parse_compact_date,
    parse_number,
    strip_exchange,
    strip_to_suffix,
)
from tallyloom.operators import keys, quality
from tallyloom.plans import companies, industry, ingest
from tallyloom.sources import sql_over_tables


@query(
    "industry_dim",
    """
select c.c_name as stock_name, printf('%06d', c.c_custkey) || '.SZ' as stock_code,
       printf('%06d', c.c_custkey) as symbol,
       n.n_name as level_3_name, 'L3_' || n.n_nationkey as level_3_code,
       r.r_name as level_2_name, 'L2_' || r.r_regionkey as level_2_code,
       'GROUP_' || (r.r_regionkey % 2) as level_1_name, 'L1_' || (r.r_regionkey % 2) as level_1_code
from customer c left join nation n on c.c_nationkey = n.n_nationkey
left join region r on n.n_regionkey = r.r_regionkey
""",
)
def industry_dim(spark: SparkSession, sf: str) -> DataFrame:
    stocks, *levels = industry_raw(spark, sf)
    named = [industry.industry_level(raw, level) for raw, level in zip(levels, (3, 2, 1))]
    return industry.industry_dimension(industry.constituents(stocks), *named)


_SEGMENTS = """
select s.c_mktsegment as segment, count(*) as n_orders,
       cast(sum(cast(t.o_totalprice as decimal(18,2))) as double) as total
from {orders} t left join {customer} s on t.o_custkey = s.c_custkey
group by s.c_mktsegment
"""


@query("sql_over_tables", _SEGMENTS.format(orders="orders", customer="customer"))
def sql_over(spark: SparkSession, sf: str) -> DataFrame:
    return sql_over_tables(
        spark,
        {"t_orders": f"{sf}/orders.parquet", "t_customer": f"{sf}/customer.parquet"},
        _SEGMENTS.format(orders="t_orders", customer="t_customer"),
    )


def _requested(spark: SparkSession, sf: str) -> DataFrame:
    return given(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("symbol"))


def _landed(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Orders by status as three landed entities."""
    orders = given(spark, sf, "orders")
    return {
        status: orders.filter(F.col("o_orderstatus") == status).select(
            F.col("o_custkey").cast("string").alias("symbol"), "o_orderkey"
        )
        for status in ("F", "O", "P")
    }


@query(
    "missing_symbols",
    """
select cast(c_custkey as varchar) as symbol from customer c
where not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderstatus = 'F')
""",
)
def missing_symbols(spark: SparkSession, sf: str) -> DataFrame:
    return keys.missing_symbols(_requested(spark, sf), _landed(spark, sf)["F"])


@query(
    "rerun_set",
    """
select s.status as entity, cast(c.c_custkey as varchar) as symbol
from customer c join (select unnest(['F', 'O', 'P']) as status) s on true
where not exists (select 1 from orders o
                  where o.o_custkey = c.c_custkey and o.o_orderstatus = s.status)
""",
)
def rerun_set(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.rerun_set(_requested(spark, sf), _landed(spark, sf))


@query(
    "restrict_symbols",
    """
select o_orderkey, cast(o_custkey as varchar) as symbol, o_totalprice from orders
where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')
""",
)
def restrict_symbols(spark: SparkSession, sf: str) -> DataFrame:
    listed = (
        given(spark, sf, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select(F.col("c_custkey").cast("string").alias("symbol"))
    )
    orders = given(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("symbol"), "o_totalprice"
    )
    return keys.restrict_symbols(orders, listed)


@query(
    "slice_symbols",
    """
select printf('%06d', o_orderkey) as symbol from orders
order by symbol limit 500 offset 100
""",
)
def slice_symbols(spark: SparkSession, sf: str) -> DataFrame:
    listed = given(spark, sf, "orders").select(
        code(F.col("o_orderkey")).alias("symbol")
    )
    return keys.slice_symbols(listed, 100, 600)


@query(
    "slice_symbols_deep",
    """
select printf('%06d', l_orderkey) as symbol from lineitem
order by symbol limit 50000 offset 4321
""",
)
def slice_symbols_deep(spark: SparkSession, sf: str) -> DataFrame:
    """A slice that lies deep in the codes and is long; codes repeat, and both ends cut such repeats."""
    listed = given(spark, sf, "lineitem").select(code(F.col("l_orderkey")).alias("symbol"))
    return keys.slice_symbols(listed, 4321, 54321)


@query(
    "coverage_report",
    """
select o_orderstatus as entity, (select count(distinct c_custkey) from customer) as requested,
       count(distinct o_custkey) as landed,
       cast(count(distinct o_custkey) as double) / (select count(distinct c_custkey) from customer)
         as coverage
from orders where o_orderstatus in ('F', 'O', 'P') group by o_orderstatus
""",
)
def coverage_report(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.coverage_report(_requested(spark, sf), _landed(spark, sf))


@query(
    "rows_per_output",
    "select cast(l_linenumber as varchar) as comp_type, count(*) as n_rows from lineitem group by 1",
)
def rows_per_output(spark: SparkSession, sf: str) -> DataFrame:
    lines = given(spark, sf, "lineitem")
    return quality.rows_per_output(
        lines.select(F.col("l_linenumber").cast("string").alias("comp_type")), "comp_type"
    )


@query(
    "full_symbol",
    f"""
with {CODES_SQL}, placed as (
  select id, code, case when left(code, 1) = '6' then 'sh' when left(code, 1) in ('0', '3') then 'sz'
                        when left(code, 1) in ('8', '4') or left(code, 2) = '92' then 'bj'
                        else 'sz' end as market
  from codes
)
select id, code, market || code as prefixed, code || '.' || upper(market) as suffixed from placed
""",
)
def full_symbols(spark: SparkSession, sf: str) -> DataFrame:
    return codes(spark, sf).select(
        "id",
        "code",
        full_symbol(F.col("code")).alias("prefixed"),
        full_symbol(F.col("code"), "suffix").alias("suffixed"),
    )


@query(
    "strip_exchange",
    f"""
with {CODES_SQL}
select id, trim(replace(replace(dressed, 'sh', ''), 'sz', '')) as stripped,
       code || case when left(code, 1) = '6' then '.SH' else '.SZ' end as suffixed
from codes
""",
)
def stripped_codes(spark: SparkSession, sf: str) -> DataFrame:
    return codes(spark, sf).select(
        "id",
        strip_exchange(F.col("dressed")).alias("stripped"),
        strip_to_suffix(F.col("dressed")).alias("suffixed"),
    )


@query(
    "extract_digits",
    f"""
with {CODES_SQL}
select id, text, nullif(regexp_extract(text, '[0-9]+'), '') as digits from codes
""",
)
def extract_digits(spark: SparkSession, sf: str) -> DataFrame:
    return codes(spark, sf).select("id", "text", first_digits(F.col("text")).alias("digits"))


_SHARES = "case when c_nationkey <> 3 then cast(c_custkey * 100 as double) end"
_LISTED = """case when c_nationkey <> 5
  then date '2000-01-01' + cast(c_custkey % 9000 as integer) end"""


@query(
    "coerce_types",
    f"""
select printf('%06d', c_custkey) as symbol, {_SHARES} as number, cast(null as date) as day
from customer where c_nationkey <> 3 or c_nationkey = 3
union all
select printf('%06d', c_custkey), null, {_LISTED} from customer
""",
)
def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    """Share counts read as numbers and listing days as dates, unreadable ones as null."""
    facts = facts_raw(spark, sf).filter(F.col("item").isin("总股本", "上市时间"))
    shares = F.when(F.col("item") == "总股本", F.col("value"))
    listed = F.when(F.col("item") == "上市时间", F.col("value"))
    return facts.select(
        "symbol", parse_number(shares).alias("number"), parse_compact_date(listed).alias("day")
    )


@query(
    "eav_pivot",
    f"""
select printf('%06d', c_custkey) as symbol, printf('%06d', c_custkey) as stock_code,
       c_name as stock_name, {_SHARES} as total_shares,
       cast(c_custkey * 60 as double) as circulating_shares,
       c_acctbal as total_market_value, cast(null as double) as circulating_market_value,
       c_mktsegment as industry, {_LISTED} as listing_date, 'R' || c_nationkey as "地域"
from customer
""",
)
def eav_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return companies.company_info(facts_raw(spark, sf), ("地域",), others=None)


@query(
    "company_facts_others",
    f"""
select printf('%06d', c_custkey) as symbol, c_name as stock_name, 1::bigint as n_others,
       'R' || c_nationkey as region
from customer
""",
)
def company_facts_others(spark: SparkSession, sf: str) -> DataFrame:
    """Facts outside the map, kept under their own names."""
    info = companies.company_info(facts_raw(spark, sf))
    return info.select(
        "symbol",
        "stock_name",
        F.size("other_facts").cast("long").alias("n_others"),
        F.element_at("other_facts", F.lit("地域")).alias("region"),
    )
