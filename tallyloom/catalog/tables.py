"""Schema operators, unions, statements, sources and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.prices import AS_OF
from tallyloom.catalog.given import given
from tallyloom.catalog.registry import query
from tallyloom.catalog.stand_ins import BARS_SQL, STATEMENTS_SQL, bars_raw, code, statements_raw
from tallyloom.functions import date_text
from tallyloom.operators import schema, unions
from tallyloom.plans import prices, statements
from tallyloom.sources import (
    read_csv,
    read_dataset,
    scratch_path,
    write_csv,
    write_csv_sample,
    write_parquet,
)


@query("scan_parquet", "select * from part")
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return read_dataset(spark, sf, "part")


@query(
    "batch_ingest",
    """
select cast(ts as date) as dt, cast(user_id as varchar) as symbol, value as close,
       cast(null as double) as total, 'events' as entity from events
union all
select cast(o_orderdate as date), cast(o_custkey as varchar), null, o_totalprice, 'orders' from orders
""",
)
def batch_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two landed layouts, each read in one scan with a given schema, stacked by name."""
    events = given(spark, sf, "events").select(
        F.col("ts").cast("date").alias("dt"),
        F.col("user_id").cast("string").alias("symbol"),
        F.col("value").alias("close"),
    )
    orders = given(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("dt"),
        F.col("o_custkey").cast("string").alias("symbol"),
        F.col("o_totalprice").alias("total"),
    )
    return unions.union_by_name(
        [schema.tag(events, entity="events"), schema.tag(orders, entity="orders")]
    )


@query(
    "rename_map",
    """
select p_partkey as code, p_name as "权重(%)", p_brand, p_type, p_size as "PE(TTM)", p_retailprice
from part
""",
)
def rename_map(spark: SparkSession, sf: str) -> DataFrame:
    mapping = {"p_partkey": "code", "p_name": "权重(%)", "p_size": "PE(TTM)", "absent": "x"}
    return schema.rename(given(spark, sf, "part"), mapping)


def _vendor_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Line items under the upper-case names of the first layout, with growth columns."""
    return given(spark, sf, "lineitem").select(
        code(F.col("l_orderkey")).alias("SECURITY_CODE"),
        F.concat(code(F.col("l_orderkey")), F.lit(".SZ")).alias("SECUCODE"),
        F.col("l_returnflag").alias("SECURITY_NAME_ABBR"),
        F.col("l_shipdate").cast("string").alias("REPORT_DATE"),
        F.when(F.col("l_linenumber") == 1, "-").otherwise(
            date_text(F.col("l_shipdate"), compact=True)
        ).alias("NOTICE_DATE"),
        F.col("l_extendedprice").alias("TOTAL_ASSETS"),
        F.col("l_discount").alias("TOTAL_ASSETS_YOY"),
        F.col("l_tax").alias("Goodwill_yoy"),
    )


_CODE = "printf('%06d', l_orderkey)"
_NOTICE = "case when l_linenumber <> 1 then cast(l_shipdate as date) end"


@query(
    "lowercase_columns",
    f"""
select {_CODE} as security_code, {_CODE} || '.SZ' as secucode, l_returnflag as security_name_abbr,
       cast(l_shipdate as date) as report_date,
       case when l_linenumber = 1 then '-' else strftime(l_shipdate, '%Y%m%d') end as notice_date,
       l_extendedprice as total_assets, l_discount as total_assets_yoy, l_tax as goodwill_yoy,
       {_CODE} as symbol
from lineitem
""",
)
def lowercase_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The Hong Kong statement build: lower-case names, report date parsed, symbol."""
    return statements.statements_hk(_vendor_statements(spark, sf))


@query(
    "drop_matching_columns",
    f"""
select {_CODE} as "SECURITY_CODE", l_extendedprice as "TOTAL_ASSETS" from lineitem
""",
)
def drop_matching_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = _vendor_statements(spark, sf).select(
        "SECURITY_CODE", "TOTAL_ASSETS", "TOTAL_ASSETS_YOY", "Goodwill_yoy"
    )
    return schema.drop_matching(raw, "YOY")


@query(
    "statements_a",
    f"""
select {_CODE} as symbol, {_CODE} || '.SZ' as symbol_full, l_returnflag as symbol_name_abbr,
       cast(l_shipdate as date) as report_date, {_NOTICE} as notice_date,
       l_extendedprice as total_assets
from lineitem
""",
)
def statements_a(spark: SparkSession, sf: str) -> DataFrame:
    return statements.statements_a(_vendor_statements(spark, sf))


@query(
    "drop_if_present",
    "select s_suppkey, s_name, s_nationkey from supplier",
)
def drop_if_present(spark: SparkSession, sf: str) -> DataFrame:
    return schema.drop_if_present(given(spark, sf, "supplier"), "s_acctbal", "not_there")


@query("project_columns", "select l_orderkey, l_extendedprice from lineitem")
def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return schema.keep_columns(
        given(spark, sf, "lineitem"), ["l_orderkey", "l_extendedprice"]
    )


@query("column_to_front", "select p_type, p_partkey, p_name, p_brand, p_size, p_retailprice from part")
def column_to_front(spark: SparkSession, sf: str) -> DataFrame:
    return schema.to_front(given(spark, sf, "part"), "p_type")


@query(
    "tag_columns",
    """
select o_orderkey, cast(o_orderdate as date) as record_date, cast(o_orderdate as date) as date,
       '000300' as index_code, date '2024-01-31' as update_date, 'L3_0' as level_3_code
from orders
""",
)
def tag_columns(spark: SparkSession, sf: str) -> DataFrame:
    orders = given(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("record_date")
    )
    copied = orders.withColumn("date", F.col("record_date"))
    tagged = schema.tag(copied, index_code="000300", update_date=AS_OF)
    present = schema.add_if_missing(tagged, "index_code", F.lit("unused"))
    return schema.add_if_missing(present, "level_3_code", F.lit("L3_0"))


@query(
    "prune_null_columns",
    """
select p_partkey, case when p_size > 25 then p_size end as partly, p_retailprice from part
""",
)
def prune_null_columns(spark: SparkSession, sf: str) -> DataFrame:
    never = F.when(F.col("p_partkey") < 0, F.col("p_name"))
    return schema.prune_null_columns(
        given(spark, sf, "part").select(
            "p_partkey",
            never.alias("never"),
            F.when(F.col("p_size") > 25, F.col("p_size")).alias("partly"),
            F.lit("NaN").cast("double").alias("not_a_number"),
            "p_retailprice",
        )
    )


@query(
    "statement_clean",
    f"""
with {STATEMENTS_SQL}
select symbol, end_date, revenue, coalesce(int_income, 0) as int_income,
       coalesce(prem_earned, 0) as prem_earned, coalesce(n_sec_tb_income, 0) as n_sec_tb_income,
       cast(0 as double) as prem_refund
from named
""",
)
def statement_clean(spark: SparkSession, sf: str) -> DataFrame:
    built = statements.income_statements(statements_raw(spark, sf)).select(
        "symbol", "end_date", "revenue", "int_income", "prem_earned", "n_sec_tb_income", "prem_refund"
    )
    return statements.clean_statement(built, ("symbol", "end_date"))


@query(
    "nulls_to_text",
    f"""
with {STATEMENTS_SQL}
select coalesce(symbol, '') as symbol, coalesce(cast(end_date as varchar), '') as end_date,
       coalesce(report_type, '') as report_type, coalesce(cast(revenue as varchar), '') as revenue,
       coalesce(cast(int_income as varchar), '') as int_income
from named
""",
)
def nulls_to_text(spark: SparkSession, sf: str) -> DataFrame:
    built = statements.income_statements(statements_raw(spark, sf))
    return schema.blank_nulls(
        built.select("symbol", "end_date", "report_type", "revenue", "int_income")
    )


@query(
    "metrics_to_double",
    """
select p_partkey, p_name, cast(p_size as double) as p_size, p_retailprice,
       cast(p_size > 25 as double) as is_large
from part
""",
)
def metrics_to_double(spark: SparkSession, sf: str) -> DataFrame:
    parts = given(spark, sf, "part").select(
        "p_partkey", "p_name", "p_size", "p_retailprice", (F.col("p_size") > 25).alias("is_large")
    )
    return schema.metrics_to_double(parts, ("p_partkey",))


@query(
    "safe_union",
    f"""
with {BARS_SQL}
select symbol, dt, close, amount, null::double as turnover from bars where adjust_type = 'none'
union all
select symbol, dt, close, null, volume from bars where adjust_type = 'hfq'
""",
)
def safe_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two layouts with a column missing or empty in one of them, next to inputs to be skipped."""
    bars = {name: prices.bars({name: table}) for name, table in bars_raw(spark, sf).items()}
    nothing = F.lit(None).cast("double")
    first = bars["none"].select("symbol", "dt", "close", "amount", nothing.alias("unused"))
    second = bars["hfq"].select(
        "symbol", "dt", "close", nothing.alias("amount"), F.col("volume").alias("turnover")
    )
    empty = first.filter(F.col("close") < -1e9)
    blank = first.select(*[F.lit(None).cast("double").alias(name) for name in ("close", "amount")])
    return unions.safe_union(spark, [first, None, empty, blank, second])


@query("report_union", f"with {STATEMENTS_SQL} select * from named")
def report_union(spark: SparkSession, sf: str) -> DataFrame:
    """The income statement build over all four report types."""
    return statements.income_statements(statements_raw(spark, sf))


@query(
    "balance_sheets",
    f"with {STATEMENTS_SQL} select * from named where report_type in ('合并报表', '母公司报表')",
)
def balance_sheets(spark: SparkSession, sf: str) -> DataFrame:
    return statements.balance_sheets(statements_raw(spark, sf))


@query("cash_flow_statements", f"with {STATEMENTS_SQL} select * from named")
def cash_flow_statements(spark: SparkSession, sf: str) -> DataFrame:
    """The cash flow build over all four report types, all columns."""
    return statements.cash_flow_statements(statements_raw(spark, sf))


SPLIT_SINCE = dt.date(1998, 1, 1)
_SPLIT = f"""
with {STATEMENTS_SQL}, kept as (
  select * from named where comp_type in ('1', '2', '3', '4'){{since}}
)
select symbol, end_date, report_type, comp_type, revenue, int_income, prem_earned, n_sec_tb_income,
       case comp_type when '1' then '' when '2' then 'int_income' when '3' then 'prem_earned'
                      else 'n_sec_tb_income' end as own_columns
from kept
"""


def _split(spark: SparkSession, sf: str, since: dt.date | None) -> DataFrame:
    special = ("int_income", "prem_earned", "n_sec_tb_income", "prem_refund")
    built = statements.income_statements(statements_raw(spark, sf))
    root = scratch_path(spark, "split_by_type")
    parts = statements.split_by_company_type(spark, built, root, "income", since)
    tables = [
        spark.read.parquet(part.path).withColumn(
            "own_columns", F.lit(",".join(name for name in special if name in part.kept))
        )
        for part in parts
    ]
    return schema.keep_columns(
        unions.union_by_name(tables),
        [
            "symbol", "end_date", "report_type", "comp_type", "revenue", "int_income",
            "prem_earned", "n_sec_tb_income", "own_columns",
        ],
    )


@query("split_by_type", _SPLIT.format(since=""))
def split_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """All statements split into one written dataset per company type, read back and stacked.

    ``own_columns`` lists which of the special measures a part kept.
    """
    return _split(spark, sf, None)


@query("split_by_type_since", _SPLIT.format(since=f" and end_date >= date '{SPLIT_SINCE}'"))
def split_by_type_since(spark: SparkSession, sf: str) -> DataFrame:
    """The split of the statements from a day on."""
    return _split(spark, sf, SPLIT_SINCE)


@query("sink_parquet_roundtrip", "select * from part")
def sink_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "parquet_sink")
    write_parquet(given(spark, sf, "part"), root, "part")
    return read_dataset(spark, root, "part")


@query("sink_csv_roundtrip", "select * from part")
def sink_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    part = given(spark, sf, "part")
    path = write_csv(part, scratch_path(spark, "csv_sink"), "part")
    return read_csv(spark, path, part.schema)


@query(
    "csv_sample",
    """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders order by o_orderkey limit 5000
""",
)
def csv_sample(spark: SparkSession, sf: str) -> DataFrame:
    orders = given(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    path = write_csv_sample(orders, scratch_path(spark, "csv_sample"), "orders", ["o_orderkey"])
    return read_csv(spark, path, orders.schema)
