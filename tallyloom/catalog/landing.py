"""Landed datasets: pruned reads, re-runs merged in, drifting types, replacement."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.given import given
from tallyloom.catalog.registry import query
from tallyloom.functions import date_text
from tallyloom.sources import (
    dataset_path,
    land_partitioned,
    merge_partitioned,
    read_dataset,
    read_drifting,
    read_partitioned,
    scratch_path,
    sql_over_tables,
    write_parquet,
)


def _totals(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a landed daily entity; the status stays for what follows."""
    return given(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("symbol"),
        F.col("o_orderdate").cast("date").alias("dt"),
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderstatus").alias("status"),
    )


@query(
    "pruned_scan",
    """
select cast(o_custkey as varchar) as symbol, cast(o_orderdate as date) as dt, o_orderkey as id,
       o_totalprice as total, o_orderstatus as status
from orders
where cast(o_orderdate as date) between date '1996-03-01' and date '1997-06-30'
  and o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING' and c_nationkey < 5)
""",
)
def pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Some codes and days of a dataset landed by year and hashed code; only their folders are read."""
    root = scratch_path(spark, "pruned_scan")
    land_partitioned(_totals(spark, sf), root, "totals")
    codes = given(spark, sf, "customer").filter("c_mktsegment = 'BUILDING' and c_nationkey < 5")
    codes = codes.select(F.col("c_custkey").cast("string").alias("symbol"))
    return read_partitioned(spark, root, "totals", codes, dt.date(1996, 3, 1), dt.date(1997, 6, 30))


@query(
    "rerun_merge",
    """
select cast(o_custkey as varchar) as symbol, cast(o_orderdate as date) as dt, o_orderkey as id,
       case when o_orderstatus = 'P' and year(o_orderdate) >= 1995 then o_totalprice * 2
            else o_totalprice end as total,
       o_orderstatus as status
from orders where o_orderstatus in ('F', 'P') or year(o_orderdate) >= 1995
""",
)
def rerun_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A first landing without the open orders, then a re-run of the last years that corrects some rows, twice, and adds others."""
    root = scratch_path(spark, "rerun_merge")
    totals = _totals(spark, sf)
    land_partitioned(totals.filter("status in ('F', 'P')"), root, "totals")
    again = totals.filter("year(dt) >= 1995 and status in ('O', 'P')")
    tries = [again.withColumn("total", F.when(F.col("status") == "P", F.col("total") * n).otherwise(F.col("total"))) for n in (1, 2)]
    merge_partitioned(spark, root, "totals", tries[0].union(tries[1]), ("symbol", "dt", "id"))
    return read_partitioned(spark, root, "totals")


@query(
    "drifting_ingest",
    """
select l_orderkey as id, cast(l_linenumber as integer) as line,
       case when l_linenumber % 3 = 2 then null
            when l_linenumber % 3 = 1 and l_suppkey % 5 = 0 then null else l_quantity end as quantity,
       cast(l_shipdate as date) as day,
       cast(case when l_linenumber % 3 = 1 and l_suppkey % 5 = 0 then 1 else 0 end as bigint) as unreadable
from lineitem
""",
)
def drifting_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Three landings of one entity: typed; all as text, with some unreadable numbers; and without one column."""
    root = scratch_path(spark, "drifting")
    items = given(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").cast("date").alias("day"), "l_suppkey",
    )
    typed = items.filter("line % 3 = 0").drop("l_suppkey")
    text = items.filter("line % 3 = 1").select(
        F.col("id").cast("string"), F.col("line").cast("string"),
        F.when(F.col("l_suppkey") % 5 == 0, "n/a").otherwise(F.col("quantity").cast("string")).alias("quantity"),
        date_text(F.col("day"), compact=True).alias("day"),
    )
    without = items.filter("line % 3 = 2").select(F.col("line").cast("double"), "id", F.col("day").cast("timestamp"))
    for name, table in (("typed", typed), ("text", text), ("without", without)):
        write_parquet(table, root, name)
    return read_drifting(spark, root, "id long, line int, quantity double, day date", "unreadable")


@query(
    "replace_dataset",
    "select o_orderkey as id, o_totalprice + 1 as total from orders where o_orderstatus <> 'F'",
)
def replace_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """A dataset replaced by rows made of itself."""
    root = scratch_path(spark, "replace")
    totals = _totals(spark, sf)
    write_parquet(totals.select("id", "total", "status"), root, "totals")
    old = read_dataset(spark, root, "totals").filter("status <> 'F'")
    write_parquet(old.select("id", (F.col("total") + 1).alias("total")), root, "totals")
    return read_dataset(spark, root, "totals")


@query(
    "sql_with_recursion",
    """
with recursive years(y) as (
  select min(year(o_orderdate)) from orders
  union all
  select y + 1 from years where y < (select max(year(o_orderdate)) from orders)
)
select cast(y as integer) as y, count(o_orderkey) as n from years left join orders on year(o_orderdate) = y group by y
""",
)
def sql_with_recursion(spark: SparkSession, sf: str) -> DataFrame:
    """SQL with a comment in front, a recursion, hints and a table of its own under an alias's name.

    The years are hashed and the orders pass by them: sorted for the join, all orders would lie in the memory of two tasks.
    """
    return sql_over_tables(
        spark,
        {"landed": dataset_path(sf.rstrip("/"), "orders"), "orders": given(spark, sf, "customer")},
        """
        -- orders by year, years without orders as well
        with recursive orders as (select year(o_orderdate) as year, o_orderkey from landed),
        years(y) as (
          select min(year) from orders
          union all
          select y + 1 from years where y < (select max(year) from orders)
        )
        select /*+ COALESCE(2), SHUFFLE_HASH(years) */ y, count(o_orderkey) as n from years left join orders on year = y group by y
        """,
    )
