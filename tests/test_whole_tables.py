"""Whole tables unless a range is asked for, text that comes back as it was, reruns, odd values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tallyloom import sources
from tallyloom.functions import parse_date
from tallyloom.operators import calendar, filters, keys, quality, series
from tallyloom.plans import companies, prices, statements


def _formatted(spark, df):
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_bars_without_a_range_are_all_bars(spark):
    data = [("1999-01-04", "sz000001", 1.0), ("2025-06-30", "sz000001", 2.0)]
    raw = spark.createDataFrame(data, "`日期` string, `股票代码` string, `收盘` double")
    assert prices.bars({"none": raw}).count() == 2
    second = spark.createDataFrame([("sh600000", "20250630")], "ts_code string, trade_date string")
    assert prices.bars_b(second).count() == 1
    assert prices.bars_b(second, start=dt.date(2025, 7, 1)).count() == 0


@pytest.mark.parametrize(
    ("build", "column", "texts"),
    [
        (lambda raw, a, b: prices.bars({"none": raw.withColumn("symbol", F.lit("x"))}, start=a, end=b), "日期",
         ["2023-12-31", "2024-01-05", "2024/01/06", " 2024-01-07", "2025-01-01"]),
        (lambda raw, a, b: prices.bars_b(raw.withColumn("ts_code", F.lit("x")), start=a, end=b), "trade_date",
         ["20231231", "20240105", "20240106", "20240107", "20250101"]),
        (lambda raw, a, b: companies.valuation(raw, a, b), "数据日期",
         ["2023-12-31", "2024-01-05", "2024.01.06", "2024-1-7", "2025-01-01"]),
    ],
)
def test_ranges_over_text_reach_the_scan(spark, tmp_path, build, column, texts):
    path = sources.write_parquet(spark.createDataFrame([(t,) for t in texts], f"`{column}` string"), str(tmp_path), "t")
    built = build(spark.read.parquet(path), dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    assert built.count() == 3
    pushed = [line for line in _formatted(spark, built).splitlines() if "PushedFilters" in line]
    assert any("GreaterThanOrEqual" in line and "LessThan" in line for line in pushed), pushed


def test_indicators_of_all_codes(spark):
    raw = spark.createDataFrame([(f"{i:06d}", i) for i in range(600)], "symbol string, pe int")
    codes = raw.select("symbol")
    assert companies.indicators(raw, codes).count() == 600
    assert companies.indicators(raw, codes, 0, 500).count() == 500
    assert companies.indicators(raw, codes, 590).count() == 10


def test_facts_outside_the_map_are_kept(spark):
    data = [("1", "行业", "bank", 0), ("1", "new", "a", 1), ("1", "new", "b", 2), ("2", None, "x", 0)]
    facts = spark.createDataFrame(data, "symbol string, item string, value string, ord int")
    found = {r["symbol"]: r for r in companies.company_info(facts, as_of=dt.date(2024, 1, 2)).collect()}
    assert found["1"]["other_facts"] == {"new": "b"} and found["1"]["industry"] == "bank"
    assert found["2"]["other_facts"] == {} and found["2"]["update_date"] == dt.date(2024, 1, 2)


def test_a_vanished_type_leaves_nothing_behind(spark, tmp_path):
    schema = "symbol string, end_date date, comp_type string, revenue double, extra double"
    day = dt.date(2020, 1, 1)
    first = spark.createDataFrame([("a", day, "1", 1.0, None), ("b", day, "4", 2.0, 3.0)], schema)
    statements.split_by_company_type(spark, first, str(tmp_path), "x")
    second = first.filter("comp_type = '1'")
    parts = statements.split_by_company_type(spark, second, str(tmp_path), "x")
    assert [p.n_rows for p in parts] == [1, 0, 0, 0]
    assert spark.read.parquet(parts[3].path).count() == 0
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith("_split")]


def test_first_rows_and_deep_slices(spark, plan):
    table = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("v"))
    firsts = keys.first_rows(table, ["k", "v"], 1500)
    assert [r["k"] for r in firsts.collect()] == list(range(1500))
    assert "Coalesce" not in plan(firsts)
    odd = spark.createDataFrame([(None, 1), (2, 2), (None, 0)], "k int, v int")
    assert [tuple(r) for r in keys.first_rows(odd, ["k", "v"], 2).collect()] == [(None, 0), (None, 1)]
    assert keys.first_rows(odd.limit(0), ["k"], 2).count() == 0
    codes = table.select(F.col("k").alias("symbol"))
    found = keys.slice_symbols(codes, 4200, 4300)
    assert sorted(r["symbol"] for r in found.collect()) == list(range(4200, 4300))
    assert "Coalesce" not in plan(found)
    assert keys.slice_symbols(codes, 6000, 7000).count() == 0


def test_text_comes_back_from_csv(spark, tmp_path):
    texts = [" lead ", "a\nb", "a\r\nb", "", None, 'say "x"', "a,b", "back\\slash", "\ttab"]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    path = sources.write_csv(table, str(tmp_path), "t")
    found = {r["id"]: r["text"] for r in sources.read_csv(spark, path, table.schema).collect()}
    assert found == dict(enumerate(texts))


def test_views_of_the_caller_stay(spark):
    spark.range(3).createOrReplaceTempView("t")
    other = spark.range(5)
    assert sources.sql_over_tables(spark, {"t": other}, "select * from t").count() == 5
    nested = "with u as (select id from t where id > 1) select * from u order by id desc"
    assert [r["id"] for r in sources.sql_over_tables(spark, {"t": other}, nested).collect()] == [4, 3, 2]
    assert spark.table("t").count() == 3
    spark.catalog.dropTempView("t")


def test_date_forms(spark):
    good = ["2020-01-02", "2020/01/02", "2020.01.02", "20200102", "20200102 10:00", "2020-1-2", " 2020-01-02 ",
            "2020-01-02T10:00:00", "2020-01-02 10:00:00.5", "2020-01-02T10:00:00Z"]
    bad = ["2020-01-02 abc", "2020-01-02Tzzz", "2020-01/02", "2020-13-01", "2020010", "", "x", "2020-02-30"]
    table = spark.createDataFrame([(t,) for t in good + bad], "t string")
    found = {r["t"]: r["d"] for r in table.select("t", parse_date(F.col("t")).alias("d")).collect()}
    assert {found[t] for t in good} == {dt.date(2020, 1, 2)}
    assert {found[t] for t in bad} == {None}


def test_odd_events_and_closes(spark):
    day = dt.date(2020, 1, 1)
    rows = [("a", day, 1.0), ("a", day, float("nan")), (None, day, 1.0), ("a", None, 1.0)]
    events = spark.createDataFrame(rows, "symbol string, date date, dividend double")
    assert [tuple(r) for r in calendar.yearly_total(events).collect()] == [("a", 2020, 1.0)]
    assert [r["symbol"] for r in calendar.symbol_span(events).collect()] == ["a"]
    closes = [("x", "none", i, c) for i, c in enumerate([1.0, float("nan"), 2.0, 4.0])]
    bars = spark.createDataFrame(closes, "symbol string, adjust_type string, dt int, close double")
    averaged = series.moving_average(series.daily_return(bars), 2).orderBy("dt").collect()
    assert [r["ma2"] for r in averaged] == [None, None, None, 3.0]
    assert [r["daily_return"] for r in averaged] == [None, None, None, 1.0]


def test_coverage_names_every_entity(spark):
    none = spark.createDataFrame([], "symbol string")
    found = quality.coverage(none, {"a": none, "b": none}).orderBy("entity").collect()
    assert [tuple(r) for r in found] == [("a", 0, 0, 0.0), ("b", 0, 0, 0.0)]


def test_open_ranges(spark):
    table = spark.createDataFrame([("2024-01-01",), (None,), ("bad",)], "d string")
    assert filters.landed_range(table, "d").count() == 3
    assert filters.landed_range(table, "d", end=dt.date(2024, 1, 1)).count() == 1
