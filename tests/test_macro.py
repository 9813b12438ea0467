from __future__ import annotations

import datetime as dt

import pytest

from tallyloom.operators import quarters
from tallyloom.plans import macro

GDP = [
    ("2024年第1-4季度", 1349083.5),
    ("2024年第1-3季度", 975357.4),
    ("2024年第1-2季度", 633599.4),
    ("2024年第1季度", 304761.8),
    ("2023年第1-4季度", 1294271.7),
    ("2023年第1-3季度", 937047.0),
    ("2023年第1-2季度", 608606.3),
    ("2023年第1季度", 292368.8),
]
SCHEMA = "`季度` string, `国内生产总值-绝对值` double"


def test_gdp_monthly(spark):
    table = macro.gdp_monthly(spark.createDataFrame(GDP, SCHEMA), start_year="2023")
    assert table.columns == ["date", "year", "month", "monthly_gdp", "monthly_gdp_yoy"]
    found = table.collect()
    assert len(found) == 24
    assert [row["date"] for row in found] == sorted((r["date"] for r in found), reverse=True)
    latest = {row["month"]: row for row in found if row["year"] == "2024"}
    assert sorted(latest) == list(range(1, 13))
    cumulative = [0, 304761.8, 633599.4, 975357.4, 1349083.5]
    for month, row in latest.items():
        quarter = (month + 2) // 3
        expected = (cumulative[quarter] - cumulative[quarter - 1]) / 3
        assert row["monthly_gdp"] == pytest.approx(expected, abs=0.1)
        assert row["date"] == dt.date(2024, month, 1)
    assert {latest[month]["monthly_gdp_yoy"] for month in (1, 2, 3)} == {4.2}
    assert {row["monthly_gdp_yoy"] for row in found if row["year"] == "2023"} == {None}


def test_start_year_is_applied_after_growth(spark):
    found = macro.gdp_monthly(spark.createDataFrame(GDP, SCHEMA), start_year=2024).collect()
    assert len(found) == 12 and all(row["monthly_gdp_yoy"] is not None for row in found)


def test_missing_quarter_unknown_label_and_zero_base(spark):
    data = [
        ("2022年第1季度", 0.0),
        ("2023年第1季度", 10.0),
        ("2023年第1-3季度", 60.0),
        ("2023年第1-4季度", 90.0),
        ("2023年全年", 90.0),
        ("年份第1季度", 90.0),
        (None, 90.0),
    ]
    found = macro.quarterly_gdp(spark.createDataFrame(data, SCHEMA)).collect()
    single = {(row["year"], row["quarter"]): row["quarter_gdp"] for row in found}
    assert single == {(2022, 1): 0.0, (2023, 1): 10.0, (2023, 3): None, (2023, 4): 30.0}
    assert all(row["monthly_gdp_yoy"] is None for row in found)


def test_series_keys_are_kept_apart(spark, rows):
    data = [("a", 2023, 1, 1.0), ("a", 2023, 2, 3.0), ("b", 2023, 2, 10.0)]
    table = spark.createDataFrame(data, "symbol string, year int, quarter int, v double")
    single = quarters.decumulate(table, "v", "single", keys=["symbol"])
    assert rows(single, "symbol", "quarter", "single") == [("a", 1, 1.0), ("a", 2, 2.0), ("b", 2, None)]


def test_money_supply(spark):
    data = [("1999.12", 1.0), ("2024.1", 2.0), ("2024.10", 3.0), ("2000.1", 4.0)]
    raw = spark.createDataFrame(data, "`统计时间` string, `货币(狭义货币M1)` double")
    found = [(row["date"], row["m1"]) for row in macro.money_supply(raw, start_year=2000).collect()]
    assert found == [
        (dt.date(2024, 10, 1), 3.0),
        (dt.date(2024, 1, 1), 2.0),
        (dt.date(2000, 1, 1), 4.0),
    ]
