"""Physical plans of the registered queries: what must and must not be in them."""

from __future__ import annotations

import re

import pytest
from tallyloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python(spark, plan, name):
    text = plan(QUERIES[name](spark, SF))
    assert [word for word in FORBIDDEN if word in text] == []
    for line in text.splitlines():
        if "Window [" in line:
            assert not re.search(r"\], \[\](, \[|$)", line), f"window over the whole table: {line}"


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("filter_status", "EqualTo(o_orderstatus,F)"),
        ("dividend_calendar", "EqualTo(o_orderstatus,F)"),
        ("filter_date_range", "GreaterThanOrEqual(o_orderdate,"),
        ("valuation", "GreaterThanOrEqual(o_orderdate,"),
        ("filter_recent", "GreaterThanOrEqual(ts,"),
        ("restrict_symbols", "EqualTo(c_mktsegment,BUILDING)"),
    ],
)
def test_filters_reach_the_scan(spark, name, expected):
    frame = QUERIES[name](spark, SF)._jdf.queryExecution()
    assert expected in frame.explainString(_mode(spark))


def _mode(spark):
    return spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")


def test_only_needed_columns_are_read(spark, plan):
    text = plan(QUERIES["project_columns"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text


def test_no_query_works_without_its_tables():
    for name, sql in ORACLES.items():
        tables = ("customer", "orders", "lineitem", "events", "part", "supplier", "nation", "region")
        assert any(table in sql for table in tables), name


def test_calendar_windows_run_once(spark, plan):
    text = plan(QUERIES["dividend_calendar"](spark, SF))
    assert text.count("Window [") <= 5


def test_recursion_hashes_the_years(spark, plan):
    """The orders pass by the hashed years: neither sorted for the join nor built into a table."""
    text = plan(QUERIES["sql_with_recursion"](spark, SF))
    assert "BuildLeft" in text and "SortMergeJoin" not in text and "BuildRight" not in text
