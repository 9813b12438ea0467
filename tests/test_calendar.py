"""The dividend calendar against a plain restatement that looks at every day and event."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import calendar
from tallyloom.plans import dividends

D = dt.date


def restated(events, names, months=11):
    """(date, symbol, name, dividend, year, last year, to date, rolling) by looking at all events."""
    joined = []
    for symbol, day, amount in events:
        if symbol is None or day is None:
            continue
        for name in names.get(symbol, [None]):
            joined.append((symbol, name, day, amount))
    out = []
    for symbol in {row[0] for row in joined}:
        own = [row for row in joined if row[0] == symbol]
        known = sorted(name for _, name, _, _ in own if name is not None)
        name = known[0] if known else None

        def total(test, own=own):
            return float(sum(a for _, _, day, a in own if a is not None and test(day)))

        for stamp in pd.date_range(min(r[2] for r in own), max(r[2] for r in own)):
            day = stamp.date()
            back = (stamp - pd.DateOffset(months=months)).date()
            totals = (
                total(lambda d, day=day: d.year == day.year - 1),
                total(lambda d, day=day: d.year == day.year and d <= day),
                total(lambda d, day=day, back=back: back <= d <= day),
            )
            paid = [float(a or 0) for _, _, d, a in own if d == day] or [0.0]
            out += [(day, symbol, name, amount, day.year, *totals) for amount in paid]
    return sorted(out, key=str)


def calendar_rows(spark, events, names, months=11):
    table = spark.createDataFrame(events, "symbol string, date date, dividend decimal(18,2)")
    pairs = [(symbol, name) for symbol, listed in names.items() for name in listed]
    dimension = spark.createDataFrame(pairs, "symbol string, stock_name string")
    result = dividends.dividend_calendar(table, dimension, months)
    return sorted((tuple(row) for row in result.collect()), key=str)


@pytest.mark.parametrize("months", [1, 11, 12])
def test_random_events(spark, months):
    dice = random.Random(months)
    events = []
    for symbol in ("a", "b", "c", "d", "e"):
        start = D(2019, 1, 1) + dt.timedelta(days=dice.randrange(800))
        for _ in range(dice.choice([1, 2, 5, 12])):
            day = start + dt.timedelta(days=dice.randrange(900))
            amount = dice.choice([None, Decimal(dice.randrange(1, 500)) / 100])
            events += [(symbol, day, amount)] * dice.choice([1, 1, 1, 2, 3])
    names = {"a": ["A"], "b": ["B2", "B1"], "c": [None], "d": ["D"]}
    assert calendar_rows(spark, events, names, months) == restated(events, names, months)


def test_month_ends(spark):
    """Events around every month end, so that each clamp of the rolling span is crossed."""
    events = []
    for number, month in enumerate(pd.date_range("2018-12-31", "2021-04-30", freq="ME")):
        for shift in (-1, 0, 1):
            day = (month + pd.Timedelta(days=shift)).date()
            events.append((f"s{number}", day, Decimal("1.00")))
        later = (month + pd.DateOffset(months=13)).date()
        events.append((f"s{number}", later, Decimal("2.00")))
    assert calendar_rows(spark, events, {}) == restated(events, {})


@pytest.mark.parametrize("months", [1, 3, 11, 12])
def test_leaving_day_on_every_day(spark, months):
    """Against a look at each following day, for four years with a leap day in them."""
    days = pd.date_range("2019-01-01", "2022-12-31")
    backs = [(day.date(), (day - pd.DateOffset(months=months)).date()) for day in days]
    expected, at = {}, 0
    for start in days:
        while at < len(backs) and backs[at][1] <= start.date():
            at += 1
        if at < len(backs):
            expected[start.date()] = backs[at][0]
    table = spark.createDataFrame([(day,) for day in expected], "day date")
    leaving = F.expr(calendar._leaving_day("day", months)).alias("leaving")
    assert {r["day"]: r["leaving"] for r in table.select("day", leaving).collect()} == expected


def test_month_end_clamp_is_inside(spark):
    events = [("x", D(2023, 2, 28), Decimal("1.50")), ("x", D(2024, 1, 31), None)]
    by_day = {row[0]: row for row in calendar_rows(spark, events, {})}
    assert by_day[D(2024, 1, 31)][7] == 1.5
    assert by_day[D(2024, 1, 31)][5] == 1.5


def test_duplicate_day_gives_two_rows_with_equal_totals(spark):
    events = [("x", D(2024, 3, 1), Decimal("1.00")), ("x", D(2024, 3, 1), Decimal("2.00"))]
    found = calendar_rows(spark, events, {"x": ["X"]})
    assert [row[3] for row in found] == [1.0, 2.0]
    assert {row[5:] for row in found} == {(0.0, 3.0, 3.0)}


def test_single_event_and_unusable_rows(spark):
    events = [
        ("x", D(2024, 3, 1), Decimal("1.00")),
        ("x", None, Decimal("5.00")),
        (None, D(2024, 3, 1), Decimal("5.00")),
    ]
    assert calendar_rows(spark, events, {}) == [
        (D(2024, 3, 1), "x", None, 1.0, 2024, 0.0, 1.0, 1.0)
    ]


def test_hot_symbol_crosses_the_network_once_per_day(spark, plan):
    """A symbol with a third of all events, most of them on one day."""
    events = [("hot", D(2024, 1, 1 + (i % 2) * 5), Decimal("1.00")) for i in range(400)]
    events += [(f"s{i}", D(2024, 1, 2 + i % 20), Decimal("1.00")) for i in range(800)]
    found = calendar_rows(spark, events, {})
    assert len(found) == 400 + 4 + 800
    assert {row[7] for row in found if row[:2] == (D(2024, 1, 6), "hot")} == {400.0}
    table = spark.createDataFrame(events, "symbol string, date date, dividend decimal(18,2)")
    names = spark.createDataFrame([], "symbol string, stock_name string")
    text = plan(calendar.change_totals(table, names))
    assert "partial_sum(paid" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_timestamps_lose_their_time_of_day(spark):
    table = spark.sql("select 'x' as symbol, timestamp'2024-03-01 13:00:00' as date, 1.0D as dividend")
    names = spark.createDataFrame([("x", "X")], "symbol string, stock_name string")
    row = dividends.dividend_calendar(table, names).first()
    assert (row["date"], row["dividend"], row["stock_name"]) == (D(2024, 3, 1), 1.0, "X")


def test_dense_calendar(spark, rows):
    span = spark.createDataFrame(
        [("a", D(2024, 2, 27), D(2024, 3, 1)), ("b", D(2024, 1, 1), D(2024, 1, 1))],
        "symbol string, first_date date, last_date date",
    )
    days = [D(2024, 2, 27), D(2024, 2, 28), D(2024, 2, 29), D(2024, 3, 1)]
    assert rows(calendar.dense_calendar(span)) == [
        *[("a", day) for day in days],
        ("b", D(2024, 1, 1)),
    ]


def test_dense_calendar_is_spread_before_it_grows(spark):
    span = calendar.symbol_span(
        spark.createDataFrame([("a", D(2024, 1, 1))], "symbol string, date date")
    )
    dense = calendar.dense_calendar(span)
    dense.collect()
    assert "REPARTITION_BY_NUM" in dense._jdf.queryExecution().executedPlan().toString()


def test_prior_year_needs_the_year_right_before(spark, rows):
    events = spark.createDataFrame(
        [("a", D(2020, 1, 1), 1.0), ("a", D(2021, 1, 1), 2.0), ("a", D(2023, 1, 1), 4.0)],
        "symbol string, date date, dividend double",
    )
    totals = calendar.prior_year_total(calendar.yearly_total(events))
    assert rows(totals, "year", "total", "last_year_total") == [
        (2020, 1.0, 0.0),
        (2021, 2.0, 1.0),
        (2023, 4.0, 0.0),
    ]


def test_dividend_events(spark, rows):
    raw = spark.createDataFrame(
        [("1", 0.5, "实施", D(2024, 5, 1)), ("1", 0.7, "预案", D(2024, 6, 1))],
        "symbol string, `派息` double, `进度` string, `股权登记日` date",
    )
    for name in ("公告日期", "除权除息日", "红股上市日"):
        raw = raw.selectExpr("*", f"cast(null as date) as `{name}`")
    assert rows(dividends.dividend_events(raw), "symbol", "dividend", "date") == [
        ("1", 0.5, D(2024, 5, 1))
    ]


def test_repeated_symbols(spark, rows):
    names = spark.createDataFrame([("a", "A"), ("a", "B"), ("b", "C")], "symbol string, stock_name string")
    assert rows(dividends.repeated_symbols(names)) == [("a", 2)]


def test_double_dividends_with_nan(spark, rows):
    table = spark.createDataFrame(
        [("x", D(2024, 3, 1), float("nan")), ("x", D(2024, 3, 2), 1.5)],
        "symbol string, date date, dividend double",
    )
    names = spark.createDataFrame([("x", "X"), ("x", "X"), ("x", "X")], "symbol string, stock_name string")
    found = dividends.dividend_calendar(table, names)
    picked = rows(found, "date", "dividend", "rolling_12m_dividend")
    assert picked == [(D(2024, 3, 1), 0.0, 0.0)] * 3 + [(D(2024, 3, 2), 1.5, 4.5)] * 3
