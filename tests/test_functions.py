from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom import functions as X


def applied(spark, values, function, kind="string"):
    table = spark.createDataFrame([(value,) for value in values], f"v {kind}").coalesce(1)
    return [row[0] for row in table.select(function(F.col("v"))).collect()]


CODES = ["600000", "000001", "300750", "830799", "430047", "920002", "900901", None]


def test_full_symbol(spark):
    markets = ["sh", "sz", "sz", "bj", "bj", "bj", "sz"]
    prefixed = [m + c for m, c in zip(markets, CODES)] + [None]
    suffixed = [f"{c}.{m.upper()}" for m, c in zip(markets, CODES)] + [None]
    assert applied(spark, CODES, X.full_symbol) == prefixed
    assert applied(spark, CODES, lambda c: X.full_symbol(c, "HZ")) == suffixed
    assert applied(spark, CODES, lambda c: X.full_symbol(c, "Suffix")) == suffixed


def test_strip_exchange(spark):
    given = [" sh600000\t", "000001sz", "bj430047", "sshz1", None]
    assert applied(spark, given, X.strip_exchange) == ["600000", "000001", "bj430047", "1", None]


def test_strip_to_suffix(spark):
    given = ["sh600000", "sz000001", "430047"]
    assert applied(spark, given, X.strip_to_suffix) == ["600000.SH", "000001.SZ", "430047.SZ"]


def test_first_digits(spark):
    given = ["600000.SH", "abc", None, "a12b34"]
    assert applied(spark, given, X.first_digits) == ["600000", None, None, "12"]


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2024-03-05", dt.date(2024, 3, 5)),
        ("2024-03-05 00:00:00", dt.date(2024, 3, 5)),
        ("20240305", dt.date(2024, 3, 5)),
        ("2024-3-5", dt.date(2024, 3, 5)),
        ("20240230", None),
        ("2020x", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, day):
    assert applied(spark, [text], X.parse_date) == [day]


def test_parse_compact_date(spark):
    given = ["19991110", "1999-11-10", "2020x", None]
    assert applied(spark, given, X.parse_compact_date) == [dt.date(1999, 11, 10), None, None, None]


def test_month_text(spark):
    given = ["2024.1", "2024.10", "2024.13", "x", None]
    expected = [dt.date(2024, 1, 1), dt.date(2024, 10, 1), None, None, None]
    assert applied(spark, given, X.month_text_to_date) == expected


def test_date_text(spark):
    day = [dt.date(2024, 3, 5)]
    assert applied(spark, day, X.date_text, "date") == ["2024-03-05"]
    assert applied(spark, day, lambda d: X.date_text(d, compact=True), "date") == ["20240305"]


def test_parse_number(spark):
    given = ["12", "1.5e3", " 7 ", "abc", "1d", "2.5f", "NaN", "", None]
    assert applied(spark, given, X.parse_number) == [12, 1500, 7, None, None, None, None, None, None]


def test_quarter_labels(spark):
    given = ["2024年第1季度", "2024年第1-1季度", "2024年第1-2季度", "2024年第1-3季度", "2024年第1-4季度", "2024年", None]
    assert applied(spark, given, X.label_quarter) == [1, 1, 2, 3, 4, None, None]
    assert applied(spark, given[:1], X.label_year) == ["2024"]
    ends = applied(spark, given, lambda c: X.quarter_end(X.label_year(c), X.label_quarter(c)))
    expected = [(3, 31), (3, 31), (6, 30), (9, 30), (12, 31)]
    assert ends == [dt.date(2024, *day) for day in expected] + [None, None]
