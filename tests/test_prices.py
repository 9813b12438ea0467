from __future__ import annotations

import datetime as dt
import random
import statistics

import numpy as np
import pandas as pd
import pytest

from tallyloom.operators import quality, series
from tallyloom.plans import prices

DAY = dt.date(2024, 1, 1)
SCHEMA = "symbol string, adjust_type string, dt date, open double, high double, low double, close double"


def bars(spark, closes, symbol="x", adjust="none"):
    data = [
        (symbol, adjust, DAY + dt.timedelta(days=i), c, c, c, c) for i, c in enumerate(closes)
    ]
    random.Random(3).shuffle(data)
    return spark.createDataFrame(data, SCHEMA)


def by_day(df, name):
    return [row[name] for row in sorted(df.collect(), key=lambda row: row["dt"])]


def test_forward_fill_keeps_the_gap_at_the_start(spark):
    table = bars(spark, [None, 1.0, None, float("nan"), 2.0, None])
    assert by_day(series.forward_fill(table), "close") == [None, 1.0, 1.0, 1.0, 2.0, 2.0]


def test_series_do_not_mix(spark):
    table = bars(spark, [1.0, None]).unionByName(bars(spark, [None, 5.0], adjust="hfq"))
    filled = {(r["adjust_type"], r["dt"].day): r["close"] for r in series.forward_fill(table).collect()}
    assert filled == {("none", 1): 1.0, ("none", 2): 1.0, ("hfq", 1): None, ("hfq", 2): 5.0}


def test_clip(spark):
    closes = [10.0] * 30 + [1000.0, None]
    clipped = by_day(series.clip_to_sigma(bars(spark, closes), ["close"]), "close")
    mean, spread = statistics.mean(closes[:-1]), statistics.stdev(closes[:-1])
    assert clipped[-1] is None
    assert clipped[-2] == pytest.approx(mean + 3 * spread)
    assert clipped[:30] == [10.0] * 30


def test_clip_leaves_a_single_value(spark):
    assert by_day(series.clip_to_sigma(bars(spark, [7.0])), "close") == [7.0]


def test_daily_return(spark):
    found = by_day(series.daily_return(bars(spark, [2.0, 3.0, 0.0, 5.0])), "daily_return")
    assert found == [None, 0.5, -1.0, None]


def test_moving_average_needs_a_full_frame(spark):
    found = by_day(series.moving_average(bars(spark, [None, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0]), 5), "ma5")
    assert found == [None] * 5 + [3.0, 4.0]


def test_clean_prices_uses_one_shuffle_and_one_sort(spark, plan):
    cleaned = prices.clean_prices(bars(spark, [float(i % 7) for i in range(40)]))
    text = plan(cleaned)
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1
    assert "Python" not in text
    averages = by_day(cleaned, "ma20")
    assert averages[:19] == [None] * 19 and averages[19] is not None


def landed(spark, factor):
    data = [
        (f"2024-01-{day:02d}", "sz000001", 10.0 * factor, 11.0 * factor, 12.0 * factor, 9.0 * factor)
        for day in (1, 20, 31)
    ]
    return spark.createDataFrame(
        data, "`日期` string, `股票代码` string, `开盘` double, `收盘` double, `最高` double, `最低` double"
    )


def test_bars_build(spark, rows):
    tables = {"hfq": landed(spark, 2.0), "none": landed(spark, 1.0)}
    built = prices.bars(tables, as_of=dt.date(2024, 2, 1), start=dt.date(2024, 1, 2), end=dt.date(2024, 1, 20))
    assert rows(built, "symbol", "dt", "close", "adjust_type") == [
        ("000001", dt.date(2024, 1, 20), 11.0, "none"),
        ("000001", dt.date(2024, 1, 20), 22.0, "hfq"),
    ]


def test_bars_default_range_is_thirty_days(spark):
    built = prices.bars({"none": landed(spark, 1.0)}, as_of=dt.date(2024, 1, 31))
    assert sorted(row["dt"].day for row in built.collect()) == [1, 20, 31]
    later = prices.bars({"none": landed(spark, 1.0)}, as_of=dt.date(2024, 2, 1))
    assert sorted(row["dt"].day for row in later.collect()) == [20, 31]


def test_fund_bars_bring_their_symbol(spark, rows):
    """Funds land without a code column; the code comes from the landing path."""
    raw = landed(spark, 1.0).drop("股票代码").selectExpr("*", "'sh510300' as symbol")
    built = prices.bars({"none": raw, "hfq": raw}, dt.date(2024, 1, 31))
    assert {row["symbol"] for row in built.collect()} == {"510300"} and built.count() == 6


def test_bars_b(spark):
    raw = spark.createDataFrame([("sh600000", "20240105", 1.5)], "ts_code string, trade_date string, vol double")
    row = prices.bars_b(raw, dt.date(2024, 1, 10)).first()
    assert row.asDict() == {
        "symbol": "600000.SH", "dt": dt.date(2024, 1, 5), "volume": 1.5, "adjust_type": "none",
    }


# The reference day of symbol 000001, unadjusted and adjusted.
FIXED_BARS = [
    ("000001", "2023-01-09", 14.75, 14.8, 14.88, 14.52, 1057659.0, 1.5613684873e9, 2.46, 1.23, 0.18, 0.55),
]
FIXED_SCHEMA = (
    "`股票代码` string, `日期` string, `开盘` double, `收盘` double, `最高` double, `最低` double,"
    " `成交量` double, `成交额` double, `振幅` double, `涨跌幅` double, `涨跌额` double, `换手率` double"
)


def test_fixed_bars_have_every_column_and_keep_the_rules(spark):
    raw = spark.createDataFrame(FIXED_BARS, FIXED_SCHEMA)
    built = prices.bars({"hfq": raw, "none": raw}, dt.date(2023, 1, 10))
    assert set(built.columns) == set(quality.BAR_COLUMNS)
    assert quality.missing_columns(built) == []
    assert quality.missing_columns(built.drop("amount", "low")) == ["low", "amount"]
    assert quality.ohlc_violations(built).count() == 0
    assert quality.adjust_completeness(built).first()["is_complete"]
    row = built.filter("adjust_type = 'none'").first()
    assert (row["open"], row["close"], row["high"], row["low"]) == (14.75, 14.8, 14.88, 14.52)


def test_ohlc_violations(spark, rows):
    data = [
        ("a", 10.0, 11.0, 12.0, 9.0, 1.0, 1.0),
        ("b", 10.0, 13.0, 12.0, 9.0, 0.0, 1.0),
        ("c", 8.0, 11.0, 12.0, 9.0, 1.0, None),
    ]
    table = spark.createDataFrame(
        data, "symbol string, open double, close double, high double, low double, volume double, amount double"
    )
    assert rows(quality.ohlc_violations(table, ["symbol"])) == [
        ("b", "high>=close"), ("b", "volume>0"), ("c", "amount>0"), ("c", "open>=low"),
    ]


def test_validate_prices(spark, rows):
    table = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", None), ("n", float("nan"))], "symbol string, close double"
    )
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("n",)], "symbol string")
    assert rows(quality.validate_prices(table, asked)) == [
        ("a", 2, True), ("b", 1, False), ("c", 0, False), ("n", 1, False),
    ]


def test_spot_info(spark):
    spot = spark.createDataFrame([("510300", "A"), ("510500", "B")], "`代码` string, `名称` string")
    row = prices.spot_info(spot, "510500", dt.date(2024, 1, 1)).collect()
    assert [r.asDict() for r in row] == [
        {"symbol": "510500", "name": "B", "update_date": dt.date(2024, 1, 1)}
    ]


def test_clean_prices_like_pandas(spark):
    """Several random series against the same steps on each one alone."""
    dice, data = random.Random(11), []
    for symbol in ("a", "b", "c"):
        for adjust in ("hfq", "none"):
            for i in range(dice.choice([1, 4, 30, 60])):
                price = dice.choice([None, float("nan"), 500.0, *([dice.uniform(5, 15)] * 12)])
                day = DAY + dt.timedelta(days=i * dice.choice([1, 1, 1]))
                data.append((symbol, adjust, day, price, price, price, price))
    dice.shuffle(data)
    table = spark.createDataFrame(data, SCHEMA)
    found = prices.clean_prices(table).toPandas().sort_values(["symbol", "adjust_type", "dt"])
    frame = pd.DataFrame(data, columns=table.columns).sort_values(["symbol", "adjust_type", "dt"])
    for keys, group in frame.groupby(["symbol", "adjust_type"]):
        close = group["close"].astype(float).ffill()
        mean, spread = close.mean(), close.std()
        if spread == spread:
            close = close.clip(mean - 3 * spread, mean + 3 * spread)
        own = found[(found["symbol"] == keys[0]) & (found["adjust_type"] == keys[1])]
        for name, expected in {
            "close": close,
            "daily_return": close / close.shift(1) - 1,
            "ma5": close.rolling(5).mean(),
            "ma20": close.rolling(20).mean(),
        }.items():
            np.testing.assert_allclose(own[name].astype(float), expected, rtol=1e-9, atol=1e-9)
