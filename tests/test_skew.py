"""One key with a third of all rows: same rows as without skew, and its partition is split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import keys
from tallyloom.plans import companies, dividends, ingest

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.shuffle.partitions": "8",
}
ROWS = 60_000


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle with limits small enough for a small table to count as skewed."""
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def events(spark):
    """A third of the rows are of symbol ``hot``."""
    return spark.range(0, ROWS, 1, 8).select(
        F.expr("if(id % 3 = 0, 'hot', concat('s', id % 997))").alias("symbol"),
        F.expr("date_add(date'2020-01-01', cast(id % 900 as int))").alias("date"),
        F.col("id").cast("decimal(18,2)").alias("dividend"),
    )


def names(spark):
    return spark.range(997).selectExpr("concat('s', id) as symbol", "concat('N', id) as stock_name").union(
        spark.sql("select 'hot', 'H'")
    )


def final_plan(df) -> str:
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_join_is_split(shuffled):
    joined = dividends.named_events(events(shuffled), names(shuffled))
    assert "skew=true" in final_plan(joined)
    assert joined.count() == ROWS and joined.filter("stock_name = 'H'").count() == ROWS // 3


def test_calendar_with_a_hot_symbol(shuffled):
    table = dividends.dividend_calendar(events(shuffled), names(shuffled))
    paid = table.filter("dividend > 0").groupBy().agg(F.count("*"), F.sum("dividend")).first()
    assert tuple(paid) == (ROWS - 1, ROWS * (ROWS - 1) / 2)
    last = table.filter("symbol = 'hot' and year = 2020").groupBy().max("current_year_total_dividend")
    own = events(shuffled).filter("symbol = 'hot' and year(date) = 2020").groupBy().sum("dividend")
    assert last.first()[0] == float(own.first()[0])


def test_hot_code_in_code_lists(shuffled):
    asked = names(shuffled).select("symbol").union(shuffled.sql("select 'absent'"))
    assert keys.restrict_symbols(events(shuffled), asked).count() == ROWS
    assert [r[0] for r in keys.missing_symbols(asked, events(shuffled)).collect()] == ["absent"]
    report = ingest.coverage_report(asked, {"events": events(shuffled)}).first()
    assert (report["requested"], report["landed"]) == (999, 998)


def test_facts_of_one_symbol_are_reduced_before_the_shuffle(shuffled, plan):
    facts = events(shuffled).select(
        "symbol",
        F.lit("股票简称").alias("item"),
        F.col("dividend").cast("string").alias("value"),
        F.col("dividend").cast("long").alias("ord"),
    )
    wide = companies.company_info(facts)
    text = plan(wide)
    assert text.index("Exchange") < text.index("partial_max_by")
    assert wide.filter("symbol = 'hot'").first()["stock_name"] == f"{ROWS - 3}.00"


def test_facts_of_one_file_are_dealt_before_they_are_sorted(spark, plan):
    """All facts in one task of the scan, many of one symbol and item, some without an order."""
    data = [("hot", "行业", f"v{i}", i) for i in range(3000)] + [(f"s{i % 700}", "new", str(i), i) for i in range(1400)]
    data += [("hot", "行业", "never", None), ("alone", "行业", "lost", None), ("s0", None, "x", 0)]
    facts = spark.createDataFrame(data, "symbol string, item string, value string, ord int").coalesce(1)
    wide = companies.company_info(facts)
    text = plan(wide)
    assert text.rindex("Exchange") > text.rindex("partial_max_by")
    found = {r["symbol"]: r for r in wide.collect()}
    assert len(found) == 702 and found["hot"]["industry"] == "v2999" and found["alone"]["industry"] is None
    assert all(found[f"s{i}"]["other_facts"] == {"new": str(700 + i)} for i in range(700))


@pytest.mark.parametrize("last", [1 << 14, 3])
def test_slices_with_repeats_and_nulls(spark, monkeypatch, last):
    """Any slice, by its head or by ranges; a third of the codes are one code."""
    monkeypatch.setattr(keys, "_LAST", last)
    data = [None] * 7 + ["hot"] * 400 + [f"{i * 37 % 600:04d}" for i in range(800)] + [""] * 3
    codes = spark.createDataFrame([(c,) for c in data], "symbol string").repartition(6)
    order = sorted(data, key=lambda c: (c is not None, c or ""))
    slices = [(3, 9), (0, 1210), (100, 101), (500, 900), (1000, 1205), (1205, None), (2000, 2100), (9, 9)]
    for start, stop in slices:
        for head in (0, 64):
            found = [r["symbol"] for r in keys.slice_symbols(codes, start, stop, head=head).collect()]
            assert sorted(found, key=lambda c: (c is not None, c or "")) == order[start:stop], (start, stop, head)
    assert keys.slice_symbols(codes.limit(0), 0, 5).count() == keys.slice_symbols(codes.limit(0), 5000, 5100).count() == 0
    numbers = spark.range(0, 20_000).selectExpr("id * 7919 % 20000 as k")
    assert sorted(r["k"] for r in keys.slice_symbols(numbers, 9_990, 10_020, key="k").collect()) == list(range(9_990, 10_020))


def test_calendar_tasks_are_even(spark, monkeypatch):
    """One symbol with most of the days, whatever the number of shuffle partitions."""
    import datetime as dt

    from tallyloom.operators import calendar

    monkeypatch.setattr(calendar, "DAYS_PER_TASK", 4000)
    day = dt.date(1900, 1, 1)
    data = [("long", day, 20_000), ("none", day, -1)] + [(f"s{i}", day, 1 + i * 7 % 900) for i in range(60)]
    spans = spark.createDataFrame([(s, d, d + dt.timedelta(days=n)) for s, d, n in data], "symbol string, first_date date, last_date date")
    wanted = sum(n + 1 for _, _, n in data)
    for partitions in ("1", "1000"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            dense = calendar.dense_calendar(spans)
            sizes = [r["count"] for r in dense.groupBy(F.spark_partition_id().alias("task")).count().collect()]
            assert dense.distinct().count() == wanted == sum(sizes)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert len(sizes) == -(-wanted // 4000) and max(sizes) <= 2 * min(sizes)


def test_calendar_tasks_grow_before_they_are_many(spark, monkeypatch):
    """A long calendar goes to larger tasks, not to ever more of them; a short one to a few for each core."""
    import datetime as dt

    from tallyloom.operators import calendar

    day = dt.date(1900, 1, 1)
    spans = spark.createDataFrame([(f"s{i}", day, day + dt.timedelta(days=999)) for i in range(50)], "symbol string, first_date date, last_date date")
    for per_task, wanted in ((100, 63), (1000, 16), (10_000, 5)):
        monkeypatch.setattr(calendar, "DAYS_PER_TASK", per_task)
        dense = calendar.dense_calendar(spans)
        sizes = [r["count"] for r in dense.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert dense.distinct().count() == 50_000 == sum(sizes) and len(sizes) == wanted
