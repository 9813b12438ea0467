"""Partitioned landing, merged re-runs, drifting types, replacement, SQL in a session of its own, counts while writing."""

from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tallyloom import sources
from tallyloom.functions import parse_date
from tallyloom.functions.dates import _date_of_form
from tallyloom.operators import unions
from tallyloom.plans import statements

BARS = "symbol string, dt date, close double"


def bars(spark, n=400):
    data = [(f"{i % 37:06d}", dt.date(2020 + i % 5, 1 + i % 12, 1 + i % 28), float(i)) for i in range(n)]
    data += [(None, dt.date(2021, 1, 1), 1.0), ("000001", None, 2.0), (None, None, 3.0), ("", dt.date(2021, 1, 1), 4.0)]
    return spark.createDataFrame(data, BARS)


def files(path) -> dict[str, int]:
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if p.is_file()}


def test_partitioned_rows_come_back(spark, tmp_path, rows):
    path = sources.land_partitioned(bars(spark), str(tmp_path), "bars", parts=4)
    assert rows(sources.read_partitioned(spark, str(tmp_path), "bars")) == rows(bars(spark))
    assert {p.name for p in Path(path).glob("year=2021/*")} == {f"part_of_4={i}" for i in range(4)}
    with pytest.raises(ValueError, match="parts"):
        sources.write_parquet(bars(spark), str(tmp_path), "plain")
        sources.read_partitioned(spark, str(tmp_path), "plain")


def test_pruned_read(spark, tmp_path, rows, plan):
    sources.land_partitioned(bars(spark), str(tmp_path), "bars")
    start, end = dt.date(2021, 3, 5), dt.date(2022, 10, 9)
    codes = spark.createDataFrame([("000001",), ("000005",), ("000005",), (None,), ("none",)], "symbol string")
    wanted = bars(spark).filter(F.col("symbol").isin("000001", "000005") & F.col("dt").between(start, end))
    by_table = sources.read_partitioned(spark, str(tmp_path), "bars", codes, start, end)
    by_list = sources.read_partitioned(spark, str(tmp_path), "bars", ["000001", "000005", "none"], start, end)
    assert rows(by_table) == rows(by_list) == rows(wanted) and wanted.count() > 3
    assert sources.read_partitioned(spark, str(tmp_path), "bars", []).count() == 0
    for df in (by_table, by_list):
        filters = [line for line in plan(df).splitlines() if "PartitionFilters" in line][0]
        inside = filters.split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "year" in inside and ("dynamicpruni" if df is by_table else "part_of_16") in inside
        assert "GreaterThanOrEqual(dt" in filters.split("PushedFilters")[1]
    fresh = sources.read_partitioned(spark, str(tmp_path), "bars", ["000001", "000005"], start, end)
    fresh.collect()
    scan = fresh._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert 0 < scan.metrics().apply("numFiles").value() < len(files(tmp_path)) / 5


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_merge_of_a_rerun(spark, tmp_path, rows, threshold):
    path = sources.land_partitioned(bars(spark), str(tmp_path), "bars", parts=4)
    landed = bars(spark).collect()
    before = files(path)
    again = [(r["symbol"], r["dt"], -r["close"], n) for n in (1, 2) for r in landed if r["symbol"] == "000003" and r["dt"].year == 2022]
    again += [("000003", dt.date(2022, 12, 31), 7.0, 1), ("000003", dt.date(2022, 12, 31), 8.0, 0), (None, None, 9.0, 0)]
    rerun = spark.createDataFrame([(s, d, c * n if c < 0 else c, n) for s, d, c, n in again], f"{BARS}, n int")
    old = {(r["symbol"], r["dt"]): r["close"] for r in landed}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for _ in range(2):  # the same merge again changes nothing
            merge = rerun.select("symbol", "dt", F.col("close"))
            sources.merge_partitioned(spark, str(tmp_path), "bars", merge, ("symbol", "dt"))
            found = {(r["symbol"], r["dt"]): r["close"] for r in sources.read_partitioned(spark, str(tmp_path), "bars").collect()}
            expected = dict(old)
            for r in merge.collect():
                place = (r["symbol"], r["dt"])
                same = [x["close"] for x in merge.collect() if (x["symbol"], x["dt"]) == place]
                expected[place] = max(same)
            assert found == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    after = files(path)
    same = [f for f in before if after.get(f) == before[f]]
    gone = {os.path.dirname(f) for f in before if f not in same}
    assert len(gone) == 2 and all("year=2022" in g or "DEFAULT" in g for g in gone) and len(same) >= len(before) - 3


def test_merge_by_order_and_its_checks(spark, tmp_path):
    landed = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0, 5)], f"{BARS}, seen int")
    sources.land_partitioned(landed, str(tmp_path), "bars")
    tries = spark.createDataFrame([("a", dt.date(2024, 1, 1), 9.0, 1), ("a", dt.date(2024, 1, 1), 2.0, 3)], f"{BARS}, seen int")
    sources.merge_partitioned(spark, str(tmp_path), "bars", tries, ("symbol", "dt"), order="seen")
    assert [tuple(r) for r in sources.read_partitioned(spark, str(tmp_path), "bars").collect()] == [("a", dt.date(2024, 1, 1), 2.0, 3)]
    sources.merge_partitioned(spark, str(tmp_path), "bars", tries.limit(0), ("symbol", "dt"))
    assert sources.read_partitioned(spark, str(tmp_path), "bars").count() == 1
    with pytest.raises(ValueError, match="keys"):
        sources.merge_partitioned(spark, str(tmp_path), "bars", tries, ("symbol",))
    with pytest.raises(ValueError, match="seen"):
        sources.merge_partitioned(spark, str(tmp_path), "bars", tries.drop("seen"), ("symbol", "dt"))


def test_hot_code_is_written_by_several_tasks(spark, tmp_path):
    hot = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("symbol"),
        F.lit(dt.date(2024, 1, 1)).alias("dt"), F.rand(1).alias("close"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        path = sources.land_partitioned(hot, str(tmp_path), "bars", parts=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(path)) > 2 and sources.read_partitioned(spark, str(tmp_path), "bars").count() == 60_000


def test_drifting_types(spark, tmp_path, rows):
    day = dt.date(2024, 2, 3)
    tables = {
        "a": ([(1, 2.5, day)], "id long, value double, day date"),
        "b": ([("2", "3.5", "20240203"), ("x", "1.5d", "2024-02-30"), (None, None, None)], "id string, value string, day string"),
        "c": ([(3, dt.datetime(2024, 2, 3, 9, 0))], "id int, day timestamp"),
        "d": ([(4.0, True, 1)], "id double, value boolean, extra int"),
    }
    for name, (data, kinds) in tables.items():
        sources.write_parquet(spark.createDataFrame(data, kinds), str(tmp_path), name)
    found = sources.read_drifting(spark, str(tmp_path), "id long, value double, day date", "unreadable")
    assert [k for _, k in found.dtypes] == ["bigint", "double", "date", "bigint"]
    assert rows(found) == sorted(
        [(1, 2.5, day, 0), (2, 3.5, day, 0), (None, None, None, 3), (None, None, None, 0), (3, None, day, 0), (4, 1.0, None, 0)],
        key=str,
    )
    assert sources.read_drifting(spark, str(tmp_path), "id long").columns == ["id"]
    assert len(sources.landed_files(spark, str(tmp_path))) >= 4
    (tmp_path / "none").mkdir()
    assert sources.read_drifting(spark, str(tmp_path / "none"), "id long", "bad").columns == ["id", "bad"]


def test_drifting_files_of_one_kind_are_one_scan(spark, tmp_path, plan):
    for i in range(6):
        kinds = "id long, value double" if i % 2 else "id long, value string"
        sources.write_parquet(spark.createDataFrame([(i, 1.0 if i % 2 else "1")], kinds), str(tmp_path), f"t{i}")
    df = sources.read_drifting(spark, str(tmp_path), "id long, value double").filter("id > 2")
    assert plan(df).count("FileScan parquet") == 2 and plan(df).count("GreaterThan(id,2)") == 2
    assert df.agg(F.sum("value")).first()[0] == 3.0


def test_replacement_that_fails_leaves_the_old_rows(spark, tmp_path):
    path = sources.write_parquet(spark.range(5), str(tmp_path), "t")
    broken = spark.read.parquet(path).select(F.when(F.col("id") == 3, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="midway"):
        sources.write_parquet(broken, str(tmp_path), "t")
    with pytest.raises(Exception, match="midway"):
        sources.write_csv(broken, str(tmp_path), "t")
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t.parquet"]
    sources.write_parquet(spark.read.parquet(path).filter("id > 1"), str(tmp_path), "t")  # of itself
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["t.parquet"]


def test_replacement_that_ended_between_the_renames(spark, tmp_path):
    path = sources.write_parquet(spark.range(5), str(tmp_path), "t")
    os.rename(path, tmp_path / "_replaced-t.parquet")
    assert sources.recover(spark, path) and not sources.recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    os.rename(path, tmp_path / "_replaced-t.parquet")
    sources.write_parquet(spark.range(7), str(tmp_path), "t")
    assert spark.read.parquet(path).count() == 7 and [p.name for p in tmp_path.iterdir()] == ["t.parquet"]


def test_sql_in_a_session_of_its_own(spark, rows):
    spark.range(2).createOrReplaceTempView("mine")
    before = {t.name for t in spark.catalog.listTables()}
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    table = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")

    def ask(sql):
        return sources.sql_over_tables(spark, {"t": table, "mine": table}, sql)

    assert rows(ask("-- note\nwith t2 as (select * from t) select id from t2")) == [(1,), (2,)]
    assert rows(ask("/* c */ with recursive r(n) as (select 1 union all select n + 1 from r where n < 3) select n from r")) == [(1,), (2,), (3,)]
    assert rows(ask("with t as (select 7 as id) select id from t")) == [(7,)]
    assert rows(ask("select /*+ BROADCAST(mine) */ mine.id from t join mine using (id)")) == [(1,), (2,)]
    assert rows(ask("select '; with' as x")) == [("; with",)]
    joined = ask("select id from t").join(spark.range(3), "id")
    assert joined.count() == 2 and joined.sparkSession is spark
    assert spark.table("mine").count() == 2 and {t.name for t in spark.catalog.listTables()} == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == shuffles
    with pytest.raises(Exception, match="not_there"):
        ask("select * from not_there")


def test_inputs_of_a_safe_union_run_once(spark, rows):
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    table = spark.range(10).withColumn("none", F.lit(None).cast("int")).mapInArrow(count, "id long, none int")
    found = unions.safe_union(spark, [table, table.limit(0), spark.range(2).withColumnRenamed("id", "x")])
    assert found.columns == ["id", "x"] and found.count() == 12 and ran.value == 10


def test_the_split_runs_its_input_once(spark, tmp_path):
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    data = [(f"{i}", dt.date(2020, 1, 1), str(1 + i % 3), float(i) if i % 3 == 1 else None, float("nan")) for i in range(30)]
    kinds = "symbol string, end_date date, comp_type string, special double, nothing double"
    rows = spark.createDataFrame(data, kinds).mapInArrow(count, kinds)
    parts = {p.company_type: p for p in statements.split_by_company_type(spark, rows, str(tmp_path), "s")}
    assert ran.value == 30 and [parts[t].n_rows for t in "1234"] == [10, 10, 10, 0]
    assert parts["2"].kept == ("symbol", "end_date", "comp_type", "special") and "special" not in parts["1"].kept
    assert len(parts["4"].kept) == 5


def test_dates_by_characters_are_those_of_the_forms(spark):
    texts = [f"{y}{a}{m}{b}{d}{t}" for y in ("2024", "0001", "20x4", "９999", "") for a in "-/. x" for m in ("2", "02", "13", "-1", "+1")
             for b in ("-", "/", "") for d in ("29", "30", "9", "0", " 9") for t in ("", " ", "T09:30", " 09:30:00.5Z", "x")]
    texts += ["20240229", "20230229", "2024022", "202402290", " 20240229", "2024.1.1", "2024.01.01", "20240229 10:00", "2024-01-1T", "2024-01-T1", "2024-01-1 ", "2024012 ", "+024-01-01", "20240102\n", "2024-01-02\n", "", "١٢٣٤٥٦٧٨", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    differ = df.select("t", parse_date(F.col("t")).alias("a"), _date_of_form(F.col("t")).alias("b")).where("not a <=> b")
    assert differ.collect() == [] and df.where(parse_date(F.col("t")).isNotNull()).count() > 20
