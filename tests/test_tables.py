"""Schema operators, unions, sources, sinks, statements, companies, code lists."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom import sources
from tallyloom.operators import filters, keys, quality, schema, unions
from tallyloom.plans import columns, companies, industry, ingest, statements


def test_rename_ignores_missing_keys_and_keeps_odd_names(spark):
    table = spark.createDataFrame([(1, 2.0, "x")], "`PE(TTM)` int, `权重(%)` double, `a.b` string")
    renamed = schema.rename(table, {"PE(TTM)": "pe_ttm", "absent": "y"})
    assert renamed.columns == ["pe_ttm", "权重(%)", "a.b"]
    assert schema.to_front(renamed, "a.b").columns == ["a.b", "pe_ttm", "权重(%)"]
    assert schema.to_front(renamed, "none").columns == renamed.columns


def test_lowercase_columns(spark):
    table = spark.createDataFrame([(1, 2)], "`ABC` int, `D` int")
    assert schema.lowercase_columns(table).columns == ["abc", "d"]
    with pytest.raises(ValueError, match="abc"):
        schema.lowercase_columns(spark.createDataFrame([(1, 2)], "`ABC` int, `x` int").toDF("ABC", "abc"))


def test_drop_matching_ignores_case(spark):
    table = spark.createDataFrame([(1, 2, 3)], "a int, A_YOY int, b_yoy_c int")
    assert schema.drop_matching(table, "YOY").columns == ["a"]


def test_prune_null_columns(spark):
    table = spark.createDataFrame(
        [(1, None, None, float("nan")), (2, None, "x", float("nan"))],
        "a int, b string, c string, d double",
    )
    assert schema.prune_null_columns(table).columns == ["a", "c"]


def test_zero_fill_to_double(spark, rows):
    table = spark.createDataFrame(
        [("s", 1, None, True), ("t", None, float("nan"), None)], "k string, a int, b double, c boolean"
    )
    cleaned = schema.zero_fill_to_double(table, ["k"])
    assert [kind for _, kind in cleaned.dtypes] == ["string", "double", "double", "double"]
    assert rows(cleaned) == [("s", 1.0, 0.0, 1.0), ("t", 0.0, 0.0, 0.0)]
    with pytest.raises(ValueError, match="k"):
        schema.zero_fill_to_double(table)


def test_blank_nulls(spark, rows):
    table = spark.createDataFrame([(1, None, dt.date(2024, 1, 2))], "a int, b double, c date")
    assert rows(schema.blank_nulls(table)) == [("1", "", "2024-01-02")]


def test_metrics_to_double(spark):
    table = spark.createDataFrame([("s", 1, True, "x")], "symbol string, a int, b boolean, c string")
    kinds = dict(schema.metrics_to_double(table).dtypes)
    assert kinds == {"symbol": "string", "a": "double", "b": "double", "c": "string"}


def test_safe_union(spark, rows):
    first = spark.createDataFrame([(1, None, None), (2, None, None)], "a int, b string, never int")
    second = spark.createDataFrame([(3, "x"), (3, "x")], "a int, b string")
    empty, blank = first.limit(0), spark.createDataFrame([(None,)], "z string")
    joined = unions.safe_union(spark, [None, first, empty, blank, second])
    assert joined.columns == ["a", "b"]
    assert rows(joined) == [(1, None), (2, None), (3, "x"), (3, "x")]
    nothing = unions.safe_union(spark, [empty, blank, None])
    assert nothing.columns == [] and nothing.count() == 0


def test_landing_keeps_leading_zeros_and_fills_missing_columns(spark, rows, tmp_path):
    """A code used as a directory name, files of different layouts, one scan."""
    root = str(tmp_path / "bars")
    spark.createDataFrame([(1.0, 2.0)], "close double, extra double").write.parquet(f"{root}/symbol=000001")
    spark.createDataFrame([(3.0, 4.0)], "close double, volume double").write.parquet(f"{root}/symbol=600000")
    table = sources.read_landing(spark, root, "close double, volume double, symbol string")
    assert rows(table) == [(1.0, None, "000001"), (3.0, 4.0, "600000")]
    assert "PartitionFilters: [isnotnull(symbol" in table.filter("symbol = '600000'")._jdf.queryExecution().toString()


def test_sql_over_tables_leaves_no_views(spark, rows, tmp_path):
    path = sources.write_parquet(spark.createDataFrame([(1, "a")], "id int, n string"), str(tmp_path), "t")
    other = spark.createDataFrame([(1, "b")], "id int, m string")
    found = sources.sql_over_tables(
        spark, {"one": path, "two": other}, "select one.id, n, m from one left join two on one.id = two.id"
    )
    assert not any(table.name in ("one", "two") for table in spark.catalog.listTables())
    assert rows(found) == [(1, "a", "b")]


def test_csv_and_sample(spark, rows, tmp_path):
    text = F.when(F.col("id") % 2 == 0, 'a,"b"')
    table = spark.range(100).withColumn("text", text).repartition(5)
    full = sources.write_csv(table, str(tmp_path), "full")
    assert rows(sources.read_csv(spark, full, table.schema)) == rows(table)
    assert any('"a,""b"""' in file.read_text() for file in (tmp_path / "full.csv").glob("*.csv"))
    sample = sources.write_csv_sample(table, str(tmp_path), "sample", ["id"], rows=7)
    picked = sources.read_csv(spark, sample, table.schema)
    assert [row["id"] for row in picked.orderBy("id").collect()] == list(range(7))


def test_scratch_is_under_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (sources.scratch_path(spark, "x") for _ in range(2))
    assert first.startswith(root) and first != second


def test_date_ranges(spark):
    table = spark.range(10).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    day = dt.date(2024, 1, 4)
    assert filters.date_range(table, "d").count() == 10
    assert filters.date_range(table, "d", start=day).count() == 7
    assert filters.date_range(table, "d", end=day).count() == 4
    assert filters.date_range(table, "d", day, day).count() == 1
    assert filters.recent_range(day) == (dt.date(2023, 12, 5), day)


def statement_rows(spark):
    data = [
        ("600000.SH", "20200101", "20200331", "1", "1", 1.0, None, None),
        ("600000.SH", "20200101", "20200630", "2", "2", 2.0, 5.0, None),
        ("600000.SH", "bad", "20091231", "6", "2", 3.0, 6.0, None),
        ("000001.SZ", "20200101", "bad", "7", "2", 4.0, 7.0, None),
        ("000001.SZ", "20200101", "20200930", "7", "9", 5.0, 8.0, None),
        ("000001.SZ", "20200101", "20200930", "5", "1", 6.0, 8.0, None),
    ]
    return spark.createDataFrame(
        data,
        "ts_code string, ann_date string, end_date string, report_type string, comp_type string,"
        " revenue double, int_income double, ebit double",
    )


def test_statements_b(spark, rows):
    built = statements.income_statements(statement_rows(spark))
    assert rows(built, "symbol", "symbol_full", "report_type", "ann_date", "end_date") == [
        ("000001", "000001.SZ", "母公司单季表", dt.date(2020, 1, 1), None),
        ("000001", "000001.SZ", "母公司单季表", dt.date(2020, 1, 1), dt.date(2020, 9, 30)),
        ("600000", "600000.SH", "单季合并", dt.date(2020, 1, 1), dt.date(2020, 6, 30)),
        ("600000", "600000.SH", "合并报表", dt.date(2020, 1, 1), dt.date(2020, 3, 31)),
        ("600000", "600000.SH", "母公司报表", None, dt.date(2009, 12, 31)),
    ]
    assert statements.balance_sheets(statement_rows(spark)).count() == 2
    assert len(columns.INCOME_COLUMNS) == len(set(columns.INCOME_COLUMNS)) == 94


def test_report_types_are_filtered_at_the_scan(spark, tmp_path):
    path = sources.write_parquet(statement_rows(spark), str(tmp_path), "landed")
    built = statements.balance_sheets(spark.read.parquet(path)).select("symbol", "report_type")
    text = built._jdf.queryExecution().toString()
    assert "In(report_type, [1,6])" in text
    assert "ReadSchema: struct<ts_code:string,report_type:string>" in text


def test_split_by_company_type(spark, rows, tmp_path):
    built = statements.income_statements(statement_rows(spark))
    since = dt.date(2010, 1, 1)
    parts = statements.split_by_company_type(spark, built, str(tmp_path), "income", since)
    assert [(part.company_type, part.n_rows) for part in parts] == [("1", 1), ("2", 1), ("3", 0), ("4", 0)]
    one, two, three, _ = (spark.read.parquet(part.path) for part in parts)
    assert set(three.columns) == set(built.columns) and three.count() == 0
    assert "int_income" not in one.columns and "ebit" not in two.columns
    assert rows(two, "comp_type", "int_income") == [("2", 5.0)]
    assert (tmp_path / "income_type_2.csv").is_dir()


def test_company_info(spark):
    data = [
        ("000001", "股票简称", "old", 0),
        ("000001", "股票简称", "new", 1),
        ("000001", "总股本", "12.5", 2),
        ("000001", "流通股", "abc", 3),
        ("000001", "上市时间", "19910403", 4),
        ("000001", "地域", "south", 5),
        ("600000", "上市时间", "2020x", 0),
    ]
    facts = spark.createDataFrame(data, "symbol string, item string, value string, ord int")
    found = {row["symbol"]: row for row in companies.company_info(facts, ("地域",)).collect()}
    first = found["000001"]
    assert (first["stock_name"], first["total_shares"], first["circulating_shares"]) == ("new", 12.5, None)
    assert (first["listing_date"], first["地域"]) == (dt.date(1991, 4, 3), "south")
    assert found["600000"]["listing_date"] is None


def test_industry(spark, rows):
    stocks = spark.createDataFrame(
        [("600000.SH", "A", "850111", "drop"), ("000001.SZ", "B", "none", "drop")],
        "`股票代码` string, `股票简称` string, `申万3级行业代码` string, `申万1级` string",
    )
    built = industry.constituents(stocks)
    assert built.columns[0] == "level_3_code" and "申万1级" not in built.columns
    levels = [
        industry.industry_level(spark.createDataFrame(data, "`行业代码` string, `行业名称` string, `上级行业` string"), level)
        for level, data in ((3, [("850111", "l3", "l2")]), (2, [("8501", "l2", "l1")]), (1, [("85", "l1", None)]))
    ]
    found = industry.industry_dimension(built, *levels[:2], levels[2].drop("上级行业"))
    assert rows(found) == [
        ("A", "600000.SH", "600000", "l3", "850111", "l2", "8501", "l1", "85"),
        ("B", "000001.SZ", "000001", None, None, None, None, None, None),
    ]
    bare = spark.createDataFrame([("600000.SH",)], "`股票代码` string")
    assert industry.constituents(bare, F.lit("850111")).first()["level_3_code"] == "850111"


def test_code_lists(spark, rows):
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "symbol string")
    landed = spark.createDataFrame([("a", 1), ("a", 2), ("x", 3)], "symbol string, v int")
    empty = landed.limit(0)
    assert rows(keys.missing_symbols(asked, landed)) == [("b",), ("c",)]
    assert rows(keys.restrict_symbols(landed, asked)) == [("a", 1), ("a", 2)]
    assert rows(keys.slice_symbols(asked, 1, 3)) == [("b",), ("c",)]
    entities = {"one": landed, "two": empty}
    report = {r["entity"]: r for r in ingest.coverage_report(asked, entities).collect()}
    assert (report["one"]["requested"], report["one"]["landed"]) == (3, 2)
    assert report["two"]["coverage"] == 0.0
    assert rows(ingest.rerun_set(asked, entities)) == [
        ("one", "b"), ("one", "c"), ("two", "a"), ("two", "b"), ("two", "c"),
    ]
    assert rows(quality.rows_per_output(landed, "symbol")) == [("a", 2), ("x", 1)]


class _Cluster:
    """The few parts of a session that the scratch folder asks for."""

    def __init__(self, master, setting=None):
        self.conf = self.sparkContext = self
        self.master, self.setting = master, setting

    def get(self, key, default=None):
        return self.setting if key == "spark.checkpoint.dir" and self.setting else default

    def getCheckpointDir(self):
        return None


def test_scratch_on_a_cluster_needs_the_setting():
    assert sources.scratch_path(_Cluster("yarn", "s3a://shared/x/"), "t").startswith("s3a://shared/x/t-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sources.scratch_path(_Cluster("yarn"), "t")
