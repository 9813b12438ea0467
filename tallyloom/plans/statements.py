"""Financial statements: build, clean, split."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import parse_date
from tallyloom.operators import filters, schema
from tallyloom.plans import columns
from tallyloom.sources import read_landing, remove, write_csv_sample, write_parquet


def statements_a(raw: DataFrame) -> DataFrame:
    """A-share statements of the first layout: no growth columns, lower-case names, dates parsed."""
    lowered = schema.lowercase_columns(schema.drop_matching(raw, "YOY"))
    return schema.coerce(
        schema.rename(lowered, columns.STATEMENTS_A),
        {name: parse_date for name in ("report_date", "notice_date", "update_date")},
    )


def statements_b(
    raw: DataFrame,
    report_types: Iterable[str] = tuple(columns.REPORT_TYPES),
    wanted: Sequence[str] | None = None,
) -> DataFrame:
    """A-share statements of the second layout, all report types in one scan.

    The report types not asked for are filtered at the scan; the others get their names. The bare
    symbol is the head of the suffixed code.
    """
    if wanted is not None:
        raw = schema.keep_columns(raw, [name for name in wanted if name in raw.columns])
    kept = list(report_types)
    branches = F
    for vendor_type, report_name in columns.REPORT_TYPES.items():
        branches = branches.when(F.col("report_type") == vendor_type, report_name)
    typed = raw.filter(F.col("report_type").isin(kept)).withColumn("report_type", branches)
    dated = schema.coerce(typed, {name: parse_date for name in ("ann_date", "f_ann_date", "end_date")})
    return schema.rename(dated, columns.STATEMENTS_B).withColumn(
        "symbol", F.substring_index("symbol_full", ".", 1)
    )


def balance_sheets(raw: DataFrame) -> DataFrame:
    return statements_b(raw, columns.BALANCE_SHEET_TYPES)


def income_statements(raw: DataFrame) -> DataFrame:
    return statements_b(raw, wanted=columns.INCOME_COLUMNS)


def cash_flow_statements(raw: DataFrame) -> DataFrame:
    return statements_b(raw)


def statements_hk(raw: DataFrame) -> DataFrame:
    """Hong Kong statements: lower-case names, report date parsed, ``symbol`` from the code."""
    lowered = schema.coerce(schema.lowercase_columns(raw), {"report_date": parse_date})
    if "security_code" not in lowered.columns:
        return lowered
    return schema.add_if_missing(lowered, "symbol", F.col("security_code"))


def clean_statement(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Missing measures to 0, every measure to double."""
    return schema.zero_fill_to_double(df, keys)


@dataclass(frozen=True)
class SplitPart:
    """One written part of a split: its company type, path, rows and columns kept."""

    company_type: str
    path: str
    n_rows: int
    kept: tuple[str, ...]


def split_by_company_type(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    name: str,
    since: dt.date | None = None,
    sample_keys: Sequence[str] = ("symbol", "end_date", "report_type", "f_ann_date", "ann_date"),
    sample_rows: int = 5000,
) -> list[SplitPart]:
    """One dataset per company type, each without the columns that are null in all its rows.

    The filtered rows are written once, by type, below ``root``: the plan behind ``df`` runs once,
    and each later step reads only its own directory. While they are written, the rows of each type are counted, and for each
    column the types that have a value; these numbers give the schemas, without a further scan. A type without rows gets an empty
    dataset with all columns, so nothing of an earlier run stays. The staged rows are removed at
    the end.
    """
    staged = f"{root.rstrip('/')}/_split-{uuid.uuid4().hex}"
    types = sorted(columns.COMPANY_TYPES)
    rows = filters.date_range(df, "end_date", start=since).filter(F.col("comp_type").isin(types))
    bit = F.lit(0)
    for place, company_type in enumerate(types):
        bit = F.when(F.col("comp_type") == company_type, 1 << place).otherwise(bit)
    observed = Observation()
    counts = [F.count(F.when(F.col("comp_type") == t, 1)).alias(f"rows {t}") for t in types]
    having = [F.bit_or(F.when(schema.present(df, c).isNotNull(), bit).otherwise(0)).alias(f"in {c}") for c in df.columns]
    (
        rows.observe(observed, *counts, *having)
        .withColumn("split_type", F.col("comp_type"))
        .write.partitionBy("split_type")
        .parquet(staged)
    )
    found = observed.get
    split_field = T.StructField("split_type", T.StringType())
    stage = read_landing(spark, staged, T.StructType([*df.schema.fields, split_field]))

    def write(company_type: str) -> SplitPart:
        n_rows = found[f"rows {company_type}"]
        place = types.index(company_type)
        kept = [c for c in df.columns if not n_rows or found[f"in {c}"] >> place & 1]
        part = schema.keep_columns(stage.filter(F.col("split_type") == company_type), kept)
        target = f"{name}_type_{company_type}"
        path = write_parquet(part, root, target)
        keys = [key for key in sample_keys if key in kept] or kept
        write_csv_sample(part, root, target, keys, sample_rows)
        return SplitPart(company_type, path, n_rows, tuple(kept))

    # The parts differ much in size; submitted together, the small ones run beside the large one.
    try:
        with ThreadPoolExecutor(max_workers=len(columns.COMPANY_TYPES)) as pool:
            return list(pool.map(write, types))
    finally:
        remove(spark, staged)
