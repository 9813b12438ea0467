"""Landed tables in folders by year and hashed code: pruned reads, and re-runs merged into them.

A table is cut into folders ``year=…/part_of_N=…``, where the part is the hash of the code. Reads of some codes or
years open only their folders, and a merge rewrites only the folders that its rows fall into. The number of
parts is in the column's name, so a reader needs no setting.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.filters import date_range
from tallyloom.sources.datasets import dataset_path
from tallyloom.sources.scratch import scratch_path

PARTS = 16
_PART = "part_of_"


def _part(code: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(code.cast("string")), F.lit(parts)).cast("int")


def _parts(df: DataFrame) -> tuple[str, int]:
    """Name of the part column and number of parts."""
    for name in df.columns:
        found = re.fullmatch(rf"{_PART}(\d+)", name)
        if found:
            return name, int(found.group(1))
    raise ValueError("the table has no column of parts")


def _placed(df: DataFrame, day: str, key: str, parts: int) -> DataFrame:
    return df.withColumns({"year": F.year(day), f"{_PART}{parts}": _part(F.col(key), parts)})


def _write(df: DataFrame, path: str, part: str, mode: str, **options: str) -> None:
    # adaptive execution cuts a folder with very many rows (a hot code) over several tasks and files
    spread = df.hint("rebalance", "year", part)
    spread.write.mode(mode).options(**options).partitionBy("year", part).parquet(path)


def land_partitioned(
    df: DataFrame, root: str, name: str, day: str = "dt", key: str = "symbol", parts: int = PARTS
) -> str:
    """Write a dataset by year of ``day`` and hashed ``key``; returns its path.

    Rows without a day are in a folder of their own, rows without a code in the part of the null.
    """
    path = dataset_path(root, name)
    _write(_placed(df, day, key, parts), path, f"{_PART}{parts}", "overwrite")
    return path


def read_partitioned(
    spark: SparkSession,
    root: str,
    name: str,
    codes: Sequence[str] | DataFrame | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    day: str = "dt",
    key: str = "symbol",
) -> DataFrame:
    """A partitioned dataset, or the rows of some codes and days of it, without the folder columns.

    A range of days and codes given as a list pick folders while the query is planned. Codes given as a table pick them at run
    time, by dynamic partition pruning, when that table is small enough to be broadcast; a larger one
    is joined.
    """
    df = spark.read.parquet(dataset_path(root, name))
    part, parts = _parts(df)
    if start is not None:
        df = df.filter(F.col("year") >= start.year)
    if end is not None:
        df = df.filter(F.col("year") <= end.year)
    df = date_range(df, day, start, end)
    if isinstance(codes, DataFrame):
        # a comparison that every code passes: only filtered tables are considered for pruning
        listed = codes.select(F.col(key).cast("string").alias("_code")).filter(F.col("_code") >= "").distinct()
        listed = listed.withColumn("_part", _part(F.col("_code"), parts))
        met = (F.col(part) == F.col("_part")) & (F.col(key).cast("string") == F.col("_code"))
        df = df.join(listed, met, "left_semi")
    elif codes is not None:
        wanted = [_part(F.lit(code), parts) for code in codes]
        df = df.filter(F.col(part).isin(*wanted) & F.col(key).cast("string").isin(*codes)) if wanted else df.limit(0)
    return df.drop("year", part)


def merge_partitioned(
    spark: SparkSession,
    root: str,
    name: str,
    rerun: DataFrame,
    keys: Sequence[str],
    order: str | None = None,
    day: str = "dt",
    key: str = "symbol",
) -> str:
    """Merge the rows of a re-run into a partitioned dataset: the last landed row of a key wins.

    A row of the re-run takes the place of the landed rows with the same ``keys`` (null equals null), other landed rows stay.
    Rows of the re-run that share their keys are one row, that of the greatest ``order`` (then the greatest row). The keys hold the day and the
    code, so a row never moves to another folder. The re-run is written first; then only folders that it falls into are read and
    rewritten, each replaced when all are written, so running the same merge again gives the same table.
    """
    if not {day, key} <= set(keys):
        raise ValueError(f"the keys must hold {day} and {key}, which say where a row is kept")
    path = dataset_path(root, name)
    landed = spark.read.parquet(path)
    part, parts = _parts(landed)
    columns = [column for column in landed.columns if column not in ("year", part)]
    unknown = sorted(set(rerun.columns) ^ set(columns))
    if unknown:
        raise ValueError(f"columns of only one side: {unknown}")
    types = {field.name: field.dataType for field in landed.schema.fields}
    fresh = rerun.select(*[F.col(column).cast(types[column]).alias(column) for column in columns])
    values = [column for column in columns if column not in keys]
    if values:
        rank = F.struct(*([F.col(order)] if order else []), *[F.col(v) for v in values])
        fresh = fresh.groupBy(*keys).agg(F.max_by(F.struct(*values), rank).alias("_row")).select(*keys, "_row.*")
    else:
        fresh = fresh.select(*keys).distinct()
    staged_path = scratch_path(spark, "rerun")
    _placed(fresh, day, key, parts).write.parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    touched = staged.select(F.col("year").alias("_year"), F.col(part).alias("_part")).distinct()
    # at most one row for each folder of the dataset
    folders = touched.collect()
    if not folders:
        return path
    years, places = {row["_year"] for row in folders}, {row["_part"] for row in folders}
    in_years = F.col("year").isin(*[y for y in years if y is not None])
    if None in years:
        in_years = in_years | F.col("year").isNull()
    old = landed.filter(in_years & F.col(part).isin(*places))
    old = old.join(touched, F.col("year").eqNullSafe(F.col("_year")) & (F.col(part) == F.col("_part")), "left_semi")
    renamed = staged.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    kept = old.join(renamed, same, "left_anti")
    merged = kept.select(*columns, "year", part).unionByName(staged.select(*columns, "year", part))
    _write(merged, path, part, "overwrite", partitionOverwriteMode="dynamic")
    return path
