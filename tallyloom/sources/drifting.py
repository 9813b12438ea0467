"""Landed files whose columns are missing or typed differently from file to file."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import parse_date
from tallyloom.operators.schema import named
from tallyloom.operators.unions import union_by_name

_FOOTERS_AT_ONCE = 16


def landed_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The Parquet files below some folders. Only their names reach the driver, as for any scan."""
    paths = [path] if isinstance(path, str) else list(path)
    listed = spark.read.format("binaryFile").options(pathGlobFilter="*.parquet", recursiveFileLookup=True)
    return sorted(row["path"] for row in listed.load(paths).select("path").collect())


def _cast(column: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return column
    if isinstance(have, T.StringType) and isinstance(want, T.DateType):
        return parse_date(column)
    if isinstance(have, T.StringType) and isinstance(want, T.NumericType):
        # the cast of text also reads a type letter behind a number
        return F.when(~column.rlike(r"[0-9.][dDfF]\s*$"), column.try_cast(want))
    if isinstance(have, T.DateType) and isinstance(want, T.NumericType):
        return F.lit(None).cast(want)
    return column.try_cast(want)


def read_drifting(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, unreadable: str | None = None
) -> DataFrame:
    """All landed files under the given schema, whatever type a file has for a column.

    The files' footers are read first, several at a time, and files with the same types for the wanted columns
    are one scan, so their filters and columns reach it. A column that a file lacks is null; a value that cannot be read as its type is null, and
    ``unreadable`` names a column with the number of such values in the row. Columns that are not wanted are not
    read. Without files the table is empty.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    files = landed_files(spark, path)
    with ThreadPoolExecutor(_FOOTERS_AT_ONCE) as pool:
        footers = list(pool.map(lambda file: spark.read.parquet(file).schema, files))
    groups: dict[tuple, tuple[T.StructType, list[str]]] = {}
    for file, footer in zip(files, footers, strict=True):
        have = {field.name: field.dataType for field in footer.fields}
        kept = [T.StructField(f.name, have[f.name]) for f in wanted.fields if f.name in have]
        kind = tuple((f.name, f.dataType.simpleString()) for f in kept)
        groups.setdefault(kind, (T.StructType(kept), []))[1].append(file)
    tables = [_group(spark, have, group, wanted, unreadable) for have, group in groups.values()]
    if tables:
        return union_by_name(tables)
    extra = [T.StructField(unreadable, T.LongType())] if unreadable else []
    return spark.createDataFrame([], T.StructType([*wanted.fields, *extra]))


def _group(
    spark: SparkSession, have: T.StructType, files: list[str], wanted: T.StructType, unreadable: str | None
) -> DataFrame:
    rows = spark.read.schema(have).parquet(*files)
    types = {field.name: field.dataType for field in have.fields}
    read, lost = [], F.lit(0).cast("long")
    for field in wanted.fields:
        if field.name not in types:
            read.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = _cast(named(field.name), types[field.name], field.dataType)
        read.append(value.alias(field.name))
        if types[field.name] != field.dataType:
            lost = lost + (named(field.name).isNotNull() & value.isNull()).cast("long")
    return rows.select(*read, *([lost.alias(unreadable)] if unreadable else []))
