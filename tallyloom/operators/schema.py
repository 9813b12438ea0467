"""Projection and schema operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import nan_to_null, parse_date


def named(name: str) -> Column:
    """Column by literal name; vendor names hold dots, brackets and percent signs."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map. Keys that are not present are ignored, other columns pass through."""
    return df.withColumnsRenamed(dict(mapping))


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that fold together are an error."""
    lowered = [name.lower() for name in df.columns]
    clashes = sorted({name for name in lowered if lowered.count(name) > 1})
    if clashes:
        raise ValueError(f"columns differ only by case: {clashes}")
    return df.toDF(*lowered)


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop the columns whose name matches a pattern, ignoring case."""
    return df.drop(*[name for name in df.columns if re.search(pattern, name, re.IGNORECASE)])


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def keep_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[named(name) for name in names])


def to_front(df: DataFrame, name: str) -> DataFrame:
    """Move a column to the front; a table without it is returned as it is."""
    if name not in df.columns:
        return df
    return keep_columns(df, [name, *[other for other in df.columns if other != name]])


def tag(df: DataFrame, **literals: object) -> DataFrame:
    """Set literal columns (report type, adjust type, index code, update date)."""
    return df.withColumns({name: F.lit(value) for name, value in literals.items()})


def add_if_missing(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, value)


def _present(field: T.StructField) -> Column:
    """The column with NaN read as missing."""
    column = named(field.name)
    return nan_to_null(column) if isinstance(field.dataType, (T.FloatType, T.DoubleType)) else column


def present(df: DataFrame, name: str) -> Column:
    """A column of a table with NaN read as missing."""
    return _present(df.schema[name])


def present_counts(df: DataFrame) -> list[Column]:
    """One count of non-missing values per column, in column order."""
    return [F.count(_present(field)) for field in df.schema.fields]


def prune_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are null in every row.

    The schema depends on the data, so this runs one aggregation; only its single row of counts
    reaches the driver.
    """
    counts = df.select(*present_counts(df)).first()
    return keep_columns(df, [name for name, count in zip(df.columns, counts) if count])


def zero_fill_to_double(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """Missing values to 0 and every column to double, apart from the keys."""
    kept = set(keys)
    wrong = [
        field.name
        for field in df.schema.fields
        if field.name not in kept and not isinstance(field.dataType, (T.NumericType, T.BooleanType))
    ]
    if wrong:
        raise ValueError(f"not numeric: {wrong}")
    return df.select(
        *[
            named(field.name)
            if field.name in kept
            else F.coalesce(_present(field).cast("double"), F.lit(0.0)).alias(field.name)
            for field in df.schema.fields
        ]
    )


def blank_nulls(df: DataFrame) -> DataFrame:
    """Text view of a table: every column as string, missing values as empty text."""
    return df.select(
        *[
            F.coalesce(_present(field).cast("string"), F.lit("")).alias(field.name)
            for field in df.schema.fields
        ]
    )


def metrics_to_double(df: DataFrame, reserved: Iterable[str] = ("symbol",)) -> DataFrame:
    """Numeric and boolean columns to double; text, dates and reserved names stay."""
    kept = set(reserved)
    return df.select(
        *[
            named(field.name).cast("double").alias(field.name)
            if field.name not in kept
            and isinstance(field.dataType, (T.NumericType, T.BooleanType))
            else named(field.name)
            for field in df.schema.fields
        ]
    )


def as_date(df: DataFrame, name: str) -> DataFrame:
    """A date column that landed as text, as a timestamp or as a date."""
    parse = parse_date if dict(df.dtypes)[name] == "string" else lambda value: value.cast("date")
    return df.withColumn(name, parse(named(name)))


def coerce(df: DataFrame, conversions: Mapping[str, object]) -> DataFrame:
    """Apply a column function to each named column that is present."""
    return df.withColumns(
        {name: convert(named(name)) for name, convert in conversions.items() if name in df.columns}
    )
