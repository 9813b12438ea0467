"""Unions by name. Duplicates are kept."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.schema import present_counts

_AT_ONCE = 4


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of tables with different columns; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def safe_union(spark: SparkSession, tables: Sequence[DataFrame | None]) -> DataFrame:
    """Union that skips absent, empty and all-null tables and drops all-null columns of each.

    Each input runs once: it is written to the shared scratch folder, and the values of its columns are counted while it is
    written. One row of counts per input reaches the driver; the union reads the written rows.
    """
    from tallyloom.sources.scratch import scratch_path  # the sources import this module

    given = [table for table in tables if table is not None and table.columns]

    def land(table: DataFrame) -> DataFrame | None:
        counted = Observation()
        # columns are written by place, so that names that differ by case alone stay apart
        places = [f"c{i}" for i in range(len(table.columns))]
        counts = [count.alias(place) for place, count in zip(places, present_counts(table))]
        path = scratch_path(spark, "union")
        table.observe(counted, *counts).toDF(*places).write.parquet(path)
        found = counted.get
        kept = [(place, field) for place, field in zip(places, table.schema.fields) if found[place]]
        if not kept:
            return None
        schema = T.StructType([T.StructField(place, field.dataType) for place, field in kept])
        return spark.read.schema(schema).parquet(path).toDF(*[field.name for _, field in kept])

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        pruned = [table for table in pool.map(land, given) if table is not None]
    return union_by_name(pruned) if pruned else spark.createDataFrame([], T.StructType([]))


def tagged_union(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Stack tables and keep in ``column`` which one each row came from."""
    return union_by_name([table.withColumn(column, F.lit(tag)) for tag, table in tables.items()])
