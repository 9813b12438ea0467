"""Given tables and written intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sources.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The rows, written once to the shared scratch folder and read back.

    The plan behind them runs once and a lost executor does not bring it back.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
