"""Vectors in fixed point: each component x becomes the integer floor(256 x), x as a double.

A row takes part if its id is given and its vector has components, none of them null, NaN or infinite, and none
of ``LARGEST`` or more in size after scaling (beyond it, squared distances and inner products of a few hundred
components no longer fit a long).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
LARGEST = 1 << 26


def usable(vector: Column) -> Column:
    """Whether a vector can be scaled; never null."""
    bound = LARGEST / SCALE

    def odd(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) >= bound)

    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, odd), F.lit(False))


def scaled(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))


def integer_rows(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``(id, label, dim, vector array<int>)`` of the rows that take part."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("raw")
    )
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("raw")))
    return rows.select("id", "label", F.size("raw").alias("dim"), scaled(F.col("raw")).alias("vector"))


def numbers(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an array column of one length as a matrix of 64-bit integers."""
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, dim)
