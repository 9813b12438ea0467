"""Three-level industry classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import first_digits
from tallyloom.operators import schema
from tallyloom.plans import columns


def industry_level(raw: DataFrame, level: int) -> DataFrame:
    """One level of the classification; levels 3 and 2 name their parent."""
    mapping = {
        "行业代码": f"level_{level}_code",
        "行业名称": f"level_{level}_name",
        **columns.INDUSTRY_VALUATION,
    }
    if level > 1:
        mapping["上级行业"] = f"level_{level - 1}_name"
    return schema.rename(raw, mapping)


def constituents(raw: DataFrame, level_3_code: Column | None = None) -> DataFrame:
    """Stocks of the level-3 industries, code first, with the bare symbol.

    ``level_3_code`` stands in for the code column where the landed table has none.
    """
    renamed = schema.rename(raw, columns.CONSTITUENTS)
    if level_3_code is not None:
        renamed = schema.add_if_missing(renamed, "level_3_code", level_3_code)
    trimmed = schema.drop_if_present(renamed, "申万1级", "申万2级")
    return schema.to_front(trimmed, "level_3_code").withColumn(
        "symbol", first_digits(F.col("stock_code"))
    )


def industry_dimension(
    stocks: DataFrame, level_3: DataFrame, level_2: DataFrame, level_1: DataFrame
) -> DataFrame:
    """Stocks with their three levels: level 3 by code, levels 2 and 1 by name.

    Stocks without a match keep null levels. Spark broadcasts a level only when its measured size
    is under the broadcast threshold, and joins by shuffle beyond it.
    """
    third = level_3.select("level_3_code", "level_3_name", "level_2_name")
    second = level_2.select("level_2_name", "level_2_code", "level_1_name")
    first = level_1.select("level_1_name", "level_1_code")
    # Equal names on both sides: the column that survives is the matched one, null without a match.
    return (
        stocks.select("stock_name", "stock_code", "symbol", F.col("level_3_code").alias("held_code"))
        .join(third, F.col("held_code") == F.col("level_3_code"), "left")
        .withColumnRenamed("level_2_name", "parent_2")
        .join(second, F.col("parent_2") == F.col("level_2_name"), "left")
        .withColumnRenamed("level_1_name", "parent_1")
        .join(first, F.col("parent_1") == F.col("level_1_name"), "left")
        .drop("held_code", "parent_2", "parent_1")
        .select(
            "stock_name", "stock_code", "symbol",
            "level_3_name", "level_3_code",
            "level_2_name", "level_2_code",
            "level_1_name", "level_1_code",
        )
    )
