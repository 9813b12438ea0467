"""Coverage, counts and checks, each as one aggregation or filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.schema import present_counts
from tallyloom.operators.unions import union_by_name

# Columns of a complete daily bar and the adjust types expected for each day.
BAR_COLUMNS = (
    "symbol", "dt", "open", "close", "high", "low", "volume", "amount", "amplitude",
    "change_percent", "change_amount", "turnover_rate", "adjust_type",
)
ADJUST_TYPES = ("hfq", "none")


def _marked(requested: DataFrame, landed: Mapping[str, DataFrame], key: str) -> DataFrame:
    """(entity, code, wanted, present): one row per entity and code seen on either side.

    Each table is read once. The sides are stacked and reduced on the map side, so a code with very
    many rows crosses the network as one row per task; nothing is broadcast and nothing is joined.
    """
    entities = F.explode(F.array(*[F.lit(entity) for entity in landed]))
    asked = requested.select(
        entities.alias("entity"),
        F.col(key).alias("code"),
        F.lit(1).alias("wanted"),
        F.lit(0).alias("present"),
    )
    found = [
        table.select(
            F.lit(entity).alias("entity"),
            F.col(key).alias("code"),
            F.lit(0).alias("wanted"),
            F.lit(1).alias("present"),
        )
        for entity, table in landed.items()
    ]
    return (
        union_by_name([asked, *found])
        .filter(F.col("code").isNotNull())
        .groupBy("entity", "code")
        .agg(F.max("wanted").alias("wanted"), F.max("present").alias("present"))
    )


def coverage(
    requested: DataFrame, landed: Mapping[str, DataFrame], key: str = "symbol"
) -> DataFrame:
    """One row per entity: codes requested, codes landed and the share landed (0 when none)."""
    entities = F.explode(F.array(*[F.lit(entity) for entity in landed]))
    every = requested.sparkSession.range(1).select(
        entities.alias("entity"), F.lit(0).alias("wanted"), F.lit(0).alias("present")
    )
    counted = (
        _marked(requested, landed, key)
        .drop("code")
        .unionByName(every)
        .groupBy("entity")
        .agg(F.sum("wanted").alias("requested"), F.sum("present").alias("landed"))
    )
    return counted.withColumn(
        "coverage", F.coalesce(F.try_divide(F.col("landed"), F.col("requested")), F.lit(0.0))
    )


def unlanded(
    requested: DataFrame, landed: Mapping[str, DataFrame], key: str = "symbol"
) -> DataFrame:
    """(entity, code) for every code that was requested and has no row in the entity."""
    lacking = (F.col("wanted") == 1) & (F.col("present") == 0)
    return _marked(requested, landed, key).filter(lacking).select("entity", F.col("code").alias(key))


def rows_per_output(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def validate_prices(
    prices: DataFrame,
    requested: DataFrame | None = None,
    key: str = "symbol",
    others: Sequence[str] = ("adjust_type", "dt"),
) -> DataFrame:
    """One verdict per symbol: valid when it is named and has a row with some value.

    ``others`` are no values: a row that holds only a day and an adjust type says nothing about the
    price. With ``others=()`` such rows count.

    With ``requested`` the symbols without any row get a verdict too.
    """
    values = prices.drop(key, *others)
    present = F.greatest(F.lit(0), *present_counts(values))
    verdicts = prices.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), present.alias("n_values")
    )
    if requested is not None:
        verdicts = requested.select(key).distinct().join(verdicts, key, "left")
    n_rows = F.coalesce("n_rows", F.lit(0)).cast("long")
    n_values = F.coalesce("n_values", F.lit(0)).cast("long")
    return verdicts.select(
        key,
        n_rows.alias("n_rows"),
        (F.col(key).isNotNull() & (n_values > 0)).alias("is_valid"),
    )


def ohlc_violations(
    bars: DataFrame, keys: Sequence[str] = ("symbol", "adjust_type", "dt")
) -> DataFrame:
    """One row per bar and broken rule. A missing value breaks the rules it takes part in."""
    rules = {
        "high>=close": F.col("high") >= F.col("close"),
        "high>=open": F.col("high") >= F.col("open"),
        "close>=low": F.col("close") >= F.col("low"),
        "open>=low": F.col("open") >= F.col("low"),
        "volume>0": F.col("volume") > 0,
        "amount>0": F.col("amount") > 0,
    }
    broken = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(holds, F.lit(False)), F.lit(name))
                for name, holds in rules.items()
            ]
        )
    )
    return bars.select(*keys, F.explode(broken).alias("rule"))


def missing_columns(df: DataFrame, expected: Sequence[str] = BAR_COLUMNS) -> list[str]:
    """Expected columns the table lacks; read from the schema, no job runs."""
    return [name for name in expected if name not in df.columns]


def adjust_completeness(bars: DataFrame, expected: Sequence[str] = ADJUST_TYPES) -> DataFrame:
    """Rows and adjust types per (symbol, dt), and whether every expected type is there."""
    flags = [F.max(F.when(F.col("adjust_type") == name, 1).otherwise(0)) for name in expected]
    found = sum(flags[1:], flags[0])
    return bars.groupBy("symbol", "dt").agg(
        F.count(F.lit(1)).alias("n_rows"),
        found.alias("n_types"),
        (found == F.lit(len(expected))).alias("is_complete"),
    )
