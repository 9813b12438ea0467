"""Coverage of a landing run and the codes to run again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallyloom.operators import quality


def coverage_report(requested: DataFrame, landed: Mapping[str, DataFrame]) -> DataFrame:
    return quality.coverage(requested, landed)


def rerun_set(requested: DataFrame, landed: Mapping[str, DataFrame]) -> DataFrame:
    """(entity, symbol) for every requested code that landed no row."""
    return quality.unlanded(requested, landed)
