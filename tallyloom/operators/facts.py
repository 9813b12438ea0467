"""(item, value) facts to one wide row per symbol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_facts(
    facts: DataFrame,
    items: Sequence[str],
    key: str = "symbol",
    item: str = "item",
    value: str = "value",
    order: str = "ord",
    others: str | None = None,
) -> DataFrame:
    """One row per symbol and one column per listed item; the last value of an item wins.

    Items that are not listed go to the map column ``others``, or are left out without one. The
    items are given, so no job runs to find them and the schema is fixed. ``max_by`` over text sorts the
    facts in each task, so they are dealt over the tasks first, as many as their size needs and not as many as
    the table has files. Facts of one (symbol, item) are dealt by their order: a symbol with very many
    facts is reduced in all tasks before its facts meet in one.
    """
    dealt = facts.repartition(key, item, order)
    last = dealt.groupBy(key, item).agg(F.max_by(value, order).alias(value))
    listed = F.coalesce(F.col(item).isin(list(items)), F.lit(False))
    wide = [F.max(F.when(F.col(item) == F.lit(name), F.col(value))).alias(name) for name in items]
    if others is not None:
        rest = F.when(~listed & F.col(item).isNotNull(), F.struct(item, value))
        wide.append(F.map_from_entries(F.array_sort(F.collect_list(rest))).alias(others))
    return last.groupBy(key).agg(*wide)
