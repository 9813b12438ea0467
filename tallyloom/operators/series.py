"""Operators over daily series.

A series is the rows of one (symbol, adjust_type), one row per day, so its length is bounded by
the calendar however many symbols there are. Every window below is partitioned by the series keys
and ordered by day: chained operators share one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SERIES_KEYS = ("symbol", "adjust_type")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _series(keys: Sequence[str]) -> str:
    return "partition by " + ", ".join(_quoted(key) for key in keys)


def _present(dtypes: dict[str, str], name: str) -> str:
    """The column as SQL text, with NaN read as missing."""
    quoted = _quoted(name)
    return f"nanvl({quoted}, null)" if dtypes[name] in ("float", "double") else quoted


def forward_fill(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "dt",
) -> DataFrame:
    """Missing values take the last earlier value of the series; a gap at the start stays null."""
    dtypes = dict(df.dtypes)
    if columns is None:
        columns = [name for name in dtypes if name not in (*keys, order)]
    so_far = (
        f"over ({_series(keys)} order by {_quoted(order)}"
        " rows between unbounded preceding and current row)"
    )
    return df.withColumns(
        {name: F.expr(f"last({_present(dtypes, name)}, true) {so_far}") for name in columns}
    )


def clip_to_sigma(
    df: DataFrame,
    columns: Sequence[str] = ("open", "high", "low", "close"),
    keys: Sequence[str] = SERIES_KEYS,
    width: float = 3.0,
) -> DataFrame:
    """Limit each column to mean ± ``width`` sample standard deviations of its series.

    A series without a deviation (one value) is left as it is, and a null stays null.
    """
    dtypes = dict(df.dtypes)
    whole = f"over ({_series(keys)})"
    clipped = {}
    for name in columns:
        if name in dtypes:
            value = _present(dtypes, name)
            mean, reach = f"avg({value}) {whole}", f"{width}D * stddev_samp({value}) {whole}"
            clipped[name] = F.expr(
                f"if({value} is null, null,"
                f" least(greatest({value}, {mean} - {reach}), {mean} + {reach}))"
            )
    return df.withColumns(clipped)


def daily_return(
    df: DataFrame,
    value: str = "close",
    name: str = "daily_return",
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "dt",
) -> DataFrame:
    """Change against the row before, as a fraction; null on a zero base."""
    current = _present(dict(df.dtypes), value)
    before = f"lag({current}) over ({_series(keys)} order by {_quoted(order)})"
    return df.withColumn(name, F.expr(f"try_divide({current}, {before}) - 1"))


def moving_average(
    df: DataFrame,
    rows: int,
    value: str = "close",
    name: str | None = None,
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "dt",
) -> DataFrame:
    """Mean of the last ``rows`` rows, null until all of them hold a value."""
    column = _present(dict(df.dtypes), value)
    frame = (
        f"over ({_series(keys)} order by {_quoted(order)}"
        f" rows between {rows - 1} preceding and current row)"
    )
    mean = F.expr(f"if(count({column}) {frame} = {rows}, avg({column}) {frame}, null)")
    return df.withColumn(name or f"ma{rows}", mean)
