"""Compare a registered query with its SQL twin, column by column and row by row."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if hasattr(value, "date") and callable(value.date):
        return value.isoformat()
    return value.isoformat() if hasattr(value, "isoformat") else value


def _rows(records, order):
    return Counter(tuple(_plain(record[i]) for i in order) for record in records)


_KINDS = {
    "tinyint": "int32", "smallint": "int32", "integer": "int32", "int": "int32",
    "bigint": "int64", "varchar": "string",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs; an empty list when names, types and values are the same."""
    cursor = con.execute(sql)
    twin_types = {name[0]: str(name[1]).lower() for name in cursor.description}
    twin = cursor.fetchall()
    names = sorted(df.columns)
    if names != sorted(twin_types):
        return [f"columns {names} and {sorted(twin_types)}"]
    types = {name: _KINDS.get(kind, kind) for name, kind in df.dtypes}
    twin_kinds = {name: _KINDS.get(kind, kind) for name, kind in twin_types.items()}
    found = [
        f"type of {name}: {types[name]} and {twin_kinds[name]}"
        for name in names
        if types[name] != twin_kinds[name]
    ]
    rows = df.collect()
    if len(rows) != len(twin):
        return [*found, f"{len(rows)} and {len(twin)} rows"]
    ours = _rows(rows, [df.columns.index(name) for name in names])
    theirs = _rows(twin, [list(twin_types).index(name) for name in names])
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        found.append(f"{extra.total()} rows differ {names}: {next(iter(extra))} {next(iter(missing))}")
    return found
