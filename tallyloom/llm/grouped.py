"""Arrow rows that arrive sorted by group, one whole group at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal keys (numbers, without nulls); a group may span batches."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([np.asarray(batch.column(k)) for k in keys], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            here = tuple(values[a].tolist())
            if held and here != at:
                yield pa.Table.from_batches(held)
                held = []
            at = here
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Rows of equally long binary values as a matrix of numbers."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=kind).reshape(len(values), -1)
