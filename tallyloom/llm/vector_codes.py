"""Vector codes: product quantisation in integers, nearest entries by Orchard search.

A vector of integers (``fixed_point``) is cut into ``parts`` equal consecutive pieces; each position has a
codebook of at most ``entries`` entries. The codebooks start as the pieces of the rows with the smallest ids, and
each round assigns every piece to its nearest entry and moves every entry to the floored mean of its pieces.

Orchard search. Every entry keeps the list of all entries sorted by their distance to it. A search holds an
entry and walks down its list; an entry nearer to the piece is jumped to and its list walked from the
top, entries met before are marked and skipped. The walk ends beyond twice the current distance: an entry x with
d(x, entry) > 2 d(piece, entry) is farther from the piece than the held one. On squared distances that is a
factor of 4, in integers and exact. At exactly twice the distance the walk goes on, so ties are met and go to the lower index. All
searches of a batch take their steps together.

A task holds a batch of rows and the codebooks; per round it leaves one row of sums and counts for each entry that it
used. The driver holds the codebooks only (``parts`` x ``entries`` rows, whatever the table).

Defined results: rows without id and vectors that ``fixed_point`` leaves out are dropped, as are vectors whose length is not
that of the first kept row (by id, then content); that length must be a multiple of ``parts``.
Rows that repeat an id are rows of their own; of such rows the smaller vector starts a codebook first. Fewer
rows than ``entries`` give smaller codebooks. Null labels are equal to each other. An empty table gives no rows.
Columns beyond the three named ones are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.fixed_point import integer_rows, numbers
from tallyloom.llm.tables import written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
_ROWS = 4096


def neighbours(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry all entries by distance (then index), and the squared distances in that order."""
    apart = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    order = np.argsort(apart, axis=1, kind="stable")
    return order, np.take_along_axis(apart, order, axis=1)


def orchard(pieces: np.ndarray, book: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry of each piece; ties go to the lower index."""
    order, apart = lists
    size, entries = len(pieces), len(book)
    best = np.zeros(size, dtype=np.int64)
    distance = ((pieces - book[0]) ** 2).sum(axis=1)
    at, place, near = best.copy(), np.zeros(size, dtype=np.int64), distance.copy()
    met = np.zeros((size, entries), dtype=bool)
    met[:, 0] = True
    active = np.arange(size)
    while len(active):
        held = at[active]
        inside = place[active] < entries
        active, held = active[inside], held[inside]
        step = place[active]
        inside = apart[held, step] <= 4 * near[active]
        active, held, step = active[inside], held[inside], step[inside]
        candidate = order[held, step]
        place[active] = step + 1
        fresh = ~met[active, candidate]
        rows, candidate = active[fresh], candidate[fresh]
        met[rows, candidate] = True
        found = ((pieces[rows] - book[candidate]) ** 2).sum(axis=1)
        better = (found < distance[rows]) | ((found == distance[rows]) & (candidate < best[rows]))
        best[rows[better]], distance[rows[better]] = candidate[better], found[better]
        jump = found < near[rows]
        rows, candidate, found = rows[jump], candidate[jump], found[jump]
        at[rows], place[rows], near[rows] = candidate, 0, found
    return best, distance


def _assign(vectors: np.ndarray, books: np.ndarray, lists: list) -> tuple[np.ndarray, np.ndarray]:
    parts, _, width = books.shape
    code = np.empty((len(vectors), parts), dtype=np.int64)
    error = np.zeros(len(vectors), dtype=np.int64)
    for p in range(parts):
        code[:, p], apart = orchard(np.ascontiguousarray(vectors[:, p * width : (p + 1) * width]), books[p], lists[p])
        error += apart
    return code, error


def _pieces(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS):
            part = batch.slice(i, _ROWS)
            yield part, numbers(part.column("vector"), dim)


def _sums(books: np.ndarray):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.shape
        lists = [neighbours(book) for book in books]
        total = np.zeros_like(books)
        count = np.zeros((parts, entries), dtype=np.int64)
        for _, vectors in _pieces(batches, parts * width):
            code, _ = _assign(vectors, books, lists)
            for p in range(parts):
                np.add.at(total[p], code[:, p], vectors[:, p * width : (p + 1) * width])
                count[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p), pa.array(e), pa.array(count[p, e]), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))],
            ["part", "entry", "n", "total"],
        )

    return add


def _codes(books: np.ndarray):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, width = books.shape
        lists = [neighbours(book) for book in books]
        for batch, vectors in _pieces(batches, parts * width):
            found, error = _assign(vectors, books, lists)
            hexed = [row.tobytes().hex() for row in found.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(hexed, pa.string()), pa.array(error)],
                ["id", "label", "code", "error"],
            )

    return code


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; unused entries stay."""
    width = books.shape[2]
    sums = rows.select("vector").mapInArrow(_sums(books), "part long, entry long, n long, total array<long>")
    sums = sums.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total")
    )
    moved = books.copy()
    for r in sums.collect():
        moved[r["part"], r["entry"]] = np.array(r["total"], dtype=np.int64) // r["n"]
    return moved


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``(id, label, code, error)`` per kept row, as a written table, and the codebooks
    (parts x entries x components). Entries are numbered in a byte: at most 256."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    rows = written(integer_rows(vectors, id_column, vector_column, label_column), "integers")
    seeds = rows.orderBy("id", "vector").limit(1).collect()
    if seeds:
        dim = seeds[0]["dim"]
        if dim % parts:
            raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
        rows = rows.where(F.col("dim") == dim)
        seeds = rows.orderBy("id", "vector").limit(entries).collect()
        books = np.array([r["vector"] for r in seeds], dtype=np.int64).reshape(len(seeds), parts, dim // parts)
        books = np.ascontiguousarray(books.transpose(1, 0, 2))
    else:
        books = np.zeros((parts, 0, 1), dtype=np.int64)
    for _ in range(rounds if seeds else 0):
        books = _moved(rows, books)
    label = rows.schema["label"].dataType.simpleString()
    coded = rows.select("id", "label", "vector").mapInArrow(_codes(books), f"id long, label {label}, code string, error long")
    return written(coded, "vector-codes"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """The coded rows and ``label_error``, the error summed over the rows of equal label."""
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "of")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def decoded(code: str, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[p, e] for p, e in enumerate(bytes.fromhex(code))])
