"""Packing documents into sequences of a fixed number of tokens by the sum-of-squares rule.

A document's ids, closed by an end id, fill whole sequences first. Its rest goes, in the order of arrival,
to the fill level that leaves the smallest sum of squared counts of partially filled sequences by
level; only an array of counts by level is looked at. At the end of a task the sequences still
open are closed: the emptiest ones are cut up to fill the fullest, and what is left of the last is laid
out in sequences of powers of two, which need no padding. So a task pads nothing, and tasks need not
meet: nothing is shuffled, and a lost task is packed again in the same way.

Defined results: null and empty texts are the end id alone. Rows that repeat are packed each. An empty
table gives no pieces. A document is encoded whole; a task holds a few megabytes of text at a time. Columns beyond
the two named ones are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 2048
END = 1
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
_BITS = 40


class Levels:
    """Sequences that are partially filled, by the sum-of-squares rule over a level array."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.counts = np.zeros(length + 1, dtype=np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(length + 1)]

    def choose(self, size: int) -> int:
        """The level from 0 (a new sequence) at which ``size`` more tokens are best placed."""
        top = self.length - size
        counts = self.counts
        # the change of the sum of squares: 2 (count after - count before) + 2, alike but for full ones
        change = counts[size : size + top + 1] - counts[: top + 1]
        change = 2 * change + 2
        change[top] -= 2 * counts[self.length] + 1
        change[0] += 2 * counts[0] - 1
        change[1:][counts[1 : top + 1] == 0] = np.iinfo(np.int64).max
        return int(np.argmin(change))

    def place(self, piece: tuple, size: int) -> list[tuple] | None:
        """Put a piece; the pieces of its sequence if that is full now."""
        level = self.choose(size)
        sequence = []
        if level:
            sequence = self.open[level].pop()
            self.counts[level] -= 1
        sequence.append(piece)
        if level + size == self.length:
            return sequence
        self.open[level + size].append(sequence)
        self.counts[level + size] += 1
        return None

    def close(self) -> Iterator[list[tuple]]:
        """Close all sequences: pieces of the emptiest are cut to fill the fullest."""
        left = [sequence for level in self.open for sequence in level]
        first, last, spare = 0, len(left) - 1, []
        while last >= first:
            sequence = left[last]
            room = self.length - sum(len(p[2]) for p in sequence)
            while room and (spare or first < last):
                if not spare:
                    spare = left[first]
                    first += 1
                doc, start, ids, tokens = spare.pop()
                sequence.append((doc, start, ids[:room], tokens))
                if len(ids) > room:
                    spare.append((doc, start + room, ids[room:], tokens))
                room -= min(room, len(ids))
            last -= 1
            if room == 0:
                yield sequence
            else:
                yield from self._powers(sequence)
        if spare:
            yield from self._powers(spare)

    def _powers(self, pieces: list[tuple]) -> Iterator[list[tuple]]:
        total = sum(len(p[2]) for p in pieces)
        pieces = pieces[::-1]
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            sequence = []
            while room:
                doc, start, ids, tokens = pieces.pop()
                sequence.append((doc, start, ids[:room], tokens))
                if len(ids) > room:
                    pieces.append((doc, start + room, ids[room:], tokens))
                room -= min(room, len(ids))
            yield sequence


class _Rows:
    """Pieces of closed sequences, until they are sent on."""

    def __init__(self, task: int, with_ids: bool):
        self.next = task << _BITS
        self.with_ids = with_ids
        self.rows: list[tuple] = []
        self.held = 0

    def add(self, sequence: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, tokens in sequence:
            row = (doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, self.next, offset)
            self.rows.append((*row, ids) if self.with_ids else row)
            offset += len(ids)
        self.held += offset if self.with_ids else 0
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*self.rows, strict=True)) or [[] for _ in range(len(names) + self.with_ids)]
        arrays = [pa.array(c, pa.int64()) for c in columns[: len(names)]]
        if self.with_ids:
            names.append("ids")
            arrays.append(pa.array([i.tolist() for i in columns[-1]], pa.list_(pa.int32())))
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays(arrays, names)


def _pack(tokenizer: str, length: int, end: int, with_ids: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from tallyloom.llm.words import slices

        encoder = _encoder(tokenizer)
        rows = _Rows(TaskContext.get().partitionId(), with_ids)
        levels = Levels(length)
        closing = np.array([end], dtype="<u4")
        for batch in batches:
            for part in slices(batch, "text"):
                docs = part.column("doc_id").to_pylist()
                for doc, ids in zip(docs, encoder.encode(part.column("text")), strict=True):
                    ids = np.concatenate([ids.astype("<u4", copy=False), closing])
                    whole = len(ids) - len(ids) % length
                    for start in range(0, whole, length):
                        rows.add([(doc, start, ids[start : start + length], len(ids))])
                    if whole < len(ids):
                        rest = ids[whole:].copy()
                        full = levels.place((doc, whole, rest, len(ids)), len(rest))
                        if full:
                            rows.add(full)
                    if len(rows.rows) >= 1 << 15 or rows.held >= 1 << 21:
                        yield rows.batch()
        for sequence in levels.close():
            rows.add(sequence)
        yield rows.batch()

    return pack


_ENCODERS: dict = {}


def _encoder(path: str):
    """One encoder for each Python worker: what it has learnt of pieces serves its later tasks."""
    from tallyloom.llm.tokens import Encoder

    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it starts in its document, its length, the CRC-32 of its ids, its
    document's tokens, its sequence and its place there; with ``with_ids`` also the ids."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(
        _pack(tokenizer, length, end, with_ids), PIECES + (", ids array<int>" if with_ids else "")
    )
