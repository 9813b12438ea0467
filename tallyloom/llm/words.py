"""Words and word n-grams of Arrow text columns as 64-bit hashes, a slice of rows at a time.

A word is a longest run of bytes other than the space and 0x09 to 0x0D. Hashes depend on the bytes
alone, so equal words have equal names in every task. Null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_PIECE = 1 << 18

BYTES = np.arange(256, dtype=np.uint8)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = BYTES.copy()
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, salt: int) -> np.ndarray:
    """``n`` odd 64-bit values that depend on the salt alone."""
    seeds = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(seeds + np.uint64(salt)) | np.uint64(1)


_LETTERS = constants(256, 11)
#: Values of letters for a second hash, which tells words apart that the first does not.
SECOND = constants(256, 31)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.cumprod(np.full(_PIECE, _BASE, dtype=np.uint64))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with at most ``limit`` bytes of text, one row at least."""
    size = np.diff(buffers(batch.column(column))[0])
    first, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if total and total + n > limit:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n
    if first < batch.num_rows:
        yield batch.slice(first)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a text column; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, dtype=np.int64)
    if data is None:
        return offsets - offsets[0], np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]


def _runs(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of every word."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    edge[-1] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends - starts


def word_hashes(
    column: pa.Array, letters: np.ndarray = BYTES, values: np.ndarray = _LETTERS
) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the index of each row's first word (one more than rows).

    ``letters`` maps bytes before hashing, such as ``LOWER``; ``values`` are the letters' numbers, such as ``SECOND``.
    """
    offsets, data = buffers(column)
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(column) + 1, dtype=np.int64)
    starts, lengths = _runs(offsets, data)
    bounds = np.searchsorted(starts, offsets)
    kept = letters[data[~_SPACE[data]]]
    at = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=at[1:])
    hashes = np.empty(len(lengths), dtype=np.uint64)
    word = 0
    while word < len(lengths):
        last = max(word + 1, int(np.searchsorted(at, at[word] + _PIECE, side="right")) - 1)
        if at[last] - at[word] <= _PIECE:
            place = np.arange(at[last] - at[word]) - np.repeat(at[word:last] - at[word], lengths[word:last])
            parts = values[kept[at[word] : at[last]]] * _POWERS[place]
            hashes[word:last] = np.add.reduceat(parts, at[word:last] - at[word])
        else:
            hashes[word] = _long_word(kept[at[word] : at[last]], values)
        word = last
    return mix(hashes + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), bounds


def _long_word(letters: np.ndarray, values: np.ndarray) -> np.uint64:
    total, scale = 0, 1
    for i in range(0, len(letters), _PIECE):
        part = letters[i : i + _PIECE]
        total += int(np.add.reduce(values[part] * _POWERS[: len(part)])) * scale
        scale = scale * int(_POWERS[len(part) - 1]) % (1 << 64)
    return np.uint64(total % (1 << 64))


_GRAM = constants(64, 23)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each ``n`` consecutive words (across rows too: the caller knows the bounds)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        total += words[j : len(words) - n + 1 + j] * _GRAM[j]
    return mix(total)


def sequence_hash(words: np.ndarray) -> np.uint64:
    """A hash for a short row of words that differs from every n-gram hash of longer rows."""
    total = np.add.reduce(words * _GRAM[8 : 8 + len(words)]) + np.uint64(len(words))
    return mix(np.array([total], dtype=np.uint64))[0]
