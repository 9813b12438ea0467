"""Ids of a public byte-level BPE tokenizer, many texts at a time.

The tokenizer splits a text into pieces (a word with the space before it, a run of digits, ...) and merges
within a piece only. Pieces repeat, so each task keeps the ids of those it has met: pieces are cut
and named for a whole slice of texts at once, and the tokenizer itself encodes only new ones. Texts
with characters outside the ranges below, or with the text of a special token, go to it whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

from tallyloom.llm.words import buffers, constants, mix

_SPECIAL = "<|endoftext|>"
#: Code points whose class is the same in every version of the character tables.
_KNOWN = 0x250
_CACHE = 1 << 20
_LETTER, _NUMBER, _SPACE, _OTHER, _UNSURE = 0, 1, 2, 3, 4


def _classes() -> np.ndarray:
    kinds = np.full(_KNOWN, _OTHER, dtype=np.uint8)
    for point in range(_KNOWN):
        category = unicodedata.category(chr(point))
        if category[0] == "L":
            kinds[point] = _LETTER
        elif category[0] == "N":
            kinds[point] = _NUMBER
    kinds[[9, 10, 11, 12, 13, 32]] = _SPACE
    kinds[[0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0]] = _UNSURE
    return kinds


def _byte_letters() -> dict[int, int]:
    """The letter by which byte-level tokenizers write each byte: printable ones themselves, the
    others in turn from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 0x100 + i for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()
_KINDS = _classes()
_LETTERS = constants(256, 31)
_BASE = np.uint64(0xA0761D6478BD642F)


class Encoder:
    """Ids of texts by the tokenizer file at ``path``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._powers = np.cumprod(np.full(64, _BASE, dtype=np.uint64))
        self._clear()

    def _clear(self) -> None:
        self._names = np.zeros(0, dtype=np.uint64)  # sorted names of the pieces met so far
        self._first = np.zeros(0, dtype=np.int64)
        self._count = np.zeros(0, dtype=np.int64)
        self._ids = np.zeros(0, dtype=np.uint32)

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text of an Arrow text column, without special tokens added."""
        offsets, data = buffers(column)
        out: list[np.ndarray | None] = [None] * len(column)
        plain = self._plain(offsets, data)
        whole = np.flatnonzero(~plain).tolist()
        if whole:
            texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8") for i in whole]
            for i, e in zip(whole, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, dtype=np.uint32)
        if plain.any():
            rows = np.flatnonzero(plain)
            kept = np.repeat(plain, np.diff(offsets))
            sizes = np.diff(offsets)[rows]
            at = np.zeros(len(rows) + 1, dtype=np.int64)
            np.cumsum(sizes, out=at[1:])
            for i, ids in zip(rows.tolist(), self._encode_plain(at, data[kept]), strict=True):
                out[i] = ids
        return out

    def _plain(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Texts of known characters only, without special tokens' text."""
        odd = (data >= 0xCA) | ((data >= 0x1C) & (data <= 0x1F))  # lead bytes from U+0280 on
        after = np.flatnonzero(data == 0xC2) + 1
        after = after[after < len(data)]
        odd[after] |= (data[after] == 0x85) | (data[after] == 0xA0)
        after = np.flatnonzero(data == 0xC9) + 1
        after = after[after < len(data)]
        odd[after] |= data[after] >= 0x90
        pipe = np.flatnonzero(data == ord("|"))
        if len(pipe):
            odd[pipe[(data[np.maximum(pipe - 1, 0)] == ord("<"))]] = True
        sums = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(odd, out=sums[1:])
        return sums[offsets[1:]] == sums[offsets[:-1]]

    def _encode_plain(self, offsets: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
        if not len(data):
            return [np.zeros(0, dtype=np.uint32)] * (len(offsets) - 1)
        starts = _pieces(offsets, data)
        ends = np.append(starts[1:], len(data))
        names = self._name(data, starts, ends)
        at = self._find(names, data, starts, ends)
        counts = self._count[at]
        total = np.zeros(len(counts) + 1, dtype=np.int64)
        np.cumsum(counts, out=total[1:])
        source = np.arange(total[-1]) + np.repeat(self._first[at] - total[:-1], counts)
        ids = self._ids[source]
        cuts = total[np.searchsorted(starts, offsets)]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def _name(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - starts
        if sizes.max() > len(self._powers):
            self._powers = np.cumprod(np.full(int(sizes.max()), _BASE, dtype=np.uint64))
        place = np.arange(len(data)) - np.repeat(starts, sizes)
        sums = np.add.reduceat(_LETTERS[data] * self._powers[place], starts)
        return mix(sums + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def _find(self, names: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of the names among the pieces met so far, after adding new ones."""
        if len(self._names) > _CACHE:
            self._clear()
        unique, first, back = np.unique(names, return_index=True, return_inverse=True)
        at = np.searchsorted(self._names, unique)
        known = at < len(self._names)
        known[known] = self._names[at[known]] == unique[known]
        new = np.flatnonzero(~known)
        if len(new):
            bytes_of = (data[starts[i] : ends[i]].tobytes() for i in first[new].tolist())
            found = [
                [t.id for t in self.tokenizer.model.tokenize(piece.decode("latin-1").translate(_BYTE_LETTERS))]
                for piece in bytes_of
            ]
            counts = np.array([len(f) for f in found], dtype=np.int64)
            firsts = len(self._ids) + np.cumsum(counts) - counts
            self._ids = np.concatenate([self._ids, np.array([i for f in found for i in f], dtype=np.uint32)])
            merged = np.concatenate([self._names, unique[new]])
            order = np.argsort(merged, kind="stable")
            self._names = merged[order]
            self._first = np.concatenate([self._first, firsts])[order]
            self._count = np.concatenate([self._count, counts])[order]
            at = np.searchsorted(self._names, unique)
        return at[back]


def _pieces(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """First byte of every piece: contractions, then letters, numbers or others with a space before
    them, then white space, of which the last space goes with what follows."""
    lead = (data & 0xC0) != 0x80
    points = data[lead].astype(np.uint16)
    place = np.flatnonzero(lead)
    two = np.flatnonzero(points >= 0xC0)
    points[two] = ((points[two] & 0x1F) << 6) | (data[place[two] + 1] & 0x3F)
    kinds = _KINDS[points]
    n = len(kinds)
    text_start = np.zeros(n + 1, dtype=bool)
    text_start[np.searchsorted(place, offsets)] = True
    text_start[n] = True
    change = np.ones(n, dtype=bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change |= text_start[:-1]
    # the last character of white space starts a piece of its own, or with what follows after a space
    last_space = (kinds == _SPACE) & np.append(change[1:], True) & ~text_start[1:]
    start = change | last_space
    after = np.flatnonzero(last_space & (points == 32)) + 1
    start[after] = False
    marks = np.flatnonzero((points == ord("'")) & start)
    if len(marks):
        _contractions(points, kinds, start, text_start, marks)
    return place[start]


def _contractions(points, kinds, start, text_start, marks) -> None:
    """'s 't 're 've 'm 'll 'd at the start of a piece are pieces; the rest of the word is one too."""
    n = len(points)
    for i in marks.tolist():
        if not start[i]:
            continue
        size = 0
        if i + 1 < n and not text_start[i + 1]:
            one = chr(points[i + 1])
            two = one + chr(points[i + 2]) if i + 2 < n and not text_start[i + 2] else ""
            size = 2 if one in "stmd" else 3 if two in ("re", "ve", "ll") else 0
        if size:
            start[i + 1 : i + size] = False
            if i + size < n:
                start[i + size] = True
