"""Repeated passages by recompression.

Rounds of recompression rewrite every document over ever larger symbols: a round first names runs of one symbol,
then pairs of a left and a right symbol, where a hash of round and name puts each symbol on a side. A name is
a hash of what it stands for, so all tasks agree on it without meeting, and equal passages get equal
symbols inside. With each symbol goes the range of words that decides it; a symbol whose range lies
in a window of ``WINDOW`` words is the same wherever the window stands.

Every window is tied to one symbol inside it, the one with the smallest name (``anchor``), or to itself
if there is none. Anchors are a few hundredths of the words. Step 1 shuffles the anchors and keeps the
names that two different texts share: only they can show repeats, since of documents with the same words the later
ones lose every word without a look at windows. Texts are told by 48 bits of their digest here. Step 2 reads the documents with such
anchors again and verifies: the windows tied to shared anchors are compared by 96 bits of their whole word
sequence (two hashes over words that are hashed twice), each with the smallest document that has it. Step 3 cuts the covered words.

Anchors and windows are reduced on the map side before they meet; a passage that a third of all documents
share meets in partial minimums and in joins that adaptive execution can split. The first document of
equal texts with many windows sends them; none is collected.

Defined results: null text has no words. Texts under ``WINDOW`` words keep all. Rows that repeat an id are one
document to each other, none of which removes from the other; a row without id neither removes nor
loses words. An empty table gives no rows. A text of any length is read whole; one text has to fit a task. Columns beyond
the two named ones are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import written

WINDOW = 50
ROUNDS = 4
_WINDOW_BASE = np.uint64(0xE7037ED1A0B428DB)


class Symbols:
    """Symbols over the words of a slice of documents, with first and end word of each and of the range
    that decides it. ``text`` is the document of a symbol."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        n = len(words)
        self.name = words
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.first = np.arange(n)
        self.end = self.first + 1
        self.low, self.high = self.first.copy(), self.end.copy()

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """First and end word of the ranges left and right of each symbol; beyond a document nothing can be
        told from inside, so the range there reaches past every window."""
        far = np.int64(1) << 60
        before, after = np.full(len(self.name), -far), np.full(len(self.name), far)
        joined = self.text[1:] == self.text[:-1]
        before[1:][joined] = self.low[:-1][joined]
        after[:-1][joined] = self.high[1:][joined]
        return before, after

    def _take(self, starts: np.ndarray, names: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        ends = np.append(starts[1:], len(self.name)) - 1
        self.name, self.low, self.high = names, low, high
        self.first, self.end = self.first[starts], self.end[ends]
        self.text = self.text[starts]

    def runs(self, number: int) -> None:
        """Name every longest run of one symbol; it is decided by its neighbours, too."""
        from tallyloom.llm.words import mix

        n = len(self.name)
        if not n:
            return
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1])
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, n))
        before, after = self._neighbours()
        names = self.name[starts].copy()
        long = sizes > 1
        names[long] = mix(names[long] + sizes[long].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(number))
        self._take(starts, names, before[starts], after[starts + sizes - 1])

    def pairs(self, number: int) -> None:
        """Name every pair of a left and a right symbol; another symbol is decided by the neighbour
        with which it could have made one."""
        from tallyloom.llm.words import mix

        n = len(self.name)
        if not n:
            return
        left = (mix(self.name + np.uint64(number * 0xD1B54A32D192ED03 % 2**64)) >> np.uint64(63)).astype(bool)
        head = np.zeros(n, dtype=bool)
        head[:-1] = left[:-1] & ~left[1:] & (self.text[1:] == self.text[:-1])
        tail = np.zeros(n, dtype=bool)
        tail[1:] = head[:-1]
        before, after = self._neighbours()
        low = np.where(left, self.low, np.minimum(self.low, before))
        high = np.where(left, np.maximum(self.high, after), self.high)
        starts = np.flatnonzero(~tail)
        names, low, high = self.name[starts].copy(), low[starts], high[starts]
        made = head[starts]
        at = starts[made]
        names[made] = mix(self.name[at] * np.uint64(3) + mix(self.name[at + 1] + np.uint64(number)))
        low[made], high[made] = self.low[at], self.high[at + 1]
        self._take(starts, names, low, high)


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """A hash of every ``window`` consecutive words of the slice, by doubling."""
    from tallyloom.llm.words import mix

    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total, done = np.zeros(n, dtype=np.uint64), 0
    power, size = words, 1
    scale = _WINDOW_BASE
    while True:
        if window & size:
            total = total * scale + power[done : done + n]
            done += size
        if size * 2 > window:
            return mix(total)
        power = power[:-size] * scale + power[size:]
        power = mix(power)
        size *= 2


def anchors(words: np.ndarray, bounds: np.ndarray, window: int, rounds: int):
    """The first word of every window of the slice's documents, its document, its hash and its anchor."""
    from tallyloom.llm.words import mix

    starts = np.arange(max(0, len(words) - window + 1))
    text = np.searchsorted(bounds, starts, side="right") - 1
    inside = starts + window <= bounds[text + 1]
    starts, text = starts[inside], text[inside]
    hashes = window_hashes(words, window)[starts]
    symbols = Symbols(words, bounds)
    for number in range(1, rounds + 1):
        symbols.runs(2 * number)
        symbols.pairs(2 * number + 1)
    usable = (symbols.high - symbols.low <= window) & (symbols.low >= 0)
    # names with the words that decide them tell more passages apart than names alone
    low, high, name = symbols.low[usable], symbols.high[usable], symbols.name[usable]
    size = (high - low).astype(np.uint64)
    name = mix(name + mix(words[low] + np.uint64(1)) * np.uint64(3) + mix(words[high - 1] + size) * np.uint64(5))
    first = np.searchsorted(low, starts, side="left")
    last = np.searchsorted(high, starts + window, side="right")
    none = first >= last
    anchor = mix(hashes + np.uint64(7))
    anchor[~none] = _range_min(name, first[~none], last[~none])
    return starts, text, hashes, anchor


def _range_min(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The smallest value of each range, from minimums over ranges of powers of two."""
    out = np.zeros(len(first), dtype=np.uint64)
    sizes = last - first
    level, width = values, 1
    while len(first) and width <= sizes.max():
        now = (sizes >= width) & (sizes < 2 * width)
        out[now] = np.minimum(level[first[now]], level[last[now] - width])
        if len(level) <= width:
            break
        level = np.minimum(level[:-width], level[width:])
        width *= 2
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _text_parts(batch: pa.RecordBatch):
    from tallyloom.llm.words import slices, word_hashes

    for part in slices(batch, "text"):
        words, bounds = word_hashes(part.column("text"))
        yield part, words, bounds


def _whole(column: pa.Array) -> tuple[list[int], list[str]]:
    """The number of words of each text, and the digest of its words joined by single spaces."""
    counts, digests = [], []
    for text in column:
        words = (text.as_py() or "").encode("utf-8").split()
        counts.append(len(words))
        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
    return counts, digests


def _named(window: int, rounds: int):
    """A row for each document with its words and their digest, and a row for each of its anchors."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words, bounds in _text_parts(batch):
                counts, digests = _whole(part.column("text"))
                ids = part.column("doc_id")
                yield _found_rows(ids, counts, digests, None, None)
                marks = np.array([int(digest[:12], 16) for digest in digests], dtype=np.int64)
                _, text, _, anchor = anchors(words, bounds, window, rounds)
                change = np.ones(len(anchor), dtype=bool)
                change[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
                at = text[change]
                yield _found_rows(ids.take(pa.array(at)), None, None, _signed(anchor[change]), pa.array(marks[at]))

    return names


_FOUND = "doc_id long, n_words long, whole_sha256 string, anchor long, mark long"


def _found_rows(ids: pa.Array, counts, digests, anchor, mark) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.nulls(n, pa.int64()) if counts is None else pa.array(counts, pa.int64()),
            pa.nulls(n, pa.string()) if digests is None else pa.array(digests, pa.string()),
            pa.nulls(n, pa.int64()) if anchor is None else anchor,
            pa.nulls(n, pa.int64()) if mark is None else mark,
        ],
        ["doc_id", "n_words", "whole_sha256", "anchor", "mark"],
    )


def _tied_windows(window: int, rounds: int):
    def tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyloom.llm.words import SECOND, word_hashes

        for batch in batches:
            for part, words, bounds in _text_parts(batch):
                starts, text, hashes, anchor = anchors(words, bounds, window, rounds)
                checks = window_hashes(word_hashes(part.column("text"), values=SECOND)[0], window)[starts]
                checks = (checks >> np.uint64(32)).astype(np.uint32).view(np.int32)
                shared = part.column("anchors")
                kept = np.zeros(len(starts), dtype=bool)
                cuts = np.searchsorted(text, np.arange(part.num_rows + 1))
                for i in range(part.num_rows):
                    a, b = cuts[i], cuts[i + 1]
                    if a < b:
                        names = np.asarray(shared[i].values, dtype=np.int64).view(np.uint64)
                        kept[a:b] = np.isin(anchor[a:b], names)
                text = text[kept]
                rows = part.column("row").take(pa.array(text))
                ids = part.column("doc_id").take(pa.array(text))
                place = (starts[kept] - bounds[text]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids, rows, pa.array(place), _signed(hashes[kept]), pa.array(checks[kept])], ["doc_id", "row", "place", "hash", "check"]
                )

    return tied


def _cut(window: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests, kept_texts = [], [], []
            _, whole = _whole(batch.column("text"))
            for text, places in zip(batch.column("text"), batch.column("places"), strict=True):
                words = (text.as_py() or "").encode("utf-8").split()
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                at = np.asarray(places.values, dtype=np.int64)
                np.add.at(edges, at, 1)
                np.add.at(edges, at + window, -1)
                covered = np.cumsum(edges[:-1]) > 0
                kept = b" ".join([w for w, gone in zip(words, covered.tolist(), strict=True) if not gone])
                removed.append(int(covered.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept.decode("utf-8"))
            arrays = [
                batch.column("doc_id"), pa.array(whole, pa.string()), pa.array(removed, pa.int64()),
                pa.array(digests, pa.string()),
            ]
            names = ["cut_id", "cut_sha256", "cut_words", "cut_kept"]
            if with_text:
                arrays.append(pa.array(kept_texts, pa.string()))
                names.append("cut_text")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return cut


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    rounds: int = ROUNDS,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed`` (words covered by a window that a document with a
    smaller id has, too) and ``kept_sha256`` of the words left, joined by single spaces; with
    ``with_text`` also these (null where nothing is removed)."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    found = written(texts.mapInArrow(_named(window, rounds), _FOUND), "anchors")
    whole = found.where("whole_sha256 is not null").drop("anchor", "mark")
    # the first of documents with the same words stands for all: the others lose every word
    firsts = (
        whole.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
        .groupBy("whole_sha256").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1").drop("copies")
    )
    firsts = written(firsts, "firsts")
    copies = whole.join(firsts, "whole_sha256").where("doc_id > first_id").groupBy("doc_id").agg(F.count("*").alias("copied"))
    # an id that also has a text of its own stays
    rows_of_id = whole.groupBy("doc_id").agg(F.count("*").alias("rows"))
    gone = copies.join(rows_of_id, "doc_id").where("copied = rows").select("doc_id")
    named = found.where("anchor is not null and doc_id is not null").select("doc_id", "anchor", "mark")
    # both sides of the joins below are written tables: a frequent key is then a skew that can be split
    shared = named.groupBy("anchor").agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
    shared = written(shared.where("low < high").select("anchor"), "shared")
    of_doc = (
        named.join(shared, "anchor")
        .groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
        .join(gone, "doc_id", "left_anti")
        .join(rows_of_id, "doc_id")
    )
    # rows of one id are told by their texts
    row = F.when(F.col("rows") > 1, F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    candidates = written(texts.join(of_doc, "doc_id").withColumn("row", row).drop("rows"), "candidates")
    windows = candidates.mapInArrow(_tied_windows(window, rounds), "doc_id long, row long, place int, hash long, check int")
    windows = written(windows, "windows")
    # both hashes together say that two windows are equal: 10^13 windows give less than 0.001 false pairs
    smallest = windows.groupBy("hash", "check").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    smallest = written(smallest.where("low < high").select("hash", "check", "low"), "smallest")
    repeats = (
        windows.join(smallest, ["hash", "check"]).where("doc_id > low")
        .groupBy("doc_id", "row").agg(F.collect_set("place").alias("places"))
    )
    hit = candidates.select("row", "doc_id", "text").join(repeats, ["doc_id", "row"])
    kind = "cut_id long, cut_sha256 string, cut_words long, cut_kept string" + (", cut_text string" if with_text else "")
    cut = hit.mapInArrow(_cut(window, with_text), kind).dropDuplicates(["cut_id", "cut_sha256"])
    rows = whole.join(firsts, "whole_sha256", "left").join(
        cut, (F.col("doc_id") == F.col("cut_id")) & (F.col("whole_sha256") == F.col("cut_sha256")), "left"
    )
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)) & (F.col("n_words") >= window)
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.select(
        F.col("doc_id").alias(id_column),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut_words", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("cut_kept", "whole_sha256")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("cut_text")).alias("kept_text")] if with_text else []),
    )
