"""Language-model scores by a class-based bigram model with exchange clustering.

Tokens are the words of a text with A-Z in lower case, then one end of text. Every word belongs to one class, and
P(w | v) = P(class of w | class of v) P(w | class of w), where the first word follows an end.

Exchange clustering. A word's counts of classes after it and before it tell, for every class, how much the
likelihood of the corpus changes if the word moves there; the word takes the best class (the lower one of
equals). Words are weighed against the class counts at the start of a round, so the result does not depend on the
partitioning; as moves at one time could chase each other, a round moves half of the words, by their
hash, and where the likelihood falls all the same it goes back and moves half as many. The ``BANDS[0]`` commonest words are exchanged for ``ROUNDS`` rounds, while all others are one class of their own, and the
assignment of the greatest likelihood stays. Then the next commonest words leave that class for their best one, a
band of ranks at a time, and at last all the other words do.

Smoothing. Class transitions are interpolated with the class frequencies by Witten-Bell weights. In each class the words
seen once stand for the words not seen: an unknown word has the class's share of them. Its class is not known, so the
score sums over all classes it could have (a forward step). The probabilities of all words and one unknown word
add up to 1 after every class.

At scale. Texts are read twice: to count words, and to turn them into numbers, which are written. The ``LOCAL`` commonest
words of all texts travel to the tasks (as hashes, counts and classes); a round is a pass over the numbers
that leaves counts of (word, class) by blocks of words, added up by block. Tokens of other
words meet by word, to get their class and count, and go back to their texts, all without the text. A word that is
not among the commonest has at most one in ``LOCAL`` of all tokens, so no word is a hot spot; a common word that
training lacks is not sent to its name. The driver holds ``LOCAL`` words and class tables, whatever the
corpus. Words are told by 64-bit hashes.

Defined results: null text is empty and consists of its end. A row without id is for training. Rows that repeat are texts of
their own. Without training rows all but the end is unknown and ``base_score`` is 0. An empty table gives no
rows. A text of any length is read whole; one text has to fit a task. Columns beyond the two named ones are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import written
from tallyloom.llm.words import LOWER, mix, slices, word_hashes

CLASSES = 64
ROUNDS = 10
BANDS = (1 << 14,)
LOCAL = 1 << 18
_END, _OPEN, _FIRST = 0, 1, 2
_END_CLASS, _OPEN_CLASS = 0, 1
_WORDS_AT_ONCE = 2048
_ENTRIES_AT_ONCE = 1 << 14
_TOKENS_AT_ONCE = 2 << 20
_BLOCK = 256
_CELLS = 1 << 22
_SLICE = 8 << 20


class Common(NamedTuple):
    """The commonest words by rank: hash, and count in the training texts."""

    word: np.ndarray
    n: np.ndarray


class Model(NamedTuple):
    """Classes and counts of the common words (``kind`` by number, with end and open first), and the class tables."""

    common: Common
    kind: np.ndarray
    texts: int
    tokens: int
    distinct: int
    transitions: np.ndarray
    emission: np.ndarray
    unknown: np.ndarray


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0

    def counted() -> pa.RecordBatch:
        word, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        n = np.bincount(at, minlength=len(word))
        train = np.bincount(at, weights=np.concatenate([t for _, t in held]), minlength=len(word)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(word), pa.array(train), pa.array(n)], ["word", "n", "all"])

    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            words, bounds = word_hashes(part.column("text"), LOWER)
            train = ~part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            held.append((words.view(np.int64), np.repeat(train, np.diff(bounds))))
            size += len(words)
            if size >= _TOKENS_AT_ONCE:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def count_words(texts: DataFrame) -> DataFrame:
    """``(word, n, all)``: occurrences in the training texts and in all, as a written table."""
    counts = texts.select("held_out", "text").mapInArrow(_counts, "word long, n long, all long")
    return written(counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("all").alias("all")), "words")


def commonest(counts: DataFrame, limit: int) -> Common:
    rows = counts.orderBy(F.desc("all"), "word").limit(limit).select("word", "n").toArrow()
    return Common(np.asarray(rows.column("word"), dtype=np.int64), np.asarray(rows.column("n"), dtype=np.int64))


def _numbers(common: Common):
    order = np.argsort(common.word)
    names = common.word[order]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                words, bounds = word_hashes(part.column("text"), LOWER)
                words = words.view(np.int64)
                code = np.full(len(words), _OPEN, dtype="<u4")
                if len(names):
                    at = np.minimum(np.searchsorted(names, words), len(names) - 1)
                    found = names[at] == words
                    code[found] = order[at[found]] + _FIRST
                places = np.flatnonzero(code == _OPEN)
                opened = words[places].astype("<i8")
                stream = np.insert(code, bounds[1:], _END)
                bounds_open = np.searchsorted(places, bounds)
                bounds = bounds + np.arange(len(bounds))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("held_out"),
                        pa.array([stream[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                        pa.array([opened[a:b].tobytes() for a, b in zip(bounds_open[:-1], bounds_open[1:], strict=True)], pa.binary()),
                    ],
                    ["id", "held_out", "codes", "open"],
                )

    return number


def numbered(texts: DataFrame, common: Common) -> DataFrame:
    """Texts as numbers: a written table of ``id``, ``held_out``, ``codes`` (end 0, other words 1, common words
    from 2 by rank), ``open`` (the hashes of the other words) and ``row``."""
    rows = texts.select("id", "held_out", "text").mapInArrow(
        _numbers(common), "id long, held_out boolean, codes binary, open binary"
    )
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "numbers", "zstd")


def _runs(batches: Iterator[pa.RecordBatch], limit: int = _TOKENS_AT_ONCE) -> Iterator[np.ndarray]:
    """The numbers of whole texts one after the other, about ``limit`` at a time."""
    held, size = [], 0
    for batch in batches:
        for value in batch.column("codes").to_pylist():
            held.append(value)
            size += len(value) // 4
            if size >= limit:
                yield np.frombuffer(b"".join(held), dtype="<u4")
                held, size = [], 0
    if held:
        yield np.frombuffer(b"".join(held), dtype="<u4")


def _blob(at: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    return at.astype("<u2").tobytes(), n.astype("<i8").tobytes()


_PROFILES = "block long, at binary, n binary"


def _profile(kind: np.ndarray, turn: np.ndarray, classes: int):
    """Counts of (word, class after, class before) for the words whose turn it is, and of class after class."""
    slot = np.full(len(kind), -1, dtype=np.int64)
    slot[turn] = np.arange(len(turn))
    wide = 2 * classes + 1

    def rows(cell: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        blocks, starts = np.unique(cell // (wide * _BLOCK), return_index=True)
        ends = np.r_[starts, len(cell)][1:]
        blobs = [_blob(cell[a:b] - k * wide * _BLOCK, n[a:b]) for k, a, b in zip(blocks, starts, ends, strict=True)]
        if blobs:
            at, counts = zip(*blobs, strict=True)
            yield _profile_rows(blocks.tolist(), at, counts)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = np.zeros(classes * classes, dtype=np.int64)
        # few words: one table of all their counts in the task; many: the counts of each run of tokens
        total = np.zeros(len(turn) * wide if len(turn) * wide <= _CELLS else 0, dtype=np.int64)
        for stream in _runs(batches):
            before = np.r_[np.uint32(_END), stream[:-1]]
            here, there = kind[stream], kind[before]
            matrix += np.bincount(there * classes + here, minlength=classes * classes)
            one, other = slot[before], slot[stream]
            left, right = one >= 0, other >= 0
            same = left & (before == stream)
            cells = np.concatenate(
                [one[left] * wide + here[left], other[right] * wide + classes + there[right], one[same] * wide + 2 * classes]
            )
            if len(total):
                total += np.bincount(cells, minlength=len(total))
            elif len(cells):
                yield from rows(*np.unique(cells, return_counts=True))
        at = np.flatnonzero(total)
        yield from rows(at, total[at])
        at = np.flatnonzero(matrix)
        if len(at):
            yield _profile_rows([-1], *([x] for x in _blob(at, matrix[at])))

    return profile


def _profile_rows(block, at, n) -> pa.RecordBatch:
    columns = [pa.array(block, pa.int64()), pa.array(list(at), pa.binary()), pa.array(list(n), pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["block", "at", "n"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, added up."""
    total, now = np.zeros(1 << 16, dtype=np.int64), None

    def done() -> pa.RecordBatch:
        at = np.flatnonzero(total)
        return _profile_rows([now], *([x] for x in _blob(at, total[at])))

    for batch in batches:
        for block, at, n in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "n")), strict=True):
            if block != now:
                if now is not None:
                    yield done()
                total[:], now = 0, block
            total[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<i8")
    if now is not None:
        yield done()


def _profiles(train: DataFrame, kind: np.ndarray, turn: np.ndarray, classes: int) -> tuple[DataFrame, np.ndarray]:
    """The counts of the words in ``turn``, and of class after class."""
    parts = train.select("codes").mapInArrow(_profile(kind, turn, classes), _PROFILES)
    parts = parts.repartition("block").sortWithinPartitions("block")
    blocks = written(parts.mapInArrow(_added, _PROFILES), "profiles", "zstd")
    matrix = np.zeros(classes * classes)
    for r in blocks.where("block = -1").collect():
        matrix[np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<i8")
    return blocks.where("block >= 0"), matrix.reshape(classes, classes)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(matrix: np.ndarray) -> float:
    """The part of the corpus's log-likelihood that depends on the classes."""
    return float(_xlogx(matrix).sum() - 2 * _xlogx(matrix.sum(axis=1)).sum())


def gains(
    own: np.ndarray, word: np.ndarray, at: np.ndarray, n: np.ndarray, repeats: np.ndarray, matrix: np.ndarray
) -> np.ndarray:
    """What each class adds to the likelihood when a word, taken out of its own one, is put there (words x classes).

    ``word``, ``at`` and ``n`` are the words' counts, sorted by word; ``repeats`` counts a word after itself.
    """
    size, classes = len(own), len(matrix)
    rows = np.arange(size)
    dense = np.zeros((size, 2 * classes))
    dense[word, at] = n
    after, before = dense[:, :classes], dense[:, classes:]
    total = after.sum(axis=1)
    marginal = matrix.sum(axis=1)
    around = np.vstack([matrix.T, matrix])
    known = _xlogx(around)
    gain = np.zeros((size, classes))
    for i in range(0, len(word), _ENTRIES_AT_ONCE):
        w, c, r = word[i : i + _ENTRIES_AT_ONCE], at[i : i + _ENTRIES_AT_ONCE], n[i : i + _ENTRIES_AT_ONCE].astype(float)
        old = around[c]
        was = known[c]
        side = c % classes
        mine = np.flatnonzero(side == own[w])
        r[mine] -= repeats[w[mine]]
        # the word's own class without the word
        old[mine] -= np.where((c[mine] < classes)[:, None], before[w[mine]], after[w[mine]])
        was[mine] = _xlogx(old[mine])
        change = _xlogx(old + r[:, None]) - was
        change[np.arange(len(w)), side] = 0
        starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        gain[w[starts]] += np.add.reduceat(change, starts, axis=0)
    own_after, own_before = after[rows, own], before[rows, own]
    inner = matrix.diagonal()
    gain += _xlogx(inner + after + before + repeats[:, None]) - _xlogx(inner)
    gain -= 2 * (_xlogx(marginal + total[:, None]) - _xlogx(marginal))
    # the own class: what leaving it takes away
    row, column = matrix[own], matrix[:, own].T
    left = _xlogx(row) - _xlogx(row - after) + _xlogx(column) - _xlogx(column - before)
    left[rows, own] = 0
    stay = left.sum(axis=1) + _xlogx(inner[own]) - _xlogx(inner[own] - own_after - own_before + repeats)
    gain[rows, own] = stay - 2 * (_xlogx(marginal[own]) - _xlogx(marginal[own] - total))
    return gain


def _best(own: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """The best class of each word but the end's; a word moves only if that is better than staying."""
    gain[:, _END_CLASS] = -np.inf
    stay = gain[np.arange(len(own)), own]
    return np.where(gain.max(axis=1) > stay + 1e-9 * np.maximum(1, np.abs(stay)), gain.argmax(axis=1), own)


def _moves(kind: np.ndarray, turn: np.ndarray, matrix: np.ndarray):
    classes = len(matrix)
    wide = 2 * classes + 1

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, at, n in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "n")), strict=True):
                slot, cell = np.divmod(np.frombuffer(at, "<u2").astype(np.int64), wide)
                n = np.frombuffer(n, "<i8")
                seen, word = np.unique(slot, return_inverse=True)
                code = turn[seen + block * _BLOCK]
                repeats = np.zeros(len(seen))
                again = cell == 2 * classes
                repeats[word[again]] = n[again]
                gain = gains(kind[code], word[~again], cell[~again], n[~again], repeats, matrix)
                best = _best(kind[code], gain)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(best)], ["code", "to"])

    return move


def cluster(
    train: DataFrame, common: Common, classes: int = CLASSES, rounds: int = ROUNDS, bands: tuple[int, ...] = BANDS
) -> tuple[np.ndarray, np.ndarray]:
    """The class of each number, and the counts of class after class, with words that are not common as one more class."""
    if classes < 3:
        raise ValueError("three classes at least: ends, other words, and words")
    size = len(common.word)
    kind = np.full(size + _FIRST, _OPEN_CLASS, dtype=np.int64)
    kind[_END] = _END_CLASS
    drawn = mix(common.word.view(np.uint64))
    first = min(size, bands[0])
    kind[_FIRST : first + _FIRST] = _FIRST + (drawn[:first] % np.uint64(classes - _FIRST)).astype(np.int64)
    group = (drawn >> np.uint64(40)).astype(np.int64)

    def moved(kind: np.ndarray, turn: np.ndarray, blocks: DataFrame, matrix: np.ndarray) -> np.ndarray:
        moves = blocks.mapInArrow(_moves(kind, turn, matrix), "code long, to long").toArrow()
        kind = kind.copy()
        kind[np.asarray(moves.column("code"), dtype=np.int64)] = np.asarray(moves.column("to"))
        return kind

    best, groups = None, 2
    for step in range(rounds + 1):
        turn = np.flatnonzero(group[:first] % groups == step % groups) + _FIRST if step < rounds else np.zeros(0, dtype=np.int64)
        blocks, matrix = _profiles(train, kind, turn, classes)
        if best is None or likelihood(matrix) >= best[0]:
            best = likelihood(matrix), kind
            if step < rounds:
                kind = moved(kind, turn, blocks, matrix)
        else:
            kind, groups = best[1], 2 * groups
    kind = best[1]
    for low, high in zip(bands, [*bands[1:], size], strict=True):
        if min(high, size) > low:
            turn = np.arange(low, min(high, size)) + _FIRST
            blocks, matrix = _profiles(train, kind, turn, classes)
            kind = moved(kind, turn, blocks, matrix)
    apart = kind.copy()
    apart[_OPEN] = classes
    return kind, _profiles(train, apart, np.zeros(0, dtype=np.int64), classes + 1)[1]


def _together(matrix: np.ndarray) -> np.ndarray:
    """The counts with the last class as part of the class of words that have not moved yet."""
    both = matrix.copy()
    both[_OPEN_CLASS] += both[-1]
    both[:, _OPEN_CLASS] += both[:, -1]
    return both[:-1, :-1]


_OPENED = "word long, row long, place long, train boolean, before short, after short"
_MET = "word long, row long, place long, train boolean, before short, after short, class short, n long"


def _open(common: Common, kind: np.ndarray):
    """The tokens that are not scored where the numbers are read, with the classes around them (-1: as open)."""
    seen = np.r_[True, False, common.n > 0]
    near = np.where(seen, kind, -1).astype(np.int16)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, others = batch.column("codes").to_pylist(), batch.column("open").to_pylist()
            row, held = np.asarray(batch.column("row")), batch.column("held_out").to_numpy(zero_copy_only=False)
            for a, b in _cuts([len(t) // 4 for t in texts]):
                stream = np.frombuffer(b"".join(texts[a:b]), "<u4")
                bounds = np.r_[0, np.cumsum([len(t) // 4 for t in texts[a:b]])]
                around = near[stream]
                places = np.flatnonzero(around < 0)
                at = np.searchsorted(bounds, places, side="right") - 1
                # a common word that training lacks is unknown: it needs a name only to be spread
                salt = np.bitwise_xor.reduce(stream) if len(stream) else 0
                word = mix(places.astype(np.uint64) + (np.uint64(salt) << np.uint64(32))).view(np.int64)
                real = stream[places] == _OPEN
                word[real] = np.frombuffer(b"".join(others[a:b]), "<i8")
                before = np.r_[np.int16(_END_CLASS), around[:-1]][places]
                columns = [
                    word, row[a:b][at], places - bounds[at], real & ~held[a:b].astype(bool)[at], before, around[places + 1]
                ]
                names = ["word", "row", "place", "train", "before", "after"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return opened


def _cuts(sizes: list[int], limit: int = _TOKENS_AT_ONCE) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def _whole(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted rows in runs that hold all rows of each of their keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(key))
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and (cut or keys[0] != last):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
        last = keys[-1]
    if held:
        yield pa.Table.from_batches(held)


def _meet(matrix: np.ndarray):
    """Class and count for every token, from the training tokens of its word; a row with no place for each word."""
    classes = len(matrix)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, "word"):
            word, row, place = (np.asarray(table.column(c)) for c in ("word", "row", "place"))
            train = np.asarray(table.column("train")).astype(bool)
            before, after = np.asarray(table.column("before")), np.asarray(table.column("after"))
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            which = np.cumsum(np.r_[True, word[1:] != word[:-1]]) - 1
            n = np.add.reduceat(train.astype(np.int64), starts)
            again = (word[1:] == word[:-1]) & (row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1) & train[1:]
            repeats = np.bincount(which[1:][again], minlength=len(starts))
            kind = np.full(len(starts), -1, dtype=np.int64)
            known = np.flatnonzero(n)
            slot = np.full(len(starts), -1)
            slot[known] = np.arange(len(known))
            sides = np.where(np.r_[after, before] < 0, _OPEN_CLASS, np.r_[after, before]).astype(np.int64)
            sides[len(after) :] += classes
            cells = (np.r_[slot[which], slot[which]] * 2 * classes + sides)[np.r_[train, train]]
            cell, count = np.unique(cells, return_counts=True)
            own = np.full(_WORDS_AT_ONCE, _OPEN_CLASS)
            for i in range(0, len(known), _WORDS_AT_ONCE):
                part = known[i : i + _WORDS_AT_ONCE]
                a, b = np.searchsorted(cell, [i * 2 * classes, (i + len(part)) * 2 * classes])
                w, at = np.divmod(cell[a:b] - i * 2 * classes, 2 * classes)
                mine = own[: len(part)]
                kind[part] = _best(mine, gains(mine, w, at, count[a:b], repeats[part].astype(float), matrix))
            names = word[starts[known]]
            empty = np.full(len(known), -1)
            columns = [
                np.r_[word, names], np.r_[row, empty], np.r_[place, empty], np.r_[train, np.ones(len(known), bool)],
                np.r_[before, empty], np.r_[after, empty], np.r_[kind[which], kind[known]], np.r_[n[which], n[known]],
            ]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int16(), pa.int16(), pa.int16(), pa.int64()]
            arrays = [pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _MET.split(", ")])

    return meet


_CHAINS = "row long, train boolean, kind binary, n binary, previous binary, after binary, leads binary"


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text: its open tokens in order, each with the class before it and the class after it."""
    for table in _whole(batches, "row"):
        row, place, kind, n, before, after = (
            np.asarray(table.column(c)).astype(np.int64) for c in ("row", "place", "class", "n", "before", "after")
        )
        # a token next to another open one takes its class from there
        beside = (row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1)
        previous = np.where(np.r_[False, beside], np.r_[kind[:1], kind[:-1]], before)
        cuts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        arrays = [kind.astype("<i2"), n.astype("<i8"), previous.astype("<i2"), after.astype("<i2"), np.r_[beside, False].astype("u1")]
        edges = list(zip(cuts.tolist(), [*cuts.tolist()[1:], len(row)], strict=True))
        columns = [pa.array([x[a:b].tobytes() for a, b in edges], pa.binary()) for x in arrays]
        train = np.asarray(table.column("train")).astype(bool)[cuts]
        names = ["row", "train", "kind", "n", "previous", "after", "leads"]
        yield pa.RecordBatch.from_arrays([pa.array(row[cuts]), pa.array(train), *columns], names)


class _Chain(NamedTuple):
    """The open tokens of some texts, one text after the other."""

    kind: np.ndarray
    n: np.ndarray
    previous: np.ndarray
    after: np.ndarray
    leads: np.ndarray
    bounds: np.ndarray


def _read_chains(batch: pa.RecordBatch) -> _Chain:
    forms = {"kind": "<i2", "n": "<i8", "previous": "<i2", "after": "<i2", "leads": "u1"}
    kind, n, previous, after, leads = (
        np.frombuffer(b"".join(batch.column(c).to_pylist()), form).astype(np.int64) for c, form in forms.items()
    )
    return _Chain(kind, n, previous, after, leads.astype(bool), np.r_[0, np.cumsum([len(x) for x in batch.column("leads").to_pylist()])])


def _open_pairs(classes: int):
    """Counts of class after class around the tokens of words that are not common."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, dtype=np.int64)
        for batch in batches:
            chain = _read_chains(batch)
            total += np.bincount(chain.previous * classes + chain.kind, minlength=len(total))
            out = ~chain.leads
            total += np.bincount(chain.kind[out] * classes + chain.after[out], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    return pairs


def train(
    rows: DataFrame, common: Common, classes: int = CLASSES, rounds: int = ROUNDS, bands: tuple[int, ...] = BANDS
) -> tuple[Model, DataFrame, DataFrame]:
    """From ``numbered`` rows: the model, the words that are not common as ``(word, n, class)``, and the tokens of such
    words, a row for each text that has some."""
    learned = rows.where("not held_out")
    kind, matrix = cluster(learned, common, classes, rounds, bands)
    opened = rows.select("row", "held_out", "codes", "open").mapInArrow(_open(common, kind), _OPENED)
    opened = opened.repartition("word").sortWithinPartitions("word", "row", "place")
    met = written(opened.mapInArrow(_meet(_together(matrix)), _MET), "open", "zstd")
    others = met.where("row = -1").select("word", "n", "class")
    chains = met.where("row >= 0").drop("word").repartition("row").sortWithinPartitions("row", "place")
    chains = written(chains.mapInArrow(_chains, _CHAINS), "chains", "zstd")
    # pairs of common words stand, those around other words are counted with the classes that these have now
    pairs = matrix[:-1, :-1].copy()
    found = chains.where("train").mapInArrow(_open_pairs(classes), "at long, n long")
    for r in found.groupBy("at").agg(F.sum("n").alias("n")).collect():
        pairs[r["at"] // classes, r["at"] % classes] += r["n"]
    size, once = np.zeros(classes), np.zeros(classes)
    np.add.at(size, kind[_FIRST:], common.n)
    np.add.at(once, kind[_FIRST:], common.n == 1)
    distinct = int((common.n > 0).sum())
    stats = others.groupBy("class").agg(
        F.count("*").alias("words"), F.sum("n").alias("n"), F.sum((F.col("n") == 1).cast("long")).alias("once")
    )
    for r in stats.collect():
        size[r["class"]] += r["n"]
        once[r["class"]] += r["once"]
        distinct += r["words"]
    texts = learned.count()
    size[_END_CLASS] = texts
    frequency = (size + 1) / (size + 1).sum()
    kinds = np.maximum((pairs > 0).sum(axis=1), 1)[:, None]
    transitions = (pairs + kinds * frequency) / (pairs.sum(axis=1)[:, None] + kinds)
    emission = size + once + 1
    unknown = (once + 1) / emission
    # an end is the only member of its class
    emission[_END_CLASS], unknown[_END_CLASS] = max(1, texts), 0.0
    distinct += texts > 0
    return Model(common, kind, texts, int(size.sum()), int(distinct), transitions, emission, unknown), others, chains


def _base(n: np.ndarray, model: Model) -> np.ndarray:
    return np.log10((n + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))


_SCORED = "row long, id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _score(model: Model):
    """The sums over common words and ends, and over the steps between them."""
    step = np.log10(model.transitions)
    n = np.r_[model.texts, 0, model.common.n]
    known = n > 0
    here = known.copy()
    here[_END] = True
    kind = np.where(here, model.kind, -1)
    emitted = np.log10(np.maximum(n, 1) / model.emission[model.kind])
    base = _base(n, model)
    # words that training lacks are scored with the words that are not common
    emitted[~here], base[~here] = 0.0, 0.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("codes").to_pylist()
            sizes = [len(t) // 4 for t in texts]
            for a, b in _cuts(sizes):
                stream = np.frombuffer(b"".join(texts[a:b]), "<u4")
                first = np.r_[0, np.cumsum(sizes[a:b])[:-1]]
                now = kind[stream]
                before = np.r_[_END_CLASS, now[:-1]]
                logs = emitted[stream] + np.where((now >= 0) & (before >= 0), step[before, now], 0.0)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("id"), part.column("held_out"), pa.array(sizes[a:b], pa.int64()),
                        pa.array(np.add.reduceat(known[stream].astype(np.int64), first)),
                        pa.array(np.add.reduceat(base[stream], first)), pa.array(np.add.reduceat(logs, first)),
                    ],
                    [f.split()[0] for f in _SCORED.split(", ")],
                )

    return score


def unknown_runs(first: np.ndarray, length: np.ndarray, last: np.ndarray, model: Model) -> np.ndarray:
    """log10 of the probability of ``length`` unknown words after class ``first`` and then of class ``last``."""
    result = np.zeros(len(first))
    state = model.transitions[first] * model.unknown
    active = np.arange(len(first))
    for k in range(1, int(length.max(initial=0)) + 1):
        total = state.sum(axis=1)
        result[active] += np.log10(total)
        state /= total[:, None]
        ends = length[active] == k
        result[active[ends]] += np.log10((state[ends] * model.transitions[:, last[active[ends]]].T).sum(axis=1))
        active, state = active[~ends], state[~ends]
        state = (state @ model.transitions) * model.unknown
    return result


def _finish(model: Model):
    """The sums over all other tokens and the steps into and out of them."""
    step = np.log10(model.transitions)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chain = _read_chains(batch)
            kind, previous, leads = chain.kind, chain.previous, chain.leads
            known, follows = kind >= 0, np.r_[False, leads[:-1]]
            logs = np.where(known, np.log10(np.maximum(chain.n, 1) / model.emission[kind]), 0.0)
            logs += np.where(known & (previous >= 0), step[previous, kind], 0.0)
            # into the next word, if that is a common one
            logs += np.where(known & ~leads, step[kind, chain.after], 0.0)
            starts = np.flatnonzero(~known & ~(follows & np.r_[False, ~known[:-1]]))
            ends = np.flatnonzero(~known & ~(leads & np.r_[~known[1:], False]))
            last = np.where(leads[ends], kind[np.minimum(ends + 1, len(kind) - 1)], chain.after[ends])
            np.add.at(logs, starts, unknown_runs(previous[starts], ends - starts + 1, last, model))
            first = chain.bounds[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), pa.array(np.add.reduceat((chain.n > 0).astype(np.int64), first)),
                    pa.array(np.add.reduceat(_base(chain.n, model), first)), pa.array(np.add.reduceat(logs, first)),
                ],
                ["at", "more_known", "more_base", "more_score"],
            )

    return finish


def score(rows: DataFrame, model: Model, chains: DataFrame) -> DataFrame:
    """One row per ``numbered`` row with its counts and scores."""
    common = rows.select("row", "id", "held_out", "codes").mapInArrow(_score(model), _SCORED)
    rest = chains.mapInArrow(_finish(model), "at long, more_known long, more_base double, more_score double")
    whole = common.join(rest, F.col("row") == F.col("at"), "left")
    return whole.select(
        "id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def score_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    classes: int = CLASSES,
    rounds: int = ROUNDS,
    bands: tuple[int, ...] = BANDS,
    local: int = LOCAL,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and
    ``perplexity`` (of a token). The model learns from the documents that are not held out."""
    texts = docs.select(
        F.col(id_column).cast("long").alias("id"), held_out(F.col(id_column)).alias("held_out"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    common = commonest(count_words(texts), local)
    rows = numbered(texts, common)
    model, _, chains = train(rows, common, classes, rounds, bands)
    scored = score(rows, model, chains).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    return scored.withColumnRenamed("id", id_column)
