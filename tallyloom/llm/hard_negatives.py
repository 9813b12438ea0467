"""Hard negatives by exact integer scores from a residue-number-system GEMM.

Scores are inner products of integer vectors (``fixed_point``). Vectors are reduced modulo several
primes, residues around zero. Over ``_SPAN`` components a product of two residue matrices stays below 2^24, so
float32 holds it exactly; longer vectors are multiplied in spans. As many primes are taken as make their product larger than
four times the largest possible score, and the signed score follows from its residues by Chinese remaindering (mixed
radix, in 64-bit integers). No score is rounded anywhere.

Anchors meet all rows in blocks. A group is one block of anchors and one block of rows: anchors come first,
rows stream past them in the order of their ids. The first pass keeps each anchor's best rows of its own label, the second the
best rows of other labels inside each positive's window of scores. A group leaves at most ``positives`` or
``positives`` x ``negatives`` rows for an anchor; ranks over all groups are then taken by anchor. Rows are
shuffled once for each block of anchors, anchors once for each block of rows; labels are no key of a
shuffle, so a label with a third of all rows is no hot spot.

Defined results: rows without id or label, and vectors that ``fixed_point`` leaves out, take no part. Only vectors of
equal length are compared. Rows that repeat an id are rows of their own, and each of them is an anchor; ties
between them go by the vector. An anchor without positives, or whose windows are empty, gives no rows; a window of a
negative positive-score is empty. An empty table gives no rows. Columns beyond the three named ones are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.fixed_point import integer_rows, numbers
from tallyloom.llm.tables import written

POSITIVES = 5
NEGATIVES = 5
ANCHORS_PER_BLOCK = 1 << 13
ROWS_PER_BLOCK = 1 << 20
ROWS_PER_TASK = 1 << 13
_BATCH = 512
_NONE = np.iinfo(np.int64).min

#: The largest primes p with 64 ((p - 1) / 2)^2 below 2^24.
_SPAN = 64
_PRIME_LIMIT = 1024


def _primes() -> list[int]:
    return [p for p in range(_PRIME_LIMIT, 500, -1) if all(p % q for q in range(2, 32))]


def primes_for(largest: int) -> list[int]:
    """Primes whose product is above four times the largest score, one at least."""
    chosen, product = [], 1
    for p in _primes():
        if chosen and product > 4 * largest:
            break
        chosen.append(p)
        product *= p
    return chosen


def residues(vectors: np.ndarray, p: int) -> np.ndarray:
    """Residues from -(p - 1) / 2 to (p - 1) / 2, in float32."""
    half = p // 2
    return ((vectors + half) % p - half).astype(np.float32)


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of the rows of two matrices, given their residues for each prime."""
    dim = left[0].shape[1]
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        total = np.zeros((len(left[k]), len(right[k])), dtype=np.float32)
        for i in range(0, dim, _SPAN):
            part = left[k][:, i : i + _SPAN] @ right[k][:, i : i + _SPAN].T
            # at most p in size before the next span is added
            total = np.fmod(total + np.fmod(part, np.float32(p)), np.float32(p))
        digit = total.astype(np.int64)
        for q, known in zip(primes, digits, strict=False):
            digit = (digit - known) * pow(q, -1, p) % p
        digits.append(digit % p)
    # The value is the score, or the score and the product of the primes; a score is below a quarter of
    # the product, so rough sizes tell which. Sums wrap around at 2^64, and the score comes out of them whole.
    value, size, radix = np.zeros(digits[0].shape, dtype=np.uint64), np.zeros(digits[0].shape), 1
    for p, digit in zip(primes, digits, strict=True):
        value += digit.astype(np.uint64) * np.uint64(radix % (1 << 64))
        size += digit * float(radix)
        radix *= p
    value[size > radix / 2] -= np.uint64(radix % (1 << 64))
    return value.view(np.int64)


class _Best:
    """The best ``keep`` rows of each anchor so far; rows come in the order of ties."""

    def __init__(self, anchors: int, keep: int):
        self.keep = keep
        self.score = np.full((anchors, keep), _NONE, dtype=np.int64)
        self.row = np.full((anchors, keep), -1, dtype=np.int64)

    def last(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, anchor: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        touched = np.unique(anchor)
        held = self.row[touched]
        there = held >= 0
        a = np.concatenate([np.repeat(touched, there.sum(axis=1)), anchor])
        s = np.concatenate([self.score[touched][there], score])
        r = np.concatenate([held[there], row])
        order = np.lexsort((r, -s, a))
        a, s, r = a[order], s[order], r[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        kept = place < self.keep
        self.score[a[kept], place[kept]] = s[kept]
        self.row[a[kept], place[kept]] = r[kept]


class _Anchors:
    def __init__(self, table: pa.Table, primes: list[int]):
        self.key = np.asarray(table.column("key"))
        self.label = np.asarray(table.column("label"))
        dim = table.column("dim")[0].as_py()
        vectors = numbers(table.column("vector").combine_chunks(), dim)
        self.residues = [residues(vectors, p) for p in primes]
        windows = [w or [] for w in table.column("windows").to_pylist()]
        self.top = np.full((len(windows), max([1, *map(len, windows)])), _NONE, dtype=np.int64)
        for i, w in enumerate(windows):
            self.top[i, : len(w)] = w


def _streams(batches: Iterator[pa.RecordBatch], primes: list[int]):
    """Per group the anchors, then its rows in pieces with their scores, and at last the mark of its end."""
    anchors, held, at = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch.column(k)) for k in ("dim", "left", "right")], axis=1)
        role = np.asarray(batch.column("role"))
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (role[1:] != role[:-1])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            here = tuple(keys[a].tolist())
            if here != at:
                if anchors is not None:
                    yield anchors, None, None
                anchors, held, at = None, [], here
            if role[a] == 0:
                held.append(batch.slice(a, b - a))
                continue
            if anchors is None:
                if not held:
                    continue
                anchors, held = _Anchors(pa.Table.from_batches(held), primes), []
            for i in range(a, b, _BATCH):
                part = batch.slice(i, min(_BATCH, b - i))
                rows = numbers(part.column("vector"), here[0])
                yield anchors, part, scores(anchors.residues, [residues(rows, p) for p in primes], primes)
    if anchors is not None:
        yield anchors, None, None


def _found(anchors: _Anchors, best: list[_Best], keys: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
    key, vec = np.concatenate(keys), np.concatenate(ids)
    anchor, window, score, row = [], [], [], []
    for j, b in enumerate(best):
        i, place = np.nonzero(b.row >= 0)
        anchor.append(anchors.key[i])
        window.append(np.full(len(i), j, dtype=np.int64))
        score.append(b.score[i, place])
        row.append(b.row[i, place])
    row = np.concatenate(row)
    columns = [np.concatenate(anchor), np.concatenate(window), np.concatenate(score), key[row], vec[row]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "window", "score", "row", "row_id"])


_FOUND = "anchor long, window long, score long, row long, row_id long"


def _search(primes: list[int], keep: int, own: bool, percent: int):
    """Own label: the best rows of each anchor. Otherwise the best rows of other labels in each window."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, keys, ids, seen, low = [], [], [], 0, None
        for anchors, part, score in _streams(batches, primes):
            if part is None:
                yield _found(anchors, best, keys, ids)
                best, keys, ids, seen = [], [], [], 0
                continue
            if not best:
                best = [_Best(len(anchors.key), keep) for _ in range(1 if own else anchors.top.shape[1])]
                # the least score in a window, less one
                low = None if own else -((-percent * anchors.top) // 100) - 1
            key, label = np.asarray(part.column("key")), np.asarray(part.column("label"))
            same = anchors.label[:, None] == label
            if own:
                i, j = np.nonzero(same & (score > best[0].last()[:, None]) & (anchors.key[:, None] != key))
                if len(i):
                    best[0].add(i, score[i, j], j + seen)
            else:
                floor = np.stack([np.maximum(low[:, w], b.last()) for w, b in enumerate(best)], axis=1)
                floor[anchors.top == _NONE] = np.iinfo(np.int64).max
                i, j = np.nonzero(~same & (score > floor.min(axis=1)[:, None]) & (score <= anchors.top.max(axis=1)[:, None]))
                s = score[i, j]
                for w, b in enumerate(best):
                    inside = (s > floor[i, w]) & (s <= anchors.top[i, w])
                    if inside.any():
                        b.add(i[inside], s[inside], j[inside] + seen)
            keys.append(key)
            ids.append(np.asarray(part.column("id")))
            seen += len(key)

    return search


def _blocks(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def mine(
    vectors: DataFrame,
    anchors: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: int = 80,
    anchors_per_block: int = ANCHORS_PER_BLOCK,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` is a condition on ``id``. A negative of a positive has another label than the anchor and a score from
    ``percent`` hundredths of the positive's score up to it. Labels are integers.
    """
    rows = integer_rows(vectors, id_column, vector_column, label_column)
    rows = rows.where("label is not null").withColumn("label", F.col("label").cast("long"))
    # a row's key follows its id, then its vector, wherever it is read
    rows = written(rows.withColumn("key", F.monotonically_increasing_id()), "vectors")
    n, size, dim = rows.agg(
        F.count("*"), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("long"))))), F.max("dim")
    ).first()
    primes = primes_for(int(dim or 0) * int(size or 0) ** 2)
    chosen = rows.where(anchors)
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    left = max(1, -(-chosen.count() // anchors_per_block))
    right = max(1, -(-n // rows_per_block), min(tasks // left, -(-n // ROWS_PER_TASK)))

    def pairs(asking: DataFrame) -> DataFrame:
        one = asking.select(
            F.lit(0).alias("role"), "dim", F.pmod(F.xxhash64("key"), F.lit(left)).alias("left"),
            F.explode(_blocks(right)).alias("right"),
            "key", "id", "label", "vector", "windows",
        )
        many = rows.select(
            F.lit(1).alias("role"), "dim", F.explode(_blocks(left)).alias("left"),
            F.pmod(F.xxhash64("key", F.lit(1)), F.lit(right)).alias("right"),
            "key", "id", "label", "vector", F.lit(None).cast("array<long>").alias("windows"),
        )
        keys = ["dim", "left", "right"]
        return one.union(many).repartition(left * right, *keys).sortWithinPartitions(*keys, "role", "id", "vector", "key")

    ties = rows.select(F.col("key").alias("row"), F.col("vector").alias("tie"))
    repeated = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0

    def ranked(found: DataFrame, by: list[str], keep: int) -> DataFrame:
        # rows of one id are told apart by their vectors; without such rows the ids decide
        found = found.join(ties, "row") if repeated else found.withColumn("tie", F.lit(None).cast("array<int>"))
        best = Window.partitionBy(*by).orderBy(F.desc("score"), "row_id", "tie", "row")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)

    asking = chosen.withColumn("windows", F.lit(None).cast("array<long>"))
    near = pairs(asking).mapInArrow(_search(primes, positives, True, percent), _FOUND)
    near = written(ranked(near, ["anchor"], positives).select("anchor", "rank", "score", "row_id"), "positives")
    windows = near.groupBy("anchor").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("windows")
    )
    asking = chosen.join(windows.withColumnRenamed("anchor", "key"), "key")
    hard = pairs(asking).mapInArrow(_search(primes, negatives, False, percent), _FOUND)
    hard = ranked(hard, ["anchor", "window"], negatives)
    positive = near.select(
        "anchor", (F.col("rank") - 1).cast("long").alias("window"), F.col("row_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    names = chosen.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    return hard.join(positive, ["anchor", "window"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def shifted(label: Column, vec_id: Column) -> Column:
    """The labels of the query: of ids divisible by 7 the next one of ten."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
