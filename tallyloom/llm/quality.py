"""Quality by importance resampling.

Two generative models over hashed n-grams, one of the target (documents labelled good), one of all raw
text, give each document a log importance weight: the sum over its n-grams of log p_target - log
p_raw. Documents are then sampled without replacement by Gumbel top-k: each weight gets a Gumbel draw that
depends on seed and id, and the k largest stay. k is the number of documents whose weight passes the
threshold that best separates labelled good from labelled bad ones, or a given share.

N-grams of a document: its words, its word pairs (a word after itself is one n-gram, whatever the word) and
the shapes of its words (letters by case, digits, other characters as they are). Raw counts cover all
documents. Labels are a bounded sample, ``LABELLED`` rows by a hash of the id. The models are two
arrays of ``BUCKETS`` numbers. The k-th largest key is found by counting keys in ever finer
ranges, so no rows are sorted or gathered.

Defined results: null and empty texts have no n-grams and weight 0. Labels that are null, or of documents that are
missing, are not used, and a labelled id that several rows share counts once, by its smallest weight; without good or without bad labels every document stays. Rows that repeat get
the same key; at the k-th key ties go to the smaller id, and rows alike in both all stay. An empty table
gives no rows. Texts of any length are read whole, in slices of rows. Columns beyond those named are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import written

BUCKETS = 1 << 16
LABELLED = 50_000
SEED = 17
_RANGES = 1024


def _shapes() -> np.ndarray:
    shape = np.arange(256, dtype=np.uint8)
    shape[ord("a") : ord("z") + 1] = ord("a")
    shape[0x80:] = ord("a")
    shape[ord("A") : ord("Z") + 1] = ord("A")
    shape[ord("0") : ord("9") + 1] = ord("0")
    return shape


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram, and the row that it is from."""
    from tallyloom.llm.words import gram_hashes, mix, word_hashes

    words, bounds = word_hashes(column)
    shapes, _ = word_hashes(column, _shapes())
    row = np.repeat(np.arange(len(column)), np.diff(bounds))
    pairs = gram_hashes(words, 2)
    inner = row[1:] == row[:-1]
    same = words[1:] == words[:-1]
    pairs[same] = np.uint64(1)
    names = np.concatenate([words, pairs[inner], mix(shapes + np.uint64(3))])
    return (names % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([row, row[1:][inner], row])


def _counts(good: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyloom.llm.words import slices

        raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                buckets, row = features(part.column("text"))
                raw += np.bincount(buckets, minlength=BUCKETS)
                ids = np.array([-1 if i is None else i for i in part.column("doc_id").to_pylist()], dtype=np.int64)
                labelled = np.isin(ids, good) & np.asarray(part.column("doc_id").is_valid())
                if labelled.any():
                    target += np.bincount(buckets[labelled[row]], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])

    return count


def _weigh(ratio: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyloom.llm.words import slices

        for batch in batches:
            for part in slices(batch, "text"):
                buckets, row = features(part.column("text"))
                weight = np.bincount(row, weights=ratio[buckets], minlength=part.num_rows)
                grams = np.bincount(row, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(weight, pa.float64()), pa.array(grams, pa.int64())], ["doc_id", "log_weight", "n_grams"]
                )

    return weigh


def _ids(labels: DataFrame, wanted: str) -> np.ndarray:
    return np.array([row["doc_id"] for row in labels.where(wanted).select("doc_id").collect()], dtype=np.int64)


def weights(docs: DataFrame, good: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, log_weight, n_grams)`` of every document; ``good`` are the ids of the target."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    counted = texts.mapInArrow(_counts(good), "bucket long, raw long, target long")
    counted = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for bucket, n, m in counted.collect():
        raw[bucket] += n
        target[bucket] += m
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    return texts.mapInArrow(_weigh(ratio), "doc_id long, log_weight double, n_grams long")


def _threshold(scored: list[tuple[float, int]]) -> float:
    """The weight that separates good from bad with the largest balanced accuracy."""
    scored = sorted(scored)
    good = sum(label for _, label in scored)
    bad = len(scored) - good
    best, at, below_good, below_bad = -1.0, -np.inf, 0, 0
    for i, (weight, label) in enumerate(scored):
        if i == 0 or weight != scored[i - 1][0]:
            balanced = (below_bad / bad + 1 - below_good / good) / 2
            if balanced > best:
                best, at = balanced, weight if i == 0 else (weight + scored[i - 1][0]) / 2
        below_good += label
        below_bad += 1 - label
    return at


def _kth(keys: DataFrame, k: int) -> tuple[float, int | None]:
    """The k-th largest ``(key, doc_id)``, ids ascending within a key, by counts in ever finer ranges."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    above = 0
    while low < high:
        width = (high - low) / _RANGES
        place = F.least(F.lit(_RANGES - 1), F.floor((F.col("key") - low) / width)) if width > 0 else F.lit(0)
        counts = (
            keys.where(F.col("key").between(low, high)).groupBy(place.alias("place"))
            .agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
            .orderBy(F.desc("place")).collect()
        )
        for row in counts:
            if above + row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            above += row["n"]
        if len(counts) == 1 and width == 0:
            break
    ties = keys.where(F.col("key") == low)
    if above + ties.count() <= k:
        return low, None
    first, last = ties.agg(F.min("doc_id"), F.max("doc_id")).first()
    while first < last:  # the id up to which ties stay
        middle = (first + last) // 2
        if above + ties.where(F.col("doc_id") <= middle).count() >= k:
            last = middle
        else:
            first = middle + 1
    return low, first


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    share: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, ``log_weight``, ``key`` (the weight with its Gumbel draw), ``kept``.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad). ``share`` of the documents stay, or as many as the
    labels say are good.
    """
    usable = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = written(
        usable.orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id").limit(LABELLED), "labels"
    )
    weighed = written(weights(docs, _ids(sample, "quality = 1"), id_column, text_column), "weights")
    uniform = (F.xxhash64(F.lit(seed), "doc_id").cast("double") + 2.0**63) / 2.0**64
    uniform = F.greatest(F.lit(2.0**-60), F.least(uniform, F.lit(1 - 2.0**-53)))
    keys = written(weighed.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform))), "keys")
    if share is None:
        # one row for each labelled id, however many rows share it
        met = keys.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.min("log_weight").alias("log_weight"))
        scored = [(r["log_weight"], int(r["quality"] == 1)) for r in met.collect()]
        if len({label for _, label in scored}) == 2:
            k = keys.where(F.col("log_weight") >= F.lit(_threshold(scored))).count()
        else:
            k = None
    else:
        k = round(share * keys.count())
    if k is None or not keys.limit(1).count():
        kept = F.lit(True)
    elif k == 0:
        kept = F.lit(False)
    else:
        key, last = _kth(keys, k)
        kept = (F.col("key") > key) | ((F.col("key") == key) & (F.lit(True) if last is None else (F.col("doc_id") <= last)))
    return keys.select(F.col("doc_id").alias(id_column), "log_weight", "key", F.coalesce(kept, F.lit(False)).alias("kept"))
