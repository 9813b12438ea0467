"""Vector codes and hard negatives against plain restatements, and their edge rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyloom.llm import hard_negatives, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHES = ("id", "key", "vector", "dim", "row", "code", "error", "windows", "role", "part", "n")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit("x") for name in CLASHES})


def some_rows(n, dim=16, labels=3, seed=0, spread=4):
    rng = np.random.default_rng(seed)
    return [
        (i, [float(x) / 256 for x in rng.integers(-spread, spread + 1, dim)], int(rng.integers(labels))) for i in range(n)
    ]


ODD = [
    (7, None, 1), (8, [], 1), (9, [math.nan] * 16, 1), (10, [1.0] * 15 + [math.inf], 2), (11, [None] + [1.0] * 15, 2),
    (12, [0.0] * 16, None), (13, [0.0] * 16, None), (None, [0.5] * 16, 1), (14, [0.25] * 8, 1),
    (15, [3.0e38] * 16, 1), (16, [-0.001] * 16, 1), (16, [0.25] * 16, 0), (16, [0.25] * 16, 0), (0, [0.5, -0.5] * 8, 1),
    (100, [0.5, -0.25] * 8, 1), (200, [-0.5] * 16, 1), (300, [0.0] * 16, 0),
]


def test_orchard_finds_the_nearest_entry():
    rng = np.random.default_rng(3)
    for spread in (2, 50, 1 << 25):
        book = rng.integers(-spread, spread, (64, 4))
        book[40], book[41] = book[3], book[3]
        pieces = np.concatenate([rng.integers(-spread, spread, (2000, 4)), book])
        best, distance = vector_codes.orchard(pieces, book, vector_codes.neighbours(book))
        apart = ((pieces[:, None] - book) ** 2).sum(axis=2)
        assert (best == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def plain_codes(rows, parts, entries, rounds):
    """Nearest entries by looking at all of them."""
    vectors = np.array([v for _, v, _ in rows])
    width = vectors.shape[1] // parts
    pieces = vectors.reshape(len(rows), parts, width)
    books = [pieces[:entries, p].copy() for p in range(parts)]
    for step in range(rounds + 1):
        apart = [((pieces[:, p, None] - books[p]) ** 2).sum(axis=2) for p in range(parts)]
        codes = [a.argmin(axis=1) for a in apart]
        if step < rounds:
            for p in range(parts):
                for e in set(codes[p].tolist()):
                    mine = pieces[codes[p] == e, p]
                    books[p][e] = mine.sum(axis=0) // len(mine)
    return np.stack(codes, axis=1), sum(a.min(axis=1) for a in apart), np.stack(books)


@pytest.mark.parametrize("n", [1, 40, 300])
def test_codes_as_by_brute_force(spark, n):
    rows = some_rows(n, 16, seed=n, spread=30)
    coded, books = vector_codes.compress(frame(spark, rows).repartition(5), parts=4, entries=16, rounds=2)
    whole = [(i, [math.floor(x * 256) for x in v], label) for i, v, label in rows]
    codes, error, expected = plain_codes(whole, 4, 16, 2)
    assert (books == expected).all()
    found = {r["id"]: (r["code"], r["error"]) for r in coded.collect()}
    assert found == {i: (bytes(codes[k].tolist()).hex(), int(error[k])) for k, (i, _, _) in enumerate(whole)}
    first = vector_codes.decoded(found[0][0], books) - np.array(whole[0][1])
    assert int((first**2).sum()) == found[0][1]


def test_codes_of_odd_rows(spark):
    coded, books = vector_codes.compress(frame(spark, ODD))
    rows = vector_codes.with_label_error(coded).collect()
    assert sorted(r["id"] for r in rows) == [0, 12, 13, 16, 16, 16, 100, 200, 300]
    for label in (None, 0, 1):
        mine = [r for r in rows if r["label"] == label]
        assert {r["label_error"] for r in mine} == {sum(r["error"] for r in mine)}
    assert books.shape == (16, 9, 1) and all(len(r["code"]) == 32 for r in rows)
    none, books = vector_codes.compress(frame(spark, ODD).limit(0))
    assert vector_codes.with_label_error(none).count() == 0 and books.size == 0


def test_codes_with_a_hot_label(spark):
    rows = [(i, v, 0 if i % 3 else label) for i, v, label in some_rows(900, labels=200, seed=4)]
    coded = vector_codes.with_label_error(vector_codes.compress(frame(spark, rows))[0])
    sums = coded.groupBy("label").agg(F.sum("error").alias("e"), F.min("label_error").alias("a"), F.max("label_error").alias("b"))
    assert sums.where("e <> a or e <> b").count() == 0 and coded.count() == 900


def test_scores_are_exact():
    rng = np.random.default_rng(5)
    for dim, size in ((3, 1 << 26), (64, 1 << 25), (200, 1000), (64, 255), (1, 1)):
        a, b = rng.integers(-size, size + 1, (7, dim)), rng.integers(-size, size + 1, (9, dim))
        a[0], b[0] = size, -size
        primes = hard_negatives.primes_for(dim * size * size)
        left = [hard_negatives.residues(a, p) for p in primes]
        right = [hard_negatives.residues(b, p) for p in primes]
        exact = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
        assert hard_negatives.scores(left, right, primes).tolist() == exact
    for p in hard_negatives._primes():
        assert 64 * (p // 2) ** 2 < 1 << 24 and all(p % q for q in range(2, p))


def plain_negatives(rows, positives=5, negatives=5, percent=80):
    """All pairs; ``rows`` are whole (id, integers, label)."""
    found = []
    for k, (anchor, a, label) in enumerate(rows):
        if anchor % 100:
            continue
        scored = sorted((-sum(map(int.__mul__, a, v)), i, v, other) for j, (i, v, other) in enumerate(rows) if j != k and len(v) == len(a))
        near = [(i, -s) for s, i, _, other in scored if other == label][:positives]
        for i, top in near:
            hard = [(j, -s) for s, j, _, other in scored if other != label and percent * top <= -100 * s <= 100 * top]
            found += [(anchor, i, r + 1, j, top, s) for r, (j, s) in enumerate(hard[:negatives])]
    return sorted(found)


def whole(rows):
    kept = [
        (i, [math.floor(x * 256) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and abs(x) < 1 << 18 for x in v)
    ]
    return kept


def mined(df, **more):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("id") % 100 == 0, **more).select(*names).collect())


@pytest.mark.parametrize("blocks", [{}, {"anchors_per_block": 2, "rows_per_block": 90}])
def test_negatives_as_by_brute_force(spark, blocks):
    rows = [(i * 10, v, label) for i, v, label in some_rows(400, 16, 3, 6)] + some_rows(40, 8, 2, 7)
    df = frame(spark, rows).repartition(7)
    expected = plain_negatives(whole(rows))
    assert len(expected) > 300 and mined(df, **blocks) == expected


def test_negatives_with_a_hot_label_and_ties(spark):
    rows = [(i, [0.5] * 16 if i % 2 else v, 0 if i % 3 else 1 + i % 40) for i, v, _ in some_rows(600, 16, 3, 8, 200)]
    assert mined(frame(spark, rows), rows_per_block=100) == plain_negatives(whole(rows))


def test_negatives_of_odd_rows(spark):
    assert mined(frame(spark, ODD)) == plain_negatives(whole(ODD))
    assert mined(frame(spark, ODD).limit(0)) == []
    repeated = [(100, v, label) for _, v, label in some_rows(30, 16, 2, 9)] + [(100, [0.25] * 16, 1)] * 3
    assert mined(frame(spark, repeated).repartition(3)) == plain_negatives(whole(repeated))
