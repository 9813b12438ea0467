"""The class-based model against plain restatements, and its edge rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import oracle
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tallyloom.llm import class_ngrams as lm
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.words import word_hashes

SF = "/root/testdata/sf0.001"
CLASHES = ("id", "row", "word", "n", "class", "held_out", "open", "base", "score", "before")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


@pytest.fixture(scope="module")
def rows():
    con = oracle.connect(SF)
    return con.execute("select doc_id, text from documents").fetchall()


def base_scores(rows):
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
    counts = Counter()
    for d, text in rows:
        if not held[d]:
            counts.update([*words(text), None])
    total, distinct = sum(counts.values()), len(counts)
    found = []
    for d, text in rows:
        c = [counts[w] for w in [*words(text), None]]
        base = sum(math.log10((x + 0.5) / (total + 0.5 * (distinct + 1))) for x in c)
        found.append((d, held[d], len(c), sum(x > 0 for x in c), total, base))
    return found


def compare(found, expected):
    def order(r):
        return (r[0] is None, r[0] or 0, r[2], r[5])

    for a, b in zip(sorted(found, key=order), sorted(expected, key=order), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9)


def plain(r):
    return r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]


def test_counts_and_base_score(spark, rows):
    found = QUERIES["op11_lm_scores"](spark, SF).collect()
    compare([plain(r) for r in found], base_scores(rows))


def test_better_than_single_words_on_held_out_texts(spark):
    found = QUERIES["op11_lm_scores"](spark, "/root/testdata/sf0.01").where("held_out")
    score, base = found.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > 0.9 * base and found.where("score >= 0 or isnan(score)").count() == 0


def plain_score(text, table, model):
    """The forward algorithm over all classes, token by token."""
    state, total = None, 0.0
    for token in [*words(text), None]:
        after = model.transitions[0] if state is None else state @ model.transitions
        here = np.zeros(len(after))
        if token is None:
            here[0] = 1.0
        elif token in table:
            n, kind = table[token]
            here[kind] = n / model.emission[kind]
        else:
            here = model.unknown
        state = after * here
        total += math.log10(state.sum())
        state = state / state.sum()
    return total


UNSEEN = [
    "unseen zzzzq", "zzzzq", "", "the zzzzq qqqqz the zzzzq", " ".join(["zzzzq", "the", "qqqqz", "zzzzq"] * 700), "qqqqz " * 9000,
]


@pytest.fixture(scope="module", params=[0, 60, 1 << 17])
def trained(request, spark, rows):
    """A model, its words, and the scores of the given texts and of held-out ones with words that are not known."""
    odd = [(900 + i, text) for i, text in enumerate([*UNSEEN, rows[0][1] + " zzzzq the"])]
    texts = spark.createDataFrame([*rows, *odd], "id long, text string")
    apart = lm.held_out(F.col("id")) | (F.col("id") >= 900)
    texts = texts.select("id", apart.alias("held_out"), F.coalesce("text", F.lit("")).alias("text")).repartition(3)
    common = lm.commonest(lm.count_words(texts), request.param)
    numbers = lm.numbered(texts, common)
    model, others, chains = lm.train(numbers, common, classes=12, rounds=4, bands=(20, 100))
    named = {}
    for _, text in [*rows, *odd]:
        named.update(dict.fromkeys(words(text)))
    hashes = dict(zip(word_hashes(pa.array(list(named)))[0].view(np.int64).tolist(), named, strict=True))
    table = {hashes[r["word"]]: (r["n"], r["class"]) for r in others.collect()}
    kinds = model.kind[2:].tolist()
    table |= {hashes[w]: (n, k) for w, n, k in zip(common.word.tolist(), common.n.tolist(), kinds, strict=True) if n}
    return model, table, [*rows, *odd], {r["id"]: r["score"] for r in lm.score(numbers, model, chains).collect()}


def test_score_is_the_forward_probability(trained):
    model, table, texts, found = trained
    assert len(found) == len(texts)
    for i, text in texts:
        assert math.isclose(found[i], plain_score(text, table, model), rel_tol=1e-9), i


def test_transitions_are_counted_with_the_final_classes(trained, rows):
    model, table, _, _ = trained
    counts = np.zeros((12, 12))
    for d, text in rows:
        if zlib.crc32(str(d).encode()) % 5 != 1:
            kinds = [0, *[table[w][1] for w in words(text)], 0]
            np.add.at(counts, (kinds[:-1], kinds[1:]), 1)
    sizes = counts.sum(axis=1)
    seen = np.maximum((counts > 0).sum(axis=1), 1)[:, None]
    frequency = (sizes + 1) / (sizes + 1).sum()
    assert np.allclose(model.transitions, (counts + seen * frequency) / (sizes[:, None] + seen))


def test_probabilities_add_up(trained):
    model, table, _, _ = trained
    mass = np.array(model.unknown)
    for n, kind in table.values():
        mass[kind] += n / model.emission[kind]
    assert np.allclose(mass[1:], 1) and model.unknown[0] == 0 and model.emission[0] == model.texts
    assert np.allclose(model.transitions.sum(axis=1), 1) and not [w for w, (_, kind) in table.items() if kind == 0]


def test_gains_are_differences_of_the_likelihood():
    rng = np.random.default_rng(2)
    vocabulary, classes = 30, 6
    pairs = rng.integers(0, vocabulary, (400, 2))
    pairs = np.concatenate([np.stack([pairs[:-1, 0], pairs[1:, 0]], axis=1), [[4, 4], [4, 4]]])
    pairs = np.concatenate([pairs, [[pairs[-1, 1], pairs[0, 0]]]])
    chain = [int(pairs[0, 0])]
    for a, b in pairs.tolist():
        chain += [b] if chain[-1] == a else [a, b]
    pairs = list(zip(chain, [*chain[1:], chain[0]], strict=True))
    kind = rng.integers(0, classes, vocabulary)

    def matrix(kind):
        m = np.zeros((classes, classes))
        for a, b in pairs:
            m[kind[a], kind[b]] += 1
        return m

    now = matrix(kind)
    word, at, n, repeats = [], [], [], np.zeros(vocabulary)
    for w in range(vocabulary):
        after = Counter(int(kind[b]) for a, b in pairs if a == w)
        before = Counter(classes + int(kind[a]) for a, b in pairs if b == w)
        for c, k in {**after, **before}.items():
            word.append(w), at.append(c), n.append(k)
        repeats[w] = sum(a == b == w for a, b in pairs)
    gain = lm.gains(kind, np.array(word), np.array(at), np.array(n), repeats, now)
    for w in range(vocabulary):
        for c in range(classes):
            other = kind.copy()
            other[w] = c
            change = lm.likelihood(matrix(other)) - lm.likelihood(now)
            assert math.isclose(gain[w, c] - gain[w, kind[w]], change, abs_tol=1e-8)


def test_clustering_finds_kinds_of_words(spark):
    """Two alternating kinds of words fall into different classes, common words and others."""
    rng = np.random.default_rng(7)
    texts = [(i, " ".join(f"{'ab'[j % 2]}{int(rng.integers(8) ** 2)}" for j in range(400))) for i in range(20)]
    df = spark.createDataFrame(texts, "id long, text string").withColumn("held_out", F.lit(False))
    names = sorted({w for _, text in texts for w in text.split()})
    hashes = dict(zip(word_hashes(pa.array(names))[0].view(np.int64).tolist(), names, strict=True))
    for local in (6, 100):
        common = lm.commonest(lm.count_words(df), local)
        model, others, _ = lm.train(lm.numbered(df, common), common, classes=5, rounds=8, bands=(4, 8))
        kinds = dict(zip((hashes[w] for w in common.word.tolist()), model.kind[2:].tolist(), strict=True))
        kinds |= {hashes[r["word"]]: r["class"] for r in others.collect()}
        assert kinds.keys() == set(names)
        assert not {k for w, k in kinds.items() if w[0] == "a"} & {k for w, k in kinds.items() if w[0] == "b"}


def test_odd_texts(spark):
    odd = [
        (5, None), (3, ""), (4, " \n\t"), (1, "One two"), (2, "one TWO"), (2, "one TWO"), (None, "one two"), (7, "ÄÖ ü 日本 word"),
        (11, "w" * 400_000), (9, "x y z " * 50_000), (8, "x y z " * 50_000 + "end"), (None, None),
    ]
    df = spark.createDataFrame(odd, "doc_id long, text string")
    df = df.withColumns({name: F.lit("x") for name in CLASHES})
    found = lm.score_documents(df, classes=5, rounds=2).collect()
    compare([plain(r) for r in found], base_scores(odd))
    assert all(r["score"] < 0 and r["perplexity"] >= 1 for r in found)
    assert lm.score_documents(df.limit(0)).count() == 0
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    alone = spark.createDataFrame([(ids[0], "one two"), (ids[1], None)], "doc_id long, text string")
    found = lm.score_documents(alone, classes=5, rounds=2).collect()
    assert all(r["held_out"] and r["base_score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in found)
    assert all(math.isfinite(r["score"]) for r in found)


@pytest.mark.parametrize("cells", [1 << 22, 0])
def test_same_whatever_the_partitioning(spark, rows, monkeypatch, cells):
    monkeypatch.setattr(lm, "_CELLS", cells)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = {r["doc_id"]: r["score"] for r in lm.score_documents(df.repartition(1), classes=8, rounds=3).collect()}
    many = {r["doc_id"]: r["score"] for r in lm.score_documents(df.repartition(9), classes=8, rounds=3).collect()}
    assert one.keys() == many.keys() and all(math.isclose(one[i], many[i], rel_tol=1e-9) for i in one)
