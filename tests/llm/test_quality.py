"""Importance resampling against a restatement in plain Python, and many sources and seats."""

from __future__ import annotations

import math
import struct
from collections import Counter

import oracle
import pyarrow as pa
import pytest
import xxhash
from tallyloom.llm import mixing, quality

SF = "/root/testdata/sf0.001"


def spark_hash(seed: int, number: int) -> int:
    """Spark's 64-bit hash of an int and a long, signed."""
    first = xxhash.xxh64(struct.pack("<i", seed), seed=42).intdigest()
    both = xxhash.xxh64(struct.pack("<q", number), seed=first).intdigest()
    return both - (1 << 64) if both >> 63 else both


def grams(text: str) -> Counter:
    """Buckets of one text's words, pairs and shapes."""
    return Counter(quality.features(pa.array([text]))[0].tolist())


def restated(texts: dict[int, str], labels: dict[int, int]) -> dict[int, tuple[float, float, bool]]:
    counts = {d: grams(t) for d, t in texts.items()}
    raw, target = Counter(), Counter()
    for d, found in counts.items():
        raw.update(found)
        if labels.get(d) == 1:
            target.update(found)
    all_raw = sum(raw.values()) + quality.BUCKETS
    all_target = sum(target.values()) + quality.BUCKETS

    def ratio(bucket: int) -> float:
        return math.log((target[bucket] + 1) / all_target) - math.log((raw[bucket] + 1) / all_raw)

    weight = {d: sum(n * ratio(b) for b, n in found.items()) for d, found in counts.items()}
    key = {}
    for d, w in weight.items():
        uniform = (spark_hash(quality.SEED, d) + 2.0**63) / 2.0**64
        key[d] = w - math.log(-math.log(max(2.0**-60, min(uniform, 1 - 2.0**-53))))
    good = [weight[d] for d, q in labels.items() if q == 1 and d in weight]
    bad = [weight[d] for d, q in labels.items() if q != 1 and d in weight]
    places = sorted({*good, *bad})
    cuts = [places[0], *[(a + b) / 2 for a, b in zip(places[:-1], places[1:], strict=True)]]

    def balanced(cut: float) -> float:
        return sum(w < cut for w in bad) / len(bad) + sum(w >= cut for w in good) / len(good)

    cut = max(cuts, key=lambda c: (round(balanced(c), 9), -c))
    k = sum(w >= cut for w in weight.values())
    stays = set(sorted(key, key=lambda d: (-key[d], d))[:k])
    return {d: (weight[d], key[d], d in stays) for d in texts}


def test_features_are_words_pairs_and_shapes():
    assert sum(grams("one two  two").values()) == 3 + 2 + 3
    assert grams("Ab1 x") == grams(" Ab1\tx\n") and grams("") == Counter()
    # a word after itself is one n-gram, whatever the word
    assert (grams("q q") - grams("q") - grams("q")) == (grams("zz zz") - grams("zz") - grams("zz"))
    # shapes: letters by case and digits are alike
    assert len(grams("ab") & grams("cd")) == 1 and not grams("ab") & grams("c1")


def test_resampling_as_by_brute_force(spark):
    con = oracle.connect(SF)
    texts = dict(con.execute("select doc_id, coalesce(text, '') from documents").fetchall())
    marks = con.execute("select doc_id, min(quality) from labels where quality is not null group by doc_id").fetchall()
    expected = restated(texts, dict(marks))
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    found = {r["doc_id"]: r for r in quality.resample(docs, labels).collect()}
    assert found.keys() == expected.keys()
    for d, (weight, key, kept) in expected.items():
        assert found[d]["log_weight"] == pytest.approx(weight, abs=1e-6)
        assert found[d]["key"] == pytest.approx(key, abs=1e-6)
        assert found[d]["kept"] == kept


def plain_targets(sizes: dict[str, int]) -> dict[str, float]:
    """Targets by raising one common share until no source is above its limit."""
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes))}
    left, targets = set(sizes), {}
    words = sum(sizes.values())
    while left:
        share = words / sum(weights[s] for s in left)
        full = {s for s in left if 3 * sizes[s] < weights[s] * share}
        if not full:
            return targets | {s: weights[s] * share for s in left}
        targets |= {s: 3.0 * sizes[s] for s in full}
        words -= sum(3 * sizes[s] for s in full)
        left -= full
    return targets


def test_targets_of_many_sources(spark):
    sizes = {f"s{i:05d}": 1 + i * i % 9973 for i in range(4000)}
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long").repartition(5)
    found = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    assert found == pytest.approx(plain_targets(sizes), rel=1e-9)


def test_seats_of_groups_of_many_parties(spark):
    votes = {(g, i): (7 * i * i + 13 * g) % 997 for g in range(3) for i in range(400)}
    rows = [(g, i, v, 1000 + g) for (g, i), v in votes.items()]
    parties = spark.createDataFrame(rows, "grp int, party long, votes long, total long").repartition(5)
    found = {(r["grp"], r["party"]): r["quota"] for r in mixing.seats(parties, ["grp"], "party", "votes", "total").collect()}
    for g in range(3):
        quotients = sorted((-votes[g, i] / (2 * k + 1), i, k) for i in range(400) for k in range(40) if votes[g, i])
        won = Counter(i for _, i, _ in quotients[: 1000 + g])
        assert {i: found[g, i] for i in range(400)} == {i: won[i] for i in range(400)}
