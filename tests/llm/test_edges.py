"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names, many alike."""

from __future__ import annotations

import hashlib
import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tallyloom.llm import (
    embeddings,
    exact_dedup,
    jaccard_join,
    language,
    mixing,
    packing,
    pii,
    quality,
    recompression,
    warc,
)
from tallyloom.llm.components import connected_components
from tallyloom.llm.queries import tokenizer_path
from tallyloom.llm.tables import written
from tallyloom.llm.tokens import Encoder
from tallyloom.llm.words import LOWER, word_hashes

CLASHES = ("id", "digest", "row", "keep_id", "shingle", "class", "cell", "source_rank", "key", "found", "value", "lost_id")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(words))


def docs(spark, rows):
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    frame = spark.createDataFrame(full, DOCS)
    return frame.withColumns({name: F.lit("x") for name in CLASHES})


LONG = prose(1, 60_000)
ROWS = [
    (5, None, "a"), (3, "", "a"), (4, " \n\t", None), (1, "one two", "b"), (2, "one two", "b"), (2, "one two", "b"),
    (9, LONG, "a"), (8, LONG + " end", "a"), (None, "one two", None), (7, "ÄÖ ü 日本 word", "c"), (None, None, "c"),
    (6, prose(2, 120), "b"), (10, prose(2, 119) + " other", "b"), (11, "w" * 400_000, "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ROWS)


@pytest.fixture(scope="module")
def none(spark):
    return docs(spark, ROWS).limit(0)


def test_exact_dedup(odd, none):
    found = {}
    for r in exact_dedup.decisions(odd).collect():
        found.setdefault(r["doc_id"], []).append((r["keep_id"], r["group_size"], r["kept"]))
    assert found[5] == [(5, 3, True)] and found[3] == [(5, 3, False)]
    assert found[2] == [(2, 4, True)] * 2 and found[1] == [(2, 4, False)]
    assert sorted(found[None]) == [(2, 4, False), (5, 3, False)]
    left = exact_dedup.survivors(odd)
    assert left.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(map(str, [5, 4, 2, 9, 8, 7, 6, 10, 11]))
    assert exact_dedup.decisions(none).count() == 0 and exact_dedup.survivors(none).count() == 0


def test_exact_dedup_many_alike(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 700)).alias("text"),
    )
    assert exact_dedup.survivors(rows).count() == rows.select("text").distinct().count()
    hot = exact_dedup.decisions(rows).where("group_size = 1000").agg(F.count("*"), F.min("keep_id"), F.max("keep_id"))
    assert tuple(hot.first()) == (1000, 2997, 2997)


@pytest.mark.parametrize("sent", [1 << 18, 0])
def test_survivors_are_the_kept_rows(spark, monkeypatch, sent):
    """Groups of two to many, null ids, rows that repeat whole or in id and text alone."""
    monkeypatch.setattr(exact_dedup, "SENT", sent)
    rng = random.Random(9)
    rows = [(i, f"text {min(rng.randrange(300), rng.randrange(300))}", "a") for i in range(1500)]
    rows += [rows[10], (10, rows[10][1], "b"), (1499, rows[1499][1], "b"), rows[1499], (None, "alone", "a"), (None, "text 1", "a")]
    df = docs(spark, rows).repartition(5)
    left = exact_dedup.survivors(df)
    best = {}
    for i, text, _ in rows:
        best[text] = i if best.get(text) is None else max(best[text], i if i is not None else -1)
    assert left.columns == df.columns
    found = [(r["text"], r["doc_id"], r["source"]) for r in left.collect()]
    assert sorted((t, str(i)) for t, i, _ in found) == sorted((t, str(i)) for t, i in best.items())
    assert {s for _, i, s in found if i == 1499} == {"b"}


def test_jaccard(spark, odd, none):
    found = {}
    for r in jaccard_join.components(odd).collect():
        found.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert found[5] == [(0, 5)] and found[3] == [(0, 3)] and found[4] == [(0, 4)]
    assert found[1] == [(1, 1)] and found[2] == [(1, 1)] * 2
    assert found[9][0][1] == found[8][0][1] == 8 and found[6][0][1] == found[10][0][1] == 6
    assert sorted(found[None], key=str) == [(0, None), (1, 1)]
    assert jaccard_join.components(none).count() == 0
    left = jaccard_join.representatives(odd)
    assert left.columns == odd.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == [1, 3, 4, 5, 6, 7, 8, 11]


def brute_components(texts: dict[int, str]) -> dict[int, int]:
    sets = {}
    for i, text in texts.items():
        words = text.encode().lower().split()
        grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)] or ([tuple(words)] if words else [])
        sets[i] = set(grams)
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("block", [1 << 20, 3000])
def test_jaccard_of_many_near_copies(spark, monkeypatch, block):
    """A large group of near copies, chains, and texts with one passage; in one and in many blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "FREQUENT_FROM", 3)
    rng = random.Random(4)
    base, passage, texts = prose(7, 120).split(), prose(8, 60), {}
    for i in range(160):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(words)
    for i in range(160, 220):
        texts[i] = prose(100 + i, rng.randint(5, 200)) + " " + passage
    chain = prose(9, 80).split()
    for i in range(220, 240):
        chain = chain[3:] + prose(i, 3).split()
        texts[i] = " ".join(chain).upper()
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.components(frame).collect()}
    assert found == brute_components(texts)


def test_mixing(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    again = sorted(map(str, mixing.mix(odd.repartition(5)).collect()))
    assert sorted(map(str, rows)) == again
    left = mixing.mixed_documents(odd)
    assert left.columns == odd.columns and left.where("text = ''").count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_seats_by_highest_quotients(spark):
    votes = [100_000, 80_000, 30_000, 20_000, 1, 0]
    parties = spark.createDataFrame([(i, v, 37) for i, v in enumerate(votes)], "party long, votes long, total long")
    found = {r["party"]: r["quota"] for r in mixing.seats(parties, [], "party", "votes", "total").collect()}
    seats = dict.fromkeys(range(len(votes)), 0)
    for _ in range(37):
        best = max(seats, key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    assert found == seats


def test_packing(spark, odd, none):
    pieces = packing.pack(odd, tokenizer_path(), with_ids=True).collect()
    encoder = Encoder(tokenizer_path())
    total = sum(len(ids) + 1 for ids in encoder.encode(pa.array([t for _, t, _ in ROWS])))
    assert sum(r["length"] for r in pieces) == total == sum(len(r["ids"]) for r in pieces)
    assert sum(r["doc_tokens"] == 1 for r in pieces) == 3
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_sum_of_squares_choice():
    rng = random.Random(3)
    levels = packing.Levels(64)
    for i in range(400):
        size = rng.randint(1, 63)
        counts = levels.counts.copy()

        def cost(level, size=size, counts=counts):
            after = counts.copy()
            if level:
                after[level] -= 1
            if level + size < 64:
                after[level + size] += 1
            return int((after[1:64] ** 2).sum())

        allowed = [0, *[h for h in range(1, 64 - size + 1) if counts[h]]]
        assert cost(levels.choose(size)) == min(map(cost, allowed))
        levels.place((i, 0, np.zeros(size, "<u4"), size), size)
    closed = list(levels.close())
    lengths = [sum(len(p[2]) for p in s) for s in closed]
    assert sum(n != 64 for n in lengths) <= 6 and all(n & (n - 1) == 0 for n in lengths)


def test_tokens_are_the_tokenizers():
    encoder = Encoder(tokenizer_path())
    rng = random.Random(5)
    letters = "aZé ß'\n  \t12²ñ!.,|<stremvld’x\r\x0b日\xa0"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["<|endoftext|> a<|endoftext|>", "I'll don't 's", None, "", "   ", "a   \n b"]
    plain = [t or "" for t in texts]
    wanted = [e.ids for e in encoder.tokenizer.encode_batch(plain, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(pa.array(texts))] == wanted


def test_word_hashes_tell_words():
    texts = ["a b  A\tb", None, "", " x ", "ab", "a\x0bb", "w" * 600_000, "w" * 600_001]
    names, bounds = word_hashes(pa.array(texts), LOWER)
    words = [w for t in texts for w in (t or "").encode().lower().split()]
    assert len(names) == len(words) == bounds[-1]
    assert len(set(names.tolist())) == len(set(words))
    assert names[0] == names[2] and names[1] == names[3]


def test_quality(spark, odd, none):
    labels = spark.createDataFrame([(9, 1, 0), (2, 0, 0), (None, 1, 0), (6, None, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.resample(odd, labels).collect()
    assert len(rows) == len(ROWS) and next(r["kept"] for r in rows if r["doc_id"] == 9)
    assert {r["log_weight"] for r in rows if r["doc_id"] in (5, 3, 4)} == {0.0}
    assert all(r["kept"] for r in quality.resample(odd, labels.limit(0)).collect())
    assert quality.resample(none, labels).count() == 0
    many = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    for share in (0.0, 0.3, 1.0):
        assert quality.resample(many, labels, share=share).where("kept").count() == round(500 * share)


def test_kth_with_ties(spark):
    keys = spark.createDataFrame([(i, float(i // 10)) for i in range(100)], "doc_id long, key double")
    for k in (1, 9, 10, 11, 55, 100):
        key, last = quality._kth(keys, k)
        kept = [i for i in range(100) if i // 10 > key or (i // 10 == key and (last is None or i <= last))]
        assert len(kept) == k


def test_language(spark, odd, none):
    rows = language.identify(odd).collect()
    assert len(rows) == len(ROWS)
    assert all((r["lang_pred"] == "und") == (r["score"] == 0) or r["lang_pred"] == "en" for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (5, 3, 4)} == {"und"}
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}
    assert language.identify(none).count() == 0


def test_language_of_the_whole_text(spark):
    """A short beginning in one language does not outweigh a long rest in another."""
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    dictionaries = language.fit(given)

    def held(lang: str, size: int) -> str:
        rows = given.where(language.held_out() & (F.col("lang") == lang)).orderBy("doc_id").select("text").collect()
        text = " ".join(r["text"] for r in rows)
        return (text * (size // len(text) + 1))[:size]

    mixed = [(1, held("fr", 32 << 10) + held("en", 128 << 10), "x"), (2, held("de", 64 << 10) + held("es", 500 << 10), "x"),
             (3, held("en", 8 << 10) + held("de", 24 << 10), "x")]
    found = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs(spark, mixed), dictionaries).collect()}
    assert found == {1: "en", 2: "es", 3: "de"}


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    a = rng.standard_normal(16)
    rows = [(i, (a + 0.05 * rng.standard_normal(16)).tolist()) for i in range(40)]
    rows += [(100 + i, rng.standard_normal(16).tolist()) for i in range(40)]
    rows += [(200, a.tolist()), (201, (3 * a).tolist()), (202, a.tolist()), (202, a.tolist()), (203, None), (204, [0.0] * 16)]
    rows += [(205, [float("nan")] * 16), (206, [None] * 16), (207, []), (208, a[:8].tolist()), (None, a.tolist()), (209, [float("inf")] + [0.0] * 15)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("digest", F.lit(1)).withColumn("rep", F.lit(2))
    found = {}
    for r in embeddings.near_duplicates(frame).collect():
        found.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    usable = [(i, np.array(v)) for i, v in rows if i is not None and v and i not in (204, 205, 206, 209)]
    for i, v in usable:
        links = sum(len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.95 for _, w in usable) - 1
        assert {n for n, _, _ in found[i]} == {links}
    assert {c for i in range(40) for _, c, _ in found[i]} == {0} and found[200][0][1] == 0 and len(found[202]) == 2
    for i in (203, 204, 205, 206, 207, 208, 209):
        assert found[i] == [(0, i, True)]
    assert found[None] == [(0, None, False)]
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_embeddings_in_blocks(spark, monkeypatch):
    """A large near-identical group: every link is counted once, in one block or many."""
    rng = np.random.default_rng(3)
    a = rng.standard_normal(16)
    rows = [(i, (a + rng.uniform(0, 0.2) * rng.standard_normal(16)).tolist()) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    wanted = ((x @ x.T) >= 0.95).sum(axis=1) - 1
    monkeypatch.setattr(embeddings, "BLOCK", 50)
    found = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(frame).collect()}
    assert sum(found.values()) >= 0.98 * wanted.sum() and all(found[i] <= wanted[i] for i in found)


@pytest.mark.parametrize(("dim", "kind"), [(16, "double"), (64, "float"), (256, "float")])
def test_embeddings_find_the_links_of_all_pairs(spark, monkeypatch, dim, kind):
    """Clusters around the threshold, in few and many dimensions, in blocks: recall by all pairs."""
    rng = np.random.default_rng(dim)
    centres = rng.standard_normal((30, dim))
    rows = [(i, (centres[i % 30] + rng.uniform(0, 0.35) * rng.standard_normal(dim)).astype(np.float32).tolist()) for i in range(1500)]
    x = np.array([v for _, v in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T) >= 0.95
    np.fill_diagonal(near, False)
    monkeypatch.setattr(embeddings, "BLOCK", 300)
    monkeypatch.setattr(embeddings, "BUCKET", 32)
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")).collect()}
    got = np.array([found[i]["n_links"] for i in range(1500)])
    assert (got <= near.sum(axis=1)).all() and got.sum() >= 0.99 * near.sum() > 1000
    for i, j in zip(*np.nonzero(near), strict=True):
        if got[i] == near[i].sum():
            assert found[i]["component_id"] == found[j]["component_id"]


def test_rotation_codes_estimate_without_bias():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((2000, 64)), rng.standard_normal(64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    q /= np.linalg.norm(q)
    turn = embeddings.rotation(64)
    packed, factor = embeddings.codes(x, turn)
    signs = np.unpackbits(packed, axis=1, count=64) * 2.0 - 1
    error = (signs @ (turn @ q)) / 8 / factor - x @ q
    bound = embeddings.CONFIDENCE * np.sqrt((1 - factor**2) / factor**2 / 63)
    assert abs(error.mean()) < 0.01 and (np.abs(error) <= bound).mean() > 0.99


def test_personal_data(spark, odd, none):
    texts = ["mail a.b@c.de, d@e.f@g.h +49 (30) 123-4567 1.2.3.4.5.6.7.8", "999.1.1.1 4111 1111 1111 1111 x4111-1111-1111-1112",
             "日本 x@y.zz " + "q" * 5, "a" * 100_000 + "@" + "b" * 5, "1" * 50_000]
    from llm.test_queries import base_spans

    frame = docs(spark, [(i, t, "a") for i, t in enumerate(texts)])
    for r in pii.personal_data(frame).collect():
        line = ",".join(f"{k}:{s}:{e}" for s, _, k, e in base_spans(texts[r["doc_id"]]))
        assert r["spans"] == line and r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
    rows = pii.personal_data(odd).collect()
    assert len(rows) == len(ROWS) and {r["spans"] for r in rows} == {""}
    assert pii.personal_data(none).count() == 0


def test_long_domains_and_many_matches(spark):
    from llm.test_queries import base_spans

    many = " ".join(f"a{i}@b.c" for i in range(40_000))
    texts = ["x a@b" + ".c" * 200_000 + " y", "1" + " 1" * 200_000, "+1" + "(2" * 100_000, many, "1.2" * 2000, "a@" * 100_000]
    found = pii.personal_data(docs(spark, [(i, t, "a") for i, t in enumerate(texts)]))
    for r in found.select("doc_id", "spans", "n_email").collect():
        line = ",".join(f"{k}:{s}:{e}" for s, _, k, e in base_spans(texts[r["doc_id"]]))
        assert r["spans"] == line, r["doc_id"]
    clean = {r["doc_id"]: r["sanitised"] for r in pii.sanitised(found).collect()}
    assert clean[0] == "x [EMAIL] y" and clean[3] == " ".join(["[EMAIL]"] * 40_000)


def plain_terms(rows) -> dict[int, list[str]]:
    """Shares of all terms and entities from their definition, and the spans of the terms that disclose one."""
    import math
    import re

    from llm.test_queries import base_spans

    word = re.compile(r"[^\W\d_]{4,}")
    texts = [t or "" for _, t, _ in rows]
    entities, terms = {}, {}
    for i, text in enumerate(texts):
        for a, _, kind, b in base_spans(text):
            value = re.sub("[^0-9]", "", text[a:b]) if kind in ("card", "phone") else text[a:b].lower()
            entities.setdefault((kind, value), set()).add(i)
        for w in word.findall(text):
            terms.setdefault(w.lower(), set()).add(i)
    z2, shown = pii.Z**2, set()
    for term, has in terms.items():
        for with_entity in entities.values():
            n, p = len(has), len(has & with_entity) / len(has)
            low = (p + z2 / (2 * n) - pii.Z * math.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
            rarity = len(with_entity) / len(texts)
            if rarity < 1 and low >= pii.LIKELY and math.log(low / rarity) / -math.log(rarity) >= pii.THRESHOLD:
                shown.add(term)
    spans = {}
    for (i, _, _), text in zip(rows, texts, strict=True):
        base = base_spans(text)
        own = [(m.start(), 4, "term", m.end()) for m in word.finditer(text) if m.group().lower() in shown]
        own = [h for h in own if not any(a < h[3] and h[0] < b for a, _, _, b in base)]
        spans[i] = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted([*base, *own]))
    return spans


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_shares_as_by_brute_force(spark, monkeypatch, sent):
    """Entities in one and in many documents, terms with and without them, with both ways to meet."""
    monkeypatch.setattr(pii, "SENT", sent)
    rng = random.Random(6)
    names, mails = [prose(200 + i, 1) + "name" for i in range(12)], [f"m{i}.name@x{i}.org" for i in range(12)]
    rows = []
    for i in range(160):
        text = prose(i % 70, 12).split()
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            k = min(rng.randrange(12), rng.randrange(12))
            text += [mails[k]] if rng.random() < 0.9 else []
            text += [names[k].title()] if rng.random() < 0.9 else []
        rng.shuffle(text)
        rows.append((i, " ".join(text) + (" +49 (30) 1234567" if i % 3 == 0 else ""), "a"))
    rows += [(200 + i, f"only once {prose(900 + i, 3)} lone{i}@x.org", "b") for i in range(5)]
    wanted = plain_terms(rows)
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs(spark, rows).repartition(3)).collect()}
    assert found == wanted and sum("term" in s for s in wanted.values()) > 20
    assert all("term" not in wanted[200 + i] for i in range(5))


def test_terms_that_disclose(spark):
    """A name that stands only with one address is a term; a common word near it is none."""
    rows = [(i, f"{prose(i, 30)} common Zebulon writes from zeb@home.org {prose(50 + i, 20)}", "a") for i in range(5)]
    rows += [(i, f"{prose(i, 40)} common words", "a") for i in range(5, 40)]
    found = pii.personal_data(docs(spark, rows))
    by_id = {r["doc_id"]: r for r in pii.sanitised(found).collect()}
    text = rows[0][1]
    start = text.index("Zebulon")
    assert f"term:{start}:{start + 7}" in by_id[0]["spans"].split(",")
    assert "common" in by_id[0]["sanitised"] and "[EMAIL]" in by_id[0]["sanitised"]
    assert "Zebulon" not in by_id[0]["sanitised"] and by_id[20]["sanitised"] is None


def terms_of(spark, rows) -> dict[int, set[str]]:
    """The terms marked in each document."""
    texts, found = {i: t for i, t, _ in rows}, {}
    for r in pii.personal_data(docs(spark, rows)).collect():
        spans = [span.split(":") for span in r["spans"].split(",") if span]
        found[r["doc_id"]] = {texts[r["doc_id"]][int(a) : int(b)] for kind, a, b in spans if kind == "term"}
    return found


def test_terms_of_few_contexts(spark):
    """Copies count as documents, and two sightings in a large table are enough."""
    rows = [(i, f"Zebulon writes from zeb@home.org {prose(1, 20)}", "a") for i in range(5)]
    rows += [(i, f"Quillon {prose(i, 9)} quill@home.net", "a") for i in (5, 6)]
    rows += [(i, f"{prose(i, 20)} writes from", "a") for i in range(7, 500)]
    found = terms_of(spark, rows)
    assert all("Zebulon" in found[i] and "writes" not in found[i] for i in range(5))
    assert "Quillon" in found[5] and "Quillon" in found[6]


def test_terms_far_from_the_entity(spark):
    """Terms and entities meet anywhere in a document."""
    far = "common words " * 40
    rows = [(i, f"Zebulon {far}{prose(i, 30)} {far}zeb@home.org", "a") for i in range(5)]
    rows += [(i, f"{prose(i, 40)} common words", "a") for i in range(5, 40)]
    found = terms_of(spark, rows)
    assert all("Zebulon" in found[i] and not found[i] & {"common", "words"} for i in range(5))


def test_terms_without_the_entity(spark):
    """A disclosing term is marked where the entity does not stand."""
    rows = [(i, f"{prose(i, 30)} Zebulon writes from zeb@home.org", "a") for i in range(9)]
    rows += [(9, f"{prose(9, 30)} zebulon, alone", "a")]
    rows += [(i, f"{prose(i, 40)} common words", "a") for i in range(10, 100)]
    found = terms_of(spark, rows)
    assert found[9] == {"zebulon"} and all("Zebulon" in found[i] for i in range(9)) and not found[50]


def test_warc(spark, tmp_path):
    payloads = ["", None, "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n", "x" * 3_000_000, "same", "same", "same", "ends\r\n", "\r", "日本\n"]
    rows = [(i, f"http://h/{i} \r\n", p) for i, p in enumerate(payloads)] + [(None, None, "same"), (4, "http://h/4", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("x"))
    warc.write_archives(pages, str(tmp_path / "w"))
    records = warc.resolved(written(warc.read_archives(spark, str(tmp_path / "w"), with_payload=True), "r")).collect()
    found = {}
    for r in records:
        found.setdefault(r["page_id"], []).append(r)
    assert len(records) == len(rows)
    for page, _, payload in rows:
        data = (payload or "").encode()
        assert {bytes(r["payload"]) for r in found[page]} == {data}
        assert {r["payload_bytes"] for r in found[page]} == {len(data)}
    assert [r["record_type"] for r in found[4]] == ["response"] * 2
    assert found[5][0]["refers_to_page"] == found[None][0]["refers_to_page"] == 4 and found[1][0]["refers_to_page"] == 0
    assert warc.archive_and_read(pages.limit(0)).count() == 0
    assert warc.archive_and_read(pages, least=5).where("record_type = 'revisit'").count() == 0


def brute_removed(texts: dict[int, str]) -> dict[int, int]:
    first, removed = {}, {}
    for i in sorted(texts):
        words = texts[i].split()
        gone = set()
        for k in range(len(words) - 49):
            window = tuple(words[k : k + 50])
            if first.setdefault(window, i) < i:
                gone.update(range(k, k + 50))
        removed[i] = len(gone)
    return removed


def test_repeated_passages(spark, odd, none):
    rows = {}
    for r in recompression.remove_repeats(odd, with_text=True).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert rows[9][0]["n_removed"] == 60_000 and rows[8][0]["n_removed"] == 0 and len(rows[2]) == 2
    assert rows[10][0]["n_removed"] == 119 and rows[10][0]["kept_text"] == "other" and rows[5][0]["n_words"] == 0
    assert recompression.remove_repeats(none).count() == 0


def test_repeated_passages_of_a_repeated_id(spark):
    """A copy does not take another text of its id out of the candidates."""
    copied, shared, later = prose(900, 80), prose(901, 60), prose(902, 60)
    rows = [(1, copied), (2, shared + " end"), (7, copied), (7, f"{shared} {later}"), (9, f"{later} rest")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["doc_id"], r["n_removed"]) for r in recompression.remove_repeats(frame).collect())
    assert found == [(1, 0), (2, 0), (7, 60), (7, 80), (9, 60)]


def test_copies_alone_send_no_windows(spark, monkeypatch):
    """A document whose passages stand in its copies only has nothing to verify."""
    tables = {}
    monkeypatch.setattr(recompression, "written", lambda df, label: tables.setdefault(label, written(df, label)))
    copied, shared = prose(910, 90), prose(911, 70)
    rows = [(1, copied), (2, copied), (3, f" {copied} "), (4, f"{shared} one"), (5, f"two {shared}"), (5, copied)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["doc_id"], r["n_removed"]) for r in recompression.remove_repeats(frame).collect())
    assert found == [(1, 0), (2, 90), (3, 90), (4, 0), (5, 70), (5, 90)]
    assert {r["doc_id"] for r in tables["windows"].collect()} == {4, 5}


def test_repeated_passages_by_brute_force(spark):
    """Runs, periods, repeats at ends, passages that many share, windows with one letter."""
    rng = random.Random(6)
    passages = [prose(300 + i, n) for i, n in enumerate((49, 50, 51, 70, 200))]
    passages += ["a " * 60, "a b " * 40, ("a " * 25 + "b " * 25), ("c " * 30 + "d " * 30)]
    texts = {}
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else prose(rng.randrange(10**6), rng.randint(0, 60)) for _ in range(4)]
        texts[i] = " ".join(parts)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["n_removed"] for r in recompression.remove_repeats(frame).collect()}
    assert found == brute_removed(texts)


def test_components(spark):
    links = [(1, 2), (2, 3), (7, 8), (9, 9), (5, 4), (4, 3)] + [(100 + i, 101 + i) for i in range(40)] + [(500, 600 + i) for i in range(50)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    by = {r["node"]: r["component"] for r in found.collect()}
    assert found.count() == len(by)
    assert {by[i] for i in (1, 2, 3, 4, 5)} == {1} and by[8] == 7 and {by[100 + i] for i in range(41)} == {100}
    assert {by[600 + i] for i in range(50)} == {500}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark, odd, none, tmp_path):
    labels = spark.createDataFrame([(9, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for start, rows in ((odd, True), (none, False)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            before, now = now, written(stage(spark, now, str(tmp_path)), name.replace(" ", "-"))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert now.columns == before.columns
        assert (now.count() > 0) == rows


def test_pipeline_over_documents(spark):
    sf = "/root/testdata/sf0.001"
    pieces = corpus_pipeline.run(spark, sf).collect()
    ids = {r["doc_id"] for r in pieces}
    documents = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert not any(labels.get(i) == 0 for i in ids)
    assert len({documents[i] for i in ids}) == len(ids)
