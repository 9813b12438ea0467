"""The corpus queries against their SQL, and against plain restatements where SQL has none."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import oracle
import pytest
from tallyloom.llm.queries import ORACLES, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("select doc_id, coalesce(text, '') from documents").fetchall())


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in texts.items()}
    pieces = sorted(QUERIES["op5_packing"](spark, SF).collect(), key=lambda r: (r["doc_id"], r["start"]))
    done, sequences = dict.fromkeys(ids, 0), {}
    for r in pieces:
        own = ids[r["doc_id"]]
        assert r["start"] == done[r["doc_id"]] and r["doc_tokens"] == len(own) and r["length"] > 0
        done[r["doc_id"]] += r["length"]
        assert zlib.crc32(own[r["start"] : done[r["doc_id"]]].tobytes()) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert done == {d: len(own) for d, own in ids.items()}
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
        padding += 0 if end & (end - 1) == 0 else 2048 - end
    assert padding == 0


_BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple]:
    found = []
    for order, (kind, pattern) in enumerate(_BASE):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in match.group().split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits) if digits else False,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((match.start(), order, kind, match.end()))
    return sorted(found)


def test_personal_data(spark, texts):
    for r in QUERIES["op9_personal_data"](spark, SF).collect():
        spans = base_spans(texts[r["doc_id"]])
        line = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        counts = {k: sum(s[2] == k for s in spans) for k, _ in _BASE}
        assert counts == {k: r[f"n_{k}"] for k, _ in _BASE}
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))


def test_languages_held_out(spark, con):
    langs = dict(con.execute("select doc_id, lang from documents").fetchall())
    found = QUERIES["op7_language"](spark, "/root/testdata/sf0.01").collect()
    langs = dict(oracle.connect("/root/testdata/sf0.01").execute("select doc_id, lang from documents").fetchall())
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in langs if zlib.crc32(str(d).encode()) % 4 == 2}
    right = sum(r["lang_pred"] == langs[r["doc_id"]] for r in held)
    assert right >= 0.93 * len(held) and all(0 <= r["score"] <= 1 for r in found)


def test_quality_separates_labels(spark):
    sf = "/root/testdata/sf0.01"
    con = oracle.connect(sf)
    labels = dict(con.execute("select doc_id, quality from labels").fetchall())
    kept = {r["doc_id"]: r["kept"] for r in QUERIES["op6_quality_resampling"](spark, sf).collect()}
    good = [kept[d] for d, q in labels.items() if q == 1]
    bad = [kept[d] for d, q in labels.items() if q == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.05 * len(bad)
