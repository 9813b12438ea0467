"""Languages against plain zstandard, and ties between them."""

from __future__ import annotations

import zlib

import oracle
import pytest
import regex
import zstandard
from pyspark.sql import functions as F
from tallyloom.llm import language

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string"


def plain_size(content: bytes, text: str) -> int:
    """A text's pieces of 4 KiB, each compressed by a compressor of its own."""
    data, size = text.lower().encode(), 0
    for i in range(0, len(data), 4096):
        parameters = zstandard.ZstdCompressionParameters(write_content_size=False, write_dict_id=False, **language.PARAMETERS)
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        size += len(zstandard.ZstdCompressor(compression_params=parameters, dict_data=words).compress(data[i : i + 4096]))
    return size


@pytest.fixture(scope="module")
def rows():
    return oracle.connect(SF).execute("select doc_id, text, lang from documents").fetchall()


def test_predictions_as_by_plain_compression(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    contents = language.fit(docs)
    assert sorted(contents) == sorted({lang for _, _, lang in rows if lang}) and all(len(c) <= language.DICTIONARY + 300 for c in contents.values())
    for r in language.predict(docs, contents).collect():
        text = next(t for d, t, _ in rows if d == r["doc_id"])
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if text is None or not regex.search(r"\p{L}", text):
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
            continue
        sizes = sorted((plain_size(c, text), lang) for lang, c in contents.items())
        margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        assert r["lang_pred"] == sizes[0][1] and abs(r["score"] - margin) < 1e-12 and r["accepted"] == (margin >= language.MARGIN)


def test_ties_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(1, "one two three", None), (2, "ÄÖÜ", None), (3, "12 34", None)], SCHEMA)
    found = language.predict(docs, {"b": b"one two three four", "a": b"one two three four"}).collect()
    assert [(r["lang_pred"], r["score"], r["accepted"]) for r in found] == [("a", 0.0, False)] * 2 + [("und", 0.0, False)]


def test_dictionaries_hold_no_held_out_text_and_all_parts_of_long_ones(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2][:3]
    out = next(i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2)
    long = " ".join(f"begin{i}" for i in range(4000)) + " " + " ".join(f"finish{i}" for i in range(4000))
    rows = [(ids[0], long, "en"), (ids[1], "short words", "en"), (ids[2], None, "en"), (out, "secretword", "en")]
    content = language.fit(spark.createDataFrame(rows, SCHEMA))["en"].decode()
    assert "secretword" not in content and "short words" in content and "begin" in content and "finish" in content
    piece = language.DICTIONARY // language.SAMPLE
    for line in content.split("\n"):
        assert line in long or line == "short words"
        assert len(line) <= piece


def test_pieces_lie_all_over_a_text(spark):
    text = "".join(chr(0x4E00 + i) for i in range(20_000))
    df = spark.createDataFrame([(i, text) for i in range(50)], "draw long, text string")
    cut = df.select(language._pieces(F.col("text"), F.col("draw"), 448).alias("p")).collect()
    starts = [ord(line[0]) - 0x4E00 for r in cut for line in r["p"].split("\n")]
    assert len(starts) == 50 * language.PIECES and min(starts) < 500 and max(starts) > 19_000
    assert sum(s > 10_000 for s in starts) > 300
