"""Language identification by compression.

Each language has a dictionary of raw content for zstandard: texts of labelled documents. A text is
compressed with every dictionary; the smallest result names the language, and a narrow margin to the
second rejects. Texts are lower-cased and compressed in pieces of ``_PIECE`` bytes, each with the fresh
dictionary, and the sizes of all pieces of a text are added up: in one long stream the text itself would take the
dictionary's place in the match tables and only its beginning would decide.

Fitting takes a bounded sample, ``SAMPLE`` documents a language chosen by a hash of the id, and
fills ``DICTIONARY`` bytes with equal shares of them. A share is cut at places of the whole text that a hash chooses
(``PIECES`` of them reach the driver, shares larger than one piece take several). Everything else reads all rows. Dictionaries
are the only thing sent to tasks: languages times ``DICTIONARY`` bytes.

Defined results: null text, and text without a letter, is ``und`` with score 0, rejected. Ties go to the
language that is first by code point. Without labelled documents every text is ``und``. Rows that
repeat are predicted each. An empty table gives no rows. Texts of any length are compressed whole. Columns beyond the three named
ones are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
DICTIONARY = 112 << 10
SAMPLE = 256
PIECES = 16
#: zstandard's parameters: short matches tell languages apart, so they are searched for from 3 bytes on.
PARAMETERS = {
    "window_log": 18, "hash_log": 15, "chain_log": 15, "search_log": 2, "min_match": 3, "target_length": 0, "strategy": 4,
}
#: A text is rejected unless the second-best result is larger by this share.
MARGIN = 0.01
_PIECE = 4 << 10


def held_out(id_column: str = "doc_id") -> Column:
    """Documents that are never learnt from: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> dict[str, bytes]:
    """A dictionary for each language of the labelled documents that are not held out."""
    labelled = docs.where(~held_out(id_column) & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    labelled = labelled.select(
        F.col(lang_column).alias("lang"), F.xxhash64(F.lit(7), F.col(id_column)).alias("draw"), F.col(text_column).alias("text")
    )
    counts = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # about twice the sample by a bound on the hash, so that few rows are ranked
    bound = F.lit(0.0)
    for lang, n in counts.items():
        bound = F.when(F.col("lang") == lang, F.lit(min(1.0, 2.0 * SAMPLE / n))).otherwise(bound)
    drawn = labelled.where((F.col("draw").cast("double") / 2.0**64 + 0.5) <= bound)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))
    share = DICTIONARY // SAMPLE
    rows = (
        drawn.select("lang", "draw", _pieces(F.col("text"), F.col("draw"), share).alias("text"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= SAMPLE)
        .select("lang", "draw", "text")
        .collect()
    )
    texts: dict[str, list[tuple[int, bytes]]] = {}
    for row in rows:
        texts.setdefault(row["lang"], []).append((row["draw"], row["text"].lower().encode("utf-8")))
    return {lang: _content([text for _, text in sorted(found)]) for lang, found in sorted(texts.items())}


def _pieces(text: Column, draw: Column, size: int) -> Column:
    """``PIECES`` pieces of a text at hashed places, a line each; a text of one piece is whole."""
    places = F.greatest(F.length(text) - size + 1, F.lit(1))
    cut = [F.substring(text, F.pmod(F.xxhash64(draw, F.lit(i)), places).cast("int") + 1, F.lit(size)) for i in range(PIECES)]
    return F.when(F.length(text) <= size, text).otherwise(F.array_join(F.array(*cut), "\n"))


def _content(texts: list[bytes]) -> bytes:
    """Equal shares of the texts, larger ones where others are short, in ``DICTIONARY`` bytes."""
    room, parts = DICTIONARY, []
    for i, text in enumerate(sorted(texts, key=len)):
        part = text[: room // (len(texts) - i)]
        parts.append(part.decode("utf-8", "ignore").encode("utf-8"))
        room -= len(part)
    return b"\n".join(parts)


def _predict(dictionaries: dict[str, bytes], margin: float):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        import zstandard

        letter = regex.compile(r"\p{L}")
        names = sorted(dictionaries)
        coders = [_coder(zstandard, dictionaries[name]) for name in names]
        for batch in batches:
            langs, scores, accepted = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                if not names or text is None or not letter.search(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    accepted.append(False)
                    continue
                data = text.lower().encode("utf-8")
                sizes = [_size(coder, data) for coder in coders]
                order = sorted(range(len(names)), key=lambda i: (sizes[i], names[i]))
                best = sizes[order[0]]
                second = sizes[order[1]] if len(order) > 1 else best + len(data)
                langs.append(names[order[0]])
                scores.append((second - best) / max(second, 1))
                accepted.append(scores[-1] >= margin)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    return predict


def _coder(zstandard, content: bytes):
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    parameters = zstandard.ZstdCompressionParameters(write_content_size=False, write_dict_id=False, **PARAMETERS)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)


def _size(coder, data: bytes) -> int:
    return sum(len(coder.compress(data[i : i + _PIECE])) for i in range(0, len(data), _PIECE))


def predict(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    id_column: str = "doc_id",
    text_column: str = "text",
    margin: float = MARGIN,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred`` (the nearest language), ``score`` (the margin to
    the second, 0 to 1) and ``accepted`` (the margin is not narrow)."""
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), held_out(id_column).alias("held_out"), F.col(text_column).alias("text")
    )
    return texts.mapInArrow(
        _predict(dictionaries, margin),
        "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean",
    )


def identify(docs: DataFrame, lang_column: str = "lang") -> DataFrame:
    """Fit on the labelled documents and predict all."""
    return predict(docs, fit(docs, lang_column=lang_column))
