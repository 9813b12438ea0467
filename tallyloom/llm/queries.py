"""The queries of this package over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    class_ngrams,
    embeddings,
    exact_dedup,
    hard_negatives,
    jaccard_join,
    language,
    mixing,
    packing,
    pii,
    quality,
    recompression,
    vector_codes,
    warc,
)
from tallyloom.llm.sql import ORACLES
from tallyloom.llm.tables import table

__all__ = ["ORACLES", "QUERIES"]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").alias("refers_to")
    )


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(table(spark, sf_dir, "documents"))


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = class_ngrams.score_documents(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    vectors = vectors.withColumn("label", hard_negatives.shifted(F.col("label"), F.col("vec_id")))
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_source_mix": op4_source_mix,
    "op5_packing": op5_packing,
    "op6_quality_resampling": op6_quality_resampling,
    "op7_language": op7_language,
    "op8_embeddings": op8_embeddings,
    "op9_personal_data": op9_personal_data,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_lm_scores": op11_lm_scores,
    "op12_vector_codes": op12_vector_codes,
    "op13_hard_negatives": op13_hard_negatives,
}
