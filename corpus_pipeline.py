"""A corpus pipeline: quality, exact copies, near copies, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next stage's docs. All stages but the last return the columns of documents. Defined results for
nulls, empty texts, ties, repeated rows and empty tables are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import exact_dedup, jaccard_join, mixing, packing, quality
from tallyloom.llm.queries import tokenizer_path
from tallyloom.llm.tables import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    decided = quality.resample(docs, table(spark, sf_dir, "labels"))
    lost = decided.where(~F.col("kept")).select(F.col("doc_id").alias("lost_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"))
    return rows.join(lost, F.col("id") == F.col("lost_id"), "left_anti").select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    return exact_dedup.survivors(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return jaccard_join.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", source_mix),
    ("packing", packed),
]

#: Hashed n-gram models, T-occurrence components and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
