"""Raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; ``run`` writes every stage's rows as
Parquet to the shared folder and reads them again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination, near_dedup, packing, pii, quality
from ledgerloom.llm.queries import tokenizer_path
from ledgerloom.scale import durable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.quality(docs).filter("kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    return near_dedup.near_duplicates(docs).filter(F.col("uid") == F.col("representative")).select("doc.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination(docs, benchmark).filter("n_hit = 0").select("doc.*")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the new text."""
    clean = pii.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids, sequence_id and offset."""
    return packing.packed_sequences(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Sampling, robust estimates and the tokenizer are beyond SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        rows = durable(stage(spark, rows, sf_dir))
    return rows
