"""A corpus cleaned and encoded: five stages, each reading what the one before it wrote.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame.  All but the last return the columns
of ``documents``; the last returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docquarry.llm.decontaminate import drop_contaminated
from docquarry.llm.exact_dedup import drop_exact_duplicates
from docquarry.llm.near_dedup import drop_near_duplicates
from docquarry.llm.piece_codec import default_model, encode_pieces
from docquarry.llm.quality import drop_low_quality, train_quality
from docquarry.llm.rows import small_batches
from docquarry.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier scores a half or more."""
    small_batches(spark)
    weights = train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return drop_low_quality(docs, weights)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (A-Z lower-cased)."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of what is left."""
    return encode_pieces(docs, default_model())


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", decontaminate),
    ("pieces", pieces),
]

#: SQL expresses neither the trained classifier nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
