"""Export and error statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docquarry.functions import logtext
from docquarry.functions.types import column


def export_stats(df: DataFrame, text: str) -> DataFrame:
    """One row: documents, bytes of the encoded ``text`` column and the mean document size."""
    size = F.coalesce(F.sum(F.octet_length(column(text)).cast("long")), F.lit(0).cast("long"))
    documents = F.count(F.lit(1))
    average = F.when(documents > 0, size.cast("double") / documents).otherwise(F.lit(0.0))
    return df.agg(
        documents.alias("documents_exported"),
        size.alias("bytes_written"),
        average.alias("avg_document_size"),
    )


def docs_per_second(documents: Column, elapsed_ms: Column) -> Column:
    """Throughput; NULL for a run too short to time."""
    return F.when(elapsed_ms > 0, documents * 1000.0 / elapsed_ms)


def classify_messages(df: DataFrame, message: str) -> DataFrame:
    """Add category, severity, retryable and retry_delay of an error message column."""
    text = column(message)
    return df.withColumns(
        {
            "category": logtext.error_category(text),
            "severity": logtext.error_severity(text),
            "retryable": logtext.error_retryable(text),
            "retry_delay": logtext.error_retry_delay(text),
        }
    )


def error_stats(df: DataFrame, message: str) -> DataFrame:
    """Number of errors by category and by severity, as ``(dimension, value, errors)``.

    Both groupings come from one pass: messages are first counted by the pair, which has a handful
    of values, and that small result is unfolded into its two totals.
    """
    pairs = classify_messages(df, message).groupBy("category", "severity").agg(F.count(F.lit(1)).alias("n"))
    labels = F.array(
        F.struct(F.lit("category").alias("dimension"), F.col("category").alias("value")),
        F.struct(F.lit("severity").alias("dimension"), F.col("severity").alias("value")),
    )
    return (
        pairs.select(F.explode(labels).alias("label"), "n")
        .groupBy(F.col("label.dimension").alias("dimension"), F.col("label.value").alias("value"))
        .agg(F.sum("n").alias("errors"))
    )
