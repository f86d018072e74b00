"""Collection scans: whole, sampled and snapshot-consistent.

A collection is any DataFrame.  Files are read fail-fast, so the first unreadable document aborts
the query instead of being dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docquarry.functions import types as dt

_FAIL_FAST = {"mode": "FAILFAST"}


def scan(
    spark: SparkSession, source: str, format: str = "parquet", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """All documents of one collection: a path, or with ``format="table"`` a table name.

    ``format="jsonl"`` reads one JSON document per line into a single VARIANT column ``doc``; any
    other format is a Spark reader format and keeps its own columns.
    """
    if format == "table":
        return spark.table(source)
    if format == "jsonl":
        return as_documents(spark.read.options(**options).text(source), "value")
    reader = spark.read.format(format).options(**{**_FAIL_FAST, **options})
    return (reader.schema(schema) if schema is not None else reader).load(source)


def as_documents(df: DataFrame, text: str, doc: str = "doc") -> DataFrame:
    """Parse a JSON text column into a VARIANT column; malformed text or a repeated key raises."""
    kept = [dt.column(c) for c in df.columns if c != text and c != doc]
    return df.select(*kept, F.parse_json(dt.column(text)).alias(doc))


def sample(df: DataFrame, n: int, key: str | None = None, limit: int | None = None) -> DataFrame:
    """First ``n`` documents, never more than the caller's ``limit``; in key order when a key is given."""
    if n <= 0:
        raise ValueError("the sample size must be greater than zero")
    size = n if limit is None else min(n, limit)
    return (df.orderBy(key) if key else df).limit(size)


@dataclass(frozen=True)
class Fingerprint:
    """Count, bytes and order-free digests of a file listing."""

    files: int
    bytes: int
    digest: int
    check: int


def fingerprint(spark: SparkSession, path: str) -> Fingerprint:
    """Fingerprint of the data files below ``path``; names, sizes and times only, no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    mark = lambda seed: F.xxhash64(F.lit(seed), "path", "length", "modificationTime")
    row = files.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum("length"), F.lit(0)),
        F.coalesce(F.bit_xor(mark(1)), F.lit(0)),
        F.coalesce(F.bit_xor(mark(2)), F.lit(0)),
    ).first()
    return Fingerprint(*row)


class SourceChanged(RuntimeError):
    """The source files changed while a snapshot scan was in use."""


@dataclass(frozen=True)
class Snapshot:
    """A scan pinned to the files that were there when it was opened.

    Spark lists the files once, so files added later are not seen.  ``verify`` fails closed when a
    pinned file was changed, removed or replaced, or when files were added.
    """

    df: DataFrame
    path: str
    pinned: Fingerprint

    def verify(self) -> None:
        now = fingerprint(self.df.sparkSession, self.path)
        if now != self.pinned:
            raise SourceChanged(f"{self.path} changed during the snapshot: {self.pinned} -> {now}")


def scan_snapshot(spark: SparkSession, path: str, format: str = "parquet", **options) -> Snapshot:
    """Open a snapshot scan; the listing is taken twice around the open so a race is noticed."""
    before = fingerprint(spark, path)
    df = scan(spark, path, format, **options)
    snapshot = Snapshot(df, path, before)
    snapshot.verify()
    return snapshot


def folder_marks(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Fingerprint of each sub-folder ``<prefix><number>``: ``(number, files, bytes, digest)``.

    Only names and sizes count, so a copied or restored output is still recognised.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    number = F.regexp_extract("path", f"/{prefix}([0-9]+)/[^/]+$", 1)
    name = F.substring_index("path", "/", -1)
    return (
        files.select(number.alias("number"), name.alias("name"), "length")
        .filter(F.col("number") != "")
        .groupBy(F.col("number").cast("long").alias("number"))
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.bit_xor(F.xxhash64("name", "length")).alias("digest"),
        )
    )


#: Inputs estimated above this size are never redistributed.
SPREAD_BYTES = 256 << 20


def spread(df: DataFrame, max_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Give a small input one partition for each core.

    A file with a single row group is read by one task however many cores there are.  The size is
    Catalyst's estimate, so nothing runs to decide this; every large input comes back unchanged.
    """
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if estimate > max_bytes:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
