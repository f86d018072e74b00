"""SHA-256 and byte length of a published output."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Parts up to this size are read whole by Spark; larger ones are hashed in chunks inside the task.
WHOLE_PART_BYTES = 256 << 20
_CHUNK = 8 << 20
# Names Hadoop and Arrow give the same object store.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


def _hash_in_chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for frame in frames:
        digests = []
        for path in frame["path"]:
            # Spark writes local paths as file:/x, Arrow expects file:///x.
            uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
            scheme, rest = uri.split(":", 1)
            system, inner = fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
            state = hashlib.sha256()
            with system.open_input_stream(inner, compression=None) as stream:
                while chunk := stream.read(_CHUNK):
                    state.update(chunk)
            digests.append(state.hexdigest())
        yield frame.assign(sha256=digests)


def part_digests(spark: SparkSession, path: str, whole_part_bytes: int = WHOLE_PART_BYTES) -> DataFrame:
    """``(path, bytes, sha256)`` for every part file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = files.filter(F.col("length") <= whole_part_bytes).select(
        "path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")
    )
    big = files.filter(F.col("length") > whole_part_bytes).select("path", F.col("length").alias("bytes"))
    return small.union(big.mapInPandas(_hash_in_chunks, "path string, bytes long, sha256 string"))


def output_digest(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(parts, bytes, sha256)`` for a whole output folder.

    The digest is taken over the sorted part digests, in two steps, so no single task lists every
    part of a large output; part names do not matter.
    """
    buckets = (
        part_digests(spark, path)
        .groupBy(F.substring("sha256", 1, 3).alias("bucket"))
        .agg(
            F.count(F.lit(1)).alias("parts"),
            F.sum("bytes").alias("bytes"),
            F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ""), 256).alias("sha256"),
        )
    )
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "sha256")))
    return buckets.agg(
        F.coalesce(F.sum("parts"), F.lit(0)).alias("parts"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.sha2(F.array_join(F.transform(ordered, lambda x: x["sha256"]), ""), 256).alias("sha256"),
    )
