"""Exact duplicates with a heavy-hitter split.

Each text is lower-cased (A-Z only) and digested once; texts do not move.  A Misra-Gries summary, made
batch by batch in every task and merged by a grouped sum, names digests that may be frequent.  Its counts are
lower bounds and only the ``counters`` largest sums go on, so a group that is frequent in no single task may be
missed; it is settled like the rest then.  These few are counted exactly, and
their verified winners are broadcast (at most ``counters`` rows), so frequent groups are settled without
a shuffle.  All other digests are shuffled as usual.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docquarry.llm.rows import by_id, stored
from docquarry.session import scratch_path

COUNTERS = 1024


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # bytes.lower() changes A-Z only, whatever the encoding.
    for batch in batches:
        digests = [
            hashlib.sha256((text.as_py() or "").encode("utf-8", "surrogatepass").lower()).digest()
            for text in batch.column(1)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary())], names=["id", "digest"])


def summarise(counts: pd.Series, counters: int) -> pd.Series:
    """A Misra-Gries summary: at most ``counters`` counts, all lowered by the largest that is left out."""
    if len(counts) <= counters:
        return counts
    cut = np.partition(counts.to_numpy(), -counters - 1)[-counters - 1]
    lowered = counts - cut
    return lowered[lowered > 0]


def _frequent(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pd.Series(dtype="int64")
        for batch in batches:
            new = pd.Series(batch.column(0).to_pylist(), dtype=object).value_counts()
            held = summarise(held.add(new, fill_value=0).astype("int64"), counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held.index), pa.binary()), pa.array(held.to_numpy(), pa.int64())], names=["digest", "least"]
        )

    return run


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    The row with the largest id of each group stays.  NULL text counts as empty; empty texts are one
    group.  A NULL id loses against any other, and stays only in a group without ids.  Rows that repeat
    an id with the same text all count in ``group_size`` and share ``kept``.  Other columns are not read;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    kind = docs.schema[id].dataType.simpleString()
    path = scratch_path(spark, "digests")
    docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(
        _digest, f"id {kind}, digest binary"
    ).write.parquet(path)
    digests = spark.read.parquet(path)

    candidates = (
        digests.select("digest")
        .mapInArrow(_frequent(counters), "digest binary, least long")
        .groupBy("digest")
        .agg(F.sum("least").alias("least"))
        .where("least > 1")
        .orderBy(F.desc("least"), "digest")
        .limit(counters)
    )
    counted = (
        digests.join(F.broadcast(candidates.select("digest")), "digest")
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    # At most `counters` rows of some 50 bytes, whatever the size of the input.
    winners = F.broadcast(spark.createDataFrame(counted.collect(), counted.schema))

    frequent = digests.join(winners, "digest").select("id", "digest", "keep_id", "group_size")
    group = Window.partitionBy("digest")
    rest = digests.join(winners, "digest", "left_anti").select(
        "id", "digest", F.max("id").over(group).alias("keep_id"), F.count(F.lit(1)).over(group).alias("group_size")
    )
    return frequent.unionByName(rest).select(
        F.col("id").alias(id),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each text, that which ``exact_groups`` keeps; all columns stay.

    Where an id has one row, the row is known by it and only ids meet the documents again.  Rows that repeat an id, or
    have none, are known by id and digest, and each is judged by its own text; of those that repeat the kept id with
    the same text, or that have no id in a group without ids, one stays.
    """
    rows = exact_groups(docs, id, text).select(F.col(id).alias("id"), F.unhex("text_sha256").alias("digest"), "kept")
    pairs = stored(rows.groupBy("id", "digest", "kept").agg(F.count(F.lit(1)).alias("n")), "exact_rows")
    several = stored(pairs.groupBy("id").agg(F.sum("n").alias("n")).where("n > 1 or id is null").select("id"), "several")
    losers = pairs.where("not kept").join(several, "id", "left_anti").select(F.col("id").alias(id))
    if several.isEmpty():
        return by_id(docs, losers, id, "left_anti")
    many = several.select(F.col("id").alias(id))
    known = by_id(by_id(docs.where(F.col(id).isNotNull()), many, id, "left_anti"), losers, id, "left_anti")
    odd = by_id(docs, many, id, "left_semi").unionByName(docs.where(F.col(id).isNull()))
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    odd = odd.withColumn("__digest", F.unhex(F.sha2(lowered.cast("binary"), 256)))
    kept = pairs.where("kept").select(F.col("id").alias("__id"), F.col("digest").alias("__other"))
    same = odd[id].eqNullSafe(kept["__id"]) & (odd["__digest"] == kept["__other"])
    once = odd.join(kept, same, "left_semi").dropDuplicates([id, "__digest"])
    return known.unionByName(once.select(*docs.columns))
