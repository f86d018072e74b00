"""Keeping or dropping rows by id without moving the rows where that is safe."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession, functions as F

from docquarry.session import scratch_path

#: Ids that are broadcast at most: 8 MB of numbers.  More are joined by a shuffle, with the same result.
BROADCAST_IDS = 1_000_000


def small_batches(spark: SparkSession) -> None:
    """Ask Spark for Arrow batches of at most 2,000 rows or 8 MB, as texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again; this cuts the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def forget(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are gone; else they stay until the driver's JVM happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def by_id(rows: DataFrame, ids: DataFrame, id: str, how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of rows with a table of ids, which is counted first."""
    ids = stored(ids.select(id).where(F.col(id).isNotNull()).distinct(), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, id, how).select(*rows.columns)


def smallest(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest 64-bit hash ``key``.

    Where there are many more, those above a bound that some 2 n rows meet are left out first, so that
    what the tasks send to the last one does not grow with their number.
    """
    total = rows.count()
    if total > 4 * n:
        rows = rows.where(F.col(key) < -(2**63) + int(2 * n / total * 2**64))
    return rows.orderBy(key).limit(n)
