"""Consecutive numbers for the rows of a sorted DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from docquarry.session import scratch_path

_PLACE, _PART, _BEFORE = "__docquarry_place", "__docquarry_part", "__docquarry_before"
# monotonically_increasing_id keeps the row number of a partition in its low 33 bits.
_ROW_BITS = 33


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """The rows with their place in the order, from 0, as a LONG column.

    The rows are stored once, as they lie; then only the sizes of the parts are added up.  The running sum is over
    one row for each part.
    """
    spark = ordered.sparkSession
    path = scratch_path(spark, "numbered")
    ordered.withColumn(_PLACE, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn(_PART, F.shiftright(_PLACE, _ROW_BITS))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select(_PART, F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias(_BEFORE))
    place = F.col(_BEFORE) + F.col(_PLACE).bitwiseAND((1 << _ROW_BITS) - 1)
    return rows.join(F.broadcast(starts), _PART).withColumn(name, place).drop(_PART, _PLACE, _BEFORE)
