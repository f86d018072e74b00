"""Write documents as JSON lines, JSON arrays, CSV, Parquet or binary documents.

Each writer produces one part file for each task through Spark's own file writers, so commits are
retry-safe and every codec and file system of Spark works.  None of them shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from docquarry.functions.jsonmodes import document_json
from docquarry.operators.flatten import flatten
from docquarry.operators.manifest import Manifest
from docquarry.sinks.bson import bson_text, documents
from docquarry.sinks.publish import FileOps

FORMATS = ("jsonl", "json", "csv", "parquet", "bson")
COMPRESSIONS = ("none", "gzip")

# Size of a part file without content, by compression.
BLANK_BYTES = {"none": 0, "gzip": 20}
# CSV in the common quoting style; a cell is quoted only when it has to be.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def csv_options(columns: int) -> dict[str, str]:
    """Writer options; an empty cell is written bare unless it is the only cell of its line."""
    return {**CSV_OPTIONS, "emptyValue": "" if columns > 1 else '""'}


def _array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one JSON array: ``[``, the elements with commas between them, ``]``."""
    line = lambda values: pa.RecordBatch.from_arrays([values], names=["value"])
    held = None
    for batch in batches:
        values = batch.column(0)
        if not len(values):
            continue
        if held is None:
            yield line(pa.array(["["], values.type))
        else:
            yield line(pc.binary_join_element_wise(held, pa.scalar(",", values.type), pa.scalar("", values.type)))
        with_comma = pc.binary_join_element_wise(values[:-1], pa.scalar(",", values.type), pa.scalar("", values.type))
        yield line(with_comma)
        held = values[-1:]
    if held is not None:
        yield line(held)
        yield line(pa.array(["]"], held.type))


def write_jsonl(texts: DataFrame, path: str, compression: str = "none") -> None:
    """One document per line."""
    texts.write.option("compression", compression).text(path)


def write_json_array(texts: DataFrame, path: str, compression: str = "none") -> None:
    """One JSON array in each part file; a run without documents writes one empty array."""
    spark = texts.sparkSession
    lines = texts.mapInArrow(_array_lines, "value string")
    lines.write.option("compression", compression).option("maxRecordsPerFile", "0").text(path)
    ops = FileOps(spark, path)
    # A task without rows leaves no file, except that a run whose first task is empty leaves a blank one.
    files = ops.data_files(path)
    blank = [name for name, size in files if size <= BLANK_BYTES[compression]]
    for name in blank:
        ops.remove(f"{path}/{name}")
    if len(blank) == len(files):
        nothing = spark.createDataFrame([("[",), ("",), ("]",)], "value string").coalesce(1)
        nothing.write.mode("overwrite").option("compression", compression).text(path)


def write_csv(cells: DataFrame, path: str, compression: str = "none") -> None:
    """Header line and rows in every part file; cells must already be text without NULL."""
    options = csv_options(len(cells.columns))
    cells.write.options(**options).option("compression", compression).csv(path)


def write_parquet(cells: DataFrame, path: str, compression: str = "none") -> None:
    cells.write.option("compression", compression).parquet(path)


def write_bson(df: DataFrame, path: str, compression: str = "none") -> None:
    """Concatenated binary documents in every part file."""
    bson_text(df).write.option("lineSep", "\0").option("compression", compression).text(path)


def encode(
    df: DataFrame,
    format: str,
    manifest: Manifest | None = None,
    json_mode: str = "canonical",
    doc: str | None = None,
) -> DataFrame:
    """Documents in the shape the writer of ``format`` takes."""
    if format in ("jsonl", "json"):
        return df.select(document_json(df, json_mode, doc).alias("value"))
    if format in ("csv", "parquet"):
        if manifest is None:
            raise ValueError("a schema manifest is required for CSV and Parquet exports")
        return flatten(df, manifest, "empty" if format == "csv" else "null", doc)
    if format == "bson":
        return df if doc is None else documents(df, doc)
    raise ValueError(f"unknown format {format!r}; use one of {', '.join(FORMATS)}")


def write(encoded: DataFrame, format: str, path: str, compression: str = "none") -> None:
    """Write an encoded DataFrame to a new folder."""
    if compression not in COMPRESSIONS:
        raise ValueError(f"unknown compression {compression!r}; use none or gzip")
    writers = {
        "jsonl": write_jsonl,
        "json": write_json_array,
        "csv": write_csv,
        "parquet": write_parquet,
        "bson": write_bson,
    }
    writers[format](encoded, path, compression)


def encoded_size(encoded: DataFrame) -> Column:
    """Bytes of an encoded row's text cells."""
    sizes = [F.octet_length(F.coalesce(F.col(f"`{c}`"), F.lit(""))) for c in encoded.columns]
    total = F.lit(0).cast("long")
    for size in sizes:
        total = total + size
    return total
