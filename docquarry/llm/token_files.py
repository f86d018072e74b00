"""Token ids of a corpus as binary shard files, and the way back.

Documents are range-partitioned by id, so shard files follow each other in ascending id order, and each
task encodes its documents in that order.  Spark's own text writer commits the shards (a row of raw bytes
and a line feed is a section), so a lost executor or a repeated task leaves no trace.  A shard file is

    section of coded blocks, "\\n" | ... | footer | footer length u64 | magic | "\\n"

and its footer indexes block starts, document ids and document lengths.  Blocks run across documents.

A tokenizer that drops white space gives each word its ids whatever its neighbours are, so the ids of a
text are those of its words.  Only words that a task has not met yet are encoded; a bounded table of known
words, searched by hash, serves all others.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from docquarry.llm import blocks
from docquarry.llm.kernels import slices, words
from docquarry.llm.word_table import WordTable

MAGIC = b"DQTOKEN1"
KNOWN_WORDS = 1_000_000


def _word_ids(definition: str):
    """Ids of many words by the tokenizers library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)

    def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        # In chunks: the library's results are far larger than the ids that are kept of them.
        for start in range(0, len(texts), 8192):
            some = [t.decode("utf-8") for t in texts[start : start + 8192]]
            found = [e.ids for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            count = np.fromiter(map(len, found), np.int64, len(found))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum())))
            counts.append(count)
        return np.concatenate(ids), np.concatenate(counts)

    return encode


#: Tables of this Python worker, by tokenizer; the next task finds the words of the last.
_TABLES: dict[int, WordTable] = {}


def _table(definition: str) -> WordTable:
    key = zlib.crc32(definition.encode())
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = WordTable(_word_ids(definition), KNOWN_WORDS)
    return _TABLES[key]


def _with_ends(ids: np.ndarray, rows: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with an end id behind each text, and the texts' lengths with it."""
    lengths = np.diff(rows) + 1
    ends = np.cumsum(lengths)
    out = np.empty(int(lengths.sum()), np.uint32)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = False
    out[inner], out[ends - 1] = ids, end_id
    return out, lengths


def _write(definition, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(definition.value)
        held, starts, ids, lengths, size, total = np.zeros(0, np.uint32), [], [], [], 0, 0

        def section(values: np.ndarray) -> pa.RecordBatch:
            nonlocal size
            data, at = blocks.encode(values)
            starts.append(at + size)
            size += len(data) + 1
            return pa.RecordBatch.from_arrays([pa.array([data.tobytes()], pa.binary())], names=["value"])

        for batch in slices(batches, "text"):
            found, rows = table.look_up(words(batch.column("text"), lower=False))
            found, counts = _with_ends(found, rows, end_id)
            ids.append(batch.column("id").cast(pa.int64()))
            lengths.append(counts)
            total += len(found)
            held = np.concatenate([held, found])
            whole = len(held) // blocks.BLOCK * blocks.BLOCK
            if whole:
                yield section(held[:whole])
                held = held[whole:]
        if not lengths:
            return
        if len(held):
            yield section(held)
        starts, lengths, ids = np.concatenate(starts), np.concatenate(lengths), pa.concat_arrays(ids)
        known = np.asarray(ids.is_valid(), np.uint8)
        footer = b"".join(
            (
                struct.pack("<QQQ", len(starts), len(lengths), total),
                starts.astype("<u8").tobytes(),
                np.asarray(ids.fill_null(0), np.int64).astype("<i8").tobytes(),
                known.tobytes(),
                lengths.astype("<u8").tobytes(),
            )
        )
        footer += struct.pack("<Q", len(footer)) + MAGIC
        yield pa.RecordBatch.from_arrays([pa.array([footer], pa.binary())], names=["value"])

    return run


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str | Path, end_id: int, id: str = "doc_id", text: str = "text"
) -> None:
    """Encode every whole text, append ``end_id``, and write shard files in ascending id order.

    ``tokenizer`` is a file of the tokenizers library whose pre-tokenizer drops white space; the driver
    reads it and sends its text to the tasks.  NULL texts are empty and have the end id only; NULL ids come
    first; rows that repeat an id follow each other.  An empty table writes no shard.  Other columns are
    not read.
    """
    definition = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    source = source.withColumn("mark", F.xxhash64("text"))
    ordered = source.repartitionByRange("id", "mark").sortWithinPartitions("id", "mark").select("id", "text")
    coded = ordered.mapInArrow(_write(definition, end_id), "value binary")
    coded.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


def _read(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                data = np.frombuffer(content.as_buffer(), np.uint8)
                end = len(data) - 1 - len(MAGIC)
                if data[end : end + len(MAGIC)].tobytes() != MAGIC:
                    raise ValueError(f"shard {shard} is not a token file or is cut off")
                (length,) = struct.unpack("<Q", data[end - 8 : end].tobytes())
                footer = data[end - 8 - length : end - 8].tobytes()
                n_blocks, n_docs, total = struct.unpack_from("<QQQ", footer)
                at = 24
                starts = np.frombuffer(footer, "<u8", n_blocks, at).astype(np.int64)
                at += 8 * n_blocks
                ids = np.frombuffer(footer, "<i8", n_docs, at)
                at += 8 * n_docs
                known = np.frombuffer(footer, np.uint8, n_docs, at).astype(bool)
                lengths = np.frombuffer(footer, "<u8", n_docs, at + n_docs).astype(np.int64)
                tokens = blocks.decode(data, starts)[:total].astype("<u4")
                first = np.cumsum(lengths) - lengths
                bounds = list(zip(first.tolist(), (first + lengths).tolist()))
                columns = {
                    "shard": pa.array(np.full(n_docs, shard, np.int32)),
                    "id": pa.array(ids, mask=~known),
                    "first": pa.array(first),
                    "n_tokens": pa.array(lengths),
                    "crc": pa.array([zlib.crc32(tokens[a:b]) for a, b in bounds], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([tokens[a:b].astype(np.int32) for a, b in bounds], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True, id: str = "doc_id") -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every document, and its ``ids``, from shard files.

    ``start`` counts the ids of all documents before it.
    """
    schema = "shard int, id long, first long, n_tokens long, crc long" + (", ids array<int>" if with_ids else "")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int")
    rows = files.select(number.alias("shard"), "content").mapInArrow(_read(with_ids), schema)
    # One row a shard; the sums before each are few numbers.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.select(number.alias("shard"), "content").mapInArrow(_totals, "shard int, total long")
    offsets = sizes.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    result = rows.join(offsets, "shard").select(
        F.col("id").alias(id),
        (F.col("offset") + F.col("first")).alias("start"),
        "n_tokens",
        F.col("crc").alias("ids_crc32"),
        *(["ids"] if with_ids else []),
    )
    return result


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals = []
        for content in batch.column("content"):
            data = content.as_buffer()
            end = data.size - 1 - len(MAGIC)
            (length,) = struct.unpack("<Q", data.slice(end - 8, 8).to_pybytes())
            totals.append(struct.unpack("<Q", data.slice(end - 8 - length + 16, 8).to_pybytes())[0])
        yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(totals, pa.int64())], names=["shard", "total"])
