"""SentencePiece encoding and decoding of whole documents.

A text gets one mark in front, spaces become marks, and it is cut before each run of marks and around
characters that no piece contains; no piece reaches over such a cut, so the words' ids make the text's.
Each task encodes the words it has not met yet by batched Viterbi (``pieces``) and looks all others up.
Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from docquarry.llm.kernels import Words, hash_spans, slices, text_bytes
from docquarry.llm.pieces import MARK, Encoder, Model, decode, fingerprint, load_model
from docquarry.llm.word_table import WordTable

KNOWN_WORDS = 1_000_000

_TABLES: dict[int, WordTable] = {}


def _table(model: Model) -> WordTable:
    """The table of this Python worker; the next task finds the words of the last."""
    key = fingerprint(model)
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = WordTable(Encoder(model).encode, KNOWN_WORDS)
    return _TABLES[key]


def _cuts(model: Model) -> np.ndarray:
    """ASCII bytes that no piece contains."""
    used = np.zeros(256, bool)
    used[128:] = True
    used[32] = True
    ordinary = np.isin(np.arange(len(model.text_count)), model.ids)
    for first, count in zip(model.text_first[ordinary].tolist(), model.text_count[ordinary].tolist()):
        used[np.frombuffer(model.texts, np.uint8, count, first)] = True
    return ~used


def _words(column: pa.Array, cuts: np.ndarray) -> Words:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pc.replace_substring(column, MARK, " ")
    front = pc.if_else(pc.equal(pc.binary_length(column), 0), "", " ").cast(pa.large_string())
    data, offsets = text_bytes(pc.binary_join_element_wise(front, column, pa.scalar("", pa.large_string())))
    first = np.zeros(len(data) + 1, bool)
    space, cut = data == 32, cuts[data]
    first[:-1] = space | cut
    first[1:-1] &= ~(space[1:] & space[:-1])
    first[1:] |= cut
    first[offsets[:-1]] = True
    starts = np.flatnonzero(first[:-1])
    ends = np.append(starts[1:], len(data))[: len(starts)]
    return Words(hash_spans(data, starts, ends), starts, ends, np.searchsorted(starts, offsets), data)


def _code(shared, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table, cuts = _table(model), _cuts(model)
        for batch in slices(batches, "text"):
            found = _words(batch.column("text"), cuts)
            ids, rows = table.look_up(found)
            columns = {"id": batch.column("id"), "n_tokens": pa.array(np.diff(rows))}
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids.astype(np.int32)))
            else:
                bounds = list(zip(rows[:-1].tolist(), rows[1:].tolist()))
                flat = ids.astype("<u4")
                texts = decode(model, ids, rows)
                origin = [(t.as_py() or "").replace(MARK, " ").encode() for t in batch.column("text")]
                columns["ids_crc32"] = pa.array([zlib.crc32(flat[a:b]) for a, b in bounds], pa.int64())
                columns["decoded_sha256"] = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
                columns["round_trip"] = pa.array([a == b for a, b in zip(texts, origin)], pa.bool_())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _coded(docs: DataFrame, model: str, id: str, text: str, with_ids: bool, columns: str) -> DataFrame:
    kind = docs.schema[id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model))
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(_code(shared, with_ids), f"id {kind}, n_tokens long, {columns}").withColumnRenamed("id", id)


def encode_pieces(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, ids`` for each row.

    Empty and NULL texts have no ids.  The mark itself in a text counts as a space, as in the library.
    Repeated rows give repeated results; other columns are not read.  The model file (identity
    normalisation, mark in front of the text) is read on the driver.
    """
    return _coded(docs, model, id, text, True, "ids array<int>")


def piece_report(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, ids_crc32, decoded_sha256, round_trip``: texts encoded and decoded in one pass."""
    return _coded(docs, model, id, text, False, "ids_crc32 long, decoded_sha256 string, round_trip boolean")


def decode_pieces(coded: DataFrame, model: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``id, text`` from arrays of ids; a NULL array is an empty text, broken UTF-8 becomes U+FFFD."""
    kind = coded.schema[id].dataType.simpleString()
    shared = coded.sparkSession.sparkContext.broadcast(load_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            rows = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
            flat = lists.drop_null().flatten().to_numpy()
            texts = [t.decode("utf-8", "replace") for t in decode(shared.value, flat, rows)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    source = coded.select(F.col(id).alias("id"), F.col(ids).cast("array<int>").alias("ids"))
    return source.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id)


def default_model() -> str | os.PathLike:
    """The public model file of this machine; any other path can be given."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
