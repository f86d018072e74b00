"""Binary document encoding (BSON) of typed rows, one Arrow batch at a time.

The encoder works on whole columns: each column becomes an array of encoded elements and the
elements of a row are joined by Arrow kernels.  There is no per-row Python except for decimals,
whose 128-bit layout has no Arrow kernel.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from docquarry.functions import types as dt
from docquarry.functions.variants import canonical_json
from docquarry.sinks.extended import text_document, text_payload

# Element type bytes of the binary format.
DOUBLE, STRING, DOCUMENT, ARRAY, BINARY = b"\x01", b"\x02", b"\x03", b"\x04", b"\x05"
OBJECT_ID, BOOLEAN, DATETIME, NULL, REGEX = b"\x07", b"\x08", b"\x09", b"\x0a", b"\x0b"
CODE, SYMBOL, INT32, TIMESTAMP, INT64 = b"\x0d", b"\x0e", b"\x10", b"\x11", b"\x12"
DECIMAL128, MAX_KEY, MIN_KEY = b"\x13", b"\x7f", b"\xff"
# Exponent bias and digits of a 128-bit decimal.
DECIMAL_BIAS, DECIMAL_DIGITS = 6176, 34

#: Reserved names under which the canonical text of schemaless values travels to the encoder: of one value,
#: and of a whole document.
EXTENDED, DOCUMENT_TEXT = "$extended", "$document"
_BYTES = pa.large_binary()
#: Input bytes encoded at a time, so that the joined result stays small.
_SLICE_BYTES = 32 << 20


def _constant(value: bytes, n: int) -> pa.Array:
    return pa.array([value], _BYTES).take(pa.array(np.zeros(n, dtype=np.int64)))


def _fixed(numbers: np.ndarray) -> pa.Array:
    """Little-endian bytes of each number."""
    numbers = np.ascontiguousarray(numbers)
    kind = pa.binary(numbers.dtype.itemsize)
    raw = pa.FixedSizeBinaryArray.from_buffers(kind, len(numbers), [None, pa.py_buffer(numbers)])
    return raw.cast(_BYTES)


def _numbers(array: pa.Array, dtype: str) -> np.ndarray:
    filled = pc.fill_null(array, 0) if array.null_count else array
    return filled.to_numpy(zero_copy_only=False).astype(dtype)


def _join(*parts: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(*parts, pa.scalar(b"", _BYTES))


def _as_bytes(array: pa.Array) -> pa.Array:
    filled = pc.fill_null(array.cast(_BYTES), pa.scalar(b"", _BYTES))
    return filled


def _lengths(array: pa.Array, extra: int) -> pa.Array:
    return _fixed(pc.binary_length(array).to_numpy(zero_copy_only=False).astype("<i8").astype("<i4") + np.int32(extra))


def _text(array: pa.Array) -> pa.Array:
    body = _as_bytes(array)
    return _join(_lengths(body, 1), body, _constant(b"\0", len(body)))


def _cstring(array: pa.Array) -> pa.Array:
    return _join(_as_bytes(array), _constant(b"\0", len(array)))


def _wrap_document(body: pa.Array) -> pa.Array:
    return _join(_lengths(body, 5), body, _constant(b"\0", len(body)))


def _decimal128(value: Decimal | None) -> bytes:
    if value is None:
        return b""
    sign, digits, exponent = value.as_tuple()
    text = "".join(map(str, digits))
    significant = text.rstrip("0") or "0"
    exponent = exponent + len(text) - len(significant) if significant != "0" else 0
    coefficient = int(significant)
    if coefficient >= 10**DECIMAL_DIGITS:
        raise ValueError(f"{value} has more than {DECIMAL_DIGITS} digits")
    bits = (sign << 127) | ((exponent + DECIMAL_BIAS) << 113) | coefficient
    return bits.to_bytes(16, "little")


def _millis(array: pa.Array) -> np.ndarray:
    if pa.types.is_date(array.type):
        return _numbers(array.cast(pa.int32()), "<i8") * 86_400_000
    per_ms = {"s": None, "ms": 1, "us": 1_000, "ns": 1_000_000}[array.type.unit]
    ticks = _numbers(array.cast(pa.int64()), "<i8")
    return ticks * 1000 if per_ms is None else ticks // per_ms


def _joined_lists(elements: pa.Array, lengths: np.ndarray) -> pa.Array:
    """Concatenate consecutive runs of elements."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("int64")
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), elements)
    return pc.binary_join(lists, pa.scalar(b"", _BYTES))


def _list_lengths(array: pa.Array) -> np.ndarray:
    return _numbers(pc.list_value_length(array), "int64")


def _list_payload(array: pa.Array) -> pa.Array:
    lengths = _list_lengths(array)
    values = array.flatten()
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    names = pa.array(np.arange(len(values)) - starts).cast(pa.string())
    return _wrap_document(_joined_lists(_elements(_cstring(names), values), lengths))


def _map_payload(array: pa.Array) -> pa.Array:
    offsets = array.offsets.to_numpy()
    spans = np.diff(offsets)
    valid = array.is_valid().to_numpy(zero_copy_only=False)
    window = slice(int(offsets[0]), int(offsets[-1]))
    keys, items = array.keys[window], array.items[window]
    if not valid.all():
        # Entries behind a null map are not part of the data.
        keep = pa.array(np.repeat(valid, spans))
        keys, items = keys.filter(keep), items.filter(keep)
    return _wrap_document(_joined_lists(_elements(_cstring(keys), items), np.where(valid, spans, 0)))


def _struct_body(array: pa.StructArray) -> pa.Array:
    parts = []
    for i in range(array.type.num_fields):
        name = array.type.field(i).name.encode("utf-8") + b"\0"
        parts.append(_elements(_constant(name, len(array)), array.field(i)))
    return _join(*parts) if parts else _constant(b"", len(array))


def _wrapper_payload(array: pa.StructArray, key: str) -> tuple[bytes, pa.Array]:
    inner = array.field(0)
    if key == dt.OID:
        digits = "".join(pc.fill_null(inner, "0" * 24).to_pylist())
        raw = np.frombuffer(bytes.fromhex(digits), dtype="S12")
        return OBJECT_ID, _fixed(raw)
    if key == dt.REGEX:
        return REGEX, _join(_cstring(inner.field("pattern")), _cstring(inner.field("options")))
    if key == dt.TIMESTAMP:
        return TIMESTAMP, _join(_fixed(_numbers(inner.field("i"), "<u4")), _fixed(_numbers(inner.field("t"), "<u4")))
    if key == dt.SYMBOL:
        return SYMBOL, _text(inner)
    if key == dt.CODE:
        return CODE, _text(inner)
    if key in (dt.MIN_KEY, dt.MAX_KEY):
        return MIN_KEY if key == dt.MIN_KEY else MAX_KEY, _constant(b"", len(array))
    raise ValueError(f"cannot encode {key}")


def _payload(array: pa.Array) -> tuple[bytes, pa.Array]:
    """Type byte and encoded values of a column; null slots hold anything."""
    kind = array.type
    if pa.types.is_boolean(kind):
        return BOOLEAN, _fixed(_numbers(array.cast(pa.uint8()), "u1"))
    if pa.types.is_int64(kind):
        return INT64, _fixed(_numbers(array, "<i8"))
    if pa.types.is_integer(kind):
        return INT32, _fixed(_numbers(array, "<i4"))
    if pa.types.is_floating(kind):
        return DOUBLE, _fixed(_numbers(array.cast(pa.float64()), "<f8"))
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return STRING, _text(array)
    if pa.types.is_binary(kind) or pa.types.is_large_binary(kind):
        body = _as_bytes(array)
        return BINARY, _join(_lengths(body, 0), _constant(b"\0", len(body)), body)
    if pa.types.is_timestamp(kind) or pa.types.is_date(kind):
        return DATETIME, _fixed(_millis(array))
    if pa.types.is_decimal(kind):
        return DECIMAL128, pa.array([_decimal128(v) for v in array.to_pylist()], _BYTES)
    if pa.types.is_map(kind):
        return DOCUMENT, _map_payload(array)
    if pa.types.is_struct(kind):
        first = kind.field(0).name if kind.num_fields else None
        if first in dt.WRAPPER_KEYS:
            return _wrapper_payload(array, first)
        return DOCUMENT, _wrap_document(_struct_body(array))
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return ARRAY, _list_payload(array)
    raise ValueError(f"cannot encode {kind}")


def _elements(names: pa.Array, array: pa.Array) -> pa.Array:
    """Encoded elements ``type name payload``; ``names`` already end in a zero byte."""
    n = len(array)
    if pa.types.is_null(array.type):
        return _join(_constant(NULL, n), names)
    if pa.types.is_struct(array.type) and array.type.num_fields and array.type.field(0).name == EXTENDED:
        return _extended_elements(names, array)
    code, payload = _payload(array)
    encoded = _join(_constant(code, n), names, payload)
    if array.null_count == 0:
        return encoded
    return pc.if_else(array.is_valid(), encoded, _join(_constant(NULL, n), names))


def _extended_elements(names: pa.Array, array: pa.StructArray) -> pa.Array:
    """Elements of schemaless values; each has a type of its own."""
    texts = pc.if_else(array.is_valid(), array.field(0), pa.scalar(None, array.type.field(0).type))
    values = [text_payload(text) for text in texts.to_pylist()]
    codes = pa.array([code for code, _ in values], _BYTES)
    return _join(codes, names, pa.array([payload for _, payload in values], _BYTES))


def encode_batch(batch: pa.RecordBatch) -> pa.Array:
    """One encoded document for each row of the batch."""
    if batch.schema.names == [DOCUMENT_TEXT]:
        return pa.array([text_document(text) for text in batch.column(0).to_pylist()], _BYTES)
    return _wrap_document(_struct_body(batch.to_struct_array()))


def _encode_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        per_row = max(1, batch.nbytes // batch.num_rows)
        step = max(1, _SLICE_BYTES // per_row)
        for start in range(0, batch.num_rows, step):
            encoded = encode_batch(batch.slice(start, step)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([encoded], names=["bson"])


def _texted(value: Column, dtype: T.DataType) -> Column:
    """The value with every VARIANT in it as canonical text."""
    if isinstance(dtype, T.VariantType):
        return F.when(value.isNotNull(), F.struct(canonical_json(value).alias(EXTENDED)))
    if not _holds_variant(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _texted(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, x: _texted(x, dtype.valueType))
    fields = [_texted(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def _holds_variant(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.VariantType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _holds_variant(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _holds_variant(dtype.valueType)
    return isinstance(dtype, T.StructType) and any(_holds_variant(f.dataType) for f in dtype.fields)


def documents(df: DataFrame, doc: str) -> DataFrame:
    """The documents in column ``doc`` in the form the encoder takes: typed columns, or canonical text of a VARIANT."""
    if isinstance(df.schema[doc].dataType, T.VariantType):
        return df.select(canonical_json(dt.column(doc)).alias(DOCUMENT_TEXT))
    return df.select(F.col(f"`{doc}`.*"))


def encode_bson(df: DataFrame, doc: str | None = None) -> DataFrame:
    """Encode each row, or the document in its column ``doc``, as one binary document, column ``bson``.

    Types come from the schema.  A VARIANT value brings its own: whole numbers that fit 32 bits are int32, larger ones
    int64, all other numbers doubles, and fields come in the order in which a VARIANT keeps them, by name.
    Missing fields of a VARIANT are left out; a NULL of a typed column is a null.  A whole document that is no
    object fails the query.
    """
    rows = df if doc is None else documents(df, doc)
    plain = rows.select(*[_texted(dt.column(f.name), f.dataType).alias(f.name) for f in rows.schema.fields])
    return plain.mapInArrow(_encode_partition, "bson binary")


def bson_text(df: DataFrame) -> DataFrame:
    """Encoded documents as rows for the text writer.

    A document always ends in a zero byte.  That byte is left to the writer's line separator, so the
    part file is the plain concatenation of the documents.
    """
    whole = F.col("bson")
    return encode_bson(df).select(F.substring(whole, F.lit(1), F.length(whole) - 1).cast("string").alias("value"))
