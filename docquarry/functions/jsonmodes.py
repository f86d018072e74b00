"""Documents as JSON text: plain, relaxed, canonical and embedded form.

A typed document is rewritten leaf by leaf into a struct that ``to_json`` prints as wanted, so the
whole conversion is one projection.  ``embedded`` is the form a sub-document takes inside a CSV or
Parquet cell: plain numbers, wrapped ids, dates, decimals and bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docquarry.functions import types as dt
from docquarry.functions import values
from docquarry.functions.variants import canonical_json, readable_json

MODES = ("canonical", "relaxed", "plain")
_KEEP_NULLS = {"ignoreNullFields": "false"}
# Fixed value: subtype written for every binary, two hex digits.
GENERIC_SUBTYPE = "00"


def _field(name: str, value: Column) -> Column:
    return F.struct(value.alias(name))


def _present(value: Column, shaped: Column) -> Column:
    return F.when(value.isNotNull(), shaped)


def _variant(value: Column) -> Column:
    return value.cast("variant")


def _object(value: Column) -> Column:
    return F.to_variant_object(value)


def _double(value: Column, mode: str) -> Column:
    value = value.cast("double")
    if mode == "canonical":
        return _present(value, _field("$numberDouble", values.canonical_double_text(value)))
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    if mode == "relaxed":
        wrapped = _object(_field("$numberDouble", values.canonical_double_text(value)))
        return F.when(finite, _variant(value)).when(value.isNotNull(), wrapped)
    return F.when(finite, value)


def _instant(value: Column, dtype: T.DataType, mode: str) -> Column:
    millis = values.epoch_millis(value, dtype)
    wrapped = _field("$date", _field("$numberLong", millis.cast("string")))
    if mode == "plain":
        return values.rfc3339(value, dtype)
    if mode == "relaxed":
        readable = _object(_field("$date", values.rfc3339(value, dtype)))
        in_range = millis.between(0, values.LAST_RFC3339_MS)
        return F.when(in_range, readable).when(value.isNotNull(), _object(wrapped))
    return _present(value, wrapped)


def _wrapper(value: Column, dtype: T.StructType, mode: str) -> Column:
    key = dt.wrapper_of(dtype)
    if mode != "plain":
        return value
    if key in (dt.MIN_KEY, dt.MAX_KEY, dt.DB_POINTER):
        return F.lit(None).cast("string")
    return values.wrapper_text(value, key)


def json_ready(value: Column, dtype: T.DataType, mode: str) -> Column:
    """Column that ``to_json`` prints in the given mode."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return _double(value, mode)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)) and mode == "canonical":
        return _present(value, _field("$numberInt", value.cast("string")))
    if isinstance(dtype, T.LongType) and mode == "canonical":
        return _present(value, _field("$numberLong", value.cast("string")))
    if isinstance(dtype, T.DecimalType):
        text = values.decimal_text(value, dtype)
        return text if mode == "plain" else _present(value, _field("$numberDecimal", text))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return _instant(value, dtype, mode)
    if isinstance(dtype, T.BinaryType):
        if mode == "plain":
            return values.hex_text(value)
        body = F.struct(F.base64(value).alias("base64"), F.lit(GENERIC_SUBTYPE).alias("subType"))
        return _present(value, _field("$binary", body))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: json_ready(x, dtype.elementType, mode))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, x: json_ready(x, dtype.valueType, mode))
    if dt.wrapper_of(dtype):
        return _wrapper(value, dtype, mode)
    if isinstance(dtype, T.StructType):
        parts = [json_ready(value.getField(f.name), f.dataType, mode).alias(f.name) for f in dtype.fields]
        return _present(value, F.struct(*parts)) if parts else value
    if isinstance(dtype, T.VariantType) and mode == "canonical":
        return F.parse_json(canonical_json(value))
    if isinstance(dtype, T.VariantType) and mode in ("plain", "relaxed"):
        return F.parse_json(readable_json(value, mode))
    return value


def embedded_json(value: Column, dtype: T.DataType) -> Column:
    """JSON text of a sub-document inside a cell."""
    return F.to_json(json_ready(value, dtype, "embedded"), _KEEP_NULLS)


def document_json(df: DataFrame, mode: str = "canonical", doc: str | None = None) -> Column:
    """One JSON text column for each row of ``df``, or for its VARIANT column ``doc``."""
    if mode not in MODES:
        raise ValueError(f"unknown JSON mode {mode!r}; use one of {', '.join(MODES)}")
    if doc is not None:
        value = dt.column(doc)
        if isinstance(dt.field_type(df.schema, doc), T.VariantType):
            return canonical_json(value) if mode == "canonical" else readable_json(value, mode)
        return F.to_json(json_ready(value, df.schema[doc].dataType, mode), _KEEP_NULLS)
    parts = [json_ready(dt.column(f.name), f.dataType, mode).alias(f.name) for f in df.schema.fields]
    return F.to_json(F.struct(*parts), _KEEP_NULLS)
