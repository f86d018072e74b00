"""Document type model: which Spark type stands for which document value.

Ordinary Spark types carry ordinary values.  Values that have no Spark type of their own are
carried as single-field *wrapper* structs named after their Extended JSON v2 key, so a column of
type ``struct<`$oid`: string>`` is an object id and ``struct<`$timestamp`: struct<t, i>>`` is an
internal timestamp.  Field names that start with ``$`` are reserved in documents, so a wrapper can
never be mistaken for a user's sub-document.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The Extended JSON v2 wrapper keys.
OID = "$oid"
REGEX = "$regularExpression"
TIMESTAMP = "$timestamp"
SYMBOL = "$symbol"
CODE = "$code"
MIN_KEY = "$minKey"
MAX_KEY = "$maxKey"
DB_POINTER = "$dbPointer"
WRAPPER_KEYS = (OID, REGEX, TIMESTAMP, SYMBOL, CODE, MIN_KEY, MAX_KEY, DB_POINTER)


def wrapper_of(dtype: T.DataType) -> str | None:
    """Wrapper key of a struct type, or None for an ordinary sub-document or scalar."""
    if isinstance(dtype, T.StructType) and dtype.fields:
        first = dtype.fields[0].name
        if first in WRAPPER_KEYS:
            return first
    return None


def is_document(dtype: T.DataType) -> bool:
    """True for types a dotted path may descend into."""
    if isinstance(dtype, T.StructType):
        return wrapper_of(dtype) is None
    return isinstance(dtype, (T.MapType, T.VariantType))


def field_type(schema: T.StructType, name: str) -> T.DataType | None:
    """Type of the field spelled exactly ``name``, or None."""
    for field in schema.fields:
        if field.name == name:
            return field.dataType
    return None


def column(name: str) -> Column:
    """Top-level column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_object(value: Column) -> Column:
    """VARIANT as a key -> VARIANT map, NULL unless it is an object."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def as_array(value: Column) -> Column:
    """VARIANT as an array of VARIANT, NULL unless it is an array."""
    return F.try_variant_get(value, "$", "array<variant>")
