"""Dotted-path lookup in typed and VARIANT documents.

A path walks through sub-documents only.  A scalar or an array in the middle makes the value
missing; there are no wildcards and no array indexes.  Field names match exactly, case included.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docquarry.functions import types as dt


@dataclass(frozen=True)
class Found:
    """A looked-up value; ``dtype`` is None when the schema has no such path."""

    value: Column
    dtype: T.DataType | None


def _bracket(part: str) -> str:
    if "'" not in part:
        return f"['{part}']"
    if '"' not in part:
        return f'["{part}"]'
    raise ValueError(f"field name {part!r} holds both kinds of quote")


def variant_path(parts: list[str]) -> str:
    """JSON path of a list of field names, one bracket step for each."""
    return "$" + "".join(_bracket(p) for p in parts)


def path_tree(fields: Iterable[str]) -> dict:
    """Nested dict of wanted names; an empty dict means "the whole value"."""
    root: dict = {}
    for path in fields:
        parts, node = path.split("."), root
        for depth, part in enumerate(parts):
            known = part in node
            if known and not node[part]:
                break
            node = node.setdefault(part, {})
            if depth == len(parts) - 1:
                node.clear()
    return root


def _missing() -> Found:
    return Found(F.lit(None).cast("string"), None)


def _walk(value: Column, dtype: T.DataType, parts: list[str]) -> Found:
    if not parts:
        return Found(value, dtype)
    head, rest = parts[0], parts[1:]
    if isinstance(dtype, T.VariantType):
        if "" in parts:
            return _missing()
        return Found(F.try_variant_get(value, variant_path(parts), "variant"), dtype)
    if isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
        return _walk(value[head], dtype.valueType, rest)
    if isinstance(dtype, T.StructType) and dt.wrapper_of(dtype) is None:
        inner = dt.field_type(dtype, head)
        if inner is not None:
            return _walk(value.getField(head), inner, rest)
    return _missing()


def lookup(df: DataFrame, path: str, doc: str | None = None) -> Found:
    """Value at ``path`` and its type.

    ``doc`` names the column that holds the documents; without it each row is a document.
    """
    parts = path.split(".")
    if doc is not None:
        return _walk(dt.column(doc), df.schema[doc].dataType, parts)
    dtype = dt.field_type(df.schema, parts[0])
    if dtype is None:
        return _missing()
    return _walk(dt.column(parts[0]), dtype, parts[1:])


def get_path(df: DataFrame, path: str, doc: str | None = None) -> Column:
    """Column holding the value at ``path``; NULL where it is missing."""
    return lookup(df, path, doc).value


def exists(found: Found) -> Column:
    """True where the path is present.  A VARIANT null is present; a typed NULL counts as missing."""
    return F.lit(False) if found.dtype is None else found.value.isNotNull()


def is_null(found: Found) -> Column:
    """True where the value is missing or null."""
    if found.dtype is None:
        return F.lit(True)
    if isinstance(found.dtype, T.VariantType):
        return found.value.isNull() | F.is_variant_null(found.value)
    return found.value.isNull()
