"""Which dotted leaf paths occur in a collection, and how often.

Sub-documents are descended into, however deep; everything else (arrays and nulls too) is a leaf; an empty
sub-document gives no path.

Paths that the schema already names are counted by one keyless aggregate, so they cost a column scan
and one row for each task.  VARIANT documents are first counted by their schema text, which the JVM
makes in one call; only the distinct texts, combined in each task, are taken apart into paths.  Keys of typed
maps are listed by an expression and exploded straight into a partial aggregate.  No document crosses the
network either way.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docquarry.functions import types as dt
from docquarry.functions.shapes import OBJECT, path_rows
from docquarry.functions.variants import opened

_NO_PATHS = "array<string>"
_SHAPE_ROWS = "names string, path string, kind string, documents long"


def _dotted(prefix: Column | None, name: Column) -> Column:
    return name if prefix is None else F.concat(prefix, F.lit("."), name)


def _variant_leaves(value: Column, prefix: Column | None) -> Column:
    """Leaf paths of a VARIANT object as an array; NULL when it is not an object."""

    def token(path: Column, item: Column) -> Column:
        return F.struct(path.alias("path"), item.alias("item"))

    def open_up(found: Column) -> Column:
        def field(entry: Column) -> Column:
            below = F.when(found["path"].isNull(), entry["key"]).otherwise(_dotted(found["path"], entry["key"]))
            return token(below, F.when(F.schema_of_variant(entry["value"]).startswith(OBJECT), entry["value"]))

        fields = F.transform(F.map_entries(dt.as_object(found["item"])), field)
        return F.when(found["item"].isNull(), F.array(found)).otherwise(fields)

    start = F.array(token(F.lit(None).cast("string") if prefix is None else prefix, value))
    leaves = F.transform(opened(value, start, open_up), lambda t: t["path"])
    return F.when(F.schema_of_variant(value).startswith(OBJECT), leaves)


def _typed_leaves(value: Column, dtype: T.DataType, prefix: Column | None) -> Column:
    """Leaf paths below a typed value as an array; NULL where nothing is below it."""
    if isinstance(dtype, T.StructType):
        parts = []
        for field in dtype.fields:
            path, inner = _dotted(prefix, F.lit(field.name)), value.getField(field.name)
            parts.append(_leaves(inner, field.dataType, path))
        known = F.concat(*parts) if parts else F.array().cast(_NO_PATHS)
        return F.when(value.isNotNull(), known).otherwise(F.array().cast(_NO_PATHS))
    entries = F.map_entries(value)
    below = F.transform(entries, lambda e: _leaves(e["value"], dtype.valueType, _dotted(prefix, e["key"])))
    return F.coalesce(F.flatten(below), F.array().cast(_NO_PATHS))


def _leaves(value: Column, dtype: T.DataType, path: Column) -> Column:
    if isinstance(dtype, T.VariantType):
        inner = _variant_leaves(value, path)
        alone = F.when(value.isNull(), F.array().cast(_NO_PATHS)).otherwise(F.array(path))
        return F.coalesce(inner, alone)
    if dt.is_document(dtype):
        return _typed_leaves(value, dtype, path)
    return F.when(value.isNull(), F.array().cast(_NO_PATHS)).otherwise(F.array(path))


def leaf_paths(df: DataFrame, doc: str | None = None) -> Column:
    """Array of the leaf paths present in each document.

    In typed documents NULL means missing, so a path is present where its value is not NULL.  In
    VARIANT documents an explicit null is a leaf of its own.
    """
    if doc is not None:
        value, dtype = dt.column(doc), df.schema[doc].dataType
        if isinstance(dtype, T.VariantType):
            return F.coalesce(_variant_leaves(value, None), F.array().cast(_NO_PATHS))
        return _typed_leaves(value, dtype, None)
    parts = [_leaves(dt.column(f.name), f.dataType, F.lit(f.name)) for f in df.schema.fields]
    return F.concat(*parts)


def shape_rows(df: DataFrame, value: Column) -> DataFrame:
    """``(names, path, kind, documents)`` for every path of a VARIANT column and every kind it has there.

    ``names`` is the path as a JSON list.  Sub-documents have the kind OBJECT, arrays ARRAY; the root is the path
    without names.
    """
    shapes = df.groupBy(F.schema_of_variant(value).alias("shape")).agg(F.count(F.lit(1)).alias("documents"))
    rows = shapes.mapInArrow(path_rows, _SHAPE_ROWS)
    return rows.groupBy("names", "path", "kind").agg(F.sum("documents").alias("documents"))


def _split(value: Column, dtype: T.DataType, path: str | None, fixed: list, open_keys: list) -> None:
    """Sort the leaves below ``value`` into schema-known ones and ones with keys only the data knows."""
    if isinstance(dtype, T.StructType) and dt.is_document(dtype):
        for field in dtype.fields:
            below = field.name if path is None else f"{path}.{field.name}"
            _split(value.getField(field.name), field.dataType, below, fixed, open_keys)
    elif dt.is_document(dtype):
        open_keys.append((value, dtype, path))
    else:
        fixed.append((path, value))


def _variant_counts(df: DataFrame, variants: list[tuple[Column, str | None]]) -> DataFrame:
    """``(path, documents)`` of the leaves of VARIANT columns."""
    found = None
    for value, path in variants:
        rows = shape_rows(df, value).where(F.col("kind") != OBJECT)
        if path is None:
            rows = rows.where("names <> '[]'").select("path", "documents")
        else:
            dotted = F.when(F.col("names") == "[]", F.lit(path)).otherwise(F.concat(F.lit(path + "."), "path"))
            rows = rows.select(dotted.alias("path"), "documents")
        found = rows if found is None else found.union(rows)
    return found


def path_counts(df: DataFrame, doc: str | None = None) -> DataFrame:
    """``(path, documents)`` for every leaf path, plus one row with a NULL path that counts all documents."""
    fixed: list = []
    open_keys: list = []
    if doc is not None:
        _split(dt.column(doc), df.schema[doc].dataType, None, fixed, open_keys)
    else:
        for field in df.schema.fields:
            _split(dt.column(field.name), field.dataType, field.name, fixed, open_keys)

    counts = [F.count(F.lit(1)).alias("c")] + [F.count(v).alias(f"c{i}") for i, (_, v) in enumerate(fixed)]
    rows = [F.struct(F.lit(None).cast("string").alias("path"), F.col("c").alias("documents"))]
    rows += [F.struct(F.lit(p).alias("path"), F.col(f"c{i}").alias("documents")) for i, (p, _) in enumerate(fixed)]
    known = df.agg(*counts).select(F.inline(F.array(*rows)))
    variants = [(v, p) for v, dtype, p in open_keys if isinstance(dtype, T.VariantType)]
    maps = [_typed_leaves(v, t, None if p is None else F.lit(p)) for v, t, p in open_keys if isinstance(t, T.MapType)]
    if not open_keys:
        return known
    if variants:
        known = known.union(_variant_counts(df, variants))
    if maps:
        found = df.select(F.explode(F.concat(*maps)).alias("path"))
        known = known.union(found.groupBy("path").agg(F.count(F.lit(1)).alias("documents")))
    # One row a path and kind; they overlap where a path has several kinds or a column name holds a dot.
    return known.groupBy("path").agg(F.sum("documents").alias("documents"))


def path_coverage(df: DataFrame, doc: str | None = None) -> DataFrame:
    """For every leaf path, how many documents hold it."""
    held = F.col("path").isNotNull() & (F.col("documents") > 0)
    return path_counts(df, doc).filter(held)


def discover_paths(df: DataFrame, doc: str | None = None) -> DataFrame:
    """Distinct leaf paths of the whole collection, at any depth, sorted bytewise."""
    return path_coverage(df, doc).select("path").orderBy("path")


def missing_fields(df: DataFrame, wanted: Iterable[str], doc: str | None = None) -> DataFrame:
    """Wanted paths no document holds, with their place in the wanted list.

    Only leaf paths count as held, so naming a whole sub-document reports it as missing.
    """
    names = list(wanted)
    rows = [(i, name) for i, name in enumerate(names)]
    asked = df.sparkSession.createDataFrame(rows, "position int, path string")
    held = path_coverage(df, doc)
    return asked.join(held, "path", "left_anti").select("position", "path").orderBy("position")
