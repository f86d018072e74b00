"""Inclusion projection: keep the listed dotted fields, nested shape unchanged."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docquarry.functions import types as dt
from docquarry.operators.paths import path_tree, variant_path


def parse_field_list(text: str) -> list[str]:
    """``"a, b,,c"`` -> ``["a", "b", "c"]``."""
    return [name for name in (part.strip() for part in text.split(",")) if name]


def _keep(value: Column, dtype: T.DataType, wanted: dict) -> Column | None:
    if not wanted:
        return value
    if isinstance(dtype, T.StructType) and dt.wrapper_of(dtype) is None:
        parts = []
        for name, inner in wanted.items():
            inner_type = dt.field_type(dtype, name)
            kept = None if inner_type is None else _keep(value.getField(name), inner_type, inner)
            if kept is not None:
                parts.append(kept.alias(name))
        return F.when(value.isNotNull(), F.struct(*parts)) if parts else None
    if isinstance(dtype, T.ArrayType):
        if _keep(F.lit(None), dtype.elementType, wanted) is None:
            return None
        return F.transform(value, lambda x: _keep(x, dtype.elementType, wanted))
    if isinstance(dtype, T.MapType):
        return _keep_entries(value, dtype, wanted)
    if isinstance(dtype, T.VariantType):
        return _keep_variant(value, wanted)
    return None


def _keep_entries(value: Column, dtype: T.MapType, wanted: dict) -> Column | None:
    """The wanted entries of a map, each cut to the names below it."""
    names = [F.lit(n) for n in wanted]
    kept = F.map_filter(value, lambda k, _: k.isin(*names))
    if not any(wanted.values()):
        return kept
    below = list(wanted.values())
    if all(inner == below[0] for inner in below):
        if _keep(F.lit(None), dtype.valueType, below[0]) is None:
            return None
        return F.transform_values(kept, lambda _, v: _keep(v, dtype.valueType, below[0]))
    if isinstance(dtype.valueType, T.VariantType):

        def cut(key: Column, entry: Column) -> Column:
            result = F.lit(None).cast("variant")
            for name, inner in wanted.items():
                result = F.when(key == name, _keep_variant(entry, inner) if inner else entry).otherwise(result)
            return result

        return F.transform_values(kept, cut)
    raise ValueError("entries of one map share a type; list the same fields below each of its keys")


def _keep_variant(value: Column, wanted: dict) -> Column:
    """VARIANT object with only the wanted fields; absent fields stay absent and NULL stays NULL."""
    keys, kept = [], []
    for name, inner in wanted.items():
        child = F.try_variant_get(value, variant_path([name]), "variant")
        keys.append(F.lit(name))
        kept.append(_keep_inside(child, inner) if inner else child)
    fields = F.map_filter(F.map_from_arrays(F.array(*keys), F.array(*kept)), lambda _, v: v.isNotNull())
    return F.when(value.isNotNull(), F.to_variant_object(fields))


def _keep_inside(child: Column, wanted: dict) -> Column:
    """A sub-document cut to the wanted fields; of an array, its sub-documents; nothing of a scalar."""
    documents = F.filter(dt.as_array(child), lambda x: dt.as_object(x).isNotNull())
    items = F.transform(documents, lambda x: _keep_variant(x, wanted))
    return F.when(dt.as_object(child).isNotNull(), _keep_variant(child, wanted)).when(
        items.isNotNull(), F.to_variant_object(items)
    )


def project(df: DataFrame, fields: str | Iterable[str], key: str | None = "_id", doc: str | None = None) -> DataFrame:
    """Keep ``fields``; the key column rides along when the collection has one.

    Fields the schema does not know are left out, as a document database leaves them out.
    """
    names = parse_field_list(fields) if isinstance(fields, str) else list(fields)
    if not names:
        raise ValueError("the field list must name at least one field")
    wanted = path_tree(names)
    if doc is not None:
        if key and key not in df.columns and key not in wanted:
            wanted = {key: {}, **wanted}
        kept = _keep(dt.column(doc), df.schema[doc].dataType, wanted)
        outer = [dt.column(key)] if key in df.columns else []
        return df.select(*outer, kept.alias(doc))
    if key and key in df.columns and key not in wanted:
        wanted = {key: {}, **wanted}
    columns = []
    for name, inner in wanted.items():
        dtype = dt.field_type(df.schema, name)
        kept = None if dtype is None else _keep(dt.column(name), dtype, inner)
        if kept is not None:
            columns.append(kept.alias(name))
    return df.select(*columns)
