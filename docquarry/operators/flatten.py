"""Flatten documents to the columns of a manifest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docquarry.functions import types as dt
from docquarry.functions.shapes import OBJECT
from docquarry.functions.values import render
from docquarry.functions.variants import needs_walk, opened, render_variant, scalar_text
from docquarry.operators.manifest import Manifest
from docquarry.operators.paths import Found, lookup

_VALUE = "__docquarry_value"
_KIND = "__docquarry_kind"
_TEXT = "__docquarry_text"
_WALKED = "__docquarry_walked"
_PATHS = "__docquarry_paths"
_SLOT = "__docquarry_slot"
_DOC = "__docquarry_doc"
_OTHERS = "__docquarry_others"


def _open_variants(df: DataFrame, found: list[Found]) -> tuple[DataFrame, dict[int, Column]]:
    """Select the looked-up values once; return the text column of each VARIANT cell.

    The text of most cells is a plain cast.  Doubles, instants and bytes have compiled rules of their own;
    arrays share one copy of the walking expression, which only rows with an array run.
    """
    variants = [i for i, f in enumerate(found) if isinstance(f.dtype, T.VariantType)]
    if not variants:
        return df, {}
    values = df.select(*[f.value.alias(f"{_VALUE}{i}") for i, f in enumerate(found) if f.dtype is not None])
    value = {i: F.col(f"{_VALUE}{i}") for i in variants}
    texts = {f"{_TEXT}{i}": F.try_variant_get(v, "$", "string") for i, v in value.items()}
    kinds = {f"{_KIND}{i}": F.schema_of_variant(v) for i, v in value.items()}
    values = values.withColumns({**texts, **kinds})
    text, kind = ({i: F.col(f"{name}{i}") for i in variants} for name in (_TEXT, _KIND))
    array = {i: kind[i].startswith("ARRAY") for i in variants}
    held = F.array(*[F.when(array[i], value[i]) for i in variants])
    some = F.concat_ws(",", *kind.values()).contains("ARRAY")
    cells = F.transform(held, lambda x: F.when(x.isNotNull(), render_variant(x)))
    walked = values.withColumn(_WALKED, F.when(some, cells))
    return walked, {
        i: F.when(array[i], F.get(F.col(_WALKED), k))
        .when(needs_walk(kind[i], text[i]), scalar_text(value[i], kind[i]))
        .otherwise(text[i])
        for k, i in enumerate(variants)
    }


def flatten(
    df: DataFrame, manifest: Manifest | Iterable[str], missing: str = "null", doc: str | None = None
) -> DataFrame:
    """One string column for each manifest path, in manifest order.

    ``missing="null"`` keeps missing and null cells NULL and empty text empty (the Parquet rule);
    ``missing="empty"`` writes all three as empty text (the CSV rule).  Paths are looked up
    independently, so ``a`` and ``a.b`` may both be columns.  For thousands of paths see ``flatten_cells``.
    """
    if missing not in ("null", "empty"):
        raise ValueError("missing must be 'null' or 'empty'")
    paths = manifest.paths if isinstance(manifest, Manifest) else Manifest.of(manifest).paths
    found = [lookup(df, path, doc) for path in paths]
    source, mixed = _open_variants(df, found)
    cells = []
    for i, (path, item) in enumerate(zip(paths, found)):
        if item.dtype is None:
            cell = F.lit(None)
        elif i in mixed:
            cell = mixed[i]
        else:
            cell = render(F.col(f"{_VALUE}{i}") if mixed else item.value, item.dtype)
        cell = cell.cast("string")
        cells.append((F.coalesce(cell, F.lit("")) if missing == "empty" else cell).alias(path))
    return source.select(*cells)


def flatten_cells(df: DataFrame, manifest: DataFrame, doc: str, cells: str = "cells") -> DataFrame:
    """The other columns and one array of cell texts, in the order of a manifest table.

    For manifests of any width: the plan holds one rule for all cells, and a document's work grows with the values it has, not with
    the paths it lacks.  Its values, sub-documents too, are rows that are joined with ``manifest``, which has the columns
    ``position`` and ``path`` (see ``manifest_table``); the gaps between those found are filled.  Missing and
    null cells are NULL.  A path walks VARIANT sub-documents only, as in ``flatten``.
    """
    if not isinstance(df.schema[doc].dataType, T.VariantType):
        raise ValueError(f"{doc} is not a VARIANT column; typed documents name their paths in the schema")
    row = F.struct("position", "path")
    slots = manifest.agg(F.array_sort(F.collect_list(row)).alias("rows")).select(F.posexplode("rows").alias(_SLOT, "row"))
    slots = slots.select(_SLOT, F.col("row.path").alias(_PATHS))
    others = [dt.column(c) for c in df.columns if c != doc]
    held = df.select(F.monotonically_increasing_id().alias(_DOC), F.struct(*others).alias(_OTHERS), _nodes(dt.column(doc)).alias("node"))
    # The root has no path, so a document without any wanted value stays.
    rows = held.select(_DOC, _OTHERS, F.explode("node").alias("node"))
    rows = rows.select(_DOC, _OTHERS, F.col("node.path").alias(_PATHS), F.col("node.value").alias(_VALUE))
    root = F.col(_PATHS).isNull()
    found = rows.join(slots, _PATHS, "left").where(root | F.col(_SLOT).isNotNull())
    found = found.withColumn(_TEXT, render_variant(F.col(_VALUE)))
    cell = F.when(~root, F.struct(_SLOT, _TEXT))
    docs = found.groupBy(_DOC).agg(F.any_value(F.when(root, F.col(_OTHERS)), True).alias(_OTHERS), F.array_sort(F.collect_list(cell)).alias(_PATHS))
    filled = _filled(F.col(_PATHS), slots.agg(F.count(F.lit(1)).cast("int")).scalar())
    return docs.select(*[F.col(_OTHERS)[c].alias(c) for c in df.columns if c != doc], filled.alias(cells))


def _nodes(value: Column) -> Column:
    """Every value of a VARIANT below its sub-documents as ``(path, item, value)``, after one for the root without a path.

    A name with a dot is left out, with all below it: no path leads there.
    """

    def token(path: Column, item: Column, value: Column) -> Column:
        return F.struct(path.alias("path"), item.alias("item"), value.alias("value"))

    def closed(value: Column) -> Column:
        return F.when(F.schema_of_variant(value).startswith(OBJECT), value)

    absent = F.lit(None).cast("variant")

    def open_up(found: Column) -> Column:
        def field(entry: Column) -> Column:
            path = F.when(found["path"].isNull(), entry["key"]).otherwise(F.concat(found["path"], F.lit("."), entry["key"]))
            return token(path, closed(entry["value"]), entry["value"])

        entries = F.filter(F.map_entries(dt.as_object(found["item"])), lambda e: ~e["key"].contains("."))
        below = F.concat(F.array(token(found["path"], absent, found["value"])), F.transform(entries, field))
        return F.when(found["item"].isNull(), F.array(found)).otherwise(below)

    root = F.array(token(F.lit(None).cast("string"), closed(value), absent))
    return F.when(value.isNull(), F.array(token(F.lit(None).cast("string"), absent, absent))).otherwise(opened(value, root, open_up))


def _filled(found: Column, n: Column) -> Column:
    """Texts at their slots among ``n``, NULL between them."""

    def gap(size: Column) -> Column:
        return F.array_repeat(F.lit(None).cast("string"), size)

    def part(entry: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(found, i - 1)[_SLOT]).otherwise(-1)
        return F.concat(gap(entry[_SLOT] - before - 1), F.array(entry[_TEXT]))

    last = F.when(F.size(found) > 0, F.get(found, F.size(found) - 1)[_SLOT]).otherwise(-1)
    return F.concat(F.flatten(F.transform(found, part)), gap(n - 1 - last))
