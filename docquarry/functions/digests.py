"""SHA-256 digests of rows, filter specs and manifests."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from docquarry.functions import types as dt
from docquarry.functions import values


def _plain(value):
    if isinstance(value, (bytes, bytearray)):
        return {"$binary": value.hex()}
    if isinstance(value, (_dt.datetime, _dt.date)):
        return {"$date": value.isoformat()}
    if isinstance(value, decimal.Decimal):
        return {"$numberDecimal": str(value)}
    raise TypeError(f"cannot digest {type(value).__name__}")


def spec_digest(spec: Mapping) -> str:
    """SHA-256 of a filter spec or manifest part as key-ordered compact JSON."""
    text = json.dumps(spec, sort_keys=True, separators=(",", ":"), default=_plain, ensure_ascii=False)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def row_digest(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """SHA-256 of a row's rendered cells.

    Each cell is written as its length, a colon and its text (``~`` for null), so two different
    rows cannot run together into the same bytes.
    """
    parts = []
    for field in df.schema.fields if columns is None else [df.schema[c] for c in columns]:
        text = values.render(dt.column(field.name), field.dataType)
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.sha2(F.concat(*parts), 256)
