"""Digest columns of span arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digest(found: DataFrame, id: str, kinds: tuple[str, ...]) -> DataFrame:
    """``id``, the number of base spans of each kind, ``base_sha256`` and all ``spans`` as text."""
    base = F.filter("found", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    digest = F.sha2(_text(base).cast("binary"), 256).alias("base_sha256")
    return found.select(id, *map(count, kinds), digest, _text(F.col("found")).alias("spans"))
