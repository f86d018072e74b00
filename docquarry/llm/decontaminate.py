"""Benchmark decontamination by size-partitioned MinHash containment search.

A short test item inside a long document has a tiny Jaccard similarity, so equal signatures would miss
it.  Containment is sketched from the item's side instead: each item keeps, for each of HASHES hash
functions, the shingle with the smallest value.  The share of these that occur anywhere in a document
estimates how much of the item the document contains, however long the document is.  Items are
partitioned by the size of their shingle set (powers of two); a partition has its own least number of hits,
and documents too short for a partition are not searched in it.  Every candidate is then verified on the
exact shingle sets.

The items are read in blocks of at most BLOCK_SHINGLES shingles, and each block is broadcast, so the
broadcast is bounded whatever the size of the benchmark; the documents are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docquarry.llm.kernels import common_count, distinct, mix, seeds, shingle_sets, shingles, slices, words
from docquarry.session import scratch_path

HASHES = 24
#: An item's share of hits may fall short of the wanted containment by so much; 0.0005 of true cases at
#: the limit fall below it (24 draws, containment 0.8).
MARGIN = 0.36
BLOCK_SHINGLES = 4_000_000


def _item_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = words(batch.column("text"))
            counts = np.diff(found.rows)
            sets = [values.tobytes() for values in shingle_sets(found, size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.minimum(counts, size)), pa.array(sets, pa.binary())],
                names=["item", "width", "shingles"],
            )

    return run


@dataclass
class Part:
    """Items of one shingle width and one power of two of set size."""

    width: int
    smallest: int
    hits: int
    items: np.ndarray
    sets: list[np.ndarray]
    sketch: np.ndarray
    owner: np.ndarray


def _parts(rows: list, percent: int) -> list[Part]:
    """Sketches of a block of items, by partition."""
    grouped: dict[tuple[int, int], list] = {}
    for row in rows:
        values = np.frombuffer(row["shingles"], np.uint64)
        grouped.setdefault((row["width"], int(math.log2(len(values)))), []).append((row["item"], values))
    factors = seeds(HASHES, salt=5000)
    parts = []
    for (width, _), members in sorted(grouped.items()):
        sketch, owner = [], []
        for i, (_, values) in enumerate(members):
            least = values[np.argmin(mix(np.multiply.outer(factors, values)), axis=1)]
            sketch.append(least)
            owner.append(np.full(HASHES, i))
        sketch, owner = np.concatenate(sketch), np.concatenate(owner)
        order = np.argsort(sketch, kind="stable")
        parts.append(
            Part(
                width,
                min(len(v) for _, v in members),
                max(1, math.ceil((percent / 100 - MARGIN) * HASHES)),
                np.array([item for item, _ in members]),
                [v for _, v in members],
                sketch[order],
                owner[order],
            )
        )
    return parts


def _contained(parts: list[Part], hashes: np.ndarray, percent: int) -> Iterator[tuple[int, int, int]]:
    """Items of a block that a text contains: item, shingles found, shingles of the item."""
    sets: dict[int, np.ndarray] = {}
    for part in parts:
        if len(hashes) < part.width:
            continue
        if part.width not in sets:
            sets[part.width] = distinct(shingles(hashes, part.width))
        values = sets[part.width]
        if len(values) < -(-percent * part.smallest // 100):
            continue
        at = np.searchsorted(values, part.sketch)
        at[at == len(values)] = 0
        hit = part.owner[values[at] == part.sketch]
        if not len(hit):
            continue
        counts = np.bincount(hit, minlength=len(part.items))
        for k in np.flatnonzero(counts >= part.hits).tolist():
            shared = common_count(part.sets[k], values)
            if 100 * shared >= percent * len(part.sets[k]):
                yield int(part.items[k]), shared, len(part.sets[k])


def _search(shared, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = words(batch.column("text"))
            rows, matches = [], []
            for i, (begin, end) in enumerate(zip(found.rows[:-1].tolist(), found.rows[1:].tolist())):
                for match in _contained(shared.value, found.hashes[begin:end], percent):
                    rows.append(i)
                    matches.append(match)
            columns = list(zip(*matches)) if matches else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)],
                names=["id", "item", "shared", "item_shingles"],
            )

    return run


def _blocks(items: DataFrame, item_id: str, item_text: str, shingle: int, percent: int) -> Iterator:
    """Broadcast sketches of the items, block by block."""
    spark = items.sparkSession
    path = scratch_path(spark, "items")
    items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).mapInArrow(
        _item_sets(shingle), "item long, width long, shingles binary"
    ).where("width > 0").withColumn("size", F.expr("octet_length(shingles) div 8")).write.parquet(path)
    stored = spark.read.parquet(path)
    total = stored.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, math.ceil(1.5 * total / BLOCK_SHINGLES))
    for block in range(blocks):
        rows = stored.where(F.pmod(F.xxhash64("item", "shingles"), F.lit(blocks)) == block).collect()
        yield spark.sparkContext.broadcast(_parts(rows, percent))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Pairs ``id, item_id, shared, item_shingles, containment`` of documents and the items they contain.

    Words are lower-cased (A-Z).  An item is contained when at least ``percent`` / 100 of its
    distinct ``shingle``-word shingles occur in the document; an item with fewer words is one shingle of all its
    words, searched at that width.  Items or documents without words, or with NULL text, match nothing.
    Repeated rows give repeated pairs.  Other columns are not read.  Ids are whole numbers; a NULL id
    stays NULL.
    """
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    result = None
    for parts in _blocks(items, item_id, item_text, shingle, percent):
        found = source.mapInArrow(_search(parts, percent), "id long, item long, shared long, item_shingles long")
        result = found if result is None else result.unionByName(found)
    return result.select(
        F.col("id").alias(id),
        F.col("item").alias("item_id"),
        "shared",
        "item_shingles",
        (F.col("shared") / F.col("item_shingles")).alias("containment"),
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The documents that contain no item, all columns as they are, without a shuffle."""

    def keep(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text):
                found = words(batch.column(text))
                bounds = zip(found.rows[:-1].tolist(), found.rows[1:].tolist())
                clean = [next(_contained(shared.value, found.hashes[a:b], percent), None) is None for a, b in bounds]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for parts in _blocks(items, item_id, item_text, shingle, percent):
        docs = docs.mapInArrow(keep(parts), docs.schema)
    return docs
