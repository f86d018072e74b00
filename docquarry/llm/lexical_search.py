"""Ranked lexical search with norm buckets.

A document's impact vector has one whole number for each term that any item asks for; an item's vector has its
terms' weights, and a score is their inner product.  Documents are stored once as such vectors and are not
shuffled: each task orders its own by length, longest first, and takes them in buckets.

* A bucket whose longest vector cannot bring an item to the item's threshold (Cauchy-Schwarz) is left out for the item,
  and so are all shorter ones.
* Inside a bucket the greatest impact of each term bounds what the item's lighter terms can add.  Only documents
  that hold one of the heavier terms, the focus, can reach the threshold.  Their partial score plus the least of that
  bound and of Cauchy-Schwarz on the other coordinates decides who survives.
* Survivors are scored anew in 64-bit integers over all their terms.

A threshold is the score of the last row held, at first that of a sample of the documents: any documents
give a valid bound, so the sample changes the work and never the result.  Each task sends its best rows of each item on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docquarry.llm.kernels import distinct, ragged, slices, words
from docquarry.llm.rows import stored
from docquarry.session import scratch_path

#: Distinct terms of all items that are broadcast as 64-bit hashes (32 MB); with more, all terms of a document are stored.
VOCABULARY = 4_000_000
#: Item terms that are searched, and broadcast, at a time.
BLOCK_TERMS = 500_000
#: Documents and terms of a bucket.
BUCKET_ROWS = 4096
BUCKET_TERMS = 1_000_000
#: Documents that set the first thresholds.
SAMPLE = 20_000
#: Room for rounding in bounds, which are doubles.
_SLACK = 1 + 1e-9

_BYTES = np.arange(256)
_GAPS = ~(
    ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
)


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts, and where each text's terms start."""
    found = words(column, gaps=_GAPS)
    return found.hashes.view(np.int64), found.rows


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        terms, rows = _terms(batch.column("text"))
        sets = [distinct(terms[a:b]) for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())]
        owner = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), pa.int64())
        terms = pa.array(np.concatenate([np.zeros(0, np.int64), *sets]), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row").take(owner), batch.column("id").take(owner), terms], names=["row", "item", "term"]
        )


def _counts(owner: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term) pairs in order, and how often each occurs."""
    order = np.lexsort((terms, owner))
    owner, terms = owner[order], terms[order]
    first = np.ones(len(order), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1])
    at = np.flatnonzero(first)
    return owner[at], terms[at], np.diff(np.append(at, len(order)))


def _cells(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary cell for each text."""
    data, width = np.ascontiguousarray(values), values.dtype.itemsize
    return pa.Array.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer((ends * width).astype(np.int64)), pa.py_buffer(data)]
    ).cast(pa.binary())


def _vectors(shared):
    """Number of terms of each text, and its wanted terms with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if shared is None else shared.value
        for batch in slices(batches, "text"):
            terms, rows = _terms(batch.column("text"))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(rows))
            if known is not None:
                at = np.searchsorted(known, terms)
                at[at == len(known)] = 0
                wanted = known[at] == terms if len(known) else np.zeros(len(terms), bool)
                owner, terms = owner[wanted], terms[wanted]
            owner, terms, counts = _counts(owner, terms)
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            cells = [_cells(terms, ends), _cells(counts.astype(np.int32), ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(rows), pa.int64()), *cells], names=["id", "n", "terms", "counts"]
            )

    return run


def _flat(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """Values of binary cells one after the other, and how many each cell has."""
    cells = column.to_pylist()
    values = np.frombuffer(b"".join(cells), dtype)
    return values, np.array([len(c) for c in cells], np.int64) // np.dtype(dtype).itemsize


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of each batch hold a term."""
    for batch in batches:
        terms, counts = np.unique(_flat(batch.column("terms"), np.int64)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(counts, pa.int64())], names=["term", "df"])


@dataclass
class Item:
    """Terms by falling weight, as places in the block's list of terms."""

    row: int
    id: int
    terms: np.ndarray
    weights: np.ndarray
    #: Length of the vector without its first 0, 1, 2 ... terms.
    rest: np.ndarray


@dataclass
class Asked:
    """A block of items."""

    terms: np.ndarray
    items: list[Item]


def _asked(rows: list) -> Asked:
    terms = distinct(np.array([r.term for r in rows], np.int64))
    grouped: dict[int, list] = {}
    for r in rows:
        grouped.setdefault(r.row, []).append(r)
    items = []
    for row, held in sorted(grouped.items()):
        held.sort(key=lambda r: (-r.weight, r.term))
        weights = np.array([r.weight for r in held], np.int64)
        squares = np.cumsum((weights[::-1].astype(np.float64)) ** 2)[::-1]
        at = np.searchsorted(terms, np.array([r.term for r in held], np.int64))
        items.append(Item(row, held[0].item, at, weights, np.append(np.sqrt(squares), 0.0)))
    return Asked(terms, items)


def _impacts(shared, documents: int, length: int):
    """Impact vectors over the terms of a block of items, with their length; others are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.terms
        for batch in batches:
            terms, sizes = _flat(batch.column("terms"), np.int64)
            counts = _flat(batch.column("counts"), np.int32)[0].astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.searchsorted(known, terms)
            at[at == len(known)] = 0
            wanted = known[at] == terms
            owner, at, counts = owner[wanted], at[wanted], counts[wanted]
            mass = 50 + (50 * batch.column("n").to_numpy() * documents) // length
            impacts = (1_000_000_000 * counts) // (1000 * counts + 20 * mass[owner])
            norm = np.sqrt(np.bincount(owner, impacts.astype(np.float64) ** 2, batch.num_rows))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            columns = [
                batch.column("id"), pa.array(norm), _cells(at.astype(np.int32), ends), _cells(impacts.astype(np.int32), ends),
            ]
            found = pa.RecordBatch.from_arrays(columns, names=["id", "norm", "terms", "impacts"])
            yield found.filter(pa.array(norm > 0))

    return run


@dataclass
class Bucket:
    """Documents of similar length, as lists of (document, impact) for each term that occurs."""

    ids: np.ndarray
    nulls: np.ndarray
    norms: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    greatest: np.ndarray
    docs: np.ndarray
    impacts: np.ndarray


def _bucket(parts: list[pa.RecordBatch], terms: int) -> Bucket:
    table = pa.Table.from_batches(parts).combine_chunks()
    ids = table.column("id").combine_chunks()
    at, sizes = _flat(table.column("terms"), np.int32)
    impacts = _flat(table.column("impacts"), np.int32)[0].astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, docs, impacts = at[order], np.repeat(np.arange(len(ids)), sizes)[order], impacts[order]
    starts = np.searchsorted(at, np.arange(terms + 1))
    sizes, starts = np.diff(starts), starts[:-1]
    greatest = np.zeros(terms, np.int64)
    held = np.flatnonzero(sizes)
    greatest[held] = np.maximum.reduceat(impacts, starts[held])
    nulls = ids.is_null().to_numpy(zero_copy_only=False)
    return Bucket(ids.fill_null(0).to_numpy(), nulls, table.column("norm").to_numpy(), starts, sizes, greatest, docs, impacts)


def _buckets(batches: Iterator[pa.RecordBatch], terms: int) -> Iterator[Bucket]:
    held, rows, size = [], 0, 0
    for batch in batches:
        ends = np.cumsum(np.array([len(c) for c in batch.column("terms").to_pylist()], np.int64) // 4)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = int(np.searchsorted(ends, before + BUCKET_TERMS - size, side="right"))
            end = min(max(end, at if rows else at + 1), at + BUCKET_ROWS - rows, batch.num_rows)
            if end > at:
                held.append(batch.slice(at, end - at))
                rows, size = rows + end - at, size + int(ends[end - 1] - before)
            if end < batch.num_rows or rows == BUCKET_ROWS or size >= BUCKET_TERMS:
                yield _bucket(held, terms)
                held, rows, size = [], 0, 0
            at = end
    if held:
        yield _bucket(held, terms)


class Best:
    """The first rows of an item: largest score, then smallest id, a NULL id last."""

    def __init__(self, most: int, threshold: int) -> None:
        self.most, self.threshold = most, max(threshold, 1)
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        first = np.lexsort((ids, nulls, -scores))[: self.most]
        self.scores, self.ids, self.nulls = scores[first], ids[first], nulls[first]
        if len(first) == self.most:
            self.threshold = max(self.threshold, int(self.scores[-1]))


def search(item: Item, bucket: Bucket, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a bucket that reach the threshold, and their scores."""
    none = np.zeros(0, np.int64)
    most = item.weights * bucket.greatest[item.terms]
    # What the terms from each place on can add.
    rest = np.append(np.cumsum(most[::-1])[::-1], 0)
    if rest[0] < threshold:
        return none, none
    focus = int(np.count_nonzero(rest >= threshold))
    sizes = bucket.sizes[item.terms]
    at = ragged(bucket.starts[item.terms], sizes)
    weights = np.repeat(item.weights, sizes)
    heavy = int(sizes[:focus].sum())
    docs, n = bucket.docs[at], len(bucket.ids)
    impacts = bucket.impacts[at]
    gains = weights * impacts
    partial = np.bincount(docs[:heavy], gains[:heavy], n)
    if focus < len(sizes):
        squares = np.bincount(docs[:heavy], impacts[:heavy].astype(np.float64) ** 2, n)
        other = np.sqrt(np.maximum(bucket.norms**2 * _SLACK - squares, 0)) * item.rest[focus]
        bound = partial + np.minimum(other, rest[focus])
    else:
        bound = partial
    survivors = (partial > 0) & (bound * _SLACK >= threshold)
    kept = survivors[docs]
    scores = np.zeros(n, np.int64)
    np.add.at(scores, docs[kept], gains[kept])
    found = np.flatnonzero(scores >= threshold)
    return found, scores[found]


def _search(shared, floors, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Asked = shared.value
        bests = [Best(most, floors.get(item.row, 1)) for item in asked.items]
        open_items = list(zip(asked.items, bests))
        for bucket in _buckets(batches, len(asked.terms)):
            longest = bucket.norms.max() * _SLACK
            # Later buckets are shorter, and thresholds only rise.
            open_items = [(i, b) for i, b in open_items if i.rest[0] * longest >= b.threshold]
            for item, best in open_items:
                found, scores = search(item, bucket, best.threshold)
                if len(found):
                    best.add(scores, bucket.ids[found], bucket.nulls[found])
        for item, best in zip(asked.items, bests):
            size = len(best.scores)
            ids = pa.array(best.ids, pa.int64(), mask=best.nulls)
            columns = [pa.array(np.full(size, item.row), pa.int64()), pa.array([item.id] * size, pa.int64()), ids]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(best.scores, pa.int64())], names=["row", "item", "id", "score"])

    return run


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most: int = 50,
) -> DataFrame:
    """The ``most`` documents with the highest score above 0 for each item: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased.  With N documents that hold
    a term, L terms in all of them, n terms in one, df documents with the term and tf occurrences in one, a
    term weighs floor(1000 ln((2N + 2) / (2 df + 1))) and has the impact 10**9 tf div (1000 tf + 20 m), m = 50 +
    50 n N div L.  A score sums weight times impact over the item's distinct terms.

    Equal scores come by ascending id, a NULL id last.  NULL or empty texts hold no terms: such documents count nowhere and such
    items get no rows.  Repeated documents are ranked each; a repeated item is searched for each of its rows.  Ids are whole
    numbers; other columns are not read; empty tables give an empty result.  Terms are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    wanted = stored(
        items.select(F.monotonically_increasing_id().alias("row"), F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
        .mapInArrow(_item_terms, "row long, item long, term long"),
        "item_terms",
    )
    terms = wanted.select("term").distinct()
    known = None
    if terms.count() <= VOCABULARY:
        hashes = np.array([r.term for r in terms.collect()], np.int64)
        known = spark.sparkContext.broadcast(np.sort(hashes))
    vectors = stored(
        docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
        .mapInArrow(_vectors(known), "id long, n long, terms binary, counts binary"),
        "term_vectors",
    )
    totals = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    documents, length = totals.documents, totals.length or 0
    holders = vectors.mapInArrow(_holders, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(documents) + 2) / (2 * F.col("df") + 1)))
    weighted = stored(wanted.join(holders, "term").select("row", "item", "term", weight.alias("weight")).where("weight > 0"), "weights")

    path = scratch_path(spark, "ranked")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    held = vectors.where(F.octet_length("terms") > 0)
    parts = max(1, math.ceil(1.2 * weighted.count() / BLOCK_TERMS))
    for part in range(parts):
        shared = spark.sparkContext.broadcast(_asked(weighted.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == part).collect()))

        def best(rows: DataFrame, floors: dict[int, int]) -> DataFrame:
            vectors = rows.mapInArrow(_impacts(shared, documents, length), "id long, norm double, terms binary, impacts binary")
            ordered = vectors.sortWithinPartitions(F.desc("norm"))
            found = ordered.mapInArrow(_search(shared, floors, most), "row long, item long, id long, score long")
            return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

        floors = {}
        if documents > 4 * SAMPLE:
            sample = best(held.where(F.rand(7) < SAMPLE / documents), {}).where(F.col("rank") == most)
            floors = {r.row: r.score for r in sample.select("row", "score").collect()}
        best(held, floors).write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.parquet(path).select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
