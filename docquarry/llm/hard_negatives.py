"""Hard negatives by a vertical branch-and-bound scan.

Vectors are stored once in blocks, dimension by dimension.  For an anchor, a block's dimensions are read in
descending size of the anchor's components; after each few of them every candidate's score is known up to what
the remaining dimensions can add or take, by the block's least and greatest value of each.  Candidates that can no
longer reach the best rows so far, or a window of scores, leave the candidate list; the last ones are known exactly.

Positives are settled first; their scores open the windows in which negatives are then searched by the same scan.
Anchors are read in blocks of at most ``ANCHORS`` and broadcast; rows stay where they are, and a task
sends no more than the wanted number of rows for each anchor and window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docquarry.llm.rows import stored
from docquarry.session import scratch_path

#: Components of one stored block (8,192 rows of 64 dimensions), and dimensions read between two cuts.
BLOCK_VALUES = 1 << 19
STEP = 8
ANCHORS = 4096
#: Stands for a NULL id inside tasks, so that it comes last among equals.
_NO_ID = np.iinfo(np.int64).max


def component_limit(dimensions: int) -> int:
    """Largest component for which 100 times an inner product fits 64 bits."""
    return math.isqrt(2**56 // max(dimensions, 1))


def _matrix(column: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    """Whole components, one row for each dimension; shorter vectors are filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    limit = component_limit(dimensions)
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    values = np.clip(values, -limit, limit).astype(np.int32)
    rows = np.zeros((len(column), dimensions), np.int32)
    rows[np.arange(dimensions) < sizes[:, None]] = values
    return rows.T


def _vertical(dimensions: int, scale: int):
    """Blocks of vectors, stored by dimension."""
    most = max(1, BLOCK_VALUES // max(dimensions, 1))

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("id").fill_null(_NO_ID).to_numpy()
        anchor = batch.column("anchor").fill_null(False).to_numpy(zero_copy_only=False)
        columns = [
            batch.column("row").to_numpy(), ids, batch.column("label").to_numpy(), anchor.astype(np.uint8),
            np.ascontiguousarray(_matrix(batch.column("vector"), dimensions, scale)),
        ]
        cells = [pa.array([c.tobytes()], pa.binary()) for c in columns]
        return pa.RecordBatch.from_arrays(cells, names=["rows", "ids", "labels", "anchors", "columns"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, most - count)
                held, count, at = [*held, part], count + part.num_rows, at + part.num_rows
                if count == most:
                    yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, count = [], 0
        if count:
            yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


@dataclass
class Block:
    """Rows of a stored block; ``columns[d]`` holds dimension d of all of them."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    anchors: np.ndarray
    columns: np.ndarray
    least: np.ndarray = field(init=False)
    greatest: np.ndarray = field(init=False)

    def __post_init__(self):
        self.least = self.columns.min(axis=1).astype(np.int64)
        self.greatest = self.columns.max(axis=1).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[Block]:
    for batch in batches:
        for cells in zip(*(column.to_pylist() for column in batch.columns)):
            rows, ids, labels = (np.frombuffer(c, np.int64) for c in cells[:3])
            columns = np.frombuffer(cells[4], np.int32).reshape(dimensions, len(rows))
            yield Block(rows, ids, labels, np.frombuffer(cells[3], np.uint8) > 0, columns)


def _anchor_rows(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, dimensions):
            at = np.flatnonzero(block.anchors)
            vectors = [block.columns[:, i].tobytes() for i in at.tolist()]
            cells = [pa.array(x[at], pa.int64()) for x in (block.rows, block.ids, block.labels)]
            yield pa.RecordBatch.from_arrays([*cells, pa.array(vectors, pa.binary())], names=["row", "id", "label", "vector"])

    return run


def scan(
    block: Block, vector: np.ndarray, candidates: np.ndarray, cut: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """The candidates that no cut removes, and their exact scores.

    ``cut(lower, upper)`` says which candidates may stay, from bounds of their scores.
    """
    order = np.argsort(-np.abs(vector), kind="stable")
    factors = vector[order]
    ends = factors * block.least[order], factors * block.greatest[order]
    # What the dimensions from a place on can add at least and at most.
    low = np.append(np.cumsum(np.minimum(*ends)[::-1])[::-1], 0)
    high = np.append(np.cumsum(np.maximum(*ends)[::-1])[::-1], 0)
    scores = np.zeros(len(candidates), np.int64)
    for begin in range(0, len(order), STEP):
        if not len(candidates):
            break
        for d in range(begin, min(begin + STEP, len(order))):
            column = block.columns[order[d]]
            scores += (column if len(candidates) == len(column) else column[candidates]) * factors[d]
        after = min(begin + STEP, len(order))
        stay = cut(scores + low[after], scores + high[after])
        if not stay.all():
            candidates, scores = candidates[stay], scores[stay]
    return candidates, scores


def _nth_largest(values: np.ndarray, n: int) -> int | None:
    return int(np.partition(values, len(values) - n)[len(values) - n]) if len(values) >= n else None


@dataclass
class Best:
    """The first ``most`` rows: largest score, then smallest id, then smallest row number."""

    most: int
    least: int | None = None
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rows: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        scores, ids, rows = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.rows, rows)))
        first = np.lexsort((rows, ids, -scores))[: self.most]
        self.scores, self.ids, self.rows = scores[first], ids[first], rows[first]
        if len(first) == self.most:
            self.least = int(self.scores[-1])


@dataclass
class Anchor:
    row: int
    id: int
    label: int
    vector: np.ndarray


def _add_positives(best: Best, anchor: Anchor, block: Block) -> None:
    """Rows of the anchor's label, but not the anchor itself."""

    def cut(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        sure = _nth_largest(lower, best.most)
        bars = [x for x in (best.least, sure) if x is not None]
        return upper >= max(bars) if bars else np.ones(len(upper), bool)

    same = np.flatnonzero((block.labels == anchor.label) & (block.rows != anchor.row))
    at, scores = scan(block, anchor.vector, same, cut)
    if len(at):
        best.add(scores, block.ids[at], block.rows[at])


def _add_negatives(bests: list[Best], windows: list[tuple[int, int]], anchor: Anchor, block: Block) -> None:
    """Rows of other labels, for each window of scores."""

    def cut(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(lower), bool)
        for best, (low, high) in zip(bests, windows):
            if low > high:
                continue
            sure = _nth_largest(lower[(lower >= low) & (upper <= high)], best.most)
            bar = max(x for x in (low, best.least, sure) if x is not None)
            stay |= (upper >= bar) & (lower <= high)
        return stay

    other = np.flatnonzero(block.labels != anchor.label)
    at, scores = scan(block, anchor.vector, other, cut)
    for best, (low, high) in zip(bests, windows):
        inside = (scores >= low) & (scores <= high)
        if inside.any():
            best.add(scores[inside], block.ids[at[inside]], block.rows[at[inside]])


def _batch(kind: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(kind)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kind.values())], names=list(kind))


_POSITIVE = {"anchor": pa.int64(), "score": pa.int64(), "id": pa.int64(), "row": pa.int64()}
_NEGATIVE = {
    "anchor": pa.int64(), "place": pa.int64(), "anchor_id": pa.int64(), "positive_id": pa.int64(),
    "positive_score": pa.int64(), "score": pa.int64(), "id": pa.int64(), "row": pa.int64(),
}


def _schema(kind: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} long" for name in kind)


def _find_positives(shared, dimensions: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: list[Anchor] = shared.value
        bests = [Best(most) for _ in anchors]
        for block in _blocks(batches, dimensions):
            for best, anchor in zip(bests, anchors):
                _add_positives(best, anchor, block)
        for anchor, best in zip(anchors, bests):
            found = zip(best.scores.tolist(), best.ids.tolist(), best.rows.tolist())
            yield _batch(_POSITIVE, [(anchor.row, *r) for r in found])

    return run


def window(score: int, percents: tuple[int, int]) -> tuple[int, int]:
    """Least and greatest whole score between two percentages of a score."""
    low, high = percents
    return -(-low * score // 100), high * score // 100


def _find_negatives(shared, dimensions: int, most: int, percents: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: list[tuple[Anchor, list[tuple[int, int]]]] = shared.value
        windows = [[window(score, percents) for score, _ in positives] for _, positives in anchors]
        bests = [[Best(most) for _ in positives] for _, positives in anchors]
        for block in _blocks(batches, dimensions):
            for (anchor, _), best, spans in zip(anchors, bests, windows):
                _add_negatives(best, spans, anchor, block)
        for (anchor, positives), best in zip(anchors, bests):
            rows = []
            for place, ((score, id), b) in enumerate(zip(positives, best)):
                found = zip(b.scores.tolist(), b.ids.tolist(), b.rows.tolist())
                rows += [(anchor.row, place, anchor.id, id, score, *r) for r in found]
            yield _batch(_NEGATIVE, rows)

    return run


def _ranked(found: DataFrame, most: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    percents: tuple[int, int] = (30, 90),
    scale: int = 256,
) -> DataFrame:
    """For each row where ``anchor`` holds, and each of its positives, the best negatives in the window.

    A component x counts as floor(scale * x); scores are inner products in 64-bit integers.  Positives
    are the first ``positives`` other rows of the anchor's label, negatives the first ``negatives`` rows of another label
    whose score lies within ``percents`` of the positive's; the larger score comes first, then the smaller id.
    Result: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.  A pair
    without negatives gives no row.

    Rows with a NULL label, a NULL vector, or a NULL or non-finite component take no part.  Shorter vectors count as
    filled with zeros.  Components of 2**28 / sqrt(dimensions) or more saturate there, so that no score
    overflows.  Ids and labels are whole numbers; NULL ids are kept and come last among equals (the id 2**63 - 1 is
    read as NULL too).  Repeated rows are rows of their own: they answer, and are asked for, each by itself.  Where ``anchor``
    is NULL the row is no anchor.  Other columns are not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    source = vectors.select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).alias("vector"), anchor.alias("anchor"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    source = source.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    dimensions = source.agg(F.max(F.size("vector"))).first()[0] or 0
    blocks = stored(
        source.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _vertical(dimensions, scale), "rows binary, ids binary, labels binary, anchors binary, columns binary"
        ),
        "vector_blocks",
    )
    asked = stored(blocks.mapInArrow(_anchor_rows(dimensions), "row long, id long, label long, vector binary"), "anchors")
    parts = math.ceil(1.1 * asked.count() / ANCHORS)
    path = scratch_path(spark, "negatives")
    for part in range(max(parts, 1)):
        rows = asked.where(F.pmod(F.xxhash64("row"), F.lit(max(parts, 1))) == part).collect()
        # 4,096 anchors or so at a time, whatever the size of the table.
        anchors = [Anchor(r.row, r.id, r.label, np.frombuffer(r.vector, np.int32).astype(np.int64)) for r in rows]
        shared = spark.sparkContext.broadcast(anchors)
        near = blocks.mapInArrow(_find_positives(shared, dimensions, positives), _schema(_POSITIVE))
        near = _ranked(near, positives, "anchor").orderBy("anchor", "rank").collect()
        found: dict[int, list[tuple[int, int]]] = {}
        for r in near:
            found.setdefault(r.anchor, []).append((r.score, r.id))
        opened = spark.sparkContext.broadcast([(a, found[a.row]) for a in anchors if a.row in found])
        far = blocks.mapInArrow(_find_negatives(opened, dimensions, negatives, percents), _schema(_NEGATIVE))
        _ranked(far, negatives, "anchor", "place").write.mode("append").parquet(path)
        shared.destroy()
        opened.destroy()
    known = lambda name: F.when(F.col(name) != int(_NO_ID), F.col(name))
    return spark.read.parquet(path).select(
        known("anchor_id").alias("anchor_id"), known("positive_id").alias("positive_id"), "rank",
        known("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
