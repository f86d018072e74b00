"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Features of a text are its words, pairs of neighbouring words, word-end shapes (the last three bytes with
letters and digits made alike) and pairs of these, hashed into BUCKETS.  A feature's value is its share of
the text's tokens, so a score is a sparse dot product that one gather and one segmented sum compute for a
whole Arrow batch.

Training reads at most TRAIN_ROWS labelled rows (those with the smallest hash of their id), turned into
features in parallel and passed once in one bounded task through the sequential learner.  The model is one
array of BUCKETS floats (4 MB), whatever the size of the corpus; scoring moves no text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docquarry.llm.kernels import hash_spans, mix, release, slices, words
from docquarry.llm.rows import smallest

BUCKETS = 1 << 20
TRAIN_ROWS = 8_000
EPOCHS = 3
#: FTRL-proximal: learning rate, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 0.6, 1.0, 0.02, 0.1
#: Factor on a feature's share, so that a typical feature is near one.
SCALE = 20.0

_B = np.arange(256, dtype=np.uint8)
_SHAPE = _B.copy()
_SHAPE[((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)] = ord("a")
_SHAPE[(_B >= 48) & (_B <= 57)] = ord("0")


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all tokens' features, four for each token, and the first token of each text."""
    found = words(column)
    shape = hash_spans(_SHAPE[found.data], np.maximum(found.starts, found.ends - 3), found.ends)
    last = np.zeros(len(found.hashes), bool)
    last[found.rows[1:][np.diff(found.rows) > 0] - 1] = True
    columns = []
    for salt, tokens in enumerate((found.hashes, shape)):
        one = mix(tokens + np.uint64(salt + 1))
        after = np.roll(tokens, -1)
        after[last] = 0
        columns += [one, mix(one ^ mix(after + np.uint64(salt + 11)))]
    buckets = (np.stack(columns, axis=1) & np.uint64(BUCKETS - 1)).astype(np.int32) if len(last) else np.zeros((0, 4), np.int32)
    return buckets, found.rows


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        buckets, rows = _features(batch.column("text"))
        index, value = [], []
        for begin, end in zip(rows[:-1].tolist(), rows[1:].tolist()):
            at, count = np.unique(buckets[begin:end], return_counts=True)
            index.append(at.astype("<i4").tobytes())
            value.append((count * (SCALE / max(1, 4 * (end - begin)))).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("turn"), batch.column("label"), pa.array(index, pa.binary()), pa.array(value, pa.binary())],
            names=["turn", "label", "index", "value"],
        )


class Ftrl:
    """Follow-the-regularised-leader with per-coordinate rates; the last coordinate is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros(BUCKETS + 1)
        self.n = np.zeros(BUCKETS + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(at)
        gradient = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        square = self.n[at] + gradient * gradient
        self.z[at] += gradient - (np.sqrt(square) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = square


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # The examples stay as they arrived; each is looked at through its buffer.
    model, examples = Ftrl(), list(batches)
    for _ in range(EPOCHS):
        for batch in examples:
            for label, at, value in zip(*(batch.column(c) for c in ("label", "index", "value"))):
                at = np.append(np.frombuffer(at.as_buffer(), "<i4"), np.int32(BUCKETS))
                value = np.append(np.frombuffer(value.as_buffer(), "<f4"), np.float32(1))
                model.learn(at, value, float(label.as_py()))
    weights = model.weights(np.arange(BUCKETS + 1)).astype("<f4")
    del examples, model
    release()
    yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], names=["weights"])


def train_quality(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, rows: int = TRAIN_ROWS
) -> np.ndarray:
    """Weights learned from at most ``rows`` labelled documents; ``usable`` is a condition on ``doc_id``.

    NULL labels and ids are ignored, repeated labels are averaged.  Without any label all weights are 0.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    # At most `rows` rows of three numbers are broadcast.
    sample = F.broadcast(smallest(known.withColumn("turn", F.xxhash64("doc_id")), "turn", rows))
    examples = docs.select("doc_id", "text").join(sample, "doc_id").select("turn", "label", "text")
    features = examples.mapInArrow(_examples, "turn long, label int, index binary, value binary")
    model = features.repartition(1).sortWithinPartitions("turn", "index").mapInArrow(_train, "weights binary").collect()
    return np.frombuffer(model[0]["weights"], "<f4") if model else np.zeros(BUCKETS + 1, np.float32)


def _scores(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    buckets, rows = _features(column)
    sums = np.concatenate([[0.0], np.cumsum(weights[buckets].sum(axis=1, dtype=np.float64))])
    count = np.diff(rows)
    margin = (sums[rows[1:]] - sums[rows[:-1]]) * (SCALE / np.maximum(1, 4 * count)) + float(weights[-1])
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def quality_scores(docs: DataFrame, weights: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, score, predicted`` for each row: the chance of label 1, and 1 where it is at least a half.

    Only the text is an input.  Empty, blank and NULL texts get the score of the bias alone.  Repeated rows
    get repeated results; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(_scores(batch.column("text"), model.value))], names=["id", "score"]
            )

    kind = docs.schema[id].dataType.simpleString()
    scored = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """The documents whose score is at least a half, all columns as they are, without a shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield batch.filter(pa.array(_scores(batch.column(text), model.value) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
