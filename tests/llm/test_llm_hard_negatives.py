"""Hard-negative mining against a plain version over all pairs."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from docquarry.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label long, id long, row long, score long, rank int, anchor string"
EMPTY = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, 1, "x") for r in rows], SCHEMA)


def mined(spark, rows, step, **options):
    found = hn.hard_negatives(frame(spark, rows), F.col("vec_id") % step == 0, **options)
    return sorted(map(repr, (tuple(r) for r in found.collect())))


def plain(rows, step, positives=5, negatives=10, percents=(30, 90), scale=256):
    used = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((i, [math.floor(scale * x) for x in v], label))
    product = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    found = []
    for k, (i, v, label) in enumerate(used):
        if i is None or i % step:
            continue
        others = [(product(v, w), j, other) for m, (j, w, other) in enumerate(used) if m != k]
        near = sorted((r for r in others if r[2] == label), key=order)[:positives]
        for score, j, _ in near:
            low, high = percents
            far = [r for r in others if r[2] != label and low * score <= 100 * r[0] <= high * score]
            for rank, r in enumerate(sorted(far, key=order)[:negatives], 1):
                found.append((i, j, rank, r[1], score, r[0]))
    return sorted(map(repr, found))


def vectors(seed, count, dims, labels=3, ids=None):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    return [
        (k if ids is None else ids[k], [0.7 * c + rng.gauss(0, 0.4) for c in centre[k % labels]], rng.randrange(labels))
        for k in range(count)
    ]


def test_mining_equals_all_pairs(spark):
    for dims in (1, 7, 8, 33):
        rows = vectors(dims, 220, dims)
        expected = plain(rows, 10)
        assert mined(spark, rows, 10) == expected and expected


def test_mining_over_many_blocks_and_anchor_blocks(spark, monkeypatch):
    rows = vectors(2, 300, 12)
    monkeypatch.setattr(hn, "ANCHORS", 7)
    blocks, run = [], hn._vertical

    def small(dimensions, scale):
        blocks.append(dimensions)
        return run(dimensions, scale)

    monkeypatch.setattr(hn, "_vertical", small)
    monkeypatch.setattr(hn, "BLOCK_VALUES", 12 * 9)
    assert mined(spark, rows, 6) == plain(rows, 6) and blocks == [12]


def test_mining_with_other_numbers(spark):
    rows = vectors(4, 150, 5)
    for options in ({"positives": 1, "negatives": 3}, {"percents": (-50, 120), "scale": 3}, {"positives": 200, "negatives": 200}):
        assert mined(spark, rows, 25, **options) == plain(rows, 25, **options)


def test_mining_with_ties_and_repeated_rows(spark):
    one, two = [0.5, 0.25, -0.5], [0.5, -0.1, -0.3]
    rows = [(k, one, k % 2) for k in range(0, 60)] + [(k, two, k % 3) for k in range(60, 100)]
    rows += [(10, one, 0)] * 3 + [(200, two, 1)] * 12 + [(None, two, 1)] * 2
    assert mined(spark, rows, 10) == plain(rows, 10)


def test_rows_that_take_no_part_and_odd_vectors(spark):
    rows = vectors(6, 60, 4)
    rows += [
        (100, None, 1), (110, [1.0, None, 1.0, 1.0], 1), (120, [1.0, float("nan"), 1.0, 1.0], 0),
        (130, [1.0, float("inf"), 1.0, 1.0], 2), (140, [1.0] * 4, None), (150, [], 1), (160, [0.5, 0.5], 1),
        (None, [1.0] * 4, 1), (170, [-1.0] * 4, -5), (180, [0.0] * 4, 0),
    ]
    assert mined(spark, rows, 10) == plain(rows, 10)
    assert mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)], 1) == plain([(0, [], 1), (1, [], 1), (2, [], 2)], 1)


def test_large_components_saturate(spark):
    limit = hn.component_limit(2)
    rows = [(0, [1e300, 0.0], 1), (1, [1e300, 0.0], 1), (2, [limit / 256 * 0.5, 0.0], 0), (3, [-1e300, 0.0], 0)]
    found = mined(spark, rows, 10)
    assert found == [repr((0, 1, 1, 2, limit**2, limit * (limit // 2)))]


def test_mining_empty_tables(spark):
    empty = spark.createDataFrame([], EMPTY)
    assert hn.hard_negatives(empty, F.col("vec_id") % 10 == 0).collect() == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 1)], 10) == []


def test_scan_cuts_candidates_before_the_last_dimension():
    rng = np.random.default_rng(1)
    columns = rng.integers(-200, 200, (64, 4000)).astype(np.int32)
    vector = np.where(np.arange(64) % 8 == 0, 150, 2).astype(np.int64)
    n = np.arange(4000)
    block, seen = hn.Block(n, n, np.zeros(4000), n < 0, columns), []

    def cut(lower, upper):
        seen.append(len(upper))
        return upper >= hn._nth_largest(lower, 5)

    at, scores = hn.scan(block, vector, n, cut)
    exact = vector @ columns
    assert set(np.argsort(-exact)[:5]) <= set(at) and (scores == exact[at]).all()
    assert seen[0] == 4000 and seen[2] < 400
