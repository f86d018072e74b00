"""Ranked search against a plain version that scores every document."""

import math
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from llm_samples import ODD, SCHEMA, frame

from docquarry.llm import lexical_search as ls

ITEMS = "item_id long, text string, doc_id long, row long, term string, score string"


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 1, "x", "y") for i, t in rows], ITEMS)


def terms(text):
    found, word = [], ""
    for c in (text or "") + " ":
        if (c.isascii() and c.isalnum()) or ord(c) > 127:
            word += c.lower() if c.isascii() else c
        else:
            found += [word] if word else []
            word = ""
    return found


def plain(docs, items, most=50):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    df = Counter(term for _, c in held for term in c)
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    found = []
    for item, text in items:
        ranked = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                ranked.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(ranked)[:most], 1):
            found.append((item, rank, None if null else i, -score))
    return sorted(map(repr, found))


def searched(spark, docs, items, most=50):
    found = ls.ranked_search(frame(spark, [t for _, t in docs], [i for i, _ in docs]), items_of(spark, items), most=most)
    return sorted(repr(tuple(r)) for r in found.select("item_id", "rank", "doc_id", "score").collect())


def collection(seed, count=300, vocabulary=400):
    rng = random.Random(seed)
    names = [f"t{i}" for i in range(vocabulary)]
    common = [1 / (k + 1) for k in range(vocabulary)]
    text = lambda low, high: " ".join(rng.choices(names, common, k=rng.randint(low, high)))
    docs = list(enumerate(text(1, 80) for _ in range(count)))
    return docs, [(k, text(3, 30)) for k in range(12)]


def test_search_equals_plain_version(spark):
    docs, items = collection(1)
    expected = plain(docs, items)
    assert searched(spark, docs, items) == expected and len(expected) > 500
    assert searched(spark, docs, items, most=3) == plain(docs, items, 3)


def test_small_buckets_blocks_and_samples(spark, monkeypatch):
    docs, items = collection(2, 500)
    for name, value in {"BUCKET_ROWS": 7, "BUCKET_TERMS": 60, "BLOCK_TERMS": 25, "SAMPLE": 60}.items():
        monkeypatch.setattr(ls, name, value)
    assert searched(spark, docs, items, 5) == plain(docs, items, 5)
    monkeypatch.setattr(ls, "VOCABULARY", 0)
    assert searched(spark, docs, items, 5) == plain(docs, items, 5)


def test_search_odd_texts_ties_and_repeated_rows(spark):
    docs = list(enumerate(ODD)) + [(k, "same words here") for k in range(40, 60)] + [(41, "same words here"), (None, "same words here")]
    items = [(1, "Same WORDS"), (1, "a b c d"), (2, None), (3, ""), (4, "---"), (5, "日本語,é 😀 long"), (None, "word x-ray"), (6, "absent")]
    assert searched(spark, docs, items, 10) == plain(docs, items, 10)


def test_search_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = items_of(spark, [(1, "word")])
    assert ls.ranked_search(none, some).collect() == []
    assert ls.ranked_search(frame(spark, ["word"]), some.limit(0)).collect() == []
    assert ls.ranked_search(frame(spark, [None, " "]), some).collect() == []


def test_bounds_settle_most_documents(monkeypatch):
    monkeypatch.setattr(ls, "BUCKET_ROWS", 20)
    rng = np.random.default_rng(0)
    row = lambda term, weight: SimpleNamespace(row=0, item=0, term=term, weight=weight)
    item = ls._asked([row(3, 5000), row(9, 900), row(11, 10)]).items[0]
    at = [np.flatnonzero(rng.random(3) < [0.05, 0.5, 0.9]).astype(np.int32) for _ in range(400)]
    impacts = [rng.integers(1000, 9000, len(a)).astype(np.int32) for a in at]
    norms = np.array([math.sqrt(sum(float(x) ** 2 for x in i)) for i in impacts])
    order = np.argsort(-norms)
    cells = lambda values: pa.array([values[k].tobytes() for k in order], pa.binary())
    batch = pa.RecordBatch.from_arrays(
        [pa.array(order), pa.array(norms[order]), cells(at), cells(impacts)], names=["id", "norm", "terms", "impacts"]
    )
    best, scored = ls.Best(5, 1), 0
    for bucket in ls._buckets(iter([batch]), 3):
        found, scores = ls.search(item, bucket, best.threshold)
        best.add(scores, bucket.ids[found], bucket.nulls[found])
        scored += len(found)
    exact = sorted(((int((item.weights[a] * i).sum()), -k) for k, (a, i) in enumerate(zip(at, impacts))), reverse=True)
    assert [(s, -i) for s, i in zip(best.scores.tolist(), best.ids.tolist())] == exact[:5]
    assert scored < 100
