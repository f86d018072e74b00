"""Connected components of a link table.

First every task contracts the links it holds to stars, in memory (PART_LINKS links are 8 MB).  When the
links need more than one task, alternating star operations follow: each round rewrites the links with two
grouped minima, so a hot node only takes part in partial aggregates and in joins that Spark can split; no
list of neighbours is ever built.  The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docquarry.llm.rows import stored

PART_LINKS = 500_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of some links, and the smallest node each is connected with."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy()])
        b = np.concatenate([b, batch.column(1).to_numpy()])
        if len(a) > 2 * PART_LINKS:
            a, b = stars(a, b)
    a, b = stars(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; the component is its smallest node.

    Links in either direction, repeated links and loops are fine; a node that only has a loop may be left
    out; an empty table gives an empty result.
    """
    links = stored(links.select("a", "b").where("a <> b"), "links")
    parts = 1 + links.count() // PART_LINKS
    links = stored(links.repartition(parts).mapInArrow(_contract, "a long, b long"), "links")
    before = None
    while parts > 1 and (mark := _mark(links)) != before:
        before = mark
        # Large star: every larger neighbour is linked to the node's smallest neighbour (or itself).
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        links = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        links = stored(links.coalesce(parts), "links")
        # Small star: smaller neighbours and the node itself are linked to the smallest neighbour.
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        links = stored(links.coalesce(parts), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct().coalesce(parts)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
