"""Near duplicates with an LSH forest.

1. Every text becomes its set of word shingles, a digest of that set and a MinHash signature.  Texts with
   one set are one class; only its smallest id goes on.
2. The signature is cut into trees.  Each tree is one sorted order of all classes (a range sort, so no
   bucket has to fit a task).  In each order a class is paired with its nearest neighbours, which are those
   with the longest common prefix, as long as the prefix has MIN_DEPTH values.  Where few classes share
   that prefix all of them are compared; where many do, neighbours agree on more values: the depth of the
   search follows the crowding of the region.
3. A pair is confirmed on the full sets.  First each class is checked against its best partner, then only
   pairs that still lie in different components.
4. Regions that were too crowded to compare all their classes and that hold more than one component are
   finished exactly.  Regions of up to REGION_ROWS classes are put together where they share components,
   and the full sets of each such cluster are compared between components inside a task, which emits only
   links that join two components.
5. Larger regions are searched by a prefix filter: with shingles in order of their frequency, two sets of the
   wanted similarity share one of the rarest fifth of each.  Holders of a shingle that at most KEY_ROWS sets have
   in that part are candidates; sets with a more frequent one there are compared inside their region, block
   against block, with blocks bounded in rows and in shingles.  Frequencies are counted in BINS bins; any order
   gives the same links, a good one only less work.  No region stays open.

The chance to miss a pair of similarity 0.8 is that of never sharing a region: (1 - 0.8^4)^20 = 0.00003.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from docquarry.llm.components import components
from docquarry.llm.kernels import (
    binary_array,
    common_count,
    mix,
    ragged,
    seeds,
    shingle_sets,
    slices,
    words,
)
from docquarry.llm.rows import by_id, stored
from docquarry.session import scratch_path

TREES = 20
DEPTH = 8
MIN_DEPTH = 4
NEIGHBOURS = 6
#: Sorted rows for each partition of a range sort, at least.
PART_ROWS = 4000
#: Classes, and shingles of all their sets, that one task compares; a single larger set is not cut.
REGION_ROWS = 2048
UNIT_SHINGLES = 4_000_000
#: Bins of shingle frequencies (2 MB), and holders of a shingle that are paired at most.
BINS = 1 << 18
KEY_ROWS = 16


def _signature(values: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a set, as 5 bits of size and the 11 bits that follow the leading one.

    The code keeps the order of the minima and is as fine for very large sets as for small ones.
    """
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    short = (values >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 512):
        hashed = np.multiply.outer(short[start : start + 512], factors)
        np.minimum(least, hashed.min(axis=0), out=least)
    part, size = np.frexp(np.maximum(least, 1).astype(np.float64))
    return ((size - 1) * 2048 + ((part - 0.5) * 4096).astype(np.int64)).astype(">u2")


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = (seeds(TREES * DEPTH, salt=1000) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        for batch in slices(batches, "text"):
            counts, digests, signatures = [], [], []
            for values in shingle_sets(words(batch.column("text")), size):
                counts.append(len(values))
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                signatures.append(_signature(values, factors).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["id", "n", "key", "signature"],
            )

    return run


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class and tree: group (the tree), its slice of the signature, id, set size."""
    for batch in batches:
        n, width = batch.num_rows, DEPTH * 2
        if not n:
            continue
        cells = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(n, TREES, width)
        rows = np.repeat(np.arange(n), TREES)
        trees = np.tile(np.arange(TREES, dtype=np.int32), n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(mix(trees.astype(np.uint64)).view(np.int64)),
                binary_array(cells.reshape(-1), width),
                batch.column("id").take(pa.array(rows)),
                batch.column("n").take(pa.array(rows)),
                batch.column("component").take(pa.array(rows)),
            ],
            names=["group", "order", "id", "n", "component"],
        )


_TREE_ROWS = "group long, order binary, id long, n long, component long"
_FOUND = "kind int, a long, b long, region long, part int, group long, order binary, id long, n long, component long"


def _prefix(order: pa.Array) -> np.ndarray:
    """First MIN_DEPTH values of each order as one number."""
    cells = np.frombuffer(b"".join(order.to_pylist()), np.uint8).reshape(len(order), DEPTH * 2)
    return np.ascontiguousarray(cells[:, : MIN_DEPTH * 2]).view("<u8").reshape(-1)


def _close(table: pa.Table, percent: int, fresh: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of neighbours in sorted rows, and the regions that reach further than the neighbours.

    Only rows from ``fresh`` on look back.  Pairs within one component, and pairs whose set sizes exclude
    the wanted similarity, are left out.
    """
    group = table["group"].to_numpy()
    prefix = _prefix(table["order"].combine_chunks())
    ids, sizes, comps = (table[c].to_numpy() for c in ("id", "n", "component"))
    left, right = [], []
    for step in range(1, NEIGHBOURS + 1):
        i = np.arange(max(step, fresh), len(ids))
        j = i - step
        small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        near = (group[i] == group[j]) & (prefix[i] == prefix[j]) & (comps[i] != comps[j])
        near &= (100 * small >= percent * large) & (ids[i] != ids[j])
        left.append(np.minimum(ids[i], ids[j])[near])
        right.append(np.maximum(ids[i], ids[j])[near])
    i = np.arange(max(NEIGHBOURS + 1, fresh), len(ids))
    j = i - NEIGHBOURS - 1
    crowded = i[(group[i] == group[j]) & (prefix[i] == prefix[j])]
    regions = np.unique(mix(group[crowded].view(np.uint64) ^ mix(prefix[crowded]))).view(np.int64)
    return np.concatenate(left), np.concatenate(right), regions


def _found(kind: int, count: int, **columns: pa.Array) -> pa.RecordBatch:
    fields = {
        "kind": pa.int32(), "a": pa.int64(), "b": pa.int64(), "region": pa.int64(), "part": pa.int32(),
        "group": pa.int64(), "order": pa.binary(), "id": pa.int64(), "n": pa.int64(), "component": pa.int64(),
    }
    columns["kind"] = pa.array(np.full(count, kind, np.int32))
    arrays = [columns[c] if c in columns else pa.nulls(count, t) for c, t in fields.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(fields))


def _pairs(left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    return _found(0, len(left), a=pa.array(left), b=pa.array(right))


def _rows(table: pa.Table) -> dict[str, pa.Array]:
    return {c: table[c].combine_chunks() for c in ("group", "order", "id", "n", "component")}


def _neighbours(percent: int):
    """Pairs (kind 0), crowded regions (1), and the first and last rows of the partition (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, head = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            table = fresh if held is None else pa.concat_tables([held, fresh])
            left, right, regions = _close(table, percent, 0 if held is None else held.num_rows)
            yield _pairs(left, right)
            yield _found(1, len(regions), region=pa.array(regions))
            if head is None or head.num_rows <= NEIGHBOURS:
                head = fresh if head is None else pa.concat_tables([head, fresh])
            held = table.slice(max(0, table.num_rows - NEIGHBOURS - 1))
        for edge, at in ((head, part), (held, part + 1)):
            if edge is not None:
                edge = edge.slice(0, NEIGHBOURS + 1)
                yield _found(2, edge.num_rows, part=pa.array(np.full(edge.num_rows, at, np.int32)), **_rows(edge))

    return run


def _across(percent: int):
    """Neighbours on both sides of a partition's edge."""

    def run(edge: pa.Table) -> pa.Table:
        order = pc.sort_indices(edge, [("group", "ascending"), ("order", "ascending"), ("id", "ascending")])
        left, right, regions = _close(edge.take(order), percent, 0)
        return pa.Table.from_batches([_pairs(left, right), _found(1, len(regions), region=pa.array(regions))])

    return run


def forest_pairs(rows: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``a, b, weight`` and the crowded regions of sorted orders."""
    spark = rows.sparkSession
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_ROWS))
    rows = rows.repartitionByRange(parts, "group", "order", "id")
    ordered = rows.sortWithinPartitions("group", "order", "id")
    path = scratch_path(spark, "forest")
    ordered.mapInArrow(_neighbours(percent), _FOUND).write.partitionBy("kind").parquet(path)
    found = spark.read.schema(_FOUND).parquet(path)
    edges = found.where("kind = 2").select("part", "group", "order", "id", "n", "component")
    across = edges.groupBy("part").applyInArrow(_across(percent), _FOUND)
    both = found.where("kind < 2").unionByName(across.select(*found.columns))
    pairs = both.where("kind = 0").groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return pairs, both.where("kind = 1").select("region").distinct()


def _verify(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", 2 << 20):
            keep = []
            left = shingle_sets(words(batch.column("text_a")), size)
            right = shingle_sets(words(batch.column("text_b")), size)
            for x, y in zip(left, right):
                both = common_count(x, y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough; each text is read from the stored candidates."""
    joined = (
        pairs.select("a", "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    )
    return joined.mapInArrow(_verify(size, percent), "a long, b long")


def _stars(labels: DataFrame) -> DataFrame:
    """Links that say the same as the labels."""
    return labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def _open(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    for end in ("a", "b"):
        label = labels.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(label, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return pairs.where("of_a <> of_b").drop("of_a", "of_b")


def near_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id, kept``.

    Words are lower-cased (A-Z).  Texts with fewer words than a shingle are one shingle; texts without
    words, or NULL, have an empty set and are linked with nothing.  Two texts are linked when their sets'
    similarity is at least ``percent`` / 100; ``component_id`` is the smallest id that can be reached, and
    ``kept`` marks the row of that id.  A NULL id is never linked: its component is NULL and it is kept.
    Rows that repeat an id are one document: their components are joined.  Other columns are not read; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sketches = stored(source.mapInArrow(_sketch(shingle), "id long, n long, key binary, signature binary"), "sketches")
    full = sketches.where("n > 0 and id is not null")
    classes = full.groupBy("key").agg(F.min("id").alias("first"))
    members = stored(full.select("id", "n", "key").join(classes, "key").select("id", "n", "first"), "members")

    nodes = full.join(classes.withColumnRenamed("first", "id"), ["key", "id"], "left_semi")
    nodes = stored(nodes.select("id", "n", "signature").dropDuplicates(["id", "n", "signature"]), "nodes")
    alone = nodes.withColumn("component", F.col("id"))
    rows = alone.mapInArrow(_trees, _TREE_ROWS)
    pairs, crowded = forest_pairs(rows, nodes.count() * TREES, percent)
    pairs, crowded = stored(pairs, "pairs"), stored(crowded, "crowded")

    # Copies of a class are linked to its first id; so are rows that repeat an id.
    links = members.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b")).distinct()
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = stored(by_id(source, wanted, "id", "left_semi"), "texts")
    best = Window.partitionBy("b").orderBy(F.desc("weight"), "a")
    ranked = stored(pairs.withColumn("rank", F.row_number().over(best)), "ranked")
    links = links.union(_confirmed(ranked.where("rank = 1"), texts, shingle, percent))
    labels = stored(components(links), "labels")
    rest = stored(_open(ranked.where("rank > 1"), labels), "open")
    if not rest.isEmpty():
        links = _stars(labels).union(_confirmed(rest, texts, shingle, percent))
        labels = stored(components(links), "labels")
    inside = rows.mapInArrow(_regions, "id long, n long, region long").join(crowded, "region", "left_semi")
    labels = _finished(inside, labels, source, shingle, percent)

    named = members.select("id", "n").distinct().join(labels, F.col("id") == F.col("node"), "left")
    named = named.select("id", F.coalesce("component", "id").alias("component_id")).distinct()
    result = sketches.select("id", "n").join(named, "id", "left")
    component = F.coalesce("component_id", "id")
    return result.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            group = batch.column("group").to_numpy().view(np.uint64)
            region = mix(group ^ mix(_prefix(batch.column("order")))).view(np.int64)
            yield batch.select(["id", "n"]).append_column("region", pa.array(region))


def _several(inside: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``id, n, region`` of regions that hold several components, with their region's size and least component."""
    inside = inside.join(labels, inside["id"] == labels["node"], "left").select(
        "id", "n", "region", F.coalesce("component", "id").alias("component")
    )
    inside = stored(inside, "crowded_rows")
    regions = inside.groupBy("region").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")
    )
    return stored(inside.join(regions.where("low <> high").drop("high"), "region"), "open_regions")


def _finished(inside: DataFrame, labels: DataFrame, source: DataFrame, size: int, percent: int) -> DataFrame:
    """Labels with all links inside crowded regions."""
    opened = _several(inside, labels)
    if opened.isEmpty():
        return labels
    small = opened.where(f"size <= {REGION_ROWS}")
    labels = stored(components(_stars(labels).union(_linked(small, source, size, percent))), "labels")
    opened = _several(opened.where(f"size > {REGION_ROWS}").select("id", "n", "region"), labels)
    if opened.isEmpty():
        return labels
    texts = stored(by_id(source, opened, "id", "left_semi"), "region_texts")
    pairs, frequent = _rare_pairs(opened, texts, size, percent)
    labels = stored(components(_stars(labels).union(_confirmed(pairs, texts, size, percent))), "labels")
    opened = _several(opened.join(frequent, "id", "left_semi").select("id", "n", "region"), labels)
    if opened.isEmpty():
        return labels
    units = opened.withColumnRenamed("region", "unit")
    return stored(components(_stars(labels).union(_compared(units, texts, size, percent))), "labels")


def _bins(size: int):
    """How many texts of the task have a shingle in each bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in slices(batches, "text"):
            for values in shingle_sets(words(batch.column("text")), size):
                np.add.at(total, (values % np.uint64(BINS)).astype(np.int64), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bin", "count"])

    return run


def _rarest(size: int, percent: int, shared):
    """The rarest shingles of each text: any set that is similar enough shares one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in slices(batches, "text"):
            keys, lengths, sizes = [np.zeros(0, np.uint64)], [], []
            for values in shingle_sets(words(batch.column("text")), size):
                order = np.lexsort((values, counts[(values % np.uint64(BINS)).astype(np.int64)]))
                part = len(values) - -(-percent * len(values) // 100) + 1 if len(values) else 0
                keys.append(values[order[:part]])
                lengths.append(part)
                sizes.append(len(values))
            rows = np.repeat(np.arange(batch.num_rows), lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    batch.column("id").take(pa.array(rows)),
                    batch.column("component").take(pa.array(rows)),
                    pa.array(np.array(sizes, np.int64)[rows]),
                ],
                names=["key", "id", "component", "n"],
            )

    return run


def _rare_pairs(opened: DataFrame, texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of components' texts that share a rare shingle, and the ids of texts that share a frequent one."""
    counted = texts.mapInArrow(_bins(size), "bin long, count long").groupBy("bin").agg(F.sum("count").alias("count"))
    counts = np.zeros(BINS, np.int64)
    for row in counted.toLocalIterator():  # at most BINS rows
        counts[row["bin"]] = row["count"]
    shared = texts.sparkSession.sparkContext.broadcast(counts)
    labelled = texts.join(opened.select("id", "component").distinct(), "id")
    keyed = labelled.mapInArrow(_rarest(size, percent, shared), "key long, id long, component long, n long")
    keyed = stored(keyed, "rarest")
    keys = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("holders"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    keys = stored(keys.where("low <> high").select("key", "holders"), "shared_keys")
    rare = stored(keyed.join(keys.where(f"holders <= {KEY_ROWS}"), "key", "left_semi"), "rare")
    a, b = (rare.select("key", *(F.col(c).alias(f"{c}_{end}") for c in ("id", "component", "n"))) for end in "ab")
    pairs = a.join(b, "key").where("id_a < id_b and component_a <> component_b")
    pairs = pairs.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    pairs = stored(pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct(), "rare_pairs")
    frequent = keyed.join(keys.where(f"holders > {KEY_ROWS}"), "key", "left_semi").select("id").distinct()
    return pairs, stored(frequent, "frequent")


def _link(size: int, percent: int):
    """Links between the components of a cluster, on full sets; one for each two components that meet."""

    def run(cluster: pa.Table) -> pa.Table:
        ids, comps = cluster["id"].to_numpy(), cluster["component"].to_numpy()
        if (comps == comps[0]).all():
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        sets = list(shingle_sets(words(cluster["text"].combine_chunks()), size))
        counts = np.array([len(s) for s in sets])
        values, place = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), counts)
        order = np.argsort(place, kind="stable")
        holders, first = owner[order], np.searchsorted(place[order], np.arange(len(values) + 1))
        begins = np.concatenate([[0], np.cumsum(counts)])
        label = np.unique(comps, return_inverse=True)[1]
        found = []
        # Every pair of components is seen from the smaller one.
        for i in np.argsort(np.bincount(label)[label], kind="stable").tolist():
            mine = place[begins[i] : begins[i + 1]]
            both = np.bincount(holders[ragged(first[mine], first[mine + 1] - first[mine])], minlength=len(sets))
            near = (100 * both >= percent * (counts + counts[i] - both)) & (label != label[i])
            for j in np.flatnonzero(near).tolist():
                if label[j] != label[i]:
                    found.append((ids[i], ids[j]))
                    label[label == label[j]] = label[i]
            if (label == label[0]).all():
                break
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _linked(small: DataFrame, source: DataFrame, size: int, percent: int) -> DataFrame:
    """Links inside small open regions; a text is read once for each cluster of regions that fits a task."""
    touching = stored(components(small.select(F.col("component").alias("a"), F.col("low").alias("b"))), "clusters")
    member = small.join(touching, small["component"] == touching["node"], "left").select(
        "id", "n", small["component"], "region", F.coalesce(touching["component"], small["component"]).alias("cluster")
    )
    member = stored(member, "cluster_rows")
    sizes = member.select("cluster", "id", "n").distinct().groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles")
    )
    fits = (F.col("size") <= REGION_ROWS) & (F.col("shingles") <= UNIT_SHINGLES)
    unit = F.when(fits, F.xxhash64("cluster")).otherwise(F.col("region"))
    units = member.join(sizes, "cluster").select(unit.alias("unit"), "id", "n", "component")
    return _compared(units, by_id(source, member, "id", "left_semi"), size, percent)


def _compared(units: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between the components of each unit; what is too much for a task is cut into blocks, and each two meet."""
    units = units.select("unit", "id", "n", "component").distinct()
    sizes = units.groupBy("unit").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    whole = (F.col("size") <= REGION_ROWS) & (F.col("shingles") <= UNIT_SHINGLES)
    need = F.greatest(F.lit(2), F.ceil(F.col("size") * 2 / REGION_ROWS), F.ceil(F.col("shingles") * 2 / UNIT_SHINGLES))
    sizes = sizes.select("unit", F.when(whole, 1).otherwise(need).alias("blocks"))
    dealt = units.join(sizes, "unit").withColumn("slot", F.pmod(F.xxhash64("id", "unit"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.where("blocks = 1 or other <> slot").select(
        "unit", F.least("slot", "other").alias("low"), F.greatest("slot", "other").alias("high"), "id", "component"
    )
    dealt = dealt.distinct()
    return dealt.join(texts, "id").groupBy("unit", "low", "high").applyInArrow(_link(size, percent), "a long, b long")


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8); all columns stay."""
    return by_id(docs, near_groups(docs, id, text).where("not kept").select(id), id, "left_anti")
