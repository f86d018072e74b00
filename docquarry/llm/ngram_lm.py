"""Interpolated modified Kneser-Ney model of word pairs, counted in Spark and read through memory maps.

Tokens are words (lower-cased A-Z) and an end token behind each text.

1. Each task counts the distinct token hashes of its texts; the counts are dealt by hash range and summed.
   The sorted hashes of all ranges are the vocabulary, and a token's number is its place in it.
2. Each task turns its texts into pairs of numbers, sorts and counts them, and deals them by context.  A
   shard's sorted pairs with their counts, and its contexts with what smoothing needs of them (total, and
   how many pairs occur once, twice, more often), are stored; so are, by word, the numbers of different
   contexts.
3. Shards are written once, as raw arrays, by Spark's text writer into the shared folder, and each worker
   maps those it needs.  A text's score is the sum of searches in these sorted arrays.

What is dealt is packed arrays, pre-summed in each task; no hot word or pair is more than one entry of a
task's array.  The number of shards follows the number of input partitions.
"""

from __future__ import annotations

import atexit
import math
import shutil
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docquarry.llm.kernels import mix, slices, words
from docquarry.session import scratch_path

END = np.uint64(0x5851F42D4C957F2D)  # hash of the end token
START = 0xFFFFFFFF  # number of the context before a text's first token
UNKNOWN = 0xFFFFFFFE  # number of a context that was never seen
SLICE = 16 << 20
MAGIC = b"DQNGRAM1"
_HEAD = struct.Struct("<8sQQ8Q")


def _shard_bits(docs: DataFrame) -> int:
    """Shards as a power of two: about eight for each partition of the input, 16 at least."""
    return max(4, min(16, math.ceil(math.log2(8 * max(1, docs.rdd.getNumPartitions())))))


def _shard_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _context_shard(contexts: np.ndarray, bits: int) -> np.ndarray:
    return _shard_of(mix(contexts.astype(np.uint64) + np.uint64(1)), bits)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts with their end tokens, and where each text starts."""
    found = words(column)
    rows = found.rows + np.arange(len(found.rows))
    out = np.full(rows[-1], END)
    inner = np.ones(len(out), bool)
    inner[rows[1:] - 1] = False
    out[inner] = found.hashes
    return out, rows


def _runs(shards: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Stretches of one shard in sorted shards."""
    if len(shards):
        cuts = np.flatnonzero(np.diff(shards)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards)]):
            yield int(shards[begin]), begin, end


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest unsigned type."""
    top = int(values.max()) if len(values) else 0
    return values.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if top <= np.iinfo(t).max))


def _packed(shard: list[int], **columns: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each shard: arrays as bytes, each with its item size in front."""
    arrays = [pa.array(shard, pa.int32())]
    for values in columns.values():
        arrays.append(pa.array([bytes([v.dtype.itemsize]) + v.tobytes() for v in values], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["shard", *columns])


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    parts = [np.frombuffer(v, f"<u{v[0]}", offset=1) for v in column.to_pylist()]
    return np.concatenate([p.astype(np.uint64) for p in parts]) if parts else np.zeros(0, np.uint64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _store(shard: int, numbers: list[int], arrays: list[np.ndarray]) -> bytes:
    """A shard's file: head, numbers, then eight-byte arrays (narrow ones last)."""
    body = b"".join(a.tobytes() for a in arrays)
    sizes = [x for a in arrays for x in (len(a), a.dtype.itemsize)]
    sizes = sizes + [0] * (8 - len(sizes))
    value = _HEAD.pack(MAGIC, shard, len(numbers), *sizes) + struct.pack(f"<{len(numbers)}Q", *numbers) + body
    # With the writer's line feed the next shard starts at a multiple of eight, so arrays are aligned.
    return value + bytes(-(len(value) + 1) % 8)


def _count_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            keys, counts = np.unique(_tokens(batch.column("text"))[0], return_counts=True)
            parts = list(_runs(_shard_of(keys, bits)))
            yield _packed(
                [s for s, _, _ in parts], keys=[keys[a:b] for _, a, b in parts], counts=[_narrow(counts[a:b]) for _, a, b in parts]
            )

    return run


def _word_shard(rows: pa.Table) -> pa.Table:
    shard = rows["shard"][0].as_py()
    keys, counts = _summed(_unpacked(rows["keys"]), _unpacked(rows["counts"]))
    return pa.table({"value": pa.array([_store(shard, [int(counts.sum())], [keys, counts])], pa.binary())})


def _write(rows: DataFrame, path: str) -> None:
    """One shard, one row of raw bytes, in files that Spark commits."""
    rows.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


_LOCAL: dict[str, np.ndarray] = {}


def _mapped(path: str) -> np.ndarray:
    """A stored file as mapped bytes; from a store without local paths a temporary copy is mapped."""
    if path not in _LOCAL:
        if path.startswith("file:"):
            local = "/" + path[5:].lstrip("/")
        else:
            from pyarrow import fs

            store, inner = fs.FileSystem.from_uri(path)
            folder = tempfile.mkdtemp(prefix="ngram-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            local = f"{folder}/shard"
            with store.open_input_stream(inner) as source, open(local, "wb") as target:
                shutil.copyfileobj(source, target, 4 << 20)
        _LOCAL[path] = np.memmap(local, np.uint8, "r")
    return _LOCAL[path]


def _shards_in(path: str) -> Iterator[tuple[int, int, list[int], list[np.ndarray]]]:
    """Every shard of a file: number, offset, numbers, arrays (views of the map)."""
    data, at = _mapped(path), 0
    while at + _HEAD.size <= len(data):
        start = at
        magic, shard, count, *sizes = _HEAD.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError(f"{path} is not a shard file")
        at += _HEAD.size
        numbers = list(struct.unpack_from(f"<{count}Q", data, at))
        at += 8 * count
        arrays = []
        for length, width in zip(sizes[::2], sizes[1::2]):
            if width:
                arrays.append(np.ndarray((length,), f"<u{width}", data, at))
                at += length * width
        at = (at + 8) // 8 * 8  # padding and the writer's line feed
        yield shard, start, numbers, arrays


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the driver needs of each shard: file, number, offset, entries, numbers."""
    for batch in batches:
        rows = []
        for path in batch.column("path").to_pylist():
            for shard, start, numbers, arrays in _shards_in(path):
                rows.append({"path": path, "shard": shard, "start": start, "size": len(arrays[0]), "numbers": numbers})
            _LOCAL.pop(path)
        yield pa.RecordBatch.from_pylist(
            rows,
            pa.schema(
                [("path", pa.string()), ("shard", pa.int32()), ("start", pa.int64()), ("size", pa.int64()),
                 ("numbers", pa.list_(pa.int64()))]
            ),
        )


def _listed(spark, path: str) -> list:
    """One row for each shard, in order; a few numbers each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select("path")
    heads = files.mapInArrow(_heads, "path string, shard int, start long, size long, numbers array<long>")
    return sorted(heads.collect(), key=lambda r: r["shard"])


@dataclass
class Folder:
    """Where the shards of one kind are; arrays are mapped on first use in a worker."""

    path: dict[int, str]
    start: dict[int, int]
    _open: dict[int, list[np.ndarray]] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"path": self.path, "start": self.start, "_open": {}}

    def arrays(self, shard: int) -> list[np.ndarray] | None:
        if shard not in self._open:
            if shard not in self.path:
                return None
            for number, _, _, arrays in _shards_in(self.path[shard]):
                self._open[number] = arrays
        return self._open[shard]


def _folder(rows: list) -> Folder:
    return Folder({r["shard"]: r["path"] for r in rows}, {r["shard"]: r["start"] for r in rows})


@dataclass
class Vocabulary:
    bits: int
    folder: Folder
    first: dict[int, int]  # number of a shard's first token
    tokens: int  # all tokens of the training texts
    size: int

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and counts of sorted token hashes; -1 and 0 for those never seen."""
        number, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for shard, begin, end in _runs(_shard_of(keys, self.bits)):
            arrays = self.folder.arrays(shard)
            if arrays is not None and len(arrays[0]):
                at = np.searchsorted(arrays[0], keys[begin:end])
                at[at == len(arrays[0])] = 0
                hit = arrays[0][at] == keys[begin:end]
                number[begin:end][hit] = at[hit] + self.first[shard]
                count[begin:end][hit] = arrays[1][at[hit]]
        return number, count


def _pairs_of(tokens: np.ndarray, rows: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Context and word of each token as one number; the context is the token before, or the start."""
    before = np.empty(len(number), np.int64)
    before[1:] = np.where(number[:-1] < 0, UNKNOWN, number[:-1])
    before[rows[:-1]] = START
    return before.astype(np.uint64) << np.uint64(32) | (number.astype(np.uint64) & np.uint64(0xFFFFFFFF))


def _count_pairs(shared, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in slices(batches, "text", SLICE):
            tokens, rows = _tokens(batch.column("text"))
            keys, inverse = np.unique(tokens, return_inverse=True)
            number = vocabulary.find(keys)[0][inverse]
            pairs, counts = np.unique(_pairs_of(tokens, rows, number), return_counts=True)
            shard = _context_shard(pairs >> np.uint64(32), bits)
            order = np.argsort(shard, kind="stable")
            pairs, counts = pairs[order], counts[order]
            parts = list(_runs(shard[order]))
            yield _packed(
                [s for s, _, _ in parts],
                context=[_narrow(pairs[a:b] >> np.uint64(32)) for _, a, b in parts],
                word=[_narrow(pairs[a:b] & np.uint64(0xFFFFFFFF)) for _, a, b in parts],
                counts=[_narrow(counts[a:b]) for _, a, b in parts],
            )

    return run


def _classes(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4)]


def _pair_shard(rows: pa.Table) -> pa.Table:
    """Sorted pairs and counts; contexts with their total and numbers of pairs seen once, twice, more."""
    shard = rows["shard"][0].as_py()
    keys = _unpacked(rows["context"]) << np.uint64(32) | _unpacked(rows["word"])
    keys, counts = _summed(keys, _unpacked(rows["counts"]))
    context = keys >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    total = np.add.reduceat(counts, first)
    kinds = [np.add.reduceat(flags.astype(np.uint64), first) for flags in (counts == 1, counts == 2, counts > 2)]
    table = np.stack([context[first], total, *kinds], axis=1).reshape(-1)
    value = _store(shard, _classes(counts), [keys, table, _narrow(counts)])
    return pa.table({"value": pa.array([value], pa.binary())})


def _contexts_of_words(low_bits: int):
    """For each word of a pair shard, in how many of its contexts it occurs, dealt by word number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for _, _, _, (keys, _, _) in _shards_in(path):
                    word, counts = np.unique(keys & np.uint64(0xFFFFFFFF), return_counts=True)
                    parts = list(_runs((word >> np.uint64(low_bits)).astype(np.int64)))
                    yield _packed(
                        [s for s, _, _ in parts],
                        word=[_narrow(word[a:b] - (np.uint64(s) << np.uint64(low_bits))) for s, a, b in parts],
                        counts=[_narrow(counts[a:b]) for _, a, b in parts],
                    )

    return run


def _spread_shard(low_bits: int):
    def run(rows: pa.Table) -> pa.Table:
        shard = rows["shard"][0].as_py()
        word, counts = _summed(_unpacked(rows["word"]), _unpacked(rows["counts"]))
        dense = np.zeros(1 << low_bits, np.uint64)
        dense[word] = counts
        numbers = [*_classes(counts), int(counts.sum()), int(np.count_nonzero(counts > 2))]
        return pa.table({"value": pa.array([_store(shard, numbers, [_narrow(dense)])], pa.binary())})

    return run


def _discounts(classes: list[int]) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and more, from how many counts are 1 to 4."""
    n1, n2, n3, n4 = classes
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    guess = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.0), k) for k, d in enumerate(guess, 1))])


@dataclass
class NgramModel:
    vocabulary: Vocabulary
    pairs: Folder
    spread: Folder
    low_bits: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    all_pairs: int  # different pairs
    word_mass: float  # share of the lowest order that goes to the uniform one

    def word_chance(self, number: np.ndarray) -> np.ndarray:
        """Lowest order: by the number of different contexts, interpolated with the uniform order."""
        uniform = 1.0 / (self.vocabulary.size + 1)
        chance = np.full(len(number), self.word_mass * uniform)
        known = np.flatnonzero(number >= 0)
        known = known[np.argsort(number[known], kind="stable")]
        for shard, begin, end in _runs(number[known] >> self.low_bits):
            arrays = self.spread.arrays(shard)
            if arrays is not None:
                at = known[begin:end]
                seen = arrays[0][number[at] & ((1 << self.low_bits) - 1)].astype(np.int64)
                chance[at] += np.maximum(seen - self.word_discounts[np.minimum(seen, 3)], 0) / max(1, self.all_pairs)
        return chance

    def pair_chance(self, pairs: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Chance of each pair's word in its context, given the word's lowest-order chance."""
        chance = lower.copy()
        context = pairs >> np.uint64(32)
        shard = _context_shard(context, self.vocabulary.bits)
        order = np.lexsort((pairs, shard))
        for number, begin, end in _runs(shard[order]):
            arrays = self.pairs.arrays(number)
            if arrays is None:
                continue
            at = order[begin:end]
            keys, table, counts = arrays
            table = table.reshape(-1, 5)
            contexts = np.ascontiguousarray(table[:, 0])
            place = np.searchsorted(contexts, context[at])
            place[place == len(contexts)] = 0
            hit = contexts[place] == context[at]
            at, place = at[hit], place[hit]
            total, once, twice, more = (table[place, k].astype(float) for k in (1, 2, 3, 4))
            spot = np.searchsorted(keys, pairs[at])
            spot[spot == len(keys)] = 0
            seen = np.where(keys[spot] == pairs[at], counts[spot], 0).astype(np.int64)
            d = self.pair_discounts
            kept = np.maximum(seen - d[np.minimum(seen, 3)], 0)
            chance[at] = (kept + (d[1] * once + d[2] * twice + d[3] * more) * lower[at]) / total
        return chance


def train_ngrams(docs: DataFrame, text: str = "text") -> NgramModel:
    """Count the texts and store the model in the shared folder."""
    spark = docs.sparkSession
    source = docs.select(F.col(text).alias("text"))
    bits = _shard_bits(source)
    packed = source.mapInArrow(_count_words(bits), "shard int, keys binary, counts binary")
    path = scratch_path(spark, "words")
    _write(packed.groupBy("shard").applyInArrow(_word_shard, "value binary"), path)
    heads = _listed(spark, path)
    first = np.concatenate([[0], np.cumsum([r["size"] for r in heads], dtype=np.int64)])
    size = int(first[-1])
    if size >= UNKNOWN:
        raise ValueError("token numbers have 32 bits; the corpus has more different tokens")
    vocabulary = Vocabulary(
        bits, _folder(heads), {r["shard"]: int(n) for r, n in zip(heads, first)}, sum(r["numbers"][0] for r in heads), size
    )
    shared = spark.sparkContext.broadcast(vocabulary)
    packed = source.mapInArrow(_count_pairs(shared, bits), "shard int, context binary, word binary, counts binary")
    path = scratch_path(spark, "pairs")
    _write(packed.groupBy("shard").applyInArrow(_pair_shard, "value binary"), path)
    pair_heads = _listed(spark, path)

    low_bits = max(8, math.ceil(math.log2(size + 1)) - bits)
    files = spark.createDataFrame(pd.DataFrame({"path": sorted({r["path"] for r in pair_heads})}, dtype=str), "path string")
    files = files.repartition(max(1, min(len(pair_heads), 8 * spark.sparkContext.defaultParallelism)))
    packed = files.mapInArrow(_contexts_of_words(low_bits), "shard int, word binary, counts binary")
    path = scratch_path(spark, "spread")
    _write(packed.groupBy("shard").applyInArrow(_spread_shard(low_bits), "value binary"), path)
    spread_heads = _listed(spark, path)

    pair_classes = [sum(r["numbers"][k] for r in pair_heads) for k in range(4)]
    word_classes = [sum(r["numbers"][k] for r in spread_heads) for k in range(4)]
    all_pairs = sum(r["numbers"][4] for r in spread_heads)
    often = sum(r["numbers"][5] for r in spread_heads)
    d = _discounts(word_classes)
    mass = (d[1] * word_classes[0] + d[2] * word_classes[1] + d[3] * often) / all_pairs if all_pairs else 1.0
    return NgramModel(
        vocabulary, _folder(pair_heads), _folder(spread_heads), low_bits, _discounts(pair_classes), d, all_pairs, mass
    )


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        vocabulary = model.vocabulary
        for batch in slices(batches, "text"):
            tokens, rows = _tokens(batch.column("text"))
            keys, inverse = np.unique(tokens, return_inverse=True)
            number, count = vocabulary.find(keys)
            lower = model.word_chance(number)
            base = np.log10((count + 1) / (vocabulary.tokens + vocabulary.size + 1))
            # A word never seen has number -1, and a pair with it is never found.
            pairs, example, back = np.unique(
                _pairs_of(tokens, rows, number[inverse]), return_index=True, return_inverse=True
            )
            chance = np.log10(model.pair_chance(pairs, lower[inverse[example]]))
            known = np.concatenate([[0], np.cumsum(count[inverse] > 0)])
            n = len(rows) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.diff(rows)),
                    pa.array(known[rows[1:]] - known[rows[:-1]]),
                    pa.array(np.add.reduceat(base[inverse], rows[:-1]) if n else np.zeros(0)),
                    pa.array(np.add.reduceat(chance[back], rows[:-1]) if n else np.zeros(0)),
                ],
                names=["id", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def ngram_scores(docs: DataFrame, model: NgramModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score, perplexity`` for each row.

    ``base_score`` is the log10 chance under add-one counts of single tokens, ``score`` that of the model.
    NULL texts are empty: they are the end token alone.  Repeated rows give repeated results; other columns
    are not read.  A model of no texts gives every token the chance 1 / 1.
    """
    kind = docs.schema[id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    scored = source.mapInArrow(_score(shared), f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.col("id").alias(id),
        "n_tokens",
        "n_known",
        F.lit(model.vocabulary.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
