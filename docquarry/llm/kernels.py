"""Vectorised text kernels that run inside Spark tasks on Arrow batches.

Words are maximal runs without ASCII white space (space, tab to carriage return).  A word is known by
a 64-bit hash of its bytes; a shingle by a hash of its words' hashes.  All functions work on whole
batches, take a NULL text as an empty one, and never look at a prefix only.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

try:
    _C = ctypes.CDLL("libc.so.6")
    _C.malloc_trim  # noqa: B018  other C libraries have no such function
except (OSError, AttributeError):
    _C = None

_BYTES = np.arange(256, dtype=np.uint8)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)
_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    values = values ^ (values >> _S30)
    values *= _M1
    values ^= values >> _S27
    values *= _M2
    values ^= values >> _S31
    return values


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """Fixed odd 64-bit multipliers."""
    return mix(np.arange(1 + salt, n + 1 + salt, dtype=np.uint64) * _M3) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, and where each text starts (one more entry than texts)."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    store = column.buffers()[2]
    data = np.frombuffer(store, np.uint8) if store is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give memory that a finished task has freed back to the machine; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _C is not None:
        _C.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded text size, so temporary arrays stay small.

    A single longer text makes a batch of its own; texts are never cut.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
    release()


@dataclass
class Words:
    """Words of a batch: hash, first byte and end of each; ``rows[i]:rows[i+1]`` are those of text i."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    data: np.ndarray


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a step for all spans together."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = ends - starts
    result = mix(left.astype(np.uint64) * _M3 + _M1)
    lane = lanes[starts] & _MASK[np.minimum(left, 8)]
    result = mix(result ^ (lane * _M3))
    open_ = np.flatnonzero(left > 8)
    at = 8
    while len(open_):
        lane = lanes[starts[open_] + at] & _MASK[np.minimum(left[open_] - at, 8)]
        result[open_] = mix(result[open_] ^ (lane * _M3))
        at += 8
        open_ = open_[left[open_] > at]
    return result


def words(column: pa.Array, lower: bool = True, gaps: np.ndarray = _SPACE) -> Words:
    """Split and hash all texts of a column; ``lower`` lower-cases A-Z first, ``gaps`` marks the bytes between words."""
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~gaps[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(hash_spans(data, starts, ends), starts, ends, np.searchsorted(starts, offsets), data)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; fewer words make one shingle of all of them, none make none."""
    n = len(hashes)
    if not n:
        return hashes
    used = min(size, n)
    factors = seeds(used, salt=0)
    total = np.full(n - used + 1, used, np.uint64) * _M2
    for i in range(used):
        total += hashes[i : n - used + 1 + i] * factors[i]
    return mix(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if len(values) < 2:
        return values
    values = np.sort(values)
    keep = np.empty(len(values), bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shingle_sets(found: Words, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text."""
    bounds = found.rows.tolist()
    for begin, end in zip(bounds[:-1], bounds[1:]):
        yield distinct(shingles(found.hashes[begin:end], size))


def common_count(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(left) > len(right):
        left, right = right, left
    if not len(left):
        return 0
    at = np.searchsorted(right, left)
    at[at == len(right)] = 0
    return int(np.count_nonzero(right[at] == left))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of several spans, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def binary_array(values: np.ndarray, width: int) -> pa.Array:
    """Binary column of fixed-width values from a contiguous array."""
    count = values.nbytes // width
    offsets = np.arange(count + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])
