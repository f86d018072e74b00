"""Patched frame-of-reference coding of token ids (numpy, used inside tasks).

Ids are cut into blocks of 256.  A block stores its minimum, and each id less the minimum in WIDTH bits,
where the width fits PERCENTILE of the block; larger values are exceptions, kept as position and value in
a list behind the packed part.  Layout of a block, little-endian:

    minimum u32 | width u8 | exceptions u16 | zero u8 | 32 * width bytes | positions u8... | values u32...

Only the last block of a shard is padded; the shard's index knows how many ids there are.
"""

from __future__ import annotations

import numpy as np

from docquarry.llm.kernels import ragged

BLOCK = 256
PERCENTILE = 90
HEAD = 8
_LANES, _LANE = 4, 64


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Blocks of values below 2**width as ``32 * width`` bytes each."""
    count = len(values)
    lanes = np.ascontiguousarray(values.reshape(count * _LANES, _LANE).T.astype(np.uint64))
    out = np.zeros((width, count * _LANES), np.uint64)
    for i in range(_LANE):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").view(np.uint8).reshape(count, 32 * width)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    count = len(packed)
    words = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8").reshape(count * _LANES, width).T)
    out = np.empty((_LANE, count * _LANES), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(_LANE):
        word, shift = divmod(i * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[word + 1] << np.uint64(64 - shift))
        out[i] = value & mask
    return np.ascontiguousarray(out.T).reshape(count, BLOCK)


def _rank(block: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Number of each exception within its block."""
    return np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of whole blocks, and where each starts; a last short block is padded with its last id."""
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    full = np.empty(blocks * BLOCK, np.uint32)
    full[: len(ids)] = ids
    full[len(ids) :] = ids[-1]
    full = full.reshape(blocks, BLOCK)
    least = full.min(axis=1)
    rest = full - least[:, None]
    kth = BLOCK * PERCENTILE // 100
    typical = np.partition(rest, kth, axis=1)[:, kth]
    width = np.frexp(typical.astype(np.float64))[1].astype(np.int64)
    patched = (rest.astype(np.uint64) >> width.astype(np.uint64)[:, None]) != 0
    block, position = np.nonzero(patched)
    values = rest[block, position]
    rest[block, position] = 0
    counts = patched.sum(axis=1)
    sizes = HEAD + 32 * width + 5 * counts
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    head = np.zeros((blocks, HEAD), np.uint8)
    head[:, :4] = least.astype("<u4").view(np.uint8).reshape(blocks, 4)
    head[:, 4] = width
    head[:, 5:7] = counts.astype("<u2").view(np.uint8).reshape(blocks, 2)
    out[starts[:, None] + np.arange(HEAD)] = head
    for bits in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == bits)
        out[(starts[rows] + HEAD)[:, None] + np.arange(32 * bits)] = _pack(rest[rows], bits)
    tail = (starts + HEAD + 32 * width)[block]
    rank = _rank(block, counts)
    out[tail + rank] = position
    cells = (tail + counts[block] + 4 * rank)[:, None] + np.arange(4)
    out[cells] = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return out, starts


def decode(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All ids of the blocks that start at the given bytes, padding included."""
    blocks = len(starts)
    if not blocks:
        return np.zeros(0, np.uint32)
    head = data[starts[:, None] + np.arange(HEAD)]
    least = np.ascontiguousarray(head[:, :4]).view("<u4").reshape(-1)
    width = head[:, 4].astype(np.int64)
    counts = np.ascontiguousarray(head[:, 5:7]).view("<u2").reshape(-1).astype(np.int64)
    out = np.zeros((blocks, BLOCK), np.uint32)
    for bits in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == bits)
        out[rows] = _unpack(data[(starts[rows] + HEAD)[:, None] + np.arange(32 * bits)], bits)
    block = np.repeat(np.arange(blocks), counts)
    tail = starts + HEAD + 32 * width
    position = data[ragged(tail, counts)]
    cells = (tail + counts)[block] + 4 * _rank(block, counts)
    out[block, position] = np.ascontiguousarray(data[cells[:, None] + np.arange(4)]).view("<u4").reshape(-1)
    return (out + least[:, None]).reshape(-1)
