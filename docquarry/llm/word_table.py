"""Ids of words that a task has met, found by hash."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from docquarry.llm.kernels import Words, ragged


class WordTable:
    """Remembers the ids of up to ``limit`` words; when it is full it starts anew.

    ``encode`` turns words (bytes) into flat ids and the number of ids of each word.  The limit bounds
    memory only: a forgotten word is encoded again.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int) -> None:
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _missing(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.arange(len(keys))
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.flatnonzero(self.keys[at] != keys)

    def _learn(self, keys: np.ndarray, texts: list[bytes]) -> None:
        ids, count = self.encode(texts)
        first = len(self.ids) + np.cumsum(count) - count
        keys, first, count = (np.concatenate(x) for x in ((self.keys, keys), (self.first, first), (self.count, count)))
        order = np.argsort(keys, kind="stable")
        self.keys, self.first, self.count = keys[order], first[order], count[order]
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])

    def look_up(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and where each text's ids start."""
        keys, example, inverse = np.unique(found.hashes, return_index=True, return_inverse=True)
        missing = self._missing(keys)
        if len(missing):
            if len(self.keys) + len(missing) > self.limit:
                self._clear()
                missing = np.arange(len(keys))
            data = found.data.tobytes()
            at = example[missing]
            spans = zip(found.starts[at].tolist(), found.ends[at].tolist())
            self._learn(keys[missing], [data[a:b] for a, b in spans])
        at = np.searchsorted(self.keys, keys)[inverse] if len(keys) else np.zeros(0, np.int64)
        count = self.count[at]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
        return self.ids[ragged(self.first[at], count)], ends[found.rows]
