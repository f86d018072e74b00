"""Rules on the form of a text, with repetition found by a suffix array over its words.

All texts of a batch share one suffix array: words are ranked within their text, prefix doubling refines
only the suffixes that are still tied, and the ranks of all levels give the longest common prefix (LCP) of
neighbouring suffixes by binary lifting.  The deepest LCP interval that holds a suffix is the longest repeat
which starts there; starts whose repeat cannot be extended to the left are those of maximal repeats.
The union of their spans and the longest of them decide, besides a few counts.  A text is one row of one task;
nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docquarry.llm.kernels import Words, hash_spans, slices, text_bytes, words

# The base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_LONG_LINE = 1024


@dataclass(frozen=True)
class Limits:
    """What a text may repeat: spans count from ``min_words`` on, a longest repeat from ``long_words`` on."""

    min_words: int = 5
    covered_percent: int = 30
    long_words: int = 32
    longest_percent: int = 15


def _dense(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Place of the first equal (major, minor) pair in sorted order, for each pair."""
    order = np.lexsort((minor, major))
    a, b = major[order], minor[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return rank


def suffix_ranks(rank: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of the runs of 1, 2, 4 ... words at each place; the last level ranks whole suffixes.

    ``rank`` ranks single words, differently in each text; ``ends`` is the end of each word's text.  A rank is
    the number of smaller runs, so refining a tied group leaves all other ranks alone.
    """
    levels, n, width = [rank], len(rank), 1
    tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(tied):
        after = tied + width
        inside = after < ends[tied]
        second = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        order = np.lexsort((second, rank[tied]))
        first, second, tied = rank[tied[order]], second[order], tied[order]
        group = np.ones(len(tied), bool)
        group[1:] = first[1:] != first[:-1]
        part = group.copy()
        part[1:] |= second[1:] != second[:-1]
        at = np.arange(len(tied))
        begin = np.maximum.accumulate(np.where(part, at, 0))
        rank = rank.copy()
        rank[tied] = first + begin - np.maximum.accumulate(np.where(group, at, 0))
        levels.append(rank)
        width *= 2
        alone = part & np.append(part[1:], True)
        tied = np.sort(tied[~alone])
    return levels


def longest_repeats(rank: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Words of the longest repeat that starts at each place and occurs elsewhere in its text; 0 below ``least``."""
    found = np.zeros(len(rank), np.int64)
    levels = suffix_ranks(rank, ends)
    start = min(int(least).bit_length() - 1, len(levels) - 1)
    if 2**start < min(least, 2) or len(levels) < 2:
        return found
    suffixes = np.empty(len(rank), np.int64)
    suffixes[levels[-1]] = np.arange(len(rank))
    a, b = suffixes[:-1], suffixes[1:]
    same = np.flatnonzero(levels[start][a] == levels[start][b])
    if not len(same):
        return found
    a, b = a[same], b[same]
    here, there, common = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        # Two suffixes of a text never end together, and no word of another text has an equal rank.
        ranks = np.append(levels[level], -1)
        step = np.where(ranks[here] == ranks[there], 1 << level, 0)
        here, there, common = here + step, there + step, common + step
    common[common < least] = 0
    np.maximum.at(found, a, common)
    np.maximum.at(found, b, common)
    return found


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in the union of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def _per_text(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[rows[1:]] - total[rows[:-1]]


def _line_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    hashes = np.empty(len(starts), np.uint64)
    short = ends - starts <= _LONG_LINE
    hashes[short] = hash_spans(data, starts[short], ends[short])
    for i in np.flatnonzero(~short).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def _repeated_lines(found: Words, offsets: np.ndarray) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line of the text."""
    texts = len(offsets) - 1
    breaks = np.flatnonzero(found.data == 10)
    # A text starts a line, and so does the byte after each line feed; empty texts add empty lines only.
    starts = np.concatenate([offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(texts), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = np.append(starts, len(found.data) + 1)[1:] - 1
    last = np.ones(len(owner), bool)
    last[:-1] = owner[1:] != owner[:-1]
    ends[last] = offsets[owner[last] + 1]
    wordy = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, starts)
    starts, ends, owner = starts[wordy], ends[wordy], owner[wordy]
    kinds = _dense(owner, _line_hashes(found.data, starts, ends))
    distinct = np.zeros(len(starts), bool)
    distinct[np.unique(kinds, return_index=True)[1]] = True
    return np.bincount(owner[~distinct], minlength=texts)


_COLUMNS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "covered_chars": "long", "longest_repeat": "long", "n_repeats": "long",
}


def measure(column: pa.Array, min_words: int) -> dict[str, np.ndarray]:
    """The measures of all texts of a column."""
    found = words(column, lower=False)
    rows, texts = found.rows, len(found.rows) - 1
    lengths = np.diff(rows)
    owner = np.repeat(np.arange(texts), lengths)
    # A code point has one byte that does not continue another.
    points = np.concatenate([np.zeros(1, np.int64), np.cumsum((found.data & 0xC0) != 0x80)])
    chars = points[found.ends] - points[found.starts]
    offsets = text_bytes(column)[1]

    repeat = longest_repeats(_dense(owner, found.hashes), rows[1:][owner], min(min_words, WINDOW))
    window = np.flatnonzero(repeat >= WINDOW)
    in_window = covered(window, np.full(len(window), WINDOW), len(repeat))
    counted = np.where(repeat >= min_words, repeat, 0)
    before = np.where(np.arange(len(counted)) > rows[:-1][owner], np.append(0, counted[:-1]), 0)
    maximal = (counted > 0) & (before <= counted)
    span = np.flatnonzero(maximal)
    in_span = covered(span, counted[span], len(counted))
    longest = np.zeros(texts, np.int64)
    np.maximum.at(longest, owner, counted)
    return {
        "n_words": lengths,
        "word_chars": _per_text(chars, rows),
        "n_symbols": _per_text(_SYMBOL[found.data], offsets),
        "n_dup_lines": _repeated_lines(found, offsets),
        "n_repeat_words": _per_text(in_window, rows),
        "covered_chars": _per_text(np.where(in_span, chars, 0), rows),
        "longest_repeat": longest,
        "n_repeats": _per_text(maximal, rows),
    }


def _measured(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = measure(batch.column("text"), min_words)
            values = [pa.array(found[name], pa.int64()) for name in _COLUMNS]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *values], names=["id", *_COLUMNS])

    return run


def quality_rules(docs: DataFrame, id: str = "doc_id", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """One row per input row: ``id``, the measures, ``base_failed`` and ``kept``.

    Words are runs without ASCII white space, case as it is.  ``base_failed``: fewer than 20 words, or
    repeated 8-word windows over more than 30 % of the words.  ``kept`` is false there, and where repeats of
    ``min_words`` or more cover more than ``covered_percent`` of the words' characters, or the longest repeat
    has ``long_words`` or more and is over ``longest_percent`` of the text's words.  ``n_repeats`` counts
    the places where a maximal repeat starts.

    A NULL text counts as empty: all measures 0, base failed.  Repeated rows and NULL ids give a row each;
    an empty table gives none.  Other columns are not read.  Words and lines are compared by 64-bit hashes.
    """
    kind = docs.schema[id].dataType.simpleString()
    schema = ", ".join([f"id {kind}", *(f"{name} {type}" for name, type in _COLUMNS.items())])
    found = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(_measured(limits.min_words), schema)
    n, longest = F.col("n_words"), F.col("longest_repeat")
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * n)
    repetitive = (100 * F.col("covered_chars") > limits.covered_percent * F.col("word_chars")) | (
        (longest >= limits.long_words) & (100 * longest > limits.longest_percent * n)
    )
    return found.select(
        F.col("id").alias(id), *_COLUMNS, failed.alias("base_failed"), (~failed & ~repetitive).alias("kept")
    )
