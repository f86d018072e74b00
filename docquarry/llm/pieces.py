"""Batched Viterbi over the pieces of a SentencePiece model, in numpy.

Words of equal length advance together, one character at a time.  Hashes of all substrings up to the
longest piece are looked up among the sorted hashes of the pieces.  At each position every piece that ends
there is a candidate, and the winner is stored as a back pointer; following the pointers from the end
gives the ids.

* Unigram models: the winner is the candidate with the largest sum of scores.
* BPE models: a piece may follow another only if merging their joined characters would leave exactly
  these two.  Every position then has one possible winner (a prefix has one encoding), and the path is the
  library's own encoding.  Whether two pieces may follow each other is read off their merge trees: walking
  back from the two whole pieces to their characters, no pair that stood side by side may have been
  mergeable earlier than the merge that ended it.

A character that is in no piece is its UTF-8 bytes, as byte pieces.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import numpy as np

from docquarry.llm.kernels import mix, ragged

MARK = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int32(-1)


@dataclass
class Model:
    """What encoding and decoding need of a model file; sent to the tasks once."""

    merges: bool
    keys: np.ndarray  # sorted hashes of the ordinary pieces
    ids: np.ndarray  # piece of each key
    length: np.ndarray  # characters of each piece
    score: np.ndarray
    digest: np.ndarray  # hash of each piece
    left: np.ndarray  # last merge of each piece (BPE), -1 for single characters
    right: np.ndarray
    stable: np.ndarray  # pieces that encode to themselves
    byte_ids: np.ndarray  # piece of each byte
    unknown: int
    texts: bytes = b""  # decoded bytes of all pieces
    text_first: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    text_count: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _hash(codes: np.ndarray) -> int:
    value = 0
    for code in codes.tolist():
        value = (value * int(_BASE) + code + 1) & 0xFFFFFFFFFFFFFFFF
    return value


def _merge(text: str, rank: dict[str, int]) -> list:
    """Merge tree of a short text: ``(string, left, right)`` nodes; best rank first, then leftmost."""
    nodes = [(c, None, None) for c in text]
    while len(nodes) > 1:
        options = [(rank.get(a[0] + b[0], 1 << 40), i) for i, (a, b) in enumerate(zip(nodes, nodes[1:]))]
        best, i = min(options)
        if best == 1 << 40:
            break
        nodes[i : i + 2] = [(nodes[i][0] + nodes[i + 1][0], nodes[i], nodes[i + 1])]
    return nodes


def load_model(path: str | os.PathLike) -> Model:
    """Read a model file on the driver."""
    from sentencepiece import SentencePieceProcessor

    reader = SentencePieceProcessor(model_file=str(path))
    count = reader.get_piece_size()
    texts = [reader.id_to_piece(i) for i in range(count)]
    byte = np.array([reader.is_byte(i) for i in range(count)])
    special = np.array([reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i) for i in range(count)])
    ordinary = [i for i in range(count) if not byte[i] and not special[i]]
    score = np.array([reader.get_score(i) for i in range(count)])
    digest = np.zeros(count, np.uint64)
    length = np.ones(count, np.int64)
    for i in ordinary:
        codes = np.array([ord(c) for c in texts[i]])
        digest[i], length[i] = _hash(codes), len(codes)
    # Scores of a BPE model are the negated order of its merges: whole numbers, nearly all different.
    several = [i for i in ordinary if length[i] > 1]
    whole = all(score[i] == int(score[i]) for i in several)
    merges = whole and len({score[i] for i in several}) > 0.99 * len(several)
    left, right = np.full(count, _NONE), np.full(count, _NONE)
    stable = np.zeros(count, bool)
    by_text = {texts[i]: i for i in ordinary}
    if merges:
        rank = {texts[i]: int(-score[i]) for i in several}
        for i in ordinary:
            tree = _merge(texts[i], rank)
            stable[i] = len(tree) == 1
            if len(tree) == 1 and tree[0][1] is not None:
                left[i], right[i] = (by_text.get(tree[0][side][0], -1) for side in (1, 2))
    else:
        stable[ordinary] = True
    keys = np.array([digest[i] for i in ordinary], np.uint64)
    order = np.argsort(keys)
    byte_ids = np.full(256, reader.unk_id(), np.int64)
    decoded = []
    for i in range(count):
        if byte[i]:
            byte_ids[int(texts[i][3:5], 16)] = i
            decoded.append(bytes([int(texts[i][3:5], 16)]))
        elif special[i]:
            decoded.append(b" \xe2\x81\x87 " if reader.is_unknown(i) else b"")
        else:
            decoded.append(texts[i].replace(MARK, " ").encode())
    sizes = np.array([len(d) for d in decoded], np.int64)
    return Model(
        merges, keys[order], np.array(ordinary)[order], length, score, digest, left.astype(np.int64),
        right.astype(np.int64), stable, byte_ids, reader.unk_id(), b"".join(decoded), np.cumsum(sizes) - sizes, sizes,
    )


class Encoder:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.longest = int(model.length[model.ids].max()) if len(model.ids) else 1
        self.power = np.array([pow(int(_BASE), i, 1 << 64) for i in range(self.longest + 1)], np.uint64)
        # Pairs that have been judged; a table of at most 4 million.
        self.pair_keys, self.pair_ok = np.zeros(0, np.uint64), np.zeros(0, bool)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece with the hash, or -1."""
        m = self.model
        at = np.searchsorted(m.keys, hashes)
        at[at == len(m.keys)] = 0
        return np.where(m.keys[at] == hashes, m.ids[at], -1)

    def _judge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves the two pieces as they are, by their merge trees."""
        m = self.model
        rank = -m.score
        ok = np.ones(len(left), bool)
        on = np.arange(len(left))
        limit = np.full(len(left), np.inf)
        by_right = np.zeros(len(left), bool)
        while len(on):
            a, b = left[on], right[on]
            joined = self._find(m.digest[a] * self.power[np.minimum(m.length[b], self.longest)] + m.digest[b])
            joined[m.length[a] + m.length[b] > self.longest] = -1
            when = np.where(joined >= 0, rank[joined], np.inf)
            bad = (when < limit[on]) | ((when == limit[on]) & by_right[on] & np.isfinite(when))
            ok[on[bad]] = False
            born_a = np.where(m.left[a] >= 0, rank[a], -np.inf)
            born_b = np.where(m.left[b] >= 0, rank[b], -np.inf)
            undo_a = born_a > born_b
            alive = ~bad & ((m.left[a] >= 0) | (m.left[b] >= 0))
            limit[on] = np.where(undo_a, born_a, born_b)
            by_right[on] = ~undo_a
            left[on] = np.where(undo_a, m.right[a], a)
            right[on] = np.where(undo_a, b, np.where(m.left[b] >= 0, m.left[b], b))
            on = on[alive]
        return ok

    def _may_follow(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """BPE: whether each piece may stand behind the other; anything may follow a start or unknown."""
        result = before < 0
        at = np.flatnonzero(~result)
        if not len(at):
            return result
        keys = before[at].astype(np.uint64) << np.uint64(32) | piece[at].astype(np.uint64)
        unique, inverse = np.unique(keys, return_inverse=True)
        if len(self.pair_keys):
            place = np.searchsorted(self.pair_keys, unique)
            place[place == len(self.pair_keys)] = 0
            known = self.pair_keys[place] == unique
        else:
            place, known = np.zeros(len(unique), np.int64), np.zeros(len(unique), bool)
        ok = np.zeros(len(unique), bool)
        ok[known] = self.pair_ok[place[known]]
        new = unique[~known]
        if len(new):
            ok[~known] = self._judge((new >> np.uint64(32)).astype(np.int64), (new & np.uint64(0xFFFFFFFF)).astype(np.int64))
            if len(self.pair_keys) > 4_000_000:
                self.pair_keys, self.pair_ok = np.zeros(0, np.uint64), np.zeros(0, bool)
            keys = np.concatenate([self.pair_keys, new])
            order = np.argsort(keys, kind="stable")
            self.pair_keys, self.pair_ok = keys[order], np.concatenate([self.pair_ok, ok[~known]])[order]
        result[at] = ok[inverse]
        return result

    def _advance(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Back pointers of equal-length words: the piece that ends at each position, and its length.

        Piece -1 is a character that no piece has.
        """
        m, (count, size) = self.model, codes.shape
        prefix = np.zeros((size + 1, count), np.uint64)
        for j in range(size):
            prefix[j + 1] = prefix[j] * _BASE + codes[:, j].astype(np.uint64) + np.uint64(1)
        reach = min(self.longest, size)
        found = []
        for width in range(1, reach + 1):
            piece = self._find((prefix[width:] - prefix[:-width] * self.power[width]).reshape(-1))
            piece[(piece >= 0) & ~m.stable[piece]] = -1
            found.append(piece.reshape(size + 1 - width, count))
        piece_at, width_at = np.full((size + 1, count), -2, np.int64), np.zeros((size + 1, count), np.int64)
        best = np.full((size + 1, count), -np.inf)
        best[0] = 0
        worst = m.score[m.ids].min() - 10 if len(m.ids) else 0.0
        for j in range(1, size + 1):
            for width in range(min(reach, j), 0, -1):
                piece = found[width - 1][j - width]
                if m.merges:
                    rows = np.flatnonzero((piece >= 0) & (width_at[j] == 0))
                    if len(rows):
                        rows = rows[self._may_follow(piece_at[j - width][rows], piece[rows])]
                        piece_at[j][rows], width_at[j][rows] = piece[rows], width
                else:
                    total = best[j - width] + np.where(piece >= 0, m.score[piece], -np.inf)
                    better = total > best[j]
                    best[j][better] = total[better]
                    piece_at[j][better], width_at[j][better] = piece[better], width
            alone = width_at[j] == 0
            piece_at[j][alone], width_at[j][alone] = -1, 1
            best[j][alone] = best[j - 1][alone] + worst
        return piece_at, width_at

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of words (UTF-8, a space is the word mark), and the number of ids of each."""
        m = self.model
        texts = [w.decode("utf-8").replace(" ", MARK) for w in words]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        pieces_of: list[tuple[np.ndarray, np.ndarray]] = []
        for size in np.unique(sizes[sizes > 0]).tolist():
            rows = np.flatnonzero(sizes == size)
            joined = "".join([texts[r] for r in rows.tolist()])
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(rows), size)
            piece_at, width_at = self._advance(codes)
            # Follow the pointers of all words together, from the end.
            position, column, steps = np.full(len(rows), size), np.arange(len(rows)), []
            while len(column):
                piece = piece_at[position, column]
                steps.append((rows[column], position, np.where(piece >= 0, piece, -1 - codes[column, position - 1].astype(np.int64))))
                position = position - width_at[position, column]
                column, position = column[position > 0], position[position > 0]
            pieces_of += steps
        if not pieces_of:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        row, position, piece = (np.concatenate(x) for x in zip(*pieces_of))
        order = np.lexsort((position, row))
        row, piece = row[order], piece[order]
        unknown = np.flatnonzero(piece < 0)
        if len(unknown):
            # An unknown character becomes its bytes.
            values = [chr(-1 - p).encode("utf-8", "surrogatepass") for p in piece[unknown].tolist()]
            copies = np.ones(len(piece), np.int64)
            copies[unknown] = [len(v) for v in values]
            first = np.cumsum(copies) - copies
            row, piece = np.repeat(row, copies), np.repeat(piece, copies)
            spots = ragged(first[unknown], copies[unknown])
            piece[spots] = m.byte_ids[np.frombuffer(b"".join(values), np.uint8)]
        return piece.astype(np.uint32), np.bincount(row, minlength=len(texts)).astype(np.int64)


def decode(model: Model, ids: np.ndarray, rows: np.ndarray) -> list[bytes]:
    """Bytes of texts from their ids; the mark put before each text is taken away."""
    ids = ids.astype(np.int64)
    count = model.text_count[ids]
    store = np.frombuffer(model.texts, np.uint8)
    data = store[ragged(model.text_first[ids], count)].tobytes()
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])[rows].tolist()
    return [data[a:b][1:] if data[a : a + 1] == b" " and b > a else data[a:b] for a, b in zip(ends[:-1], ends[1:])]


def fingerprint(model: Model) -> int:
    """Number that tells two models apart."""
    return int(mix(np.bitwise_xor.reduce(mix(model.keys + model.ids.astype(np.uint64))).reshape(1))[0])
