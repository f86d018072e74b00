"""Secrets: fixed patterns, and a linear-chain conditional random field that finds more.

Base kinds (assign, access, hex) are reported wherever their fixed pattern holds.  The field tags tokens as
begin, inside or outside of a secret.  Its features are a token's shape, length, digit share, character
changes and prefix, the words and shapes beside it, the separator before it, and how much of the text looks
like assignments.  Spans it finds that touch no base span are added as kind ``crf``.

It is trained on windows of at most TRAIN_TEXTS documents that the base patterns may match and as many others
(smallest hash of the text).  A copy of each of these texts gets generated values at places drawn from its own
hash: secrets of several alphabets behind names that no base pattern knows, or with no name at all, and values
that only look alike (ids, versions, addresses, dates, paths, names), so that what is learned is the form of a
secret and of its surroundings and not the base patterns.  The weights are one small array.
Tagging is a pass over the texts without a
shuffle.  Tokens whose outside score leads by more than all transitions together can win are outside in the
best path whatever stands beside them, so only the stretches between them need Viterbi; stretches of equal
length advance together.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docquarry.llm.kernels import Words, hash_spans, mix, slices, text_bytes
from docquarry.llm.rows import smallest, stored

# Base patterns and their order.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs shorter than 16 fail wherever they start, so asking for 16 changes no result.
HEX = re.compile(r"[0-9a-f]{16,}")
WORDS = ("passw", "secret", "token", "api")

BUCKETS = 1 << 16
OUT, BEGIN, INSIDE = 0, 1, 2
TRAIN_TEXTS = 3000
WINDOW = 8
ROUNDS = 4
CHUNK = 1024
RATE, DECAY = 0.3, 1e-5
PLANTED = 6

#: Parts of the names that generated secrets stand behind, and names and forms of values that are none.
_OWNERS = ("", "", "db_", "client_", "user_", "app-", "admin_", "smtp_", "service_", "root_", "cloud_", "x-")
_NAMES = ("pwd", "pass", "passphrase", "passcode", "key", "access_key", "private_key", "signing_key", "auth", "credential", "creds")
_SIGNS = ("=", ": ", " = ", ":", " := ", '="', ": '", '": "', " ")
_PLAIN = ("version", "id", "order_id", "date", "host", "ip", "path", "url", "size", "ref", "build", "status", "author", "file", "code")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"
_ALPHABETS = (
    _LETTERS + _DIGITS, _LETTERS + _LETTERS.upper() + _DIGITS, _LETTERS + _LETTERS.upper() + _DIGITS + "+/",
    _LETTERS + _LETTERS.upper() + _DIGITS + "-_", _LETTERS.upper() + "234567", _DIGITS + "ABCDEF",
)

_B = np.arange(256)
_BREAK = np.isin(_B, [32, 9, 10, 11, 12, 13, *map(ord, "\"'=:,;()[]{}<>|`")])
_LOWER_AZ = np.where((_B >= 65) & (_B <= 90), _B + 32, _B).astype(np.uint8)
_HEX = ((_B >= 48) & (_B <= 57)) | ((_B >= 97) & (_B <= 102))
_CLASS = np.zeros(256, np.uint8)  # lower, upper, digit, other ASCII, other
_CLASS[(_B >= 65) & (_B <= 90)] = 1
_CLASS[(_B >= 48) & (_B <= 57)] = 2
_CLASS[(_B < 48) | ((_B > 57) & (_B < 65)) | ((_B > 90) & (_B < 97)) | ((_B > 122) & (_B < 128))] = 3
_CLASS[_B >= 128] = 4


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind."""
    found = []
    low = text.lower()
    if any(word in low for word in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


def _edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that begin and that end a run; a run never goes on into the next text."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return first, last


def _may_have_base(data: np.ndarray, offsets: np.ndarray, column: pa.Array) -> list[bool]:
    """Texts worth a look with the base patterns: none with a match is left out."""
    first, last = _edges(_HEX[data], offsets)
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    long_hex = np.zeros(len(offsets), bool)
    long_hex[np.searchsorted(offsets, starts[ends - starts >= 16], "right") - 1] = True
    result = []
    for i, text in enumerate(column):
        value = text.as_py() or ""
        result.append(bool(long_hex[i]) or "AKIA" in value or any(word in value.lower() for word in WORDS))
    return result


def _tokens(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Tokens between white space, quotes, brackets and assignment signs."""
    first, last = _edges(~_BREAK[data], offsets)
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    low = _LOWER_AZ[data]
    return Words(hash_spans(low, starts, ends), starts, ends, np.searchsorted(starts, offsets), data)


def _features(found: Words, offsets: np.ndarray) -> np.ndarray:
    """Hashed features of every token."""
    data, starts, ends = found.data, found.starts, found.ends
    n = len(starts)
    if not n:
        return np.zeros((0, 1), np.int32)
    size = ends - starts
    kind = _CLASS[data]

    def within(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.int32), np.cumsum(flags, dtype=np.int32)])
        return total[ends] - total[starts]

    share = [within(kind == c) for c in range(5)]
    shape = sum(((share[c] > 0).astype(np.uint64) << np.uint64(c)) for c in range(5))
    changes = np.zeros(len(data), bool)
    changes[1:] = kind[1:] != kind[:-1]
    turns = np.minimum(within(changes), 12).astype(np.uint64)
    bucket = np.minimum(np.log2(size + 1) * 2, 14).astype(np.uint64)
    digits = (8 * share[2] // np.maximum(1, size)).astype(np.uint64)
    head = hash_spans(data, starts, np.minimum(ends, starts + 4))
    word = np.where(size <= 12, found.hashes, np.uint64(1))
    low = _LOWER_AZ[data]
    tail = hash_spans(low, np.maximum(starts, ends - 4), ends)
    short_tail = hash_spans(low, np.maximum(starts, ends - 3), ends)
    letters = np.maximum(1, share[0] + share[1])
    vowels = (8 * within(np.isin(low, list(b"aeiou"))) // letters).astype(np.uint64)
    rate = (16 * within(changes) // np.maximum(1, size)).astype(np.uint64)

    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(found.rows))
    before = np.empty(n, np.int64)  # end of the token before, or start of the text
    before[1:] = ends[:-1]
    before[found.rows[:-1][np.diff(found.rows) > 0]] = offsets[:-1][np.diff(found.rows) > 0]
    sign = np.concatenate([np.zeros(1, np.int32), np.cumsum((data == 61) | (data == 58), dtype=np.int32)])
    quote = np.concatenate([np.zeros(1, np.int32), np.cumsum((data == 34) | (data == 39), dtype=np.int32)])
    gap = ((sign[starts] > sign[before]) * 1 + (quote[starts] > quote[before]) * 2).astype(np.uint64)
    assigned = np.bincount(doc, weights=(gap & np.uint64(1)).astype(float), minlength=len(offsets) - 1)
    style = np.minimum(4, np.log2(1 + 100 * assigned / np.maximum(1, np.diff(found.rows)))).astype(np.uint64)[doc]

    def beside(values: np.ndarray, step: int) -> np.ndarray:
        moved = np.full(n, np.uint64(0xFFFF))
        if step < 0:
            moved[1:] = values[:-1]
            moved[found.rows[:-1][np.diff(found.rows) > 0]] = np.uint64(0xFFFE)
        else:
            moved[:-1] = values[1:]
            moved[found.rows[1:][np.diff(found.rows) > 0] - 1] = np.uint64(0xFFFE)
        return moved

    form = shape | bucket << np.uint64(8)
    columns = [
        np.zeros(n, np.uint64), form, shape | turns << np.uint64(8), shape | digits << np.uint64(8) | bucket << np.uint64(16),
        head, word, gap | shape << np.uint64(8), beside(word, -1), beside(word, 1), beside(form, -1), beside(form, 1),
        style | gap << np.uint64(8), style | form << np.uint64(8), beside(word, -1) ^ (gap << np.uint64(3)),
        beside(tail, -1), beside(short_tail, -1) ^ (gap << np.uint64(3)), vowels | bucket << np.uint64(8) | shape << np.uint64(16),
        rate | bucket << np.uint64(8) | shape << np.uint64(16), rate | vowels << np.uint64(8) | gap << np.uint64(16),
    ]
    salted = [mix(c + np.uint64(k << 56)) & np.uint64(BUCKETS - 1) for k, c in enumerate(columns)]
    return np.stack(salted, axis=1).astype(np.int32)


@dataclass
class Field:
    """Weights of features for each tag, and of pairs of neighbouring tags."""

    emit: np.ndarray
    step: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        total = np.zeros((len(features), 3), np.float32)
        for k in range(features.shape[1]):
            total += self.emit[features[:, k]]
        return total


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(features: np.ndarray, tags: np.ndarray) -> Field:
    """Maximise the likelihood of equally long windows by AdaGrad; gradients by forward and backward sums.

    Steps are taken on chunks of windows, in an order drawn from a fixed seed for each round.
    """
    field = Field(np.zeros((BUCKETS, 3)), np.zeros((3, 3)))
    memory = [np.full((BUCKETS, 3), 1e-8), np.full((3, 3), 1e-8)]
    rng = np.random.default_rng(0)
    for _ in range(ROUNDS):
        order = rng.permutation(len(features))
        for start in range(0, len(order), CHUNK):
            part = order[start : start + CHUNK]
            gradients = _slopes(field, features[part], tags[part])
            for weights, gradient, past in zip((field.emit, field.step), gradients, memory):
                past += gradient * gradient
                weights += RATE * gradient / np.sqrt(past)
    return Field(field.emit.astype(np.float32), field.step.astype(np.float32))


def _slopes(field: Field, features: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the mean log likelihood of some windows, less the decay."""
    count, size, width = features.shape
    flat = features.reshape(-1)
    truth = np.eye(3)[tags]
    pairs = np.einsum("nta,ntb->ab", truth[:, :-1], truth[:, 1:])
    emit = field.emit[features].sum(axis=2)
    ahead, back = np.empty((size, count, 3)), np.zeros((size, count, 3))
    ahead[0] = emit[:, 0]
    for t in range(1, size):
        ahead[t] = emit[:, t] + _log_sum(ahead[t - 1][:, :, None] + field.step, 1)
    for t in range(size - 2, -1, -1):
        back[t] = _log_sum(field.step + (emit[:, t + 1] + back[t + 1])[:, None, :], 2)
    whole = _log_sum(ahead[-1], 1)
    chance = np.exp(ahead + back - whole[None, :, None]).transpose(1, 0, 2)
    wrong = (truth - chance).reshape(-1, 3)
    slope = np.stack([np.bincount(flat, np.repeat(wrong[:, tag], width), minlength=BUCKETS) for tag in range(3)], axis=1)
    both = np.zeros((3, 3))
    for t in range(size - 1):
        joint = ahead[t][:, :, None] + field.step + (emit[:, t + 1] + back[t + 1])[:, None, :]
        both += np.exp(joint - whole[:, None, None]).sum(axis=0)
    return slope / count - DECAY * field.emit, (pairs - both) / count - DECAY * field.step


def viterbi(field: Field, emit: np.ndarray) -> np.ndarray:
    """Best tags of many stretches of one length (stretches, tokens, 3); outside stands on both sides."""
    count, size, _ = emit.shape
    score = emit[:, 0] + field.step[OUT]
    back = np.zeros((size, count, 3), np.int8)
    for t in range(1, size):
        options = score[:, :, None] + field.step
        back[t] = options.argmax(axis=1)
        score = options.max(axis=1) + emit[:, t]
    tags = np.empty((count, size), np.int8)
    tags[:, -1] = (score + field.step[:, OUT]).argmax(axis=1)
    for t in range(size - 1, 0, -1):
        tags[:, t - 1] = back[t][np.arange(count), tags[:, t]]
    return tags


def _lead(step: np.ndarray) -> float:
    """Most that any tag can gain over outside from its neighbours."""
    gains = [
        step[a, y] + step[y, b] - step[a, OUT] - step[OUT, b] for a in range(3) for y in (BEGIN, INSIDE) for b in range(3)
    ]
    return float(max(gains))


def tag(field: Field, features: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Best tags of all tokens; the texts' tokens are ``rows[i]:rows[i+1]``."""
    tags = np.zeros(len(features), np.int8)
    if not len(features):
        return tags
    emit = field.emissions(features)
    open_ = np.flatnonzero(emit[:, OUT] - emit[:, 1:].max(axis=1) <= _lead(field.step) + 1e-3)
    if not len(open_):
        return tags
    cut = np.ones(len(open_), bool)
    cut[1:] = (np.diff(open_) > 1) | np.isin(open_[1:], rows)
    first = open_[cut]
    size = np.diff(np.append(np.flatnonzero(cut), len(open_)))
    for length in np.unique(size).tolist():
        at = first[size == length][:, None] + np.arange(length)
        tags[at] = viterbi(field, emit[at])
    return tags


def _secret(rng: random.Random, text: str) -> tuple[str, str]:
    """A name with its sign, and a generated secret; some long ones have no name."""
    if rng.random() < 0.2:
        word = "".join(rng.choices(_LETTERS, k=rng.randint(3, 8)))
        value = "".join(rng.choice((word, word.title(), rng.choice("!@#$%._-"), str(rng.randint(1, 9999)))) for _ in range(4))
        value += "".join(rng.choices(_DIGITS, k=3)) + word[:4]
        named = True
    else:
        value = "".join(rng.choices(rng.choice(_ALPHABETS), k=rng.randint(14, 48)))
        if rng.random() < 0.2:
            value = "".join(rng.choices(_LETTERS, k=rng.randint(2, 4))) + rng.choice("_-") + value
        named = len(value) < 24 or rng.random() < 0.67
    if not named:
        return "", value
    name = rng.choice(_OWNERS) + rng.choice(_NAMES)
    return rng.choice((name, name, name.upper(), name.title().replace("_", ""))) + rng.choice(_SIGNS), value


def _harmless(rng: random.Random, text: str) -> tuple[str, str]:
    """A name with its sign, or none, and a value that is no secret."""

    def digits(n: int) -> str:
        return "".join(rng.choices(_DIGITS, k=n))

    def word() -> str:
        at = rng.randrange(len(text) + 1)
        near = re.findall(r"[A-Za-z]{3,12}", text[at : at + 80])
        return rng.choice(near) if near else "".join(rng.choices(_LETTERS, k=rng.randint(3, 9)))

    some = "".join(rng.choices("0123456789abcdef", k=32))
    forms = (
        lambda: ".".join(str(rng.randint(0, 30)) for _ in range(3)) + rng.choice(("", "-rc" + digits(1), "-beta", ".dev" + digits(2))),
        lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)) + rng.choice(("", "/24", ":8080")),
        lambda: f"20{digits(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}" + rng.choice(("", f"T{rng.randint(10, 23)}:30:{digits(2)}Z")),
        lambda: digits(rng.randint(4, 20)),
        lambda: f"{some[:8]}-{some[8:12]}-{some[12:16]}-{some[16:20]}-{some[20:]}",
        lambda: "/" + "/".join(word().lower() for _ in range(rng.randint(2, 5))) + rng.choice(("", ".txt", ".py")),
        lambda: "https://" + word().lower() + ".example.com/" + word() + "?page" + digits(1),
        lambda: "_".join(word().lower() for _ in range(rng.randint(2, 4))),
        lambda: "_".join(word().upper() for _ in range(rng.randint(2, 4))),
        lambda: "".join(word().title() for _ in range(rng.randint(2, 4))) + rng.choice(("", digits(1))),
        lambda: "-".join(word().lower() for _ in range(rng.randint(2, 4))) + rng.choice(("", "-" + digits(2))),
        lambda: word().lower() + digits(2) + "@example.org",
        lambda: "".join(rng.choices(_LETTERS.upper(), k=2)) + "-" + digits(rng.randint(4, 6)),
        lambda: some[: rng.randint(6, 10)],
        lambda: "978-" + digits(1) + "-" + digits(2) + "-" + digits(6) + "-" + digits(1),
        word,
    )
    value = rng.choice(forms)()
    draw = rng.random()
    if draw < 0.3:
        return "", value
    if draw < 0.6:  # a name of a secret with a word or two behind it
        return rng.choice(_OWNERS) + rng.choice(_NAMES) + rng.choice(_SIGNS), rng.choice((word(), f"{word()}_{word()}", word().lower()))
    return rng.choice(_PLAIN) + rng.choice(_SIGNS), value


def _planted(text: str) -> tuple[str, list[tuple[int, int, bool]]]:
    """The text with generated values at some of its gaps, and where they are and whether they are secrets."""
    rng = random.Random(zlib.crc32(text.encode()))
    gaps = [m.start() for m in re.finditer(r"\s", text)] or [len(text)]
    parts, spans, last, size = [], [], 0, 0
    for place in sorted(rng.choices(gaps, k=PLANTED)):
        secret = rng.random() < 0.5
        name, value = (_secret if secret else _harmless)(rng, text)
        before = text[last:place] + rng.choice(" \n") + name
        after = next((sign[-1] for sign in _SIGNS if sign[-1] in "\"'" and name.endswith(sign[-1])), "") + " "
        spans.append((size + len(before), size + len(before) + len(value), secret))
        parts += [before, value, after]
        size += len(before) + len(value) + len(after)
        last = place
    return "".join(parts) + text[last:], spans


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training windows of each text: features and tags, around base matches, far from them, and around planted values."""
    size = 2 * WINDOW + 1
    for batch in slices(batches, "text"):
        plain = batch.column("text").to_pylist()
        for texts, planted in ((plain, [[] for _ in plain]), zip(*map(_planted, plain))):
            column = pa.array(texts, pa.string())
            data, offsets = text_bytes(column)
            found = _tokens(data, offsets)
            features = _features(found, offsets)
            tags = np.zeros(len(features), np.int8)
            centres = []
            for i, (value, extra) in enumerate(zip(texts, planted)):
                low, high = found.rows[i], found.rows[i + 1]
                if high - low < size:
                    continue
                spans = [(ASSIGN.match(value, s).start(2) if kind == "assign" else s, e, True) for kind, s, e in base_spans(value)]
                marked = []
                for start, end, secret in [*spans, *extra]:
                    begin = offsets[i] + len(value[:start].encode())
                    finish = begin + len(value[start:end].encode())
                    inner = np.arange(low, high)[(found.ends[low:high] > begin) & (found.starts[low:high] < finish)]
                    if secret:
                        tags[inner] = INSIDE
                        tags[inner[:1]] = BEGIN
                    marked += inner[:1].tolist()
                if not extra:
                    marked += np.unique(np.linspace(low, high - 1, 4 + len(marked)).astype(int)).tolist()
                centres += [min(max(c, low + WINDOW), high - 1 - WINDOW) for c in marked]
            at = np.array(centres, np.int64).reshape(-1, 1) + np.arange(-WINDOW, WINDOW + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f.tobytes() for f in features[at].astype("<i4")], pa.binary()),
                    pa.array([t.tobytes() for t in tags[at]], pa.binary()),
                ],
                names=["features", "tags"],
            )


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        yield batch.filter(pa.array(_may_have_base(data, offsets, batch.column("text")), pa.bool_()))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, tags = [], []
    for batch in batches:
        features += batch.column("features").to_pylist()
        tags += batch.column("tags").to_pylist()
    if not tags:
        return
    size = 2 * WINDOW + 1
    field = fit(
        np.frombuffer(b"".join(features), "<i4").reshape(len(tags), size, -1),
        np.frombuffer(b"".join(tags), np.int8).reshape(len(tags), size),
    )
    yield pa.RecordBatch.from_arrays(
        [pa.array([field.emit.tobytes()], pa.binary()), pa.array([field.step.tobytes()], pa.binary())], names=["emit", "step"]
    )


def train_field(docs: DataFrame, text: str = "text", texts: int = TRAIN_TEXTS) -> Field | None:
    """Train on at most ``texts`` distinct documents that base patterns may match and as many others; None without any."""
    source = docs.select(F.col(text).alias("text")).where("text is not null")
    turns = stored(source.mapInArrow(_suspects, "text string").select(F.xxhash64("text").alias("turn")).distinct(), "turns")
    others = stored(source.where("text <> ''").select(F.xxhash64("text").alias("turn")).distinct(), "others")
    # At most twice `texts` numbers are broadcast; only the texts they stand for move.
    chosen = F.broadcast(smallest(turns, "turn", texts).union(smallest(others, "turn", texts)).distinct())
    some = source.withColumn("turn", F.xxhash64("text")).join(chosen, "turn", "left_semi")
    windows = some.dropDuplicates(["turn"]).select("text").mapInArrow(_windows, "features binary, tags binary")
    rows = windows.repartition(1).sortWithinPartitions("features", "tags").mapInArrow(_fit, "emit binary, step binary").collect()
    if not rows:
        return None
    return Field(
        np.frombuffer(rows[0]["emit"], np.float32).reshape(BUCKETS, 3), np.frombuffer(rows[0]["step"], np.float32).reshape(3, 3)
    )


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
_SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in slices(batches, "text"):
            column = batch.column("text")
            data, offsets = text_bytes(column)
            added: dict[int, list[tuple[int, int]]] = {}
            if field is not None:
                found = _tokens(data, offsets)
                tags = tag(field, _features(found, offsets), found.rows)
                inside = np.flatnonzero(tags)
                doc = np.searchsorted(found.rows, inside, "right") - 1
                last = -2
                for at, i in zip(inside.tolist(), doc.tolist()):
                    if at == last + 1 and tags[at] == INSIDE and added.get(i):
                        added[i][-1] = (added[i][-1][0], int(found.ends[at]))
                    else:
                        added.setdefault(i, []).append((int(found.starts[at]), int(found.ends[at])))
                    last = at
            spans = []
            for i, look in enumerate(_may_have_base(data, offsets, column)):
                base = base_spans(column[i].as_py() or "") if look else []
                mine = [dict(kind=k, start=s, end=e, base=True) for k, s, e in base]
                for begin, finish in added.get(i, ()):
                    start = len(data[offsets[i] : begin].tobytes().decode())
                    end = start + len(data[begin:finish].tobytes().decode())
                    if not any(s < end and start < e for _, s, e in base):
                        mine.append(dict(kind="crf", start=start, end=end, base=False))
                order = (*BASE, "crf")
                spans.append(sorted(mine, key=lambda s: (s["start"], order.index(s["kind"]))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, pa.list_(_SPAN))], names=["id", "found"])

    return run


def find_secrets(docs: DataFrame, field: Field | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, found`` for each row; ``found`` is an array of kind, start, end, base.

    Positions count code points of the whole text, the end is exclusive; spans are in order of start, then
    kind.  Without a trained field only base spans are found.  NULL and empty texts have none.  Repeated
    rows give repeated results; other columns are not read; an empty table gives an empty result.
    """
    kind = docs.schema[id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(field)
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(_find(shared), f"id {kind}, found {_SPANS}").withColumnRenamed("id", id)
