"""PII, secrets, decontamination, quality and the n-gram model against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_samples import ODD, SCHEMA, frame, prose, shingle_set, words

from docquarry.llm import secret_scan
from docquarry.llm.decontaminate import contained_items, drop_contaminated
from docquarry.llm.kernels import text_bytes
from docquarry.llm.ngram_lm import ngram_scores, train_ngrams
from docquarry.llm.pii import find_pii, luhn, mask_pii, mod97
from docquarry.llm.quality import drop_low_quality, quality_scores, train_quality
from docquarry.llm.secret_scan import find_secrets, train_field
from docquarry.llm.spans import span_digest

PERSONAL = [
    "write to a.b+c@mail-1.example.com, or x@y or me@host.org.", "a@b.c_x@y.z @ @@ a@@b.cc", "é ü mail: jo@ex.de 😀 jo@ex.de",
    "10.0.0.1 1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 0001.02.3.255 9999999999.1.1.1", "4111 1111 1111 1111 and 4111111111111112",
    "1234-5678-9012-3452 4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1", "+1 (555) 010-9999 +49 30 123456 +1 +1 2", "+1 555.010.9999x",
    "IBAN DE89370400440532013000 or GB82 WEST 1234 5698 7654 32", "DE89370400440532013001 iban", "ssn 123-45-6789, 123-45-6789",
    "call 555-010-9999 now", "9" * 5000, "+" + "1 " * 3000, "a." * 4000 + "@x.y", "2001:0db8:0000:0000:0000:ff00:0042:8329",
]


def plain_base(text, patterns):
    spans = []
    for order, (kind, pattern, good) in enumerate(patterns):
        spans += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text or "") if good(m)]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def digits(m):
    return re.sub(r"[^0-9]", "", m.group())


PII_PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) < 256 for p in m.group().split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]
SECRET_PATTERNS = [
    (
        "assign",
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m.group(2)) >= 12,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18),
    ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 16),
]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_pii_base_spans(spark):
    texts = PERSONAL + ODD
    found = {r.doc_id: r for r in span_digest(find_pii(frame(spark, texts)), "doc_id", ("email", "ip", "card", "phone")).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        base = plain_base(text, PII_PATTERNS)
        assert found[i].base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest(), text[:60]
        counts = Counter(k for k, _, _ in base)
        assert [found[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [counts[k] for k in ("email", "ip", "card", "phone")]
        assert not base or set(joined(base).split(",")) <= set(found[i].spans.split(","))


def test_pii_added_spans_and_mask(spark):
    found = {r.doc_id: [s.kind for s in r.found if not s.base] for r in find_pii(frame(spark, PERSONAL)).collect()}
    assert found[8] == ["iban", "iban"] and found[9] == [] and found[10] == ["ssn", "ssn"]
    assert found[11] == ["local_phone"] and found[15] == ["ipv6"]
    masked = mask_pii(frame(spark, ["to jo@ex.de!", None]))
    assert masked.schema == frame(spark, []).schema
    assert sorted(str(r.text) for r in masked.collect()) == ["None", "to <email>!"]
    assert mod97("DE89370400440532013000") and not mod97("DE89370400440532013001")
    assert find_pii(spark.createDataFrame([], SCHEMA)).count() == 0


def secret_texts():
    rng = random.Random(0)
    texts = prose(80, 31)
    for i in range(40):
        value = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((18, 40))))
        w = texts[i].split()
        w.insert(rng.randrange(len(w)), rng.choice((f"password={value}", f'token = "{value}"', value, "AKIA" + value.upper()[:16])))
        texts[i] = " ".join(w)
    return texts + ODD + [
        "PASSWORD: abcdefghijkl Api_Key='a/b+c=d.e-f_g1' secret=short", "AKIAABCDEFGH AKIA0123456789ABCD tail", "f" * 15 + " " + "f" * 16,
        "éé password=abcdefghijklmnop 😀", "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop",
    ]


def test_secret_base_spans(spark):
    texts = secret_texts()
    docs = frame(spark, texts)
    field = train_field(docs)
    found = {r.doc_id: r for r in span_digest(find_secrets(docs, field), "doc_id", ("assign", "access", "hex")).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        base = plain_base(text, SECRET_PATTERNS)
        assert found[i].base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest(), text[:60]
        assert not base or set(joined(base).split(",")) <= set(found[i].spans.split(","))


@pytest.mark.parametrize("texts", [
    ["see the code", "deadbeefdeadbeef0123 is the digest"], ["cafe", "", "deadbeefdeadbeef", "deadbeefdeadbeef"],
    ["f" * 15, "f" * 15, "a" * 16], ["a" * 8, "b" * 8, "é" + "c" * 16],
])
def test_secret_hex_runs_end_with_their_text(spark, texts):
    column = pa.array(texts)
    look = secret_scan._may_have_base(*text_bytes(column), column)
    assert look == [bool(secret_scan.base_spans(t)) for t in texts]
    docs = frame(spark, texts).coalesce(1)
    found = {r.doc_id: [tuple(s) for s in r.found] for r in find_secrets(docs, None).collect()}
    assert found == {i: [(*s, True) for s in plain_base(t, SECRET_PATTERNS)] for i, t in enumerate(texts)}


def test_secret_field_finds_what_patterns_miss(spark):
    rng = random.Random(19)
    field = train_field(frame(spark, secret_texts() + prose(300, 61)))
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    secrets = ["pwd = 9g3z77q2c4Kd81e6R05a7vb9", "client_key: 'Zx81-QpLw72-mNbV93-tYuR'", "db_pass=hunter2hunter2XYZ99"]
    for name in ("mail_pwd", "DB_PASS", "vault-key", "storage_auth", "hmac_key", "ClientKey", "login_passphrase", "deploy_credential"):
        for sign in ("=", ": ", ' = "'):
            secrets += [name + sign + "".join(rng.choices(letters, k=rng.randint(16, 40))) for _ in range(3)]
    clean = [
        "version: 3.11.2-rc1", "host = 192.168.20.117", "order_id=8812390045", "path: /usr/share/doc/readme.txt", "build 20240817",
        "primary_key: customer_id", "pass: the first one", "date = 2023-11-05T10:30:00Z", "MAX_RETRY_COUNT = 12", "key: value",
        "HttpRequestHandler", "foreign_key = order_lines", "phone +1-202-555-0143", "AB-48213", "state-of-the-art", "x = 3.14159265",
        "id: 123e4567-e89b-12d3-a456-426614174000", "mail jane.doe42@example.org", "auth = optional", "file: report_final_v2.pdf",
    ] * 3
    hosts = prose(len(secrets) + len(clean), 77)
    texts, spans = [], []
    for host, phrase in zip(hosts, secrets + clean):
        w = host.split()
        at = rng.randrange(len(w))
        texts.append(" ".join(w[:at]) + " " + phrase + " " + " ".join(w[at:]))
        value = re.split(r" ?[=:] ?", phrase)[-1].strip("'\"")
        spans.append((texts[-1].index(phrase) + phrase.index(value), value))
    assert not any(secret_scan.base_spans(t) for t in texts)
    found = {r.doc_id: r.found for r in find_secrets(frame(spark, texts), field).collect()}
    assert all(s.kind == "crf" for f in found.values() for s in f)
    hits = sum(any((s.start, s.end) == (spans[i][0], spans[i][0] + len(spans[i][1])) for s in found[i]) for i in range(len(secrets)))
    total = sum(map(len, found.values()))
    missed = [secrets[i] for i in range(len(secrets)) if not found[i]]
    wrong = [texts[i][s.start : s.end] for i in range(len(secrets), len(texts)) for s in found[i]]
    assert hits >= 0.9 * len(secrets) and hits >= 0.9 * total, (hits, len(secrets), total, missed, wrong)
    empty = spark.createDataFrame([], SCHEMA)
    assert train_field(empty) is None and find_secrets(empty, None).count() == 0


def test_field_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(5)
    features, tags = rng.integers(0, 9, (4, 5, 3)), rng.integers(0, 3, (4, 5)).astype(np.int8)
    emit = np.zeros((secret_scan.BUCKETS, 3))
    emit[:9] = rng.normal(size=(9, 3))
    field = secret_scan.Field(emit, rng.normal(size=(3, 3)))

    def mean_log_likelihood():
        total = 0.0
        for x, y in zip(features, tags):
            def score(path):
                return sum(field.emit[x[t], k].sum() for t, k in enumerate(path)) + sum(field.step[a, b] for a, b in zip(path, path[1:]))

            total += score(y) - np.log(sum(np.exp(score(p)) for p in itertools.product(range(3), repeat=5)))
        return total / len(features)

    slope, turn = secret_scan._slopes(field, features, tags)
    for weights, gradient, cells in ((field.emit, slope, [(0, 0), (4, 1), (8, 2)]), (field.step, turn, [(0, 1), (1, 2), (2, 2)])):
        for cell in cells:
            kept = weights[cell]
            weights[cell] = kept + 1e-5
            up = mean_log_likelihood()
            weights[cell] = kept - 1e-5
            down = mean_log_likelihood()
            weights[cell] = kept
            assert gradient[cell] + secret_scan.DECAY * kept == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_viterbi_is_best_path():
    rng = np.random.default_rng(0)
    field = secret_scan.Field(np.zeros((4, 3), np.float32), rng.normal(size=(3, 3)).astype(np.float32))
    for length in (1, 2, 5):
        emit = rng.normal(size=(20, length, 3)).astype(np.float32)
        best = secret_scan.viterbi(field, emit)
        for k in range(20):
            def value(path):
                whole = [0, *path, 0]
                return sum(field.step[a, b] for a, b in zip(whole, whole[1:])) + sum(emit[k, t, y] for t, y in enumerate(path))

            paths = [[]]
            for _ in range(length):
                paths = [[*p, y] for p in paths for y in range(3)]
            assert value(best[k].tolist()) == pytest.approx(max(map(value, paths)), abs=1e-4)


def test_tag_without_pruning_is_the_same():
    rng = np.random.default_rng(1)
    step = rng.normal(size=(3, 3)).astype(np.float32)
    emit = rng.normal(size=(64, 3)).astype(np.float32) * 3
    emit[:, 0] += 2
    field = secret_scan.Field(emit, step)  # token t has the one feature t
    features = np.arange(64, dtype=np.int32)[:, None]
    rows = np.array([0, 20, 20, 64])
    whole = np.concatenate([secret_scan.viterbi(field, emit[None, a:b])[0] for a, b in ((0, 20), (20, 64))])
    assert (secret_scan.tag(field, features, rows) == whole).all()


def test_contained_items(spark):
    docs = prose(40, 41, 100, 2000)
    items = prose(12, 42, 20, 60) + [None, "", "tiny item", "one"]
    docs[3] += " " + items[0]
    docs[4] = items[1].upper() + " " + docs[4]
    w = items[2].split()
    docs[5] += " " + " ".join(w[: len(w) * 95 // 100])
    docs[6] += " " + " ".join(w[: len(w) // 2])
    docs[7] += " tiny item at the end"
    docs += ODD
    table = spark.createDataFrame([(i, t, 5) for i, t in enumerate(items)], "item_id long, text string, id long")
    expected = set()
    for i, t in enumerate(docs):
        for k, item in enumerate(items):
            size = min(5, len(words(item)))
            if size and len(words(t)) >= size:
                s, x = shingle_set(t, size), shingle_set(item, size)
                if len(s & x) >= 0.8 * len(x):
                    expected.add((i, k, len(s & x), len(x)))
    assert len(expected) >= 4
    got = contained_items(frame(spark, docs), table)
    assert {(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in got.collect()} == expected
    kept = drop_contaminated(frame(spark, docs), table)
    assert {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {e[0] for e in expected}
    assert kept.schema == frame(spark, []).schema
    assert contained_items(spark.createDataFrame([], SCHEMA), table).count() == 0
    assert contained_items(frame(spark, docs), table.limit(0)).count() == 0
    assert drop_contaminated(frame(spark, docs), table.limit(0)).count() == len(docs)


def test_items_in_several_blocks(spark, monkeypatch):
    from docquarry.llm import decontaminate

    items = prose(12, 42, 20, 60)
    docs = [f"{a} {b}" for a, b in zip(prose(12, 43), items)]
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 100)
    got = contained_items(frame(spark, docs), table)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i in range(12)}


def test_quality_learns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/../sf0.01/labels.parquet")
    from docquarry.llm.queries import op8_quality

    scores = op8_quality(spark, f"{sf_dir}/../sf0.01")
    assert scores.count() == docs.count()
    held = scores.where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in held) / len(held)
    good = [r for r in held if r.quality == 1]
    assert right >= 0.95 and sum(r.predicted for r in good) / len(good) >= 0.99
    assert {r.held_out for r in scores.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1} == {True}


def test_quality_odd_rows(spark):
    docs = frame(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int")
    weights = train_quality(docs, none)
    assert {(r.score, r.predicted) for r in quality_scores(docs, weights).collect()} == {(0.5, 1)}
    assert drop_low_quality(docs, weights).count() == len(ODD)
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 1), (3, 0), (3, 1), (7, 0)], "doc_id long, quality int")
    scores = quality_scores(docs, train_quality(docs, labels)).collect()
    assert len(scores) == len(ODD) and all(0 <= r.score <= 1 for r in scores)
    assert quality_scores(spark.createDataFrame([], SCHEMA), weights).count() == 0


def plain_model(texts):
    """Interpolated modified Kneser-Ney of word pairs, from dictionaries."""
    lines = [[*words(t), "end"] for t in texts]
    count = Counter(w for line in lines for w in line)
    pairs = Counter(p for line in lines for p in zip(["start", *line], line))
    spread = Counter(w for _, w in pairs)
    total, kinds = Counter(), defaultdict(Counter)
    for (v, _), c in pairs.items():
        total[v] += c
        kinds[v][min(c, 3)] += 1

    def discounts(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        if not n[0] or not n[1]:
            return [0, 0.5, 0.5, 0.5]
        y = n[0] / (n[0] + 2 * n[1])
        guess = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
        return [0, *(min(max(d, 0.0), k) for k, d in enumerate(guess, 1))]

    d2, d1 = discounts(pairs.values()), discounts(spread.values())
    size, kept = len(count), sum(d1[min(c, 3)] for c in spread.values())

    def lower(w):
        c = spread.get(w, 0)
        return max(c - d1[min(c, 3)], 0) / len(pairs) + kept / len(pairs) / (size + 1)

    def chance(v, w):
        if v not in total:
            return lower(w)
        c = pairs.get((v, w), 0)
        mass = sum(d2[k] * kinds[v][k] for k in (1, 2, 3))
        return (max(c - d2[min(c, 3)], 0) + mass * lower(w)) / total[v]

    return count, chance


def test_ngram_scores(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(40)], k=rng.randint(0, 60))) for _ in range(80)] + ODD
    new = texts[:30] + ["never seen words", "W1 w2 unseen w1 w2", None]
    count, chance = plain_model(texts)
    n, v = sum(count.values()), len(count)
    scores = {r.doc_id: r for r in ngram_scores(frame(spark, new), train_ngrams(frame(spark, texts))).collect()}
    for i, t in enumerate(new):
        line = [*words(t), "end"]
        assert (scores[i].n_tokens, scores[i].n_known) == (len(line), sum(w in count for w in line))
        assert scores[i].train_tokens == n
        assert scores[i].base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in line))
        known = [w if w in count else None for w in line]
        expected = sum(math.log10(chance(a, b)) for a, b in zip(["start", *known], known))
        assert scores[i].score == pytest.approx(expected), t
    for context in ("start", b"w0", b"w7", "nothing"):
        assert sum(chance(context, w) for w in [*count, None]) == pytest.approx(1.0)


def test_ngram_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = train_ngrams(empty)
    assert [(r.n_known, r.train_tokens, r.score) for r in ngram_scores(frame(spark, ["a b"]), model).collect()] == [(0, 0, 0.0)]
    assert ngram_scores(empty, model).count() == 0
