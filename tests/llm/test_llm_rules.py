"""Quality rules against a plain version over all pairs of suffixes."""

import random

from llm_samples import ODD, SCHEMA, frame

from docquarry.llm.quality_rules import Limits, quality_rules

BREAKS = " \t\n\v\f\r"


def split_words(text):
    for mark in BREAKS:
        text = text.replace(mark, " ")
    return [w for w in text.split(" ") if w]


def plain(text, limits):
    text = text or ""
    w = split_words(text)
    n = len(w)
    longest = [0] * n
    for p in range(n):
        for q in range(p):
            k = 0
            while p + k < n and w[p + k] == w[q + k]:
                k += 1
            longest[p], longest[q] = max(longest[p], k), max(longest[q], k)
    spans = {p + j for p in range(n) if longest[p] >= limits.min_words for j in range(longest[p])}
    windows = {p + j for p in range(n) if longest[p] >= 8 for j in range(8)}
    lines = [x for x in text.split("\n") if split_words(x)]
    chars, covered = sum(map(len, w)), sum(len(w[i]) for i in spans)
    most = max((x for x in longest if x >= limits.min_words), default=0)
    failed = n < 20 or 100 * len(windows) > 30 * n
    bad = 100 * covered > limits.covered_percent * chars or (
        most >= limits.long_words and 100 * most > limits.longest_percent * n
    )
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return n, chars, symbols, len(lines) - len(set(lines)), len(windows), covered, most, failed, not failed and not bad


NAMES = "n_words word_chars n_symbols n_dup_lines n_repeat_words covered_chars longest_repeat base_failed kept".split()


def texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        vocabulary = [f"w{i}é" for i in range(rng.choice([2, 3, 6, 20, 200]))]
        one = "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", " \t", "$ ", " "]) for _ in range(rng.randrange(90)))
        yield one + rng.choice(["\n", " ", ""]) + one[: rng.choice([0, 0, 40, 400])]


def compare(spark, all_texts, limits=Limits()):
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in quality_rules(frame(spark, all_texts), limits=limits).collect()}
    assert got == {i: plain(t, limits) for i, t in enumerate(all_texts)}
    return got


def test_rules_equal_plain_version(spark):
    got = compare(spark, list(texts(1, 120)))
    assert {True, False} == {r[-1] for r in got.values()}


def test_rules_with_other_limits(spark):
    sample = list(texts(2, 40))
    for limits in (Limits(min_words=2), Limits(min_words=9, long_words=1, longest_percent=1), Limits(3, 0, 1, 0)):
        compare(spark, sample, limits)


def test_method_fails_what_the_base_lets_pass(spark):
    rng = random.Random(5)
    fresh = lambda n: [f"x{rng.randrange(10**9)}" for _ in range(n)]
    passage, shorts = fresh(40), fresh(6)
    long = " ".join(fresh(60) + passage + fresh(60) + passage + fresh(68))  # 80 of 268 words repeat: 30 %
    fragments = " ".join(x for _ in range(8) for x in shorts + fresh(4))  # six words at a time, eight times
    kept = {i: r for i, r in compare(spark, [long, fragments, " ".join(fresh(300))]).items()}
    assert [kept[i][7] for i in range(3)] == [False, False, False]
    assert [kept[i][8] for i in range(3)] == [True, False, True]
    strict = compare(spark, [long], Limits(longest_percent=14))
    assert strict[0][8] is False


def test_rules_on_odd_texts(spark):
    short = [t if len(t or "") < 1000 else t[:600] for t in ODD]
    compare(spark, short)
    got = {r.doc_id: r for r in quality_rules(frame(spark, ODD)).collect()}
    long = got[12]
    assert (long.n_words, long.n_repeat_words, long.longest_repeat, long.kept) == (30_000, 30_000, 29_999, False)
    assert len(got) == len(ODD) and got[0].n_words == 0 and got[0].base_failed


def test_rules_on_empty_tables_repeated_and_null_ids(spark):
    assert quality_rules(spark.createDataFrame([], SCHEMA)).collect() == []
    found = quality_rules(frame(spark, ["a b", "a b", None], [None, None, 4])).collect()
    assert sorted((r.doc_id is None, r.n_words) for r in found) == [(False, 0), (True, 2), (True, 2)]
