"""Exact, near and substring dedup against plain versions."""

import hashlib
import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from llm_samples import ODD, SCHEMA, components, edited, frame, prose, shingle_set

from docquarry.llm import substring_dedup
from docquarry.llm.exact_dedup import drop_exact_duplicates, exact_groups, summarise
from docquarry.llm.near_dedup import drop_near_duplicates, near_groups
from docquarry.llm.substring_dedup import K, _between, align, anchors, chain, repeated_passages


def plain_exact(texts):
    same = {}
    lowered = [(t or "").encode().lower() for t in texts]
    for i, t in enumerate(lowered):
        same.setdefault(t, []).append(i)
    return {
        i: (max(same[t]), len(same[t]), max(same[t]) == i, hashlib.sha256(t).hexdigest()) for i, t in enumerate(lowered)
    }


@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_exact_groups(spark, counters):
    texts = ODD + ["Hot Copy"] * 300 + ["hot copy"] * 100 + prose(50) + prose(10)
    got = {r[0]: tuple(r)[1:] for r in exact_groups(frame(spark, texts), counters=counters).collect()}
    assert got == plain_exact(texts)


def test_exact_keeps_columns_and_empty_table(spark):
    docs = frame(spark, ODD + ["same", "SAME"])
    kept = drop_exact_duplicates(docs)
    assert kept.schema == docs.schema
    expected = {i for i, v in plain_exact(ODD + ["same", "SAME"]).items() if v[2]}
    assert {r.doc_id for r in kept.collect()} == expected
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_groups(empty).count() == 0 and drop_exact_duplicates(empty).count() == 0


def test_exact_null_ids_and_repeated_rows(spark):
    docs = frame(spark, ["a", "a", "a", "b", "b"], [None, 1, 1, None, None])
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact_groups(docs).collect())
    assert got == [("1", "1", 3, True)] * 2 + [("None", "1", 3, False)] + [("None", "None", 2, True)] * 2


def test_summary_keeps_frequent():
    rng = np.random.default_rng(0)
    stream = rng.permutation(np.concatenate([np.repeat(7, 400), np.repeat(8, 300), np.arange(100, 700)]))
    held = pd.Series(dtype="int64")
    for part in np.array_split(stream, 13):
        held = summarise(held.add(pd.Series(part).value_counts(), fill_value=0).astype("int64"), 4)
    assert len(held) <= 4 and {7, 8} <= set(held.index)
    assert held[7] <= 400 and held[7] >= 400 - 1300 / 5


def near_sample():
    rng = random.Random(5)
    base = prose(60, 1)
    texts = list(ODD)
    for t in base:
        texts += [t, t.upper()] + [edited(t, rng, share) for share in (0.0, 0.01, 0.02, 0.05, 0.2)]
    hub = prose(1, 9, 150, 151)[0]
    texts += [edited(hub, rng, 0.02) for _ in range(120)]  # one large group of near copies
    return texts


@pytest.mark.parametrize("size", [4, 5])
def test_near_groups(spark, size):
    texts = near_sample()
    sets = {i: shingle_set(t, size) for i, t in enumerate(texts)}
    expected = components(sets, 80)
    got = {r.doc_id: r for r in near_groups(frame(spark, texts), shingle=size).collect()}
    assert {i: r.component_id for i, r in got.items()} == expected
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


@pytest.mark.parametrize("limits", [
    {"REGION_ROWS": 10}, {"REGION_ROWS": 10, "UNIT_SHINGLES": 600, "KEY_ROWS": 3, "BINS": 8},
])
def test_near_crowded_regions_are_finished(spark, monkeypatch, limits):
    from docquarry.llm import near_dedup

    for name, value in limits.items():
        monkeypatch.setattr(near_dedup, name, value)
    rng = random.Random(3)
    hub = prose(1, 4, 200, 201)[0]
    other = edited(hub, rng, 0.12)
    texts = [edited(hub, rng, 0.02) for _ in range(40)] + [edited(other, rng, 0.02) for _ in range(40)]
    # Copies of one template, most of them just not similar enough, with a few links among them.
    texts += [edited(hub, rng, rng.choice([0.04, 0.06, 0.1])) for _ in range(60)]
    expected = components({i: shingle_set(t, 5) for i, t in enumerate(texts)}, 80)
    assert len(set(expected.values())) > 5
    assert {r.doc_id: r.component_id for r in near_groups(frame(spark, texts)).collect()} == expected


def test_near_template_without_neighbours(spark, monkeypatch):
    """Links are found by the exact search alone, where no sorted order gives a pair."""
    from docquarry.llm import near_dedup

    rng = random.Random(8)
    hub = prose(1, 4, 200, 201)[0]
    texts = [edited(hub, rng, rng.choice([0.03, 0.06])) for _ in range(60)]
    expected = components({i: shingle_set(t, 5) for i, t in enumerate(texts)}, 80)
    rows = frame(spark, texts).selectExpr("doc_id id", "text")
    sizes = rows.selectExpr("id", "cast(size(split(text, ' ')) as long) n", "7L region")
    for limits in ({"REGION_ROWS": 8, "KEY_ROWS": 1000}, {"REGION_ROWS": 8, "KEY_ROWS": 0}):
        for name, value in limits.items():
            monkeypatch.setattr(near_dedup, name, value)
        none = spark.createDataFrame([], "node long, component long")
        labels = {r.node: r.component for r in near_dedup._finished(sizes, none, rows, 5, 80).collect()}
        assert {i: labels.get(i, i) for i in expected} == expected, limits


def test_near_signatures_of_large_sets():
    from docquarry.llm import near_dedup

    factors = (near_dedup.seeds(160, salt=1000) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    rng = np.random.default_rng(2)
    for count in (5, 400, 200_000):
        a, b = (rng.integers(0, 2**64, count, dtype=np.uint64) for _ in range(2))
        left, right = near_dedup._signature(a, factors), near_dedup._signature(b, factors)
        assert (left == right).sum() <= 2
        assert (near_dedup._signature(np.concatenate([a, b]), factors) == np.minimum(left, right)).all()


def test_near_null_ids_repeats_and_empty_table(spark):
    docs = frame(spark, ["a b c d e f", "a b c d e f", None, "a b c d e f"], [None, 3, 4, 3])
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_groups(docs).collect())
    assert got == [("3", "3", True), ("3", "3", True), ("4", "4", True), ("None", "None", True)]
    empty = spark.createDataFrame([], SCHEMA)
    assert near_groups(empty).count() == 0
    assert drop_near_duplicates(empty).schema == empty.schema


def test_passages(spark):
    rng = random.Random(2)
    texts = prose(30, 11, 150, 300)
    shared = prose(1, 12, 80, 81)[0]
    fuzzy = " ".join(w if k % 27 else "changed" for k, w in enumerate(shared.split()))
    carriers = {3: shared, 8: shared, 15: fuzzy, 20: shared.upper()}
    for i, passage in carriers.items():
        w = texts[i].split()
        at = rng.randrange(len(w))
        texts[i] = " ".join(w[:at]) + "\n" + passage + " " + " ".join(w[at:])
    texts += ODD
    found = repeated_passages(frame(spark, texts)).collect()
    across = [r for r in found if r.doc_id != r.partner_id]
    assert {r.doc_id for r in across} | {r.partner_id for r in across} == set(carriers)
    for r in across:
        assert r.n_words >= 50 and r.identity >= 0.8
        a = texts[r.doc_id].lower().split()[r.start : r.end]
        b = texts[r.partner_id].lower().split()[r.partner_start : r.partner_end]
        assert min(len(a), len(b)) == r.n_words >= (75 if r.partner_id == 3 else 50)
    # A text that repeats one word is a repeated passage of itself.
    assert {(r.doc_id, r.partner_id) for r in found} - {(r.doc_id, r.partner_id) for r in across} == {(42, 42)}


def test_passages_in_many_texts_link_all(spark, monkeypatch):
    from docquarry.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "FREQUENT", 3)
    monkeypatch.setattr(substring_dedup, "RANGE_BYTES", 5000)
    monkeypatch.setattr(substring_dedup, "PACK_WORDS", 2000)
    shared = prose(1, 12, 60, 61)[0]
    texts = [f"{t} {shared}" for t in prose(100, 21, 60, 90)] + prose(10, 22)
    found = repeated_passages(frame(spark, texts)).collect()
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        a, b = sorted((find(r.doc_id), find(r.partner_id)))
        parent[b] = a
    assert {find(i) for i in range(100)} == {0} and all(find(i) == i for i in range(100, 110))
    assert len(found) < 600
    assert repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def best_window(a, b):
    """Whether 50 words or more of two equally placed passages have an identity of 0.8."""
    same = np.concatenate([[0], np.cumsum([x == y for x, y in zip(a, b)])])
    return any(5 * (same[j] - same[i]) >= 4 * (j - i) for i in range(len(a)) for j in range(i + 50, len(a) + 1))


def test_fuzzy_passages_are_found(spark):
    rng = random.Random(4)
    texts, expected = [], set()
    around = prose(800, 41, 60, 90)
    for kind in [1 / 10, 3 / 20, 1 / 5] * 40 + [5, 8, 10] * 10:
        passage = prose(1, len(texts) + 1000, 60, 61)[0].split()
        change = (lambda k: k % kind == kind - 1) if kind > 1 else (lambda k: rng.random() < kind)
        fuzzy = [f"x{rng.randrange(10**9)}" if change(k) else w for k, w in enumerate(passage)]
        if best_window(passage, fuzzy):
            expected.add((len(texts) + 1, len(texts)))
        for one in (passage, fuzzy):
            before, after = around[len(texts)], around[len(texts) + 400]
            texts.append(f"{before} {' '.join(one)} {after}")
    found = repeated_passages(frame(spark, texts)).collect()
    assert {(r.doc_id, r.partner_id) for r in found} == expected and len(expected) > 100
    assert all(r.n_words >= 50 and r.identity >= 0.8 for r in found)


def plain_chain(found):
    """Best score of a chain by all pairs."""
    found = sorted(found)
    score = []
    for i, (a, b, size) in enumerate(found):
        best = 0.0
        for j, (x, y, width) in enumerate(found[:i]):
            if x + width <= a and y + width <= b:
                best = max(best, score[j] - 0.25 * (a - x - width + b - y - width))
        score.append(size + best)
    return max(score)


def test_chain_is_best():
    rng = random.Random(1)
    for _ in range(200):
        found = list({(rng.randrange(60), rng.randrange(60), rng.randrange(1, 9)) for _ in range(rng.randrange(1, 14))})
        path = chain(found)[0]
        score = sum(m[2] for m in path)
        score -= 0.25 * sum(n[0] - m[0] - m[2] + n[1] - m[1] - m[2] for m, n in zip(path, path[1:]))
        assert score == pytest.approx(plain_chain(found))


def test_anchors_and_alignment():
    assert anchors(np.array([0, 5, 40]), np.array([10, 15, 90])) == [(0, 10, K + 5), (40, 90, K)]
    a = np.arange(100, dtype=np.uint64)
    b = np.concatenate([a[:40], np.array([900], np.uint64), a[42:]])
    assert align(a, b, [(0, 0, 40), (42, 41, 58)]) == (0, 100, 0, 99, 98)
    assert _between(np.array([1, 2, 3, 4]), np.array([2, 9, 4])) == 2


@pytest.mark.parametrize("part", [500_000, 40])
def test_components(spark, monkeypatch, part):
    from docquarry.llm import components as module

    monkeypatch.setattr(module, "PART_LINKS", part)
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(5, 5), (3, 2), (2, 3)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    rng.shuffle(links)
    parent = list(range(300))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    found = {r.node: r.component for r in module.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: find(n) for a, b in links if a != b for n in (a, b)}
    assert module.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_passages_where_all_short_seeds_are_common(spark):
    rng = random.Random(8)
    for vocabulary, texts in ((6, 400), (12, 200)):
        names = [f"w{k}" for k in range(vocabulary)]
        lines = [rng.choices(names, k=rng.randint(60, 120)) for _ in range(texts)]
        carriers = rng.sample(range(texts), 80)
        expected = set()
        for a, b in zip(carriers[::2], carriers[1::2]):
            passage = rng.choices(names, k=60)
            for i in (a, b):
                at = rng.randrange(len(lines[i]))
                lines[i][at:at] = passage
            expected.add((max(a, b), min(a, b)))
        found = repeated_passages(frame(spark, [" ".join(w) for w in lines])).collect()
        whole = {(r.doc_id, r.partner_id) for r in found if r.common >= 55}
        assert expected <= whole and all(r.n_words >= 50 and r.identity >= 0.8 for r in found)


@pytest.mark.parametrize("share", [0.05, 0.1, 0.15])
def test_passages_with_left_out_and_added_words(spark, share):
    """At least nine in ten of the pairs whose passages still have 50 words of identity 0.8 are found."""
    rng = random.Random(int(1000 * share))
    around, texts, pairs = prose(160, 61, 60, 90), [], []
    for k in range(80):
        passage = prose(1, 5000 + k, 80, 81)[0].split()
        other = []
        for w in passage:
            draw = rng.random()
            if draw < share / 3:
                continue
            other.append(f"y{rng.randrange(10**9)}" if draw < 2 * share / 3 else w)
            if draw > 1 - share / 3:
                other.append(f"z{rng.randrange(10**9)}")
        for j, one in enumerate((passage, other)):
            texts.append(f"{around[2 * k + j]} {' '.join(one)} {around[(2 * k + j + 7) % 160][:200]}")
        pairs.append((2 * k + 1, 2 * k))
    found = {(r.doc_id, r.partner_id) for r in repeated_passages(frame(spark, texts)).collect()}
    assert len(found & set(pairs)) >= 0.9 * len(pairs)


def test_changed_passages_whose_seeds_other_texts_hold_by_chance(spark):
    """Every shared seed has other carriers, a different one each, and they come before both texts; no run of ten words is left."""
    rng = random.Random(62)
    texts, pairs = [], []
    for k in range(20):
        passage = [f"p{k}x{i}" for i in range(50)]
        # Ten changed words leave eleven runs; seven of them have four words, the least that fifty words allow.
        changed = set(np.cumsum([5, 4] * 3 + [5] * 4) - 1)
        other = [f"y{rng.randrange(10**9)}" if i in changed else w for i, w in enumerate(passage)]
        for i in range(47):
            texts.append(" ".join([f"a{rng.randrange(10**9)}" for _ in range(60)] + passage[i : i + 4]))
        pairs.append((len(texts) + 1, len(texts)))
        texts += [" ".join([f"b{rng.randrange(10**9)}" for _ in range(60)] + one) for one in (passage, other)]
    found = {(r.doc_id, r.partner_id) for r in repeated_passages(frame(spark, texts)).collect()}
    assert found == set(pairs)


def common_seeds(rng, passage, texts):
    """Texts that hold every four words of a passage, in any order and with other words between."""
    other = lambda n: [f"c{rng.randrange(10**9)}" for _ in range(n)]
    turns = [rng.sample(range(len(passage) - 3), len(passage) - 3) for _ in range(texts)]
    return [" ".join(w for i in turn for w in passage[i : i + 4] + other(4)) for turn in turns]


def test_changed_passages_whose_seeds_are_all_in_large_groups(spark, monkeypatch):
    """Only the first text of each seed was matched with the others, and that one holds no more than the seed."""
    rng = random.Random(63)
    texts, pairs = [], []
    for k in range(4):
        passage = [f"q{k}x{i}" for i in range(50)]
        changed = set(np.cumsum([5, 4] * 3 + [5] * 4) - 1)
        other = [f"y{rng.randrange(10**9)}" if i in changed else w for i, w in enumerate(passage)]
        texts += common_seeds(rng, passage, 30)
        pairs.append((len(texts) + 1, len(texts)))
        texts += [" ".join([f"b{rng.randrange(10**9)}" for _ in range(60)] + one) for one in (passage, other)]
    docs = frame(spark, texts)
    found = repeated_passages(docs).collect()
    assert {(r.doc_id, r.partner_id) for r in found} == set(pairs) and all(r.n_words >= 50 and r.identity >= 0.8 for r in found)
    for name, value in (("FREQUENT", 3), ("RANGE_BYTES", 20_000), ("PACK_WORDS", 5_000), ("BLOCK", 7), ("COMMON_SEEDS", 50)):
        monkeypatch.setattr(substring_dedup, name, value)
    assert {(r.doc_id, r.partner_id) for r in repeated_passages(docs).collect()} == set(pairs)


def test_variants_of_a_line_that_many_texts_share(spark):
    """Ninety texts have one line of 26 words; what follows has no four words in common, but with some texts enough single ones."""
    rng = random.Random(64)
    line, ends = prose(1, 101, 26, 26)[0].split(), [w.split() for w in prose(6, 102, 30, 30)]
    tails = []
    for i in range(90):
        end = ends[i % 9] if i % 9 < 6 else prose(1, 500 + i, 30, 30)[0].split()
        tails.append(line + [w if (j + 1) % 4 and j % 11 != i % 11 else f"z{rng.randrange(10**9)}" for j, w in enumerate(end)])
    texts = [f"{prose(1, 700 + i, 60, 90)[0]} {' '.join(tail)}" for i, tail in enumerate(tails)]
    alike = {(i, j) for i in range(90) for j in range(i) if best_window(tails[i], tails[j])}
    found = {(r.doc_id, r.partner_id) for r in repeated_passages(frame(spark, texts)).collect()}

    def linked(pairs):
        group = list(range(90))
        for a, b in pairs:
            one, other = sorted((group[a], group[b]))
            group = [one if g == other else g for g in group]
        return group

    assert linked(found) == linked(alike) and len(alike) > 90 and len(set(linked(alike))) > 30


def test_every_place_of_a_seed_in_a_text_is_matched(spark):
    """The first place of each seed in a text is a stray one; the passage comes later."""
    rng = random.Random(65)
    passage = [f"s{i}" for i in range(50)]
    changed = set(np.cumsum([5, 4] * 3 + [5] * 4) - 1)
    other = [f"y{rng.randrange(10**9)}" if i in changed else w for i, w in enumerate(passage)]
    texts = [f"{common_seeds(rng, passage, 1)[0]} {' '.join(one)}" for one in (passage, other)]
    found = {(r.doc_id, r.partner_id) for r in repeated_passages(frame(spark, texts)).collect()}
    assert (1, 0) in found


def test_passages_of_rows_that_repeat_an_id(spark):
    shared, other = prose(2, 71, 70, 71)
    texts = [f"{prose(1, 72)[0]} {shared}", f"{other} {prose(1, 73)[0]}", f"{shared} {prose(1, 74)[0]}", f"{other} x y z", f"{other} x y z", shared]
    found = repeated_passages(frame(spark, texts, [5, 5, 7, 9, 9, None])).collect()
    assert {(r.doc_id, r.partner_id) for r in found} == {(7, 5), (9, 5)}
    same = repeated_passages(frame(spark, [f"{shared} a b", f"c d {shared}"], [4, 4])).collect()
    assert [(r.doc_id, r.partner_id) for r in same] == [(4, 4)]


def test_every_carrier_has_rows_under_its_own_id(spark, tmp_path):
    from docquarry.llm.queries import op2_substring_dedup

    shared, twice = prose(1, 81, 60, 61)[0], prose(1, 82, 60, 61)[0]
    texts = [f"{t} {shared}" if i in (2, 5, 9) else t for i, t in enumerate(prose(12, 83))] + [f"{twice} and {twice}"]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    query = op2_substring_dedup(spark, str(tmp_path))
    rows = {tuple(r) for r in query.collect()}
    once = {tuple(r) for r in repeated_passages(frame(spark, texts)).collect()}
    assert rows == once | {(*r[3:6], *r[:3], *r[6:]) for r in once} and query.columns == repeated_passages(frame(spark, texts)).columns
    assert {r[0] for r in rows} == {2, 5, 9, 12}


def keyed(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["key", "text"])


def test_seeds_take_little_memory():
    """Executors were stopped over 3,000 MB: packing took 131 bytes a seed, matching a range 54 beside its rows."""
    picks = np.random.default_rng(5).integers(0, 100_000, (2_000, 300)).tolist()
    batch = keyed([" ".join(f"w{x}" for x in row) for row in picks])
    tracemalloc.start()
    try:
        packed = pa.Table.from_batches(substring_dedup._packed(1)(iter([batch])))
        packing = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        substring_dedup._repeats(packed)
        matching = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    count = sum(len(seeds) // 4 for seeds in packed.column("seeds").to_pylist())
    assert count > 600_000 and packing < 80 * count and matching < 40 * count


def test_small_steps_give_the_same_matches(monkeypatch):
    shared, common = prose(2, 91, 60, 61)
    texts = [f"{t} {shared}" if i % 9 == 0 else f"{common} {t}" if i % 2 else t for i, t in enumerate(prose(90, 92, 60, 90))]
    texts += [" ".join([*prose(1, 93, 66_000, 66_001), shared]), texts[0]]

    def matches():
        packed = pa.Table.from_batches(substring_dedup._packed(3)(iter([keyed(texts[:50]), keyed(texts)])))
        parts = [packed.filter(pa.compute.equal(packed.column("range"), k)) for k in range(3)]
        return [row for part in parts for row in substring_dedup._repeats(part).to_pylist()], packed.num_rows

    found, rows = matches()
    for name, value in (("SLICE_BYTES", 500), ("BATCH_BYTES", 100), ("_STEP", 7)):
        monkeypatch.setattr(substring_dedup, name, value)
    again, _ = matches()
    assert again == found and found and rows == 4  # one pack: seeds of three ranges, and one row of frequent matches


def test_passages_of_few_words_are_linked(spark):
    """The first text with sixteen times one word may have no fifty, and so link none of those that do."""
    runs = [("of " * 20,) * 40, ("of " * 60,) * 4, ("er " * 12 + "es " * 38,) * 4, ("la la le " * 20,) * 4, ("to " * 10 + "by " * 30 + "to " * 10,) * 4]
    runs += [("er " * 20 + "es " * 24 + "et " * 20,) * 40, ("la la le " * 7,) * 40, ("by " * 20,) * 40]
    kinds = [run for same in runs[:1] + runs[5:] + runs[1:5] for run in same]
    around = prose(2 * len(kinds), 95, 30, 31)
    texts = [f"{around[2 * i]} {run} {around[2 * i + 1]}" for i, run in enumerate(kinds)]
    linked = list(range(len(texts)))
    for r in repeated_passages(frame(spark, texts).coalesce(1)).collect():
        one, other = linked[r.doc_id], linked[r.partner_id]
        linked = [one if k == other else k for k in linked]
    for first in range(160, 176, 4):
        assert len({linked[i] for i in range(first, first + 4)}) == 1, kinds[first]


def test_exact_copies_are_dropped_by_row(spark):
    rows = [(5, "a"), (9, "A"), (5, "b"), (7, "c"), (7, "C"), (None, "d"), (None, "D"), (None, "e"), (3, "e"), (6, None), (2, "")]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    kept = [(r.doc_id, (r.text or "").lower()) for r in drop_exact_duplicates(docs).collect()]
    assert sorted(kept, key=str) == sorted([(9, "a"), (5, "b"), (7, "c"), (None, "d"), (3, "e"), (6, "")], key=str)
    assert drop_exact_duplicates(docs).columns == docs.columns
