"""Small tables and plain versions that the operators are compared with."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, id long, n long, key string, component long, seed long, score string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def shingle_set(text, size):
    w = words(text)
    if not w:
        return frozenset()
    size = min(size, len(w))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def rows(texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return [(i, t, "en", 7, 7, "k", 7, 7, "s") for i, t in zip(ids, texts)]


def frame(spark, texts, ids=None):
    return spark.createDataFrame(rows(texts, ids), SCHEMA)


def prose(count, seed=0, low=60, high=220):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    return [" ".join(rng.choices(vocabulary, k=rng.randint(low, high))) for _ in range(count)]


def edited(text, rng, share):
    w = text.split()
    for _ in range(int(len(w) * share)):
        w[rng.randrange(len(w))] = "x" + str(rng.randrange(10**6))
    return " ".join(w)


#: Nulls, empty and blank texts, one word, ties and repeated rows, a very long text, other scripts.
ODD = [
    None, "", "   \n\t ", "word", "WORD", "word", "a b c", "a b c d", "A B C D", "é É ß", "日本語 テキスト", "a\x00b c",
    "long " * 30_000, "x" * 50_000, "😀 and ▁ mark ▁▁", "tab\tand\nline\r\nends", None, "",
]


def components(sets, percent):
    """Smallest id reachable over links of sufficient similarity, by all pairs."""
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
