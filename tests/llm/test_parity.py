"""Jaccard join against all pairs, with groups forced through the search across components."""

import random

import numpy as np
import xxhash

from tessera.llm import parity
from tessera.llm.parity import deduplicated, jaccard_components


def brute(rows, percent, width):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        if w and i is not None:
            sets.setdefault(i, set()).add(frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))))
    ids, root = sorted({i for i, _ in rows if i is not None}), {}
    for i in ids:
        root[i] = i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in sets:
        for y in sets:
            if x < y and any(100 * len(a & b) >= percent * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def texts(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    common = " ".join(word() for _ in range(12))
    base = [[word() for _ in range(r.choice((3, 6, 25, 60, 200)))] for _ in range(25)]
    rows = []
    for b in base:
        for _ in range(r.choice((1, 2, 8))):
            w = list(b)
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                w[r.randrange(len(w))] = word()
            rows.append(" ".join(w) + (" " + common if r.random() < 0.4 else ""))
    drift = [word() for _ in range(150)]
    for _ in range(40):                       # a chain of near copies whose ends are far apart
        drift[r.randrange(150)] = word()
        rows.append(" ".join(drift))
    rows += [rows[-1]] * 6 + ["", None, "   ", "one", "ONE", "one two three", rows[0].upper()]
    return list(enumerate(rows))


def result(df):
    return {r["doc_id"]: r["component_id"] for r in df.collect()}


def test_components_equal_all_pairs(spark):
    for seed, percent, width, paired in ((1, 85, 4, 1), (3, 80, 5, 32)):
        rows = texts(seed)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert result(jaccard_components(docs, percent, width, paired)) == brute(rows, percent, width), seed


def test_long_texts_are_split_whole():
    text = "  ".join(random.Random(5).choice(("Ab", "é\u00a0x", "long" * 9)) for _ in range(60_000)) + "\n"
    want = [xxhash.xxh3_64_intdigest(w) for w in text.encode().lower().split()]
    assert len(text) > 3 * parity.PIECE
    assert np.array_equal(parity.word_hashes(text, parity.WordHashes()), np.array(want, np.uint64))


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long, "x"), (2, long + " end", "x"), (3, None, None), (4, "", "x"), (None, long, "x"), (5, "a b c d e f", "x"),
            (5, "a b c d e f", "x"), (6, "a b c d e f", "x"), (7, "k l m n o p", "x"), (7, "a b c d e f", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, root string")
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 4), (None, None), (5, 5), (6, 5), (7, 5)}
    kept = sorted(deduplicated(docs).select("doc_id", "root").collect(), key=str)
    assert [r["doc_id"] for r in kept] == [1, 3, 4, 5, None]
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard_components(empty).count() == 0


def test_linked_sets_of_all_small_sizes_share_a_key():
    """Every size pair of 10 to 60 shingles, one set within the other or both reaching out, at exactly the most differing shingles."""
    r = np.random.default_rng(7)
    for percent in (80, 85):
        bands = parity.Bands(percent)
        for a in range(10, 61):
            for b in range(a, 61):
                same = next((k for k in range(1, a + 1) if 100 * k >= percent * (a + b - k)), None)
                if same is None:
                    continue
                for _ in range(4):
                    s = r.integers(0, 1 << 64, a + b - same, dtype=np.uint64)
                    x, y = s[:a], s[a - same:]
                    keys = [bands.keys(parity.positions(np.unique(z)), len(z)) for z in (x, y)]
                    assert len(y) == b and np.intersect1d(*keys).size, (percent, a, b)
