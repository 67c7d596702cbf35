"""Merkle manifest against a direct tree over the sorted leaves."""

import hashlib
import random
import zlib

import pytest

from tessera.llm import manifest as m

COLUMNS = "doc_id bigint, source string, lang string, n_chars bigint, text string, hash int, idx string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(d, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d[0], d[1], d[2], d[3], text)))


def tree(hashes):
    """Levels from the leaves up."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([h("".join(at[i:i + 16])) for i in range(0, len(at), 16)])
    return levels


def siblings(levels, i):
    out = []
    for at in levels[:-1]:
        lo = i // 16 * 16
        out.append((at[lo:i], at[i + 1:lo + 16]))
        i //= 16
    return out


def wanted(rows):
    def key(d):
        return d[0] is not None, d[0] or 0, leaf(d, d[4])

    groups = {}
    for d in rows:
        groups.setdefault(d[1], []).append(d)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf(d, d[4]) for d in sorted(groups[s], key=key)]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for j, s in enumerate(names):
        for i, d in enumerate(sorted(groups[s], key=key)):
            path = siblings(trees[s], i) + siblings(top, j)
            bad = zlib.crc32(("" if d[0] is None else str(d[0])).encode()) % 5 == 0 and d[4] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in d[4]) if bad else d[4]
            at = leaf(d, text)
            for left, right in path:
                at = h("".join(left) + at + "".join(right))
            out.append((d[0], leaf(d, d[4]), trees[s][-1][0], top[-1][0], h("".join("".join(a) + "".join(b) for a, b in path)),
                        at, at == top[-1][0]))
    return sorted(out, key=str)


def got(spark, rows):
    df = m.manifest(spark.createDataFrame([(*d, 1, "x") for d in rows], COLUMNS))
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"])
                   for r in df.collect()), key=str)


def corpus(n, sources, seed=3):
    r = random.Random(seed)
    rows = [(i, r.choice(sources), r.choice(["en", None]), r.choice([None, i]), r.choice(["Ab c", "é " * 3, "", None, "Z" * 50])) for i in range(n)]
    r.shuffle(rows)
    return rows


def test_manifest_equals_a_direct_tree(spark):
    rows = corpus(700, ["a", "b", None, "B", "é"]) + [(9000, "one", "x", 1, "Alone"), (None, "a", None, None, None), (None, "a", None, None, "Q"),
                                                      (5, "a", "en", 1, "same Text"), (5, "a", "en", 1, "same Text")]
    assert got(spark, rows) == wanted(rows)
    assert {v[-1] for v in wanted(rows)} == {True, False}


@pytest.mark.parametrize("digits", [1, 2])
def test_manifest_over_several_stages(spark, monkeypatch, digits):
    monkeypatch.setattr(m, "DIGITS", digits)
    monkeypatch.setattr(m, "BLOCK_BITS", m.DIGIT_BITS * digits)
    rows = corpus(600, ["hot"] * 60 + [f"s{i}" for i in range(40)])
    assert got(spark, rows) == wanted(rows)


@pytest.mark.parametrize("n", [1, 16, 17, 256, 257])
def test_manifest_at_the_edges_of_a_level(spark, n):
    rows = corpus(n, ["s"])
    assert got(spark, rows) == wanted(rows)


def test_manifest_of_nothing(spark):
    assert got(spark, []) == []
