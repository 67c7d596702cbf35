"""Piece encoding against the library, and against greedy merging by definition."""

import random

import numpy as np
import pytest

from tessera.llm import pieces

tokenizers = pytest.importorskip("public_tokenizers")
MODEL = tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    with open(MODEL, "rb") as f:
        return pieces.Encoder(pieces.Tables(f.read()))


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), np.int32).tolist()


def test_random_texts_as_the_library_encodes_them(encoder):
    r = random.Random(5)
    vocabulary = list(encoder.tables.ids)
    odd = [" ", "  ", "▁", "\n", "é", "漢", "😀", "\0", "\t", "�", "</s>", "<0x41>", "́", "٣"]
    for _ in range(4000):
        text = "".join(r.choice(vocabulary) if r.random() < 0.6 else r.choice(odd) if r.random() < 0.7 else r.choice("ab 0") * r.randint(1, 60)
                       for _ in range(r.randint(0, 9)))
        assert ids(encoder, text) == encoder.library.encode(text), repr(text)
        assert encoder.decode(ids(encoder, text)) == encoder.library.decode(encoder.library.encode(text))


@pytest.mark.parametrize("text", ["", " ", "▁", "a" * 50_000, " " * 5_000, "ab " * 20_000, "=" * 999, "漢" * 3_000])
def test_empty_and_long_texts(encoder, text):
    assert ids(encoder, text) == encoder.library.encode(text)


def test_whole_text_at_once_gives_the_same_ids(encoder, monkeypatch):
    """Stretches are only a short cut."""
    text = "The  quick brown fox,   reads 12 books\nabout ▁x▁▁ naïve 漢字 " * 5
    monkeypatch.setattr(encoder.tables, "separable", False)
    assert ids(encoder, text) == encoder.library.encode(text)


def test_pair_test_equals_merging(encoder):
    r = random.Random(6)
    vocabulary = sorted(encoder.tables.splits)
    runs = [p for p in vocabulary if len(set(p)) == 1]
    for _ in range(6000):
        some = runs if r.random() < 0.3 else vocabulary
        a, b = r.choice(some), r.choice(some)
        assert encoder.compatible(a, b) == (pieces.symbols(a + b, encoder.tables.ranks) == [a, b]), (a, b)


def test_merges_against_order_are_found():
    """bc joins first, then abc, and only then abcd, though abcd ranks before abc."""
    class Made:
        ids = {p: i for i, p in enumerate(["a", "b", "c", "d", "bc", "abcd", "ab", "cd", "abc"])}
        ranks = {"bc": 0, "ab": 1, "cd": 2, "abcd": 3, "abc": 4}
        splits = {"bc": (0, "b", "c"), "ab": (1, "a", "b"), "cd": (2, "c", "d"), "abcd": (3, "abc", "d"), "abc": (4, "a", "bc")}
        irregular = {"abcd"}
    assert pieces.merged("abcd", Made.ranks)[-1] == ("abcd", "abc", "d")
    one = pieces.Encoder.__new__(pieces.Encoder)
    one.tables, one.names, one.pairs, one.packs = Made, list(Made.ids), {}, []
    one.sizes = pieces.array("i", map(len, one.names))
    one.numbers = {p: i for i, p in enumerate(one.names)}
    Made.bytes = list(range(256))
    import ahocorasick
    one.automaton = ahocorasick.Automaton()
    for p, i in one.numbers.items():
        one.automaton.add_word(p, i)
    one.automaton.make_automaton()
    r = random.Random(7)
    for _ in range(500):
        text = "".join(r.choice("abcdx") for _ in range(r.randint(1, 12)))
        assert [one.names[t] for t in one.tokens(text)] == pieces.symbols(text, Made.ranks), text


def test_rows_with_nulls_repeats_and_clashing_columns(spark, encoder):
    rows = [(1, "Hello  world", 7, "x"), (1, "Hello  world", 7, "x"), (None, None, None, None), (3, "", 1, ""), (4, "é漢😀" * 3000, 1, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int, decoded string")
    got = sorted(pieces.encoded(df, MODEL).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert got[0] == (None, [], "") and got[3] == (3, [], "") and got[1] == got[2] and len(got) == 5
    for g, text in ((got[1], rows[0][1]), (got[4], rows[4][1])):
        assert g["ids"] == encoder.library.encode(text) and g["decoded"] == encoder.library.decode(g["ids"])
    assert pieces.encoded(df.limit(0), MODEL).count() == 0


def test_malformed_bytes(spark, encoder):
    df = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    assert pieces.encoded(df, MODEL).head()["ids"] == encoder.library.encode("a�b")


def test_small_tables_forget_without_changing_ids(encoder, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 2)
    fresh = pieces.Encoder(encoder.tables)
    text = "one two three one two four five one six " * 3
    assert ids(fresh, text) == encoder.library.encode(text) and len(fresh.known) <= 2
