"""Conversation repair against a plain program over (cost, audit) strings, and parts of it against all audits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tessera.functions.ordered import join_small
from tessera.llm import repair as m

COLUMNS = "conv_id bigint, turn bigint, role string, text string, present int, part string"
CASES = (0, 1, 2, 3, 4)


def damage(rows):
    out = []
    for c, t, role, text in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        role, text = (" " if v is None else v for v in (role, text))
        case = zlib.crc32(name.encode()) % 20
        if case == 1:
            text = ""
        if case == 2:
            text = re.sub("[.!?]", "", text)
        if case == 4:
            role = "user"
        out += [(c, t, role, text)] * {0: 0, 3: 2}.get(case, 1)
    return out


def least(steps):
    """(cost, audit) of the best repair by the definition, states: nothing, s, u, a."""
    def put(at):
        at = dict(at)
        for to, places in (("u", "0sa"), ("a", "u")):
            for p in places:
                if p in at:
                    at[to] = min(x for x in (at.get(to), (at[p][0] + 3, at[p][1] + "I")) if x)
        return at
    at = {"0": (0, "")}
    for initial, go, cut in steps:
        nxt = {}
        before = put(at)
        for p, (cost, audit) in before.items():
            options = [(p, cost + 4, "D")]
            if not go:
                extra = 3 if cut else 0
                to = "a" if p == "u" else "u"
                options.append((to, cost + 3 + extra, "R"))
                if initial == to or (initial == "s" and p == "0"):
                    options.append((initial, cost + extra, "K"))
            for to, c, letter in options:
                nxt[to] = min(x for x in (nxt.get(to), (c, audit + letter)) if x)
        at = nxt
    at = put(at)
    return min(at[p] for p in "0a" if p in at)


def wanted(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        got = sorted((r for r in damage(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, steps, counts = set(), [], [0, 0, 0]
        for _, _, role, text in got:
            body = text.strip(" \t\n\v\f\r")
            kind = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if kind is not None:
                counts[kind] += 1
            steps.append((role[:1], kind in (0, 1), kind == 2))
        turns = [r[1] for r in got if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _, _), (b, _, _) in zip(steps, steps[1:]))
        cost, audit = least(steps)
        lines, left, state = [], iter(got), "0"
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter == "D":
                continue
            state = row[2][:1] if letter == "K" else "a" if state == "u" else "u"
            role = row[2] if letter == "K" else {"u": "user", "a": "assistant"}[state]
            lines.append(f"{role}:{row[3] if row else ''}")
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return out


def got(spark, rows, partitions=None):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS)
    if partitions:
        df = df.repartition(partitions)
    report, pieces = m.repair(df)
    out = join_small(report, m.digests(pieces), ["conv_id"]).collect()
    assert len(out) == len({r["conv_id"] for r in out})
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"])
            for r in out}


def talk(r, conv, n, turn=None):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "Unknown"]
    texts = ["Hello there.", "no end", "What?", "", " \t", None, "é!", "Fine. Really", "same", "x" * 30 + "."]
    return [(conv, (i if turn is None else turn) + r.choice([0, 0, 0, 1]) if r.random() < 0.95 else None,
             ["user", "assistant"][i % 2] if r.random() < 0.6 else r.choice(roles),
             f"Turn {i}." if r.random() < 0.5 else r.choice(texts)) for i in range(n)]


def test_damage_of_every_kind(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {t}. More!") for c in range(40) for t in range(6)]
    assert {zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, *_ in rows} >= set(CASES)
    assert got(spark, rows) == wanted(rows)


def test_random_conversations(spark):
    r = random.Random(1)
    rows = [x for c in range(150) for x in talk(r, c, r.randint(0, 14))] + talk(r, None, 9) + [(77, 3, "user", "again")] * 4
    r.shuffle(rows)
    assert got(spark, rows, 3) == wanted(rows)


@pytest.mark.parametrize("block, fan", [(3, 2), (7, 1024), (64, 4)])
def test_blocks_give_the_same_as_one_piece(spark, monkeypatch, block, fan):
    """A hot conversation, cut into many blocks that are combined over several levels."""
    monkeypatch.setattr(m, "BLOCK_ROWS", block)
    monkeypatch.setattr(m, "FAN", fan)
    r = random.Random(block)
    rows = talk(r, 5, 150) + talk(r, 6, 40) + [x for c in range(10, 40) for x in talk(r, c, r.randint(1, 5))] + talk(r, None, 20)
    assert got(spark, rows, 4) == wanted(rows)


def test_repeated_rows_of_one_turn_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_ROWS", 16)
    rows = [(1, 2, "user", "same.")] * 120 + [(1, 3, "assistant", "yes.")]
    assert got(spark, rows, 4) == wanted(rows)


def test_dropped_rows_and_empty_tables(spark):
    dropped = [(c, t, "user", "x.") for c in range(200) for t in range(2) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(got(spark, dropped).values()) == {nothing}
    assert got(spark, []) == {}


def test_program_finds_the_least_of_all_audits():
    """Against every audit of up to four rows."""
    def legal(audit, rows):
        cost, state, left = 0, "0", iter(rows)
        for letter in audit:
            if letter == "I":
                state, cost = "a" if state == "u" else "u", cost + 3
                continue
            initial, go, cut = next(left)
            if letter == "D":
                cost += 4
                continue
            if go:
                return None
            to = "a" if state == "u" else "u"
            if letter == "K":
                if initial != to and not (initial == "s" and state == "0"):
                    return None
                to = initial
            cost, state = cost + 3 * (letter == "R") + 3 * cut, to
        return cost if state in "0a" else None

    r = random.Random(3)
    for _ in range(60):
        rows = [(r.choice("suat"), r.random() < 0.2, r.random() < 0.3) for _ in range(r.randint(0, 4))]
        options = []
        for letters in itertools.product("KRD", repeat=len(rows)):
            for places in itertools.product(range(3), repeat=len(rows) + 1):
                audit = "".join("I" * n + x for n, x in zip(places, letters)) + "I" * places[-1]
                cost = legal(audit, rows)
                if cost is not None:
                    options.append((cost, audit))
        tree = m.Prefixes()
        cost, _, more, node = m.finish(tree, m.walk(tree, [m.Fault(go, cut, i.encode()) for i, go, cut in rows], m.NOTHING))
        assert (cost, tree.spelled(node).decode() + "I" * more) == min(options) == least(rows)


@pytest.mark.parametrize("modulus", [m.MODULUS, 2, 1])
def test_prefix_order_holds_under_collisions(monkeypatch, modulus):
    monkeypatch.setattr(m, "MODULUS", modulus)
    r, tree = random.Random(4), m.Prefixes()
    nodes = [0]
    for _ in range(300):
        nodes.append(tree.add(r.choice(nodes), r.choice(b"DK")))
    for _ in range(2000):
        x, y = r.choice(nodes), r.choice(nodes)
        assert tree.less(x, y) == (tree.spelled(x) < tree.spelled(y)), (tree.spelled(x), tree.spelled(y))
