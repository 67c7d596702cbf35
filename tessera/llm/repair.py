"""Conversation structure repair: the cheapest, then alphabetically least list of edits.

A conversation, in turn order, is to read `(s?(ua)+)?` by the initials of its roles. The
edits are Keep (0), Rerole to user or assistant (3), Delete (4, the only edit of a blank or
repeated row) and Insert of an empty turn (3, anywhere); a row that ends without `.`, `!`
or `?` costs 3 more where it stays. Their initials in order are the audit.

The dynamic program has four states (nothing yet, `s`, ends in `u`, ends in `a`). Audit
prefixes are nodes that share their beginnings; each has a rolling hash and its ancestors
at distances 1, 2, 4, ..., so that two audits of equal cost are compared by a search for
their longest common prefix. Equal hashes of different nodes are verified letter by letter.

Rows are dealt out by ranges of (conversation, turn). A conversation that lies within one
range and one block is repaired on the spot. The first and last one of each range, which
may go on in the next, and those longer than a block are cut into blocks: a block gives,
for every pair of entry and exit state, the cheapest cost and the rank of its audit among
the block's. Audits of a block hold one letter per row and end in one, so none begins
another, and comparing ranks block by block compares whole audits. Blocks are combined by
the same program over ranks, many at a time, until one choice a conversation is left;
it goes down again to the blocks, which spell out their part. So no task holds more than
a block of rows, however many rows a conversation has.

Edge cases: a null id, turn, role or text counts as one space where it is hashed or
written, and a null turn sorts first and is no turn for the gaps; a null id is a
conversation of its own; rows of one turn are ordered by role, then text (bytes), so
repeated rows are duplicates; an empty role has no initial and cannot be kept; malformed
UTF-8 is carried as it is; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.functions.ordered import RANK, num_partitions, rank_within
from tessera.llm.common import scratch, stored

#: Rows and bytes of a block, and blocks combined at a time.
BLOCK_ROWS, BLOCK_BYTES, FAN = 16_384, 4 << 20, 1_024
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
MODULUS, BASE = (1 << 61) - 1, 911_382_323
LEGAL = {b"su", b"ua", b"au"}


class Prefixes:
    """Strings that share their beginnings: node 0 is empty, every other adds a letter to its parent."""

    def __init__(self):
        self.letter, self.depth, self.hash, self.up = bytearray(1), array("i", [0]), array("Q", [0]), [array("i", [0])]

    def add(self, parent: int, letter: int) -> int:
        depth = self.depth[parent] + 1
        node = len(self.letter)
        if depth >> len(self.up):
            self.up.append(array("i", bytes(4 * node)))
        self.letter.append(letter)
        self.depth.append(depth)
        self.hash.append((self.hash[parent] * BASE + letter + 1) % MODULUS)
        at = parent
        for level in self.up:
            level.append(at)
            at = level[at]
        return node

    def ancestor(self, node: int, depth: int) -> int:
        away, k = self.depth[node] - depth, 0
        while away:
            if away & 1:
                node = self.up[k][node]
            away, k = away >> 1, k + 1
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether nodes of one depth spell the same, letter by letter up to where they meet."""
        parent = self.up[0]
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = parent[a], parent[b]
        return True

    def less(self, x: int, y: int) -> bool:
        if x == y:
            return False
        depth = min(self.depth[x], self.depth[y])
        a, b = self.ancestor(x, depth), self.ancestor(y, depth)
        if self.hash[a] == self.hash[b]:
            if self.same(a, b):
                return self.depth[x] < self.depth[y]
            return self.spelled(x) < self.spelled(y)
        for level in reversed(self.up):
            p, q = level[a], level[b]
            if self.hash[p] != self.hash[q]:
                a, b = p, q
        if self.same(self.up[0][a], self.up[0][b]):
            return self.letter[a] < self.letter[b]
        return self.spelled(x) < self.spelled(y)

    def spelled(self, node: int) -> bytes:
        out, parent = bytearray(), self.up[0]
        while node:
            out.append(self.letter[node])
            node = parent[node]
        return bytes(reversed(out))

    def best(self, options: Iterable[tuple[int, int, int]]) -> tuple[int, int] | None:
        """(cost, node) of the least of (cost, parent, letter); letter 0 stands for the parent itself."""
        least: list = []
        for option in options:
            if not least or option[0] < least[0][0]:
                least = [option]
            elif option[0] == least[0][0]:
                least.append(option)
        chosen = None
        for cost, parent, letter in least:
            node = self.add(parent, letter) if letter else parent
            if chosen is None or self.less(node, chosen[1]):
                chosen = cost, node
        return chosen


K, R, D, I = b"KRDI"
Row = tuple[int | None, bytes, bytes]


class Fault(NamedTuple):
    must_go: bool
    truncated: bool
    initial: bytes


def faults(rows: Sequence[Row], first) -> tuple[list[Fault], dict]:
    """Faults of rows in order, and their counts; `first(i)` tells whether row i is the first of its role and text."""
    out, counts = [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for i, (_, role, text) in enumerate(rows):
        end = text.rstrip()[-1:]
        kind = "blank" if not end else "duplicate" if not first(i) else None if end in b".!?" else "truncated"
        if kind:
            counts[kind] += 1
        out.append(Fault(kind in ("blank", "duplicate"), kind == "truncated", role[:1]))
    return out, counts


def inserted(tree: Prefixes, at: list) -> list:
    """States before a row: turns may be inserted at will."""
    n, s, u, a = at
    u = tree.best([(x[0], x[1], 0) for x in (u,) if x] + [(x[0] + INSERT, x[1], I) for x in (n, s, a) if x])
    a = tree.best([(x[0], x[1], 0) for x in (a,) if x] + [(x[0] + INSERT, x[1], I) for x in (u,) if x])
    return [n, s, u, a]


def walk(tree: Prefixes, found: Sequence[Fault], entry: int) -> list:
    """(cost, node) of the best audit by exit state."""
    at: list = [None] * 4
    at[entry] = 0, 0
    for f in found:
        before = inserted(tree, at)
        options: list[list] = [[(x[0] + DELETE, x[1], D)] if x else [] for x in before]
        if not f.must_go:
            n, s, u, a = before
            more = CUT if f.truncated else 0
            if f.initial == b"s" and n:
                options[SYSTEM].append((n[0] + KEEP + more, n[1], K))
            cost, letter = (KEEP + more, K) if f.initial == b"u" else (REROLE + more, R)
            options[USER] += [(x[0] + cost, x[1], letter) for x in (n, s, a) if x]
            cost, letter = (KEEP + more, K) if f.initial == b"a" else (REROLE + more, R)
            options[ASSISTANT] += [(x[0] + cost, x[1], letter) for x in (u,) if x]
        at = [tree.best(o) for o in options]
    return at


def finish(tree: Prefixes, at: list) -> tuple[int, int, int, int]:
    """(cost, exit state, inserted turns at the end, node) of the best audit of a whole conversation."""
    ends = [(x, state, more) for state, more in ((NOTHING, 0), (ASSISTANT, 0), (USER, 1), (SYSTEM, 2)) if (x := at[state])]
    cost, node = tree.best([(x[0] + INSERT * more, x[1], 0) for x, _, more in ends])
    return next((cost, state, more, node) for x, state, more in ends if x[1] == node and x[0] + INSERT * more == cost)


def applied(rows: Sequence[Row], audit: bytes, state: int) -> list[tuple[bytes, bytes]]:
    """(role, text) of the turns that an audit leaves."""
    out, left = [], iter(rows)
    for letter in audit:
        _, role, text = next(left) if letter != I else (None, b"", b"")
        if letter == D:
            continue
        to = SYSTEM if letter == K and role[:1] == b"s" else ASSISTANT if state == USER else USER
        out.append((role if letter == K else b"user" if to == USER else b"assistant", text))
        state = to
    return out


def shape(rows: Sequence[Row]) -> dict:
    """What a block tells of turns and neighbouring roles."""
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    return {"first": initials[0] if rows else None, "last": initials[-1] if rows else None,
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "lo": turns[0] if turns else None, "hi": turns[-1] if turns else None,
            "turns": sum(a != b for a, b in zip(turns, turns[1:])) + bool(turns)}


def joined(a: dict, b: dict) -> dict:
    """The counts and shape of two stretches of a conversation, one after the other."""
    out = {c: a[c] + b[c] for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
    if a["last"] is not None and b["first"] is not None:
        out["illegal"] += a["last"] + b["first"] not in LEGAL
    out["turns"] -= a["hi"] is not None and a["hi"] == b["lo"]
    out["first"] = b["first"] if a["first"] is None else a["first"]
    out["last"] = a["last"] if b["last"] is None else b["last"]
    out["lo"] = b["lo"] if a["lo"] is None else a["lo"]
    out["hi"] = a["hi"] if b["hi"] is None else b["hi"]
    return out


def gaps(stretch: dict) -> int:
    return 0 if stretch["lo"] is None else stretch["hi"] - stretch["lo"] + 1 - stretch["turns"]


def matrix(ways: list[list], spelled) -> tuple[list, list]:
    """Costs, and ranks of the audits, by entry and exit state (None where there is no way)."""
    spell = [spelled(e, x) if x else None for e, row in enumerate(ways) for x in row]
    order = {s: i for i, s in enumerate(sorted({s for s in spell if s is not None}))}
    return [x[0] if x else None for row in ways for x in row], [None if s is None else order[s] for s in spell]


def block_ways(found: Sequence[Fault]) -> tuple[list, list]:
    trees = [Prefixes() for _ in range(4)]
    ways = [walk(tree, found, e) for e, tree in enumerate(trees)]
    return matrix(ways, lambda e, x: trees[e].spelled(x[1]))


def chain(tree: Prefixes, ranks: Sequence[Sequence], costs: Sequence[Sequence], entry: int) -> list:
    """(cost, node) by exit state over consecutive blocks; a letter is a rank plus one."""
    at: list = [None] * 4
    at[entry] = 0, 0
    for c, r in zip(costs, ranks):
        at = [tree.best([(at[e][0] + c[4 * e + x], at[e][1], r[4 * e + x] + 1) for e in range(4) if at[e] and c[4 * e + x] is not None])
              for x in range(4)]
    return at


def states(ranks: Sequence[Sequence], letters: bytes, entry: int) -> list[tuple[int, int]]:
    """(entry, exit) of each block on a chain."""
    out = []
    for r, letter in zip(ranks, letters):
        leave = next(x for x in range(4) if r[4 * entry + x] == letter - 1)
        out.append((entry, leave))
        entry = leave
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage rule: conv_id, turn, role, text (binary) and `present`, false for the trace of a dropped row."""
    blank = F.lit(" ")
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_case"))
    case = F.col("_case")
    rows = rows.select(
        "conv_id", "turn", "_case", (case != 0).alias("present"),
        F.when(case == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(case <= 1, "").when(case == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).cast("binary").alias("text"))
    copies = F.when(case == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("_copy", F.explode(copies)).select("conv_id", "turn", F.col("role").cast("binary").alias("role"), "text", "present")


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
TURNS = "array<struct<role:binary,text:binary>>"
STRETCH = ("first binary, last binary, blank bigint, duplicate bigint, truncated bigint, illegal bigint, lo bigint, hi bigint, turns bigint, "
           "costs array<bigint>, ranks array<int>")
FIELDS = [c.split()[0] for c in STRETCH.split(", ")]


def _frame(spark, ddl: str):
    """Arrow schema of a DDL string."""
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def one_conversation(rows: Sequence[Row]) -> tuple:
    """Report values, audit and turns of a whole conversation."""
    seen: set = set()

    def first(i: int) -> bool:
        known = rows[i][1:] in seen
        seen.add(rows[i][1:])
        return not known

    found, counts = faults(rows, first)
    tree = Prefixes()
    cost, _, more, node = finish(tree, walk(tree, found, NOTHING))
    audit = tree.spelled(node) + bytes([I]) * more
    s = shape(rows)
    return (gaps(s), counts["blank"], counts["duplicate"], counts["truncated"], s["illegal"], cost), audit.decode(), applied(rows, audit, NOTHING)


def _first_pass(schema: pa.Schema):
    """Range partitions in order: conversations of one range and block are repaired, rows of the others handed on with a block number."""
    def run(batches):
        out: list = []
        held: list = []
        block = n = size = 0
        key, edge = None, True                     # the first conversation may have begun in the range before

        def hand_on():
            nonlocal block, n, held, size
            for turn, role, text, present in held:
                out.append((key[0], None, None, None, block, n, turn, role, text, present))
                n += 1
            block, held, size = block + 1, [], 0

        def close(last: bool):
            nonlocal held, size
            if edge or last:
                hand_on()
            elif held:
                report, audit, turns = one_conversation([r[:3] for r in held if r[3]])
                out.append((key[0], report, audit, turns, *[None] * 6))
            held, size = [], 0

        def ready():
            cols = list(zip(*out))
            arrays = [pa.array(cols[0], schema.field(0).type)]
            arrays.append(pa.array([None if r is None else dict(zip(names, r)) for r in cols[1]], schema.field(1).type))
            arrays.append(pa.array(cols[2], schema.field(2).type))
            arrays.append(pa.array([None if t is None else [{"role": a, "text": b} for a, b in t] for t in cols[3]], schema.field(3).type))
            arrays += [pa.array(c, f.type) for c, f in zip(cols[4:], list(schema)[4:])]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        names = [f.name for f in schema.field(1).type]
        given = 0
        for b in batches:
            for conv, turn, role, text, present in zip(*[b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present")]):
                if key is None or key[0] != conv:
                    if key is not None:
                        close(False)
                        edge = False
                    key = (conv,)
                held.append((turn, role, text, present))
                size += len(text)
                given += len(text)
                if len(held) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                    edge = True                    # longer than a block
                    hand_on()
                if given >= BLOCK_BYTES and out:
                    given = 0
                    yield ready()
        if key is not None:
            close(True)
        if out:
            yield ready()
    return run


def _rows(table: pa.Table) -> tuple[list[int], list[Row]]:
    """Positions and rows of a block, in order and without the traces of dropped rows."""
    table = table.sort_by("n")
    cols = [table.column(c).to_pylist() for c in ("n", "turn", "role", "text", "present")]
    kept = [r for r in zip(*cols) if r[4]]
    return [r[0] for r in kept], [r[1:4] for r in kept]


def _stretches(schema: pa.Schema, rows: list[dict]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per conversation the report (gaps, blank, duplicate, truncated, illegal, cost); and its pieces in order:
    conv_id, piece (from 0), audit, turns (role and text as bytes). Conversations without rows have a piece without turns."""
    spark = conversations.sparkSession
    folder = scratch(spark)
    rows = damaged(conversations)
    key = rows.schema["conv_id"].dataType.simpleString()
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    # The last range key parts rows that are equal in all others; which of them goes where does not matter.
    ranges = [*order, F.substring("text", 1, 64), F.col("_salt")]
    rows = (rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(num_partitions(rows), *ranges)
            .sortWithinPartitions(*order, "text").drop("_salt"))
    ddl = (f"conv_id {key}, report struct<{REPORT.replace(' bigint', ':bigint')}>, audit string, turns {TURNS}, "
           "block int, n bigint, turn bigint, role binary, text binary, present boolean")
    first = stored(rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text", "present")
                   .mapInArrow(_first_pass(_frame(spark, ddl)), ddl)
                   .withColumn("part", F.spark_partition_id()), f"{folder}/first")
    done = first.where("report IS NOT NULL")
    open_rows = first.where("report IS NULL").select("conv_id", "part", "block", "n", "turn", "role", "text", "present")

    # The first row of each role and text, by block; found by aggregation, so no group is ever gathered.
    firsts = (open_rows.where("present").groupBy("conv_id", F.sha2(F.concat(F.octet_length("role").cast("string").cast("binary"), F.lit(b":"), "role", "text"), 256))
              .agg(F.min(F.struct("part", "block", "n")).alias("f")).select("f.*"))

    ddl = f"conv_id {key}, part int, block int, rows array<bigint>, {STRETCH}"
    block_schema = _frame(spark, ddl)

    def summed(_, left, right):
        if not left.num_rows:
            return block_schema.empty_table()
        firsts_here = set(right.column("n").to_pylist())
        places, kept = _rows(left)
        found, counts = faults(kept, lambda i: places[i] in firsts_here)
        costs, ranks = block_ways(found)
        lead = {c: left.column(c)[0].as_py() for c in ("conv_id", "part", "block")}
        return _stretches(block_schema, [{**lead, **counts, **shape(kept), "costs": costs, "ranks": ranks,
                                          "rows": [n for n, f in zip(places, found) if f.must_go]}])

    by_block = open_rows.groupBy("part", "block").cogroup(firsts.groupBy("part", "block"))
    blocks = stored(by_block.applyInArrow(summed, ddl), f"{folder}/blocks")
    ranked = rank_within(blocks, ["conv_id"], ["part", "block"]).select("conv_id", F.col(RANK).alias("idx"), "part", "block", "rows", *FIELDS)
    level = stored(ranked, f"{folder}/level0")
    gone = level.select("conv_id", "idx", "part", "block", "rows")

    ddl_level = f"conv_id {key}, idx bigint, {STRETCH}"
    level_schema = _frame(spark, ddl_level)

    def combined(_, table):
        items = table.sort_by("idx").to_pylist()
        total = items[0]
        for item in items[1:]:
            total = joined(total, item)
        trees = [Prefixes() for _ in range(4)]
        ranks, costs = [i["ranks"] for i in items], [i["costs"] for i in items]
        ways = [chain(tree, ranks, costs, e) for e, tree in enumerate(trees)]
        costs, ranks = matrix(ways, lambda e, x: trees[e].spelled(x[1]))
        return _stretches(level_schema, [{**{c: total[c] for c in FIELDS if c in total}, "conv_id": items[0]["conv_id"],
                                          "idx": items[0]["idx"] // FAN, "costs": costs, "ranks": ranks}])

    levels = [level.select("conv_id", "idx", *FIELDS)]
    while (levels[-1].agg(F.max("idx")).head()[0] or 0) > 0:
        up = levels[-1].groupBy("conv_id", F.floor(F.col("idx") / FAN).alias("up")).applyInArrow(combined, ddl_level)
        levels.append(stored(up, f"{folder}/level{len(levels)}"))

    ddl_top = f"conv_id {key}, {REPORT}, idx bigint, entry int, leave int, more int"
    top_schema = _frame(spark, ddl_top)

    def settled(batches):
        """The last choice of each conversation: its exit state and the turns inserted at the end."""
        for b in batches:
            out = []
            for item in b.to_pylist():
                tree = Prefixes()
                cost, leave, more, _ = finish(tree, chain(tree, [item["ranks"]], [item["costs"]], NOTHING))
                out.append({**item, "gaps": gaps(item), "cost": cost, "idx": 0, "entry": NOTHING, "leave": leave, "more": more})
            yield from _stretches(top_schema, out).to_batches()

    top = stored(levels[-1].mapInArrow(settled, ddl_top), f"{folder}/top")
    ddl_way = f"conv_id {key}, idx bigint, entry int, leave int, more int"
    way_schema = _frame(spark, ddl_way)

    def handed_down(_, parent, children):
        items, (way,) = children.sort_by("idx").to_pylist(), parent.to_pylist()
        ranks, costs = [i["ranks"] for i in items], [i["costs"] for i in items]
        tree = Prefixes()
        _, node = chain(tree, ranks, costs, way["entry"])[way["leave"]]
        steps = states(ranks, tree.spelled(node), way["entry"])
        return _stretches(way_schema, [{"conv_id": i["conv_id"], "idx": i["idx"], "entry": e, "leave": x, "more": way["more"] if i is items[-1] else 0}
                                       for i, (e, x) in zip(items, steps)])

    ways = top.select("conv_id", "idx", "entry", "leave", "more")
    for below in reversed(levels[:-1]):
        ways = ways.groupBy("conv_id", "idx").cogroup(below.groupBy("conv_id", F.floor(F.col("idx") / FAN).alias("idx"))).applyInArrow(handed_down, ddl_way)

    ddl_piece = f"conv_id {key}, piece bigint, audit string, turns {TURNS}"
    piece_schema = _frame(spark, ddl_piece)

    def spelled(_, left, right):
        (way,) = right.to_pylist()
        places, kept = _rows(left)
        goes = set(way["rows"])
        found = [Fault(n in goes, text.rstrip()[-1:] not in b".!?", role[:1]) for n, (_, role, text) in zip(places, kept)]
        tree = Prefixes()
        _, node = walk(tree, found, way["entry"])[way["leave"]]
        audit = tree.spelled(node) + bytes([I]) * way["more"]
        turns = [{"role": a, "text": b} for a, b in applied(kept, audit, way["entry"])]
        return _stretches(piece_schema, [{"conv_id": way["conv_id"], "piece": way["idx"], "audit": audit.decode(), "turns": turns}])

    # A way and the rows that must go, side by side by (conversation, block number): both have one row each.
    of_block = (ways.select("conv_id", "idx", F.struct("entry", "leave", "more").alias("way"), F.lit(None).cast(gone.select(F.struct("part", "block", "rows").alias("b")).schema["b"].dataType).alias("b"))
                .unionByName(gone.select("conv_id", "idx", F.lit(None).cast("struct<entry:int,leave:int,more:int>").alias("way"), F.struct("part", "block", "rows").alias("b")))
                .groupBy("conv_id", "idx").agg(F.first("way", ignorenulls=True).alias("way"), F.first("b", ignorenulls=True).alias("b"))
                .select("conv_id", "idx", "way.*", "b.*"))
    pieces = open_rows.groupBy("part", "block").cogroup(of_block.groupBy("part", "block")).applyInArrow(spelled, ddl_piece)
    pieces = stored(pieces, f"{folder}/pieces")
    names = [c.split()[0] for c in REPORT.split(", ")]
    report = done.select("conv_id", *[F.col(f"report.{c}").alias(c) for c in names]).unionByName(top.select("conv_id", *names))
    return report, done.select("conv_id", F.lit(0).cast("bigint").alias("piece"), "audit", "turns").unionByName(pieces)


def digests(pieces: DataFrame) -> DataFrame:
    """conv_id, audit and repaired_sha256 (of `role:text` lines) of each conversation: its pieces are read in
    order, one after the other, and only the running hash and the audit are held."""
    import hashlib
    key = pieces.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {key}, audit string, repaired_sha256 string"
    schema = _frame(pieces.sparkSession, ddl)
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(b":"), t["text"]).cast("string")), "\n")
    lines = pieces.select("conv_id", "piece", "audit", F.size("turns").alias("lines"), body.cast("binary").alias("body"))

    def run(batches):
        key, state, audit, empty = None, None, [], True
        for b in batches:
            out = []
            for conv, text, n, body in zip(*[b.column(c).to_pylist() for c in ("conv_id", "audit", "lines", "body")]):
                if key is None or key[0] != conv:
                    if key is not None:
                        out.append((key[0], "".join(audit), state.hexdigest()))
                    key, state, audit, empty = (conv,), hashlib.sha256(), [], True
                audit.append(text)
                if n:
                    state.update(body if empty else b"\n" + body)
                    empty = False
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((key[0], "".join(audit), state.hexdigest()), schema)], schema=schema)

    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, ddl)
