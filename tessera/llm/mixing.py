"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold
them). Token capacity flows from the patterns to the quotas of the sources;
using a document's words for the k-th time costs k - 1, which is convex, so the
flow repeats as little as it can. The flow is solved on the aggregate (at most
MAX_PATTERNS patterns, checked); documents are then selected in a seeded order:
the running size of a pattern in hash order, from per-bucket sums and a sort
inside each bucket, so no sort is global and no bucket grows with a hot source.
What a whole-document cut leaves open is closed, in FILLS rounds, by the document
whose size comes nearest to the rest without exceeding it (else, and in the last
round, nearest at all).

Edge cases: null or empty text has size 0 and nothing is taken of it; a null
source is a source of its own, ordered last; repeated rows share their hash and
are taken or left together; an empty table gives no rows; other columns are not
carried.
"""

from __future__ import annotations

import math
from collections import defaultdict, deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, scratch, stored

WEIGHTS = (3, 1, 2)
RATIO = 1.5
REPEATS = 2
MAX_PATTERNS = 100_000
ROWS_PER_BUCKET = 20_000
FILLS = 4


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of total by weight; a share above most * size stops there and the excess is reshared."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def route(capacity: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int], tiers: int) -> list[list[dict[int, int]]]:
    """Min-cost flow: flow[tier][pattern][source]. The k-th use of a pattern costs k - 1, so augmenting
    paths are exhausted tier by tier (shortest paths first); a path may reroute earlier flow at no cost."""
    sent: list[dict[int, int]] = [defaultdict(int) for _ in capacity]
    holders: list[list[int]] = [[] for _ in quota]
    for p, ms in enumerate(members):
        for s in ms:
            holders[s].append(p)
    left, used, levels = list(quota), [0] * len(capacity), []
    for tier in range(tiers):
        free = list(capacity)
        for start in range(len(capacity)):
            while free[start] > 0:
                # Breadth first from the pattern to any source with quota left.
                came, found, line = {("p", start): None}, None, deque([("p", start)])
                while line and found is None:
                    kind, i = line.popleft()
                    for nxt in ([("s", s) for s in members[i]] if kind == "p" else
                                [("p", p) for p in holders[i] if sent[p][i] > 0]):
                        if nxt not in came:
                            came[nxt] = (kind, i)
                            if nxt[0] == "s" and left[nxt[1]] > 0:
                                found = nxt
                                break
                            line.append(nxt)
                if found is None:
                    break
                path, at = [], found
                while at is not None:
                    path.append(at)
                    at = came[at]
                path.reverse()
                amount = min(free[start], left[found[1]])
                for a, b in zip(path, path[1:]):
                    if a[0] == "s":
                        amount = min(amount, sent[b[1]][a[1]])
                for a, b in zip(path, path[1:]):
                    if a[0] == "p":
                        sent[a[1]][b[1]] += amount
                    else:
                        sent[b[1]][a[1]] -= amount
                free[start] -= amount
                left[found[1]] -= amount
                used[start] += amount
        levels.append([c - f for c, f in zip(capacity, free)])
    # Each pattern's words, tier by tier, go to its sources in order.
    flow = []
    rest = [dict(x) for x in sent]
    for level in levels:
        row = []
        for p, amount in enumerate(level):
            got = {}
            for s in sorted(rest[p]):
                x = min(amount, rest[p][s])
                if x > 0:
                    got[s], amount = x, amount - x
                    rest[p][s] -= x
            row.append(got)
        flow.append(row)
    return flow


def mix(docs: DataFrame, key: Sequence[str], weights: Sequence[float] = WEIGHTS, ratio: float = RATIO,
        repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """docs(*key, sources array<string>, size bigint) -> key, sources, size, source_size, target, taken.

    weights repeat over the sources in order (code points, null last). source_size and target are
    those of the document's first source. `uses` lists, for each use, the source that it counts for.
    """
    spark = docs.sparkSession
    tag = F.transform("sources", lambda s: F.when(s.isNull(), "1").otherwise(F.concat(F.lit("0"), s)))
    rows = stored(docs.select(
        *key, F.array_sort(F.array_distinct(tag)).alias("pattern"), F.col("size").cast("bigint").alias("size"),
        F.xxhash64(F.lit(seed), *key).alias("h")), f"{scratch(spark)}/sizes")
    found = (rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
             .limit(MAX_PATTERNS + 1).collect())
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found.sort(key=lambda r: [x.encode() for x in r["pattern"]])
    names = sorted({s for r in found for s in r["pattern"]}, key=str.encode)
    at = {s: i for i, s in enumerate(names)}
    members = [[at[s] for s in r["pattern"]] for r in found]
    capacity = [int(r["size"] or 0) for r in found]
    sizes = [0] * len(names)
    for ms, c in zip(members, capacity):
        for s in ms:
            sizes[s] += c
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], ratio * sum(capacity), repeats)
    flow = route(capacity, members, [math.floor(g + 0.5) for g in goal], repeats)
    n_buckets = max(16, math.ceil(max([r["n"] for r in found], default=0) / ROWS_PER_BUCKET))
    plan = spark.createDataFrame(
        [(r["pattern"], names[members[i][0]] if members[i] else "", sizes[members[i][0]] if members[i] else 0,
          goal[members[i][0]] if members[i] else 0.0, [sum(level[i].values()) for level in flow])
         for i, r in enumerate(found)],
        "pattern array<string>, first string, source_size bigint, target double, quota array<bigint>")
    unit = F.shiftrightunsigned(F.col("h"), 11) / F.lit(float(1 << 53))
    light = rows.withColumn("b", F.floor(unit * n_buckets).cast("int"))
    sums = light.groupBy("pattern", "b").agg(F.sum("size").alias("s"))
    before = sums.select("pattern", "b", (F.sum("s").over(Window.partitionBy("pattern").orderBy("b")) - F.col("s")).alias("before"))
    inside = Window.partitionBy("pattern", "b").orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # The plan has a row for each of at most MAX_PATTERNS patterns; Spark broadcasts it if its size allows.
    placed = stored(light.join(before, ["pattern", "b"]).withColumn("upto", F.col("before") + F.sum("size").over(inside))
                    .drop("before", "b"), f"{scratch(spark)}/placed").join(plan, "pattern")
    whole = [F.col("upto") <= F.col("quota")[t] for t in range(repeats)]
    chosen = [{} for _ in range(repeats)]
    for round_ in range(FILLS):
        last = round_ == FILLS - 1
        taken = _with_uses(placed, chosen, whole)
        rest = taken.groupBy("pattern").agg(*[
            (F.first("quota")[t] - F.coalesce(F.sum(F.when(F.col(f"use{t}"), F.col("size"))), F.lit(0))).alias(f"rest{t}")
            for t in range(repeats)])
        open_ = taken.join(rest, "pattern").where(F.col("size") > 0)
        near = [F.abs(F.col("size") - F.col(f"rest{t}")) for t in range(repeats)]
        fills = open_.groupBy("pattern").agg(*[
            F.min(F.when(~F.col(f"use{t}") & (near[t] < F.col(f"rest{t}")),
                         F.struct((F.lit(not last) & (F.col("size") > F.col(f"rest{t}"))).alias("over"), near[t].alias("d"), "h"))).alias(f"fill{t}")
            for t in range(repeats)]).collect()
        for r in fills:
            for t in range(repeats):
                if r[f"fill{t}"]:
                    chosen[t].setdefault(tuple(r["pattern"]), []).append(r[f"fill{t}"]["h"])
    out = _with_uses(placed, chosen, whole)
    uses = sum((F.col(f"use{t}").cast("int") for t in range(repeats)), F.lit(0))
    return out.select(*key, F.expr("transform(pattern, s -> if(s = '1', null, substring(s, 2)))").alias("sources"),
                      "size", "source_size", "target", (F.col("size") * uses).cast("bigint").alias("taken"))


def _with_uses(placed: DataFrame, chosen: list[dict], whole: list[Column]) -> DataFrame:
    """placed with a flag for each use: inside the seeded cut, or one of the (pattern, hash) that fill it up."""
    spark, names = placed.sparkSession, {p for c in chosen for p in c}
    fills = spark.createDataFrame([(list(p), [c.get(p, []) for c in chosen]) for p in names],
                                  "pattern array<string>, fills array<array<bigint>>")
    flags = {f"use{t}": w | F.coalesce(F.array_contains(F.col("fills")[t], F.col("h")), F.lit(False)) for t, w in enumerate(whole)}
    return placed.join(fills, "pattern", "left").withColumns(flags)


def mixed_documents(documents: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken of documents(doc_id, text, source): each row's pattern is its own source."""
    docs = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.array("source").alias("sources"),
                            n_words(F.col("text")).alias("size"))
    return mix(docs, ["doc_id", "text_hash"], seed=seed).drop("text_hash", "sources")
