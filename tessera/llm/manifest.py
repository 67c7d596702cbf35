"""Merkle manifest of a dataset by a nested-struct rollup.

Every row is a leaf; the leaves of a source, ascending by id, form a 16-ary hash tree,
and the roots of all sources, ascending by source, form another one above it.

The position of a node in its level is split into hexadecimal digits, one column a
digit. Within a block of 16^3 nodes the digit columns are grouped away one after the
other, each time nesting the children as structs below their parent; as the blocks are
dealt out once by (source, block), the three groupings need no further shuffle. The
hashes of the blocks are the nodes of the next stage, until one block a source is left.
Proofs go back down the same stored blocks: a block meets the siblings above it by
grouping on (source, block), and its nested structs are exploded, each step putting the
siblings of the chosen child in front of the path. No proof is put together by a join,
and no row ever holds more than one block.

Edge cases: null columns hash as `-`; a null id sorts first and counts as empty text in
the tampering rule; equal ids are ordered by their leaf hash, so repeated rows are leaves
of their own; a null source is a source of its own and comes first; an empty table gives
no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordered import RANK, rank_within
from tessera.llm.common import fold, lower_ascii, scratch, stored

#: Children of a node, as a power of two, and levels that one block nests.
DIGIT_BITS, DIGITS = 4, 3
BLOCK_BITS = DIGIT_BITS * DIGITS
STEP = "struct<left:string,right:string,hashed:boolean>"


def field(c: Column) -> Column:
    """A value as it enters a leaf: byte count, colon, value; `-` for null."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return sha(*map(field, (doc_id, source, lang, n_chars, text)))


def blocks_of(nodes: DataFrame, key: str, payload: Sequence[str] = ()) -> DataFrame:
    """One row per (key, block of 16^3 nodes): idx, hash, hashed (false where the level held a lone
    node, which stands for itself), kids (nested children, each with digit, hash and its own kids)."""
    digits = [f"d{i}" for i in reversed(range(DIGITS))]
    at = [F.shiftright("idx", DIGIT_BITS * i).bitwiseAND((1 << DIGIT_BITS) - 1).cast("int").alias(f"d{i}")
          for i in reversed(range(DIGITS))]
    out = nodes.select(key, F.shiftright("idx", BLOCK_BITS).alias("block"), *at, "hash", *payload).repartition(key, "block")
    nested = list(payload)
    for i in range(DIGITS):
        digit = f"d{i}"
        above = ["block", *digits[:DIGITS - 1 - i]]
        child = F.struct(F.col(digit).alias("digit"), "hash", *nested)
        first = F.forall(F.array(*[F.col(c).cast("long") for c in above]), lambda x: x == 0)
        out = out.groupBy(key, *above).agg(F.sort_array(F.collect_list(child)).alias("kids"))
        out = out.withColumn("hashed", ~(first & (F.size("kids") == 1)))
        out = out.withColumn("hash", F.when(F.col("hashed"), F.sha2(F.array_join("kids.hash", ""), 256))
                             .otherwise(F.col("kids")[0]["hash"]))
        nested = ["hashed", "kids"]
    return out.withColumnRenamed("block", "idx")


def climb(nodes: DataFrame, key: str, folder: str, payload: Sequence[str] = ()) -> list[DataFrame]:
    """Block tables from the leaves up, the last with one block a key; `nodes` is a stored table."""
    stages = []
    while True:
        most = nodes.agg(F.max("idx")).head()[0] or 0
        stages.append(stored(blocks_of(nodes, key, () if stages else payload), f"{folder}/stage{len(stages)}"))
        if most < 1 << BLOCK_BITS:
            return stages
        nodes = stages[-1].select(key, "idx", "hash")


def opened(blocks: DataFrame, above: DataFrame, key: str, carried: Sequence[str], payload: Sequence[str] = ()) -> DataFrame:
    """The nodes of the blocks with their paths: key, idx, hash, path (from the node up), `carried`, `payload`.
    `above` has the path and the carried columns of each block, by (key, idx)."""
    tree = F.struct("hashed", "kids")
    seed = F.struct("path", *carried)
    both = (blocks.select(key, "idx", tree.alias("tree"), F.lit(None).cast(above.select(seed.alias("s")).schema["s"].dataType).alias("seed"))
            .unionByName(above.select(key, "idx", F.lit(None).cast(blocks.select(tree.alias("t")).schema["t"].dataType).alias("tree"), seed.alias("seed"))))
    out = (both.groupBy(key, "idx").agg(F.first("tree", ignorenulls=True).alias("tree"), F.first("seed", ignorenulls=True).alias("seed"))
           .select(key, "idx", "tree.*", "seed.*"))
    for i in range(DIGITS):
        nested = ["hashed", "kids"] if i < DIGITS - 1 else list(payload)
        out = out.select(key, "idx", "hashed", "path", *carried, "kids", F.posexplode("kids").alias("i", "kid"))
        hashes = F.col("kids.hash")
        step = F.struct(F.array_join(F.slice(hashes, F.lit(1), F.col("i")), "").alias("left"),
                        F.array_join(F.slice(hashes, F.col("i") + 2, F.size(hashes)), "").alias("right"), "hashed")
        out = out.select(key, (F.shiftleft("idx", DIGIT_BITS) + F.col("kid.digit")).alias("idx"), F.col("kid.hash").alias("hash"),
                         F.concat(F.array(step), "path").alias("path"), *carried, *[F.col("kid")[c].alias(c) for c in nested])
    return out


def descend(stages: list[DataFrame], seeds: DataFrame, key: str, carried: Sequence[str], payload: Sequence[str] = ()) -> DataFrame:
    for i in reversed(range(len(stages))):
        seeds = opened(stages[i], seeds, key, carried, payload if i == 0 else ())
    return seeds


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda acc, p: F.when(p["hashed"], sha(p["left"], acc, p["right"])).otherwise(acc))


def manifest(documents: DataFrame, tamper_modulo: int = 5) -> DataFrame:
    """doc_id, source, position (from 0 in its source), leaf, subroot, root, path (siblings left and right by
    level, from the leaf up), proof_sha256, folded_root, verified, tampered (whether the text was changed
    before the proof was folded) of every row."""
    folder = scratch(documents.sparkSession)
    cols = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = fold(F.col("doc_id"), tamper_modulo) == 0
    leaves = documents.select(
        F.col("doc_id"), F.col("source"), leaf_hash(*cols, F.col("text")).alias("hash"),
        F.when(chosen, leaf_hash(*cols, lower_ascii(F.col("text")))).alias("changed"))
    ranked = rank_within(leaves, ["source"], ["doc_id", "hash"])
    payload = ["doc_id", "changed"]
    nodes = stored(ranked.select("source", F.col(RANK).alias("idx"), "hash", *payload), f"{folder}/leaves")
    stages = climb(nodes, "source", f"{folder}/leaf", payload)

    tops = rank_within(stages[-1].select("source", "hash"), [], [F.col("source").asc_nulls_first()])
    tops = stored(tops.select(F.lit(0).alias("all"), F.col(RANK).alias("idx"), "hash", "source"), f"{folder}/subroots")
    upper = climb(tops, "all", f"{folder}/upper", ["source"])
    seed = upper[-1].select("all", "idx", F.array().cast(f"array<{STEP}>").alias("path"), F.col("hash").alias("root"))
    sources = descend(upper, seed, "all", ["root"], ["source"]).select(
        "source", F.lit(0).cast("bigint").alias("idx"), "path", F.col("hash").alias("subroot"), "root")

    out = descend(stages, sources, "source", ["subroot", "root"], payload)
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    out = out.select("doc_id", "source", F.col("idx").alias("position"), F.col("hash").alias("leaf"), "subroot", "root", "path",
                     F.sha2(siblings, 256).alias("proof_sha256"),
                     folded(F.coalesce("changed", "hash"), F.col("path")).alias("folded_root"),
                     (F.coalesce("changed", "hash") != F.col("hash")).alias("tampered"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
