"""N-gram Jaccard join with parity sketches.

A document's set holds its distinct shingles (4 words by default). Every shingle flips one bit of
a long parity sketch (SKETCH bits, kept as the sorted positions of the odd ones), so
the Hamming distance of two sketches is at most the symmetric difference of the sets.
For sizes a and b, Jaccard >= t bounds that by D = (a + b) (1 - t) / (1 + t).

Pigeonhole join: sizes fall into bands whose ends differ by the factor 1 / t, so that
linked documents lie in one band or in neighbours. For each band the sketch is cut
into D + 1 + E segments; D differing bits leave E + 1 of the first D + 1 + E segments
equal, so a document looks at that many and sends keys for all but the E with the fewest bits
(ordered by bits, then key: of the E + 1 equal segments the last in that order is
among the E first of neither document). Empty segments and those with one common
shingle say little and are left out that way. Keys travel packed, by hash bucket; equal
sets count as one class everywhere.

Documents that share a key are candidates: all pairs of a small group; of a larger
one the pairs with its smallest class, which joins groups of copies without pairing
them up. Candidates whose short sketches (in the buckets, for small sets: folded to 64 bits) differ by more
than D are dropped, the rest are verified on the texts. After connected components, larger groups whose members
are not yet one component are searched again across components, in chunks, with the
short sketches compared inside the task: each component but a group's largest offers
its nearest pairs, 64 times as many in each round; a member whose pairs have all been offered
is settled and leaves its group, and with the last one the group leaves the search. So no link
between different components is missed and no group is paired out.

Texts move only where ids need them: a bitmap of the hashed ids (at most MARKS bits) tells
in place which documents can't be among them, the rest meet the ids in an exact join.

Shingles are compared by 64-bit and sets by 128-bit hashes.

Edge cases: texts without words are empty (n_shingles 0) and alone; with fewer
words than a shingle the whole sequence is one shingle; repeated rows have equal sets and are
one class; rows with one id count as one document; rows with a null id are returned
with a null component and link with nothing; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import buckets, scratch, stored

SHINGLE = 4
PERCENT = 85
SKETCH = 1 << 40
SHORT = 512               # bits of a short sketch, at least; twice the size of the set, up to a power of two
SPARE = 0.25              # further segments, as a share of those that the pigeonhole needs
PAIRED = 32               # classes in a group whose pairs are all taken
CHUNK = 2000              # classes compared with as many in one task
MARKS = 1 << 25           # bits of a bitmap of ids, at most; beyond a sixteenth as many ids, more documents than needed move
CHARS_PER_BUCKET = 6e6
BLOCK_KEYS, BLOCK_DOCS = 250_000, 5_000
PIECE = 1 << 18             # bytes of a text split into words at a time
CACHED = 150_000
ODD = np.uint64(0x9E3779B97F4A7C15)
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x + np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def word_hashes(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Hashes of all words in order; a long text is split piece by piece, each ending at white space."""
    b, at, out = (text or "").encode("utf-8", "surrogatepass").lower(), 0, [np.zeros(0, np.uint64)]
    while at < len(b):
        space = SPACE.search(b, at + PIECE)
        end = space.start() if space else len(b)
        out.append(np.fromiter(map(hashes.__getitem__, b[at:end].split()), np.uint64))
        at = end
    return np.concatenate(out)


def shingles(text: str | None, hashes: WordHashes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    h = word_hashes(text, hashes)
    if not len(h):
        return np.zeros(0, np.uint64)
    n = max(1, len(h) - width + 1)
    out = np.full(n, min(len(h), width), np.uint64)
    for i in range(min(width, len(h))):
        out = mixed(out * ODD + h[i:i + n])
    return np.unique(out)


def digest(s: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return (int(np.bitwise_xor.reduce(mixed(s, 1))).to_bytes(8, "little")
            + int(mixed(s, 2).sum(dtype=np.uint64)).to_bytes(8, "little"))


def positions(s: np.ndarray) -> np.ndarray:
    """Sorted positions of the odd bits of the parity sketch."""
    p = s >> np.uint64(24)
    if len(p) > 1 and (p[1:] == p[:-1]).any():
        p, c = np.unique(p, return_counts=True)
        p = p[c % 2 == 1]
    return p


def short_sketch(p: np.ndarray, n: int) -> bytes:
    size = max(SHORT, 1 << (2 * n - 1).bit_length()) if n else SHORT
    return np.packbits(np.bincount((mixed(p) % np.uint64(size)).astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def apart(x: bytes, y: bytes) -> int:
    """Hamming distance of two short sketches, the longer folded to the shorter."""
    if len(x) != len(y):
        n = min(len(x), len(y))
        x, y = (np.bitwise_xor.reduce(np.frombuffer(z, np.uint64).reshape(-1, n // 8), axis=0) for z in (x, y))
    else:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    return int(np.bitwise_count(x ^ y).sum())


def folded(sketch: bytes) -> int:
    """A short sketch folded to 64 bits: still a parity sketch, with one bit a shingle."""
    return int(np.bitwise_xor.reduce(np.frombuffer(sketch, np.int64)))


class Bands:
    """Size bands and their segments for a threshold of `percent`."""

    def __init__(self, percent: int = PERCENT, largest: int = 1 << 40):
        self.percent, self.first = percent, [1]
        while self.first[-1] <= largest:
            self.first.append(self.first[-1] * 100 // percent + 1)
        self._edges = {}

    def of(self, n: int) -> int:
        return bisect_right(self.first, n) - 1

    def most(self, a: int, b: int) -> int:
        """Greatest symmetric difference of linked sets of these sizes."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def spare(self, band: int) -> int:
        d = self.most(self.first[band + 1] - 1, self.first[band + 1] - 1)
        return math.ceil(SPARE * (d + 1))

    def tells(self, band: int) -> bool:
        """Whether linked sets of a band stay nearer in 64-bit sketches than others do (half the bits)."""
        top = self.first[band + 1] - 1
        return self.most(top, top) < 32

    def edges(self, band: int) -> np.ndarray:
        """Ends of the segments of a band's sketches."""
        if band not in self._edges:
            top = self.first[band + 1] - 1
            n = self.most(top, top) + 1 + self.spare(band)
            self._edges[band] = np.array([SKETCH * i // n for i in range(n + 1)], np.uint64)
        return self._edges[band]

    def keys(self, p: np.ndarray, n: int) -> np.ndarray:
        """Keys of a sketch of a set of size n: for its own band and, as the smaller partner, for the next."""
        own, out = self.of(n), []
        biggest = n * 100 // self.percent
        z = mixed(p, 3)
        for band in (own, own + 1):
            if band > own and biggest < self.first[band]:
                break
            edges, spare = self.edges(band), self.spare(band)
            partner = min(biggest, self.first[band + 1] - 1)
            some = min(len(edges) - 1, self.most(n, partner) + 1 + spare)
            at = np.searchsorted(p, edges[:some + 1])
            count = np.diff(at)
            if len(z):
                sums = np.bitwise_xor.reduceat(np.append(z[:at[-1]], np.uint64(0)), at[:-1])
                sums = np.where(count > 0, sums, np.uint64(0))
            else:
                sums = np.zeros(some, np.uint64)
            key = mixed(sums + mixed(np.arange(some, dtype=np.uint64) * ODD + np.uint64(band), 5))
            out.append(key[np.lexsort((key, count))[spare:]])
        return np.concatenate(out)


SENT = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("classes", pa.binary()), ("bands", pa.binary()), ("folds", pa.binary()),
                  ("ids", pa.binary()), ("known", pa.binary()), ("sizes", pa.binary()), ("digests", pa.binary()),
                  ("sketches", pa.list_(pa.binary()))])
SENT_DDL = ("bucket int, keys binary, classes binary, bands binary, folds binary, ids binary, known binary, sizes binary, "
            "digests binary, sketches array<binary>")
DOCS = ("ids", "known", "sizes", "digests", "sketches")


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def sketched(documents: DataFrame, percent: int, width: int, n_buckets: int) -> DataFrame:
    """Packed rows by bucket: keys (their other 32 bits, each with its class), and documents (keys null). Keys of sets
    small enough for the 64-bit sketch to tell come first, with band (from 1) and that sketch."""
    def run(batches):
        bands, hashes = Bands(percent), WordHashes()
        keys, docs, seen, n = [], [], set(), 0

        def flush():
            out = []
            if keys:
                k = np.concatenate([x[0] for x in keys])
                each = lambda i, kind: np.repeat(np.array([x[i] for x in keys], kind), [len(x[0]) for x in keys])
                c, band, f = each(1, np.int64), each(2, np.uint8), each(3, np.int64)
                b, k = (k % np.uint64(n_buckets)).astype(np.int32), (k // np.uint64(n_buckets)).astype(np.uint32)
                by = 2 * b + (band == 0)
                order = np.argsort(by.astype(np.uint16) if n_buckets < 32768 else by, kind="stable")
                k, c, band, f = k[order], c[order], band[order], f[order]
                cuts = np.searchsorted(by[order], np.arange(2 * n_buckets + 1))
                out += [(i, k[x:y].tobytes(), c[x:y].tobytes(), band[x:m].tobytes(), f[x:m].tobytes()) + (None,) * len(DOCS)
                        for i, (x, m, y) in enumerate(zip(cuts[::2], cuts[1::2], cuts[2::2])) if y > x]
            out.append((int.from_bytes(docs[0][1][8:], "little") % n_buckets, None, None, None, None,
                        np.array([d[0] or 0 for d in docs], np.int64).tobytes(), np.array([d[0] is not None for d in docs]).tobytes(),
                        np.array([d[2] for d in docs], np.int32).tobytes(), b"".join(d[1] for d in docs), [d[3] for d in docs]))
            for x in (keys, docs, seen):
                x.clear()
            return _rows(SENT, out)

        for batch in batches:
            for i, text in zip(batch.column("doc_id"), batch.column("text")):
                i, s = i.as_py(), shingles(text.as_py(), hashes, width)
                p, d = positions(s), digest(s)
                docs.append((i, d, len(s), short_sketch(p, len(s))))
                if len(s) and i is not None and d not in seen:
                    seen.add(d)
                    band = bands.of(len(s))
                    keys.append((bands.keys(p, len(s)), int.from_bytes(d[:8], "little", signed=True),
                                 band + 1 if bands.tells(band) else 0, folded(docs[-1][3])))
                    n += len(keys[-1][0])
                if n >= BLOCK_KEYS or len(docs) >= BLOCK_DOCS:
                    yield flush()
                    n = 0
        if docs:
            yield flush()

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SENT_DDL)


def members(table: DataFrame) -> DataFrame:
    """doc_id, n, digest, sketch of every document of the stored packed rows."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary())])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids, known = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["known"], bool)
                cut = lambda x, w: [x[i:i + w] for i in range(0, len(x), w)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=~known), pa.array(np.frombuffer(r["sizes"], np.int32).astype(np.int64)),
                     pa.array(cut(r["digests"], 16), pa.binary()), pa.array(r["sketches"], pa.binary())], schema=schema)

    return (table.where("ids is not null").select(*DOCS)
            .mapInArrow(run, "doc_id bigint, n bigint, digest binary, sketch binary"))


FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("group", pa.list_(pa.int64()))]
                  + [SENT.field(x) for x in DOCS])
FOUND_DDL = ("a bigint, b bigint, key bigint, group array<bigint>, ids binary, known binary, sizes binary, digests binary, "
             "sketches array<binary>")


def candidates(table: DataFrame, percent: int, paired: int) -> DataFrame:
    """Rows (a, b): pairs of classes; rows (key, group): the classes of a larger group; and the packed documents as they came."""
    top = np.array(Bands(percent).first[:256]) - 1       # of a band's sizes, bands from 1

    def run(key, packed):
        sent = packed.column("keys").is_valid()
        docs, packed = packed.filter(pc.invert(sent)), packed.filter(sent)
        unpacked = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in packed.column(name)]
        k, c = unpacked("keys", np.uint32), unpacked("classes", np.int64)
        band, f = ([np.r_[x, np.zeros(len(y) - len(x), kind)] for x, y in zip(unpacked(name, kind), k)]
                   for name, kind in (("bands", np.uint8), ("folds", np.uint64)))
        k, c, band, f = (np.concatenate([np.zeros(0, kind), *x])
                         for x, kind in ((k, np.uint32), (c, np.int64), (band, np.uint8), (f, np.uint64)))
        order = np.lexsort((c, k))
        k, c, band, f = k[order], c[order], band[order], f[order]
        new = np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])][:len(k)]
        k, c, band, f = k[new], c[new], band[new], f[new]
        start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]][:len(k)])
        size = np.diff(np.r_[start, len(k)])
        pairs, groups = [], []

        def near(x, y):
            """By the 64-bit sketches, where both have one."""
            most = (top[band[x]] + top[band[y]]) * (100 - percent) // (100 + percent)
            return (band[x] == 0) | (band[y] == 0) | (np.bitwise_count(f[x] ^ f[y]) <= most)

        for g in np.unique(size[(size > 1) & (size <= paired)]):
            i, j = np.triu_indices(g, 1)
            first = start[size == g]
            x, y = (first[:, None] + i).ravel(), (first[:, None] + j).ravel()
            ok = near(x, y)
            pairs.append(np.stack([c[x[ok]], c[y[ok]]], axis=1))
        for first, g in zip(start[size > paired], size[size > paired]):
            y = np.arange(first + 1, first + g)
            y = y[near(np.full(len(y), first), y)]
            pairs.append(np.stack([np.full(len(y), c[first]), c[y]], axis=1))
            groups.append((key[0].as_py() << 32 | int(k[first]), c[first:first + g].tolist()))
        p = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)

        def rows(n, **columns):
            return pa.Table.from_arrays([columns[x.name].cast(x.type) if x.name in columns else pa.nulls(n, x.type) for x in FOUND], schema=FOUND)

        return pa.concat_tables([
            rows(len(p), a=pa.array(p[:, 0]), b=pa.array(p[:, 1])),
            rows(len(groups), key=pa.array([x[0] for x in groups], pa.int64()), group=pa.array([x[1] for x in groups], pa.list_(pa.int64()))),
            rows(docs.num_rows, **{x: docs.column(x) for x in DOCS})])

    return table.groupBy("bucket").applyInArrow(run, FOUND_DDL)


def marked(ids: DataFrame, doc_id: Column) -> Column:
    """Whether an id may be in the only column of `ids`: always true for those that are, seldom for others."""
    bits = min(MARKS, max(1 << 13, 1 << (16 * ids.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    rows = (ids.select(place(F.col(ids.columns[0])).alias("at"))
            .groupBy(F.expr("at div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))")).toArrow())
    words = np.zeros(bits // 64, np.int64)
    words[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    sent = ids.sparkSession.sparkContext.broadcast(words)

    @F.arrow_udf("boolean")
    def hit(at: pa.Array) -> pa.Array:
        at = at.to_numpy()
        return pa.array((sent.value[at >> 6] >> (at & 63) & 1).astype(bool))

    return hit(place(doc_id.cast("bigint")))


def verified(pairs: DataFrame, classes: DataFrame, documents: DataFrame, percent: int, width: int) -> DataFrame:
    """Edges (u, v) of ids whose sets are linked, from distinct pairs (a, b) of 64-bit class names: first by sizes and
    the short sketches, then exactly on the texts."""
    folder = scratch(documents.sparkSession)
    named = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    classes = stored(classes.join(named, "class", "left_semi"), f"{folder}/paired")
    side = lambda x: classes.select(F.col("class").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "sketch", "digest")])
    bands = (100 - percent, 100 + percent)
    both = (pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where("id_a <> id_b or digest_a <> digest_b")
            .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"))
    schema = pa.schema([("id_a", pa.int64()), ("id_b", pa.int64()), ("digest_a", pa.binary()), ("digest_b", pa.binary())])

    def close(batches):
        for b in batches:
            if not b.num_rows:
                continue
            most = (b.column("n_a").to_numpy() + b.column("n_b").to_numpy()) * bands[0] // bands[1]
            ok = pa.array([apart(x, y) <= d for x, y, d in zip(b.column("sketch_a").to_pylist(), b.column("sketch_b").to_pylist(), most.tolist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(f.name) for f in schema], schema=schema).filter(ok)

    left = both.select("id_a", "id_b", "n_a", "n_b", "sketch_a", "sketch_b", "digest_a", "digest_b").mapInArrow(
        close, "id_a bigint, id_b bigint, digest_a binary, digest_b binary")
    left = stored(left, f"{folder}/close")
    needed = stored(left.select(F.col("id_a").alias("doc_id")).union(left.select("id_b")).distinct(), f"{folder}/needed")
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(marked(needed, F.col("doc_id")))
    texts = stored(texts.join(needed, "doc_id", "left_semi"), f"{folder}/texts")
    text = lambda x: texts.select(F.col("doc_id").alias(f"id_{x}"), F.col("text").alias(f"text_{x}"))
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def exact(batches):
        hashes, last = WordHashes(), (None, None)
        for b in batches:
            keep = []
            for row in zip(*(b.column(c) for c in ("text_a", "text_b", "digest_a", "digest_b"))):
                ta, tb, da, db = (x.as_py() for x in row)
                if ta != last[0]:
                    last = (ta, shingles(ta, hashes, width))
                x, y = last[1], shingles(tb, hashes, width)
                same = len(np.intersect1d(x, y, assume_unique=True))
                # With repeated ids the join also brings other texts of the id.
                keep.append(100 * same >= percent * (len(x) + len(y) - same) and digest(x) == da and digest(y) == db)
            yield pa.RecordBatch.from_arrays([b.column("id_a"), b.column("id_b")], schema=out).filter(pa.array(keep, pa.bool_()))

    return (left.join(text("a"), "id_a").join(text("b"), "id_b")
            .select("id_a", "id_b", "text_a", "text_b", "digest_a", "digest_b").mapInArrow(exact, "u bigint, v bigint"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (u, v); the root is the smallest node. Alternating large and small
    stars; each round is a written table, and a node's neighbours only meet in partial minima and joins."""
    folder, now, mark = scratch(edges.sparkSession), edges, None
    for i in range(100):
        both = now.union(now.select("v", "u")).where("u <> v").distinct()
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        now = stored(small, f"{folder}/stars{i}")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == mark:
            break
        mark = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def merged(roots: DataFrame, edges: DataFrame, path: str) -> DataFrame:
    """The components (node, root) after further edges: only the graph of the old roots is searched again."""
    root = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    links = stored(edges.join(root("u"), "u", "left").join(root("v"), "v", "left")
                   .select(F.coalesce("root_u", "u").alias("u"), F.coalesce("root_v", "v").alias("v")).where("u <> v").distinct(), f"{path}links")
    if links.isEmpty():
        return roots
    now = components(links)
    renamed = (roots.join(now.select(F.col("node").alias("root"), F.col("root").alias("now")), "root", "left")
               .select("node", F.coalesce("now", "root").alias("root")))
    # Old roots are no nodes of `roots`, so no node comes twice.
    return stored(renamed.union(now), f"{path}roots")


def still_open(spread: DataFrame, roots: DataFrame, path: str) -> DataFrame:
    """The rows (key, class, id) of larger groups whose members are not one component, with root and the group's
    number of chunks. Components only grow, so a group left out here stays settled."""
    rooted = stored(spread.select("key", "class", "id").join(roots, F.col("id") == F.col("node"), "left")
                    .select("key", "class", "id", F.coalesce("root", "id").alias("root")), path)
    several = (rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("g"))
               .where("lo <> hi").select("key", F.ceil(F.col("g") / CHUNK).cast("int").alias("chunks")))
    return rooted.join(several, "key")


def across(spread: DataFrame, classes: DataFrame, percent: int, limit: int, listed: bool = False) -> DataFrame:
    """Pairs (a, b) of classes that share a larger group but no component, near by size and short sketch: for each
    component of an open group but its largest, the `limit` nearest by the sketches. Rows (open) name the groups in
    which some component has further ones; if `listed`, with the classes in the pairs of such components, by chunks.
    All pairs of the other classes have been offered."""
    rows = (spread.join(classes.select("class", "id", "n", "sketch"), ["class", "id"])
            .withColumn("c", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
            .withColumn("d", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("key", F.least("c", "d").alias("lo"), F.greatest("c", "d").alias("hi"), "c", "class", "n", "root", "sketch"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("open", pa.int64()), ("classes", pa.list_(pa.int64()))][:3 + listed])

    def run(key, t):
        _, lo, hi = (k.as_py() for k in key)
        col = lambda x: t.column(x).to_numpy()
        name, n, root, chunk = col("class"), col("n"), col("root"), col("c")
        sketches = [np.frombuffer(x, np.uint64) for x in t.column("sketch").to_pylist()]
        least = min(map(len, sketches))
        bits = np.stack([np.bitwise_xor.reduce(x.reshape(-1, least), axis=0) for x in sketches])
        found, size = np.unique(root, return_counts=True)
        pairs, further = set(), np.zeros(len(root), bool)
        for r in np.delete(found, np.argmax(size)):
            best, met = [], np.zeros(len(root), bool)
            for i in np.flatnonzero(root == r):
                j = np.flatnonzero((root != r) & ((chunk != chunk[i]) if lo != hi else True)
                                   & (100 * np.minimum(n[i], n) >= percent * np.maximum(n[i], n)))
                far = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
                ok = far <= (n[i] + n[j]) * (100 - percent) // (100 + percent)
                j, far = j[ok], far[ok]
                if len(j):
                    met[i] = met[j] = True
                    first = np.lexsort((name[j], far))[:limit + 1]
                    best += [(int(far[x]), min(int(name[i]), int(name[j[x]])), max(int(name[i]), int(name[j[x]]))) for x in first]
            pairs.update(p[1:] for p in sorted(best)[:limit])
            if len(set(best)) > limit:
                further |= met
        out = [(*p, None, None) for p in pairs]
        if further.any():
            out.append((None, None, key[0].as_py(), np.unique(name[further]).tolist()))
        return pa.Table.from_batches([_rows(schema, out)])

    ddl = "a bigint, b bigint, open bigint" + ", classes array<bigint>" * listed
    return rows.groupBy("key", "lo", "hi").applyInArrow(run, ddl).distinct()


def jaccard_components(documents: DataFrame, percent: int = PERCENT, width: int = SHINGLE, paired: int = PAIRED) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    spark = documents.sparkSession
    folder = scratch(spark)
    chars = documents.agg(F.sum(F.length("text"))).first()[0]
    # The keys are on disk once, on their way to the buckets.
    found = stored(candidates(sketched(documents, percent, width, buckets(chars, CHARS_PER_BUCKET)), percent, paired), f"{folder}/candidates")
    docs = members(found)
    # A class: its 64-bit name, smallest id, size and short sketch.
    classes = stored(docs.where("n > 0 and doc_id is not null").groupBy("digest")
                     .agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
                     .mapInArrow(_named, "digest binary, id bigint, n bigint, sketch binary, class bigint"), f"{folder}/classes")
    pairs = stored(found.where("a is not null").select("a", "b").distinct(), f"{folder}/pairs")
    # Rows with one id are one document: its classes are linked.
    per = docs.where("n > 0 and doc_id is not null").join(classes.select("digest", "id"), "digest").select("doc_id", "id")
    several = per.groupBy("doc_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi")
    same_id = per.join(several, "doc_id").where("id <> lo").select(F.col("id").alias("u"), F.col("lo").alias("v"))
    edges = stored(verified(pairs, classes, documents, percent, width).union(same_id), f"{folder}/edges")
    roots = components(edges)
    spread = (found.where("key is not null").select("key", F.explode("group").alias("class"))
              .join(classes.select("class", "id"), "class"))
    tested, limit, shared = pairs, 1, None
    while True:
        spread = stored(still_open(spread, roots, f"{folder}/rooted{limit}"), f"{folder}/open{limit}")
        # Later rounds have no other classes.
        shared = shared or stored(classes.join(spread.select("class").distinct(), "class", "left_semi"), f"{folder}/shared")
        near = stored(across(spread, shared, percent, limit, listed=True), f"{folder}/across{limit}")
        new = stored(near.where("a is not null").select("a", "b").join(tested, ["a", "b"], "left_anti"), f"{folder}/new{limit}")
        if not new.isEmpty():
            tested, roots = tested.union(new), merged(roots, verified(new, classes, documents, percent, width), f"{folder}/round{limit}")
        further = near.where("open is not null").select(F.col("open").alias("key"), F.explode("classes").alias("class")).distinct()
        if further.isEmpty():
            break
        # The other members of groups have offered all their pairs.
        spread, limit = further.join(shared.select("class", "id"), "class"), 64 * limit
    rooted = classes.join(roots, F.col("id") == F.col("node"), "left").select(
        "digest", F.coalesce("root", "id").alias("root"))
    return (docs.join(rooted, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id")))


def deduplicated(documents: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """One document of each component, that with the smallest id (one of its rows, if it repeats); all columns.
    Rows with a null id are all kept."""
    found = stored(jaccard_components(documents, percent, width).select(F.col("doc_id").alias("_id"), "component_id"),
                   f"{scratch(documents.sparkSession)}/components")
    drop = found.where("_id <> component_id").select("_id").distinct()
    repeated = found.where("_id = component_id").groupBy("_id").count().where("count > 1").select("_id")
    repeated = stored(repeated, f"{scratch(documents.sparkSession)}/repeated")
    # Most documents stay where they are; those that may have to go or come twice meet the ids.
    moved = marked(drop.union(repeated), documents["doc_id"])
    some = documents.where(moved)
    some = some.join(drop, some["doc_id"].cast("bigint") == drop["_id"], "left_anti")
    if not repeated.isEmpty():
        match = some["doc_id"].cast("bigint") == repeated["_id"]
        some = some.join(repeated, match, "left_anti").unionByName(some.join(repeated, match, "left_semi").dropDuplicates(["doc_id"]))
    return documents.where(~moved).unionByName(some)


def _named(batches):
    for b in batches:
        names = [int.from_bytes(d[:8], "little", signed=True) for d in b.column("digest").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.int64())], names=[*b.schema.names, "class"])
