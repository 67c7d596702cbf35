"""Benchmark decontamination by the q-gram lemma (SWIFT-style filtering).

Texts are normalised (lower case, runs of other than letters and digits become
one blank; a character below is a byte of the UTF-8 result). An alignment of n characters with at most e edits shares at least
n + 1 - q (e + 1) q-grams whose positions lie within e diagonals. Each document's
q-grams look up the benchmark's; hits are counted in diagonal bands of width
2 (e + 1) that overlap by half, in document windows that overlap by half, and only
regions that meet the bound go on to a banded alignment, which finds the matched
stretch of the item and its edits.

A leak is a stretch of at least min(MIN_LENGTH, length of the item) characters of
an item that aligns with at most EDITS of its length in edits.

The benchmark's index is broadcast in blocks of at most BLOCK_CHARS characters
(checked before it is collected); more items mean more passes over the documents,
with the same result. Documents are read in place, whole, without a shuffle.

Edge cases: null and empty texts, and items without a letter or digit, match
nothing; items shorter than q match as whole words; a null item id is kept as
null; repeated documents are matched one by one, an item that leaks several times
into a document gives its best match; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 12
MIN_LENGTH = 60
EDITS = 0.05
BLOCK_CHARS = 8_000_000
BATCH_BYTES = 1 << 20
_OTHER = re.compile(r"[\W_]+")


def normal(text: str | None) -> bytes:
    return _OTHER.sub(" ", (text or "").lower()).strip().encode("utf-8", "surrogatepass")


def codes(b: np.ndarray) -> np.ndarray:
    """A 64-bit code of each q-gram of a byte array (equal grams have equal codes)."""
    n = len(b) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(Q):
        out = out * np.uint64(0x100000001B3) + b[i:i + n]
    return out * np.uint64(0x9E3779B97F4A7C15)


class Index:
    """q-grams of a block of items: sorted codes with the item and position of each occurrence."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.items = items
        parts = [codes(np.frombuffer(t, np.uint8).astype(np.uint64)) for _, t in items]
        code = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(items)), [len(p) for p in parts])
        place = np.concatenate([np.arange(len(p)) for p in parts]) if parts else np.zeros(0, int)
        order = np.argsort(code, kind="stable")
        code, self.owner, self.place = code[order], owner[order], place[order]
        self.code, self.start, self.count = np.unique(code, return_index=True, return_counts=True)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.code >> np.uint64(44)] = True
        self.length = np.array([min(MIN_LENGTH, len(t)) for _, t in items], np.int64)
        self.edits = np.floor(self.length * EDITS).astype(np.int64)
        self.need = np.maximum(1, self.length + 1 - Q * (self.edits + 1))
        self.short = [(i, t) for i, (_, t) in enumerate(items) if 0 < len(t) < Q]

    def hits(self, text: np.ndarray):
        """(position in text, item, position in item) of each shared q-gram."""
        code = codes(text)
        at = np.flatnonzero(self.seen[code >> np.uint64(44)])
        if not len(at) or not len(self.code):
            return (np.zeros(0, np.int64),) * 3
        place = np.minimum(np.searchsorted(self.code, code[at]), len(self.code) - 1)
        same = self.code[place] == code[at]
        at, place = at[same], place[same]
        n = self.count[place]
        first = np.repeat(self.start[place] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return np.repeat(at, n), self.owner[first], self.place[first]


def regions(index: Index, doc: np.ndarray, at: np.ndarray, item: np.ndarray, place: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, item, least and greatest diagonal) of the bands that meet the bound in some window."""
    width = index.edits[item] + 1
    diagonal = at - place
    band = diagonal // width
    # A window of twice the length, at every length, holds each alignment of the length and its edits.
    window = at // (index.length[item] + index.edits[item])
    keys, out = [], set()
    for db in (0, 1):
        for dw in (0, 1):
            keys.append(np.stack([doc, item, band - db, window - dw, place], axis=1))
    rows = np.unique(np.concatenate(keys), axis=0)          # a q-gram of the item counts once
    if not len(rows):
        return []
    new = np.flatnonzero(np.r_[True, (rows[1:, :4] != rows[:-1, :4]).any(axis=1)])
    count = np.diff(np.r_[new, len(rows)])
    for d, i, b, _, _ in rows[new[count >= index.need[rows[new, 1]]]].tolist():
        w = int(index.edits[i]) + 1
        out.add((d, i, b * w, (b + 2) * w - 1))
    return sorted(out)


def align(text: bytes, item: bytes, low: int, high: int, least: int) -> tuple[int, int, int, int] | None:
    """Best stretch of the item in the diagonals low..high of the text, at least `least` characters with at
    most EDITS of them in edits: (item from, item to, text end, edits). A match scores 1 and an edit costs
    1 / EDITS - 1; the first pass starts a stretch anew where its score falls below zero, the second lets it
    fall by three edits, for edits near its start."""
    cost, best = 1 / EDITS - 1, None
    for floor in (0.0, -3 * cost):
        row = {d: (0.0, 0, 0) for d in range(low, high + 1)}  # (score, start in the item, edits) a diagonal
        for j, c in enumerate(item):
            new, left = {}, None
            for d in range(low, high + 1):
                i = j + d
                if not 0 <= i < len(text):
                    new[d], left = (0.0, j + 1, 0), None
                    continue
                s, a, e = row[d]
                options = [(s + 1, a, e) if text[i] == c else (s - cost, a, e + 1)]
                if d + 1 in row:                              # a character of the item is missing in the text
                    s, a, e = row[d + 1]
                    options.append((s - cost, a, e + 1))
                if left is not None:                          # a character of the text is extra
                    s, a, e = left
                    options.append((s - cost, a, e + 1))
                x = max(options, key=lambda o: (o[0], -o[1]))
                s, a, e = new[d] = left = x if x[0] >= floor else (0.0, j + 1, 0)
                n = j + 1 - a
                if n >= least and e <= EDITS * n and (best is None or (n, -e) > (best[1] - best[0], -best[3])):
                    best = (a, j + 1, i + 1, e)
            row = new
    return best


OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("matched_chars", pa.int64()), ("edits", pa.int64()),
                 ("item_chars", pa.int64()), ("end_position", pa.int64())])
OUT_DDL = "doc_id bigint, item_id bigint, matched_chars bigint, edits bigint, item_chars bigint, end_position bigint"


def search(index: Index, ids: list, texts: list[bytes]) -> list[tuple]:
    """OUT rows of a batch of normalised documents."""
    gap = b"\0" * Q
    joined = np.frombuffer(gap.join(texts), np.uint8).astype(np.uint64)
    starts = np.cumsum([0] + [len(t) + Q for t in texts[:-1]])
    at, item, place = index.hits(joined)
    doc = np.searchsorted(starts, at, side="right") - 1
    best: dict[tuple[int, int], tuple] = {}
    for d, i, low, high in regions(index, doc, at - starts[doc], item, place):
        whole, least = index.items[i][1], int(index.length[i])
        if (found := best.get((d, i))) and found[0] == len(whole) and not found[1]:
            continue
        m = align(texts[d], whole, low, high, least)
        if m and (found is None or (m[1] - m[0], -m[3]) > (found[0], -found[1])):
            best[d, i] = (m[1] - m[0], m[3], m[2])
    for i, t in index.short:
        for d, text in enumerate(texts):
            if (p := f" {text.decode('utf-8', 'replace')} ".find(f" {t.decode('utf-8', 'replace')} ")) >= 0:
                best[d, i] = (len(t), 0, p + len(t))
    return [(ids[d], index.items[i][0], n, e, len(index.items[i][1]), end) for (d, i), (n, e, end) in sorted(best.items())]


def blocks(benchmark: DataFrame):
    """Blocks of (item id, normalised text) with at most BLOCK_CHARS characters but for a single longer item."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(chars / (BLOCK_CHARS / 2)))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        yield [(r["item_id"], t) for r in part if (t := normal(r["text"]))]


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched_chars, edits, item_chars, end_position (in the normalised text) of every leak."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.length("text") > 0)
    out = None
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            index, ids, texts, n = Index(shared.value), [], [], 0
            emit = lambda rows: pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(OUT)], schema=OUT)
            for b in batches:
                for i, t in zip(b.column("doc_id"), b.column("text")):
                    ids.append(i.as_py())
                    texts.append(normal(t.as_py()))
                    n += len(texts[-1])
                    if n >= BATCH_BYTES:
                        yield emit(search(index, ids, texts))
                        ids, texts, n = [], [], 0
            if texts:
                yield emit(search(index, ids, texts))

        found = docs.mapInArrow(run, OUT_DDL)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without a leak, all columns, in one pass a block of items and without a shuffle."""
    out = documents
    for block in blocks(benchmark):
        shared = documents.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            index = Index(shared.value)
            for b in batches:
                texts, keep, n = [], [], 0
                column = b.column("text")
                for i in range(b.num_rows):
                    texts.append(normal(column[i].as_py()))
                    n += len(texts[-1])
                    if n >= BATCH_BYTES or i + 1 == b.num_rows:
                        bad = {row[0] for row in search(index, range(len(texts)), texts)}
                        keep += [k not in bad for k in range(len(texts))]
                        texts, n = [], 0
                yield b.filter(pa.array(keep, pa.bool_()))

        out = out.mapInArrow(run, documents.schema)
    return out
