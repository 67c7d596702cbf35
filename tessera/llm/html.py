"""Main text of web pages by differencing with the page of the nearest URL.

A page becomes lines (one a block). Within each host, distinct pages are sorted by
URL path; the nearest page is the neighbour with the longer common path prefix (the
previous one in a tie). Their lines are aligned by longest common subsequence and
shared lines are deleted, unless they lie in an explicit article element, whose
text the contract keeps whole. Lines of elements that are boilerplate by their name,
class or role (menus, adverts, notices, forms, comments, ...) go as well, shared or
not, and where a page has an article, so does what stands outside it.

Only line hashes are sorted: pages of a host are range-partitioned by (host, path),
so a hot host is spread over many tasks; the ends of the partitions (two rows each)
are handed to their neighbours. Copies of a page within a host share one entry.

Edge cases: null and empty html give empty text; null URLs belong to the empty host
and path; a page without a neighbour in its host has no shared line; unclosed
elements end with their container or the page; repeated rows give equal results;
other columns are not carried.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left
from collections import defaultdict
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.urls import host_of, path_of

_RAW = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select|head|title|button|object)\b"
                  r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>", re.S | re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>")
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_DROPPED = frozenset("nav footer aside form header menu dialog".split())
_DROPPED_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
                           "sidebar footer breadcrumb breadcrumbs cookie cookies consent notice notices popup modal newsletter subscribe "
                           "signup login share sharing social related comment comments disqus respond reply replies masthead".split())
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
PLAIN, ARTICLE, DROPPED = 0, 1, 2


@lru_cache(4096)
def _boilerplate(attributes: str) -> bool:
    for kind, *values in _NAMED.findall(attributes):
        words = next((v for v in values if v), "").lower().split()
        if kind.lower() == "role":
            if _DROPPED_ROLES & set(words):
                return True
        elif any(_DROPPED_WORDS & set(re.split(r"[-_]+", w)) or w in ("header", "site-header", "page-header") for w in words):
            return True
    return False


def lines(page: str | None) -> list[tuple[str, int]]:
    """Blocks of a page as (text, PLAIN | ARTICLE | DROPPED), in order."""
    out, held = [], []
    page = _RAW.sub(" ", page or "")
    inside, skip, depth, at = 0, None, 0, 0

    def flush():
        text = " ".join(entities.unescape("".join(held)).split())
        if text:
            out.append((text, DROPPED if skip else ARTICLE if inside else PLAIN))
        held.clear()

    for m in _TAG.finditer(page):
        held.append(page[at:m.start()])
        at = m.end()
        close, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        name = name.lower()
        if name == "br":
            held.append(" ")
        dropped = not close and name not in _VOID and (
            name in _DROPPED and not (name == "header" and inside) or bool(attributes) and _boilerplate(attributes))
        if name in _BLOCK or dropped:
            flush()
        if skip:
            if name == skip and not attributes.endswith("/"):
                if close and depth == 1:
                    flush()
                depth += -1 if close else 1
                if not depth:
                    skip = None
            elif not close and name in ("article", "main") and skip in ("nav", "header", "form", "menu"):
                skip = None                                   # the container was never closed
        elif dropped and not attributes.endswith("/"):
            skip, depth = name, 1
        if name in ("article", "main") and not skip:
            inside = max(0, inside - 1) if close else inside + 1
    held.append(page[at:])
    flush()
    return out


def common(a: list[bytes], b: list[bytes]) -> list[int]:
    """Positions in a of a longest common subsequence with b: equal ends, then by bit rows.

    Row i has a bit at j where the subsequence of left[:i] and right grows with right[j]; a row
    follows from the one before in a few operations on whole numbers. Every step-th row is
    kept, the rows between are made again on the way back, so memory grows with the root of
    the rows. From the end, the first place in right that allows the length is taken, and the
    last place in left with that line.
    """
    n = min(len(a), len(b))
    head = next((i for i in range(n) if a[i] != b[i]), n)
    tail = next((i for i in range(n - head) if a[-1 - i] != b[-1 - i]), n - head)
    left, right = a[head:len(a) - tail], b[head:len(b) - tail]
    both = set(left) & set(right)
    at = [i for i, x in enumerate(left) if x in both]
    left, right = [left[i] for i in at], [x for x in right if x in both]
    in_left, in_right = defaultdict(list), defaultdict(list)
    for found, of in ((in_left, left), (in_right, right)):
        for i, x in enumerate(of):
            found[x].append(i)
    full, often = (1 << len(right)) - 1, {}

    def places(x):
        if x in often:
            return often[x]
        bits = bytearray(len(right) // 8 + 1)
        for j in in_right[x]:
            bits[j >> 3] |= 1 << (j & 7)
        made = int.from_bytes(bits, "little")
        if len(in_right[x]) ** 2 > len(right):
            often[x] = made
        return made

    def after(row, x):
        free = full ^ row
        hit = free & places(x)
        return full ^ (((free + hit) | (free - hit)) & full)

    step = isqrt(len(left)) + 1
    kept, row = [], 0
    for i, x in enumerate(left):
        if i % step == 0:
            kept.append(row)
        row = after(row, x)
    mid, rows, i, j = [], [], len(left), len(right)
    while (grown := row & ((1 << j) - 1)):
        j = grown.bit_length() - 1
        seen = in_left[right[j]]
        i = seen[bisect_left(seen, i) - 1]
        mid.append(head + at[i])
        if not rows or i < first:
            first = i - i % step
            rows = [kept[first // step]]
            for x in left[first:i]:
                rows.append(after(rows[-1], x))
        row = rows[i - first]
    return [*range(head), *reversed(mid), *range(len(a) - tail, len(a))]


def _hash(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()


def _prefix(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def shared_lines(entries: DataFrame) -> DataFrame:
    """(host, digest, shared array<int>) for entries(host, path, digest, hashes), one a distinct page of a host:
    the positions of the lines that the page shares with the page of the nearest URL."""
    rows = (entries.repartitionByRange("host", "path", "digest").sortWithinPartitions("host", "path", "digest")
            .select("host", "path", "digest", "hashes").checkpoint())
    ends_ddl = "part int, n int, host string, path string, digest binary, hashes binary"

    def edges(batches):
        first = last = None
        for b in batches:
            if b.num_rows:
                first = first or b.slice(0, 1).to_pylist()[0]
                last = b.slice(b.num_rows - 1).to_pylist()[0]
        if first:
            part = TaskContext.get().partitionId()
            out = [{"part": part, "n": i, **r} for i, r in enumerate((first, last))]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("part", pa.int32()), ("n", pa.int32()), ("host", pa.string()),
                                                                    ("path", pa.string()), ("digest", pa.binary()), ("hashes", pa.binary())]))

    # Two rows a partition: what a partition's ends need to know of their neighbours.
    ends = sorted(rows.mapInArrow(edges, ends_ddl).collect(), key=lambda r: (r["part"], r["n"]))
    order = sorted({r["part"] for r in ends})
    firsts, lasts = ({r["part"]: r.asDict() for r in ends if r["n"] == n} for n in (0, 1))
    outer = rows.sparkSession.sparkContext.broadcast(
        {p: (lasts[order[i - 1]] if i else None, firsts[order[i + 1]] if i + 1 < len(order) else None) for i, p in enumerate(order)})
    schema = pa.schema([("host", pa.string()), ("digest", pa.binary()), ("shared", pa.list_(pa.int32()))])

    def differ(batches):
        before, after = outer.value.get(TaskContext.get().partitionId(), (None, None))

        def result(prev, row, nxt):
            near = [(_prefix(row["path"], o["path"]), rank, o) for rank, o in ((1, prev), (0, nxt)) if o and o["host"] == row["host"]]
            out = []
            if near:
                other = max(near, key=lambda x: x[:2])[2]
                cut = lambda x: [x[i:i + 8] for i in range(0, len(x), 8)]
                out = common(cut(row["hashes"]), cut(other["hashes"]))
            return {"host": row["host"], "digest": row["digest"], "shared": out}

        prev, row = None, before
        for b in batches:
            out = []
            for nxt in b.to_pylist():
                if row is not None and row is not before:
                    out.append(result(prev, row, nxt))
                prev, row = row, nxt
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if row is not None and row is not before:
            yield pa.RecordBatch.from_pylist([result(prev, row, after)], schema=schema)

    return rows.mapInArrow(differ, "host string, digest binary, shared array<int>")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_lines, n_shared of pages(page_id, url, html)."""
    urls = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    digest = lambda hashes: hashlib.blake2b(hashes, digest_size=16).digest()
    light = pa.schema([("host", pa.string()), ("path", pa.string()), ("digest", pa.binary()), ("hashes", pa.binary())])

    def hashes(batches):
        for b in batches:
            packed = [b"".join(_hash(t) for t, _ in lines(h.as_py())) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("host"), b.column("path"), pa.array([digest(x) for x in packed], pa.binary()),
                                              pa.array(packed, pa.binary())], schema=light)

    kept = pa.list_(pa.struct([("i", pa.int32()), ("t", pa.string()), ("fixed", pa.bool_())]))
    full = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("digest", pa.binary()),
                      ("n_lines", pa.int64()), ("kept", kept)])

    def parsed(batches):
        for b in batches:
            digests, counts, rows = [], [], []
            for h in b.column("html"):
                found = lines(h.as_py())
                wanted = ARTICLE if any(kind == ARTICLE for _, kind in found) else PLAIN
                digests.append(digest(b"".join(_hash(t) for t, _ in found)))
                counts.append(len(found))
                rows.append([{"i": i, "t": t, "fixed": kind == ARTICLE} for i, (t, kind) in enumerate(found) if kind == wanted])
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), b.column("host"), pa.array(digests, pa.binary()),
                                              pa.array(counts, pa.int64()), pa.array(rows, kept)], schema=full)

    entries = (urls.select("host", "path", "html").mapInArrow(hashes, "host string, path string, digest binary, hashes binary")
               .groupBy("host", "digest").agg(F.min("path").alias("path"), F.first("hashes").alias("hashes")))
    shared = shared_lines(entries)
    rows = (urls.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", "host").mapInArrow(
        parsed, "page_id bigint, url string, host string, digest binary, n_lines bigint, "
                "kept array<struct<i:int,t:string,fixed:boolean>>").join(shared, ["host", "digest"], "left"))
    mask = F.coalesce(F.col("shared"), F.array().cast("array<int>"))
    text = F.array_join(F.transform(F.filter("kept", lambda x: x["fixed"] | ~F.array_contains(mask, x["i"])), lambda x: x["t"]), "\n")
    return rows.select("page_id", "url", text.alias("text"), F.length(text).cast("bigint").alias("n_chars"), "n_lines",
                       F.size(mask).cast("bigint").alias("n_shared"))
