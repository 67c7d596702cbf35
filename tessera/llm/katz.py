"""Katz backoff language model (bigrams over all training words).

Tokens are a text's words (A-Z lower-cased) and one end token. Every training word has
its own counts and bigrams; words not in training are one class, `unknown`:

    P(w | h)   = d(c) c(h, w) / c(h)           if the bigram was seen
               = alpha(h) P(w)                 otherwise
    P(w)       = d(c) c(w) / (N + 1)           training words; the end token undiscounted
    P(unknown) = the mass the discounts leave

d are Good-Turing discounts (Katz, counts up to 5); alpha(h) is the discounted
mass divided by the unigram mass of the words unseen after h, so each history
sums to one. Words and bigrams are told apart by 63-bit hashes.

Counts are stored in tables partitioned by bucket, one packed row a bucket; the bucket
number follows the corpus size. Words with at least max(2, N / HOT_WORDS) tokens (at most
HOT_WORDS of them) are hot: only their hashes, counts and weights are broadcast, which
changes where a count is looked up, not what is counted. A bigram lies in the bucket of its
history if that is not hot, else of its word if that is not hot, else of the pair; so all
bigrams of a history that is not hot meet in one bucket, which no hot word can fill. Counts
of its words that lie in other buckets (`guests`) are asked for once. Bigrams of two hot
words with at least N / HOT_BIGRAMS occurrences are resolved in the map task.

Texts never move: map tasks send packed (key, position in block) arrays to the buckets
and the buckets send sums back to the blocks. All documents are scored, in SLICES stored one after
the other, so that the arrays of one slice only are on disk at a time.

Edge cases: null text is empty (its only token is the end); a null id counts as
held out; repeated rows are scored one by one; an empty table gives no rows;
other columns are ignored. With no training rows every token is unknown.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import buckets, held_out, scratch, stored
from tessera.llm.parity import ODD, PIECE, SPACE, mixed

HOT_WORDS = 1 << 17
HOT_BIGRAMS = 1 << 19
START, END, FIRST = 0, 1, 2
TOP = np.uint64(1 << 63)  # set in hashes; places of hot words are below 2^32
CUT = 5                   # counts above are not discounted
CHARS_PER_BUCKET = 4e6
BLOCK_TOKENS, BLOCK_DOCS = 1_200_000, 8192
SENT_TOKENS = 400_000     # of a block that is scored: its keys are not summed first, so small blocks cost no disk
ROW_BIGRAMS = 1 << 15     # bigrams in one row of a table; larger rows cost the JVM whole regions of its heap in each copy
SLICES = 3                # of the documents, scored one after the other: what is sent for one is gone before the next


def good_turing(n) -> np.ndarray:
    """Discounts d[0..CUT] from counts of counts n[0..CUT+1]; where Good-Turing
    ratios are unusable, absolute discounts n1 / (n1 + 2 n2), kept in 0.1..0.9."""
    n = np.asarray(n, float)
    d = np.ones(CUT + 1)
    absolute = min(max(n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5, 0.1), 0.9)
    common = (CUT + 1) * n[CUT + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUT + 1):
        x = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] and common < 1 else 0.0
        d[r] = x if 0.0 < x < 1.0 else (r - absolute) / r
    return d


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(c <= CUT, d[np.minimum(c, CUT)], 1.0) * c


def _hashes(text: str | None) -> np.ndarray:
    """Hashes of all words in order; a long text is split piece by piece, each ending at white space."""
    b, at, out = (text or "").encode("utf-8", "surrogatepass").lower(), 0, []
    while at < len(b):
        space = SPACE.search(b, at + PIECE)
        end = space.start() if space else len(b)
        out += map(xxhash.xxh3_64_digest, b[at:end].split())
        at = end
    return np.frombuffer(b"".join(out), np.uint64)


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((spread >> np.uint64(33)) % np.uint64(n)).astype(np.int32)


def _pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Keys of bigrams: both places for two hot words, else a hash."""
    return np.where((h | w) < TOP, (h << np.uint64(32)) | w, mixed(h * ODD + w) | TOP)


def _pair_buckets(h: np.ndarray, w: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    return _bucket(np.where(h >= TOP, h, np.where(w >= TOP, w, keys)), n)


def _cuts(b: np.ndarray, n: int):
    """(bucket, from, to) of sorted bucket numbers."""
    cuts = np.searchsorted(b, np.arange(n + 1))
    return [(i, x, y) for i, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _joined(table: pa.Table, name: str, kind, only: int = 0) -> np.ndarray:
    """The packed values of a column in the rows of one kind."""
    held = [np.frombuffer(x.as_buffer(), kind) for k, x in zip(table.column("kind").to_pylist(), table.column(name)) if k == only]
    return np.concatenate(held) if held else np.zeros(0, kind)


def _unique_sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, their sums and the place of each in `keys`."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.array([], int)
    sums = np.add.reduceat(counts[order], first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    return keys[first], sums, order[first]


def _by_bucket(b: np.ndarray, n: int) -> np.ndarray:
    return np.argsort(b.astype(np.uint16) if n < 65536 else b, kind="stable")


def _histogram(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, CUT + 2), minlength=CUT + 3)[: CUT + 2].tolist()


#: Packed messages and tables: kind 0 words (a, counts), 1 bigrams (a, b, counts), 2 words of other buckets (a, counts),
#: 3 bigrams of hot words (key a, counts).
PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("counts", pa.binary()),
                    ("sender", pa.int32())])
PACKED_DDL = "bucket int, kind int, a binary, b binary, counts binary, sender int"
WORDS = pa.schema([("bucket", pa.int32()), ("words", pa.binary()), ("counts", pa.binary()), ("total", pa.int64()),
                   ("types", pa.int64()), ("histogram", pa.list_(pa.int64()))])
WORDS_DDL = "bucket int, words binary, counts binary, total bigint, types bigint, histogram array<bigint>"
BIGRAMS = pa.schema([("bucket", pa.int32()), ("first", pa.int32()), ("h", pa.binary()), ("w", pa.binary()), ("counts", pa.binary()), ("guests", pa.binary()),
                     ("hot", pa.binary()), ("hot_counts", pa.binary()), ("hot_cover", pa.binary()), ("histogram", pa.list_(pa.int64()))])
BIGRAMS_DDL = ("bucket int, first int, h binary, w binary, counts binary, guests binary, hot binary, hot_counts binary, "
               "hot_cover binary, histogram array<bigint>")


def unigram_counts(train: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, words, counts) of all training words as sorted hashes, one packed row a bucket."""
    def spread(batches):
        held, n = [], 0

        def flush():
            words, counts = np.unique(np.concatenate(held) | TOP, return_counts=True)
            held.clear()
            b = _bucket(words, n_buckets)
            order = _by_bucket(b, n_buckets)
            return _batch(PACKED, [(i, 0, words[order[x:y]].tobytes(), None, counts[order[x:y]].astype(np.uint32).tobytes(), None)
                                   for i, x, y in _cuts(b[order], n_buckets)])

        for batch in batches:
            for text in batch.column("text"):
                held.append(_hashes(text.as_py()))
                n += len(held[-1])
                if n >= BLOCK_TOKENS:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    def add(key, table):
        words, counts, _ = _unique_sum(_joined(table, "a", np.uint64), _joined(table, "counts", np.uint32))
        return pa.Table.from_batches([_batch(WORDS, [(key[0].as_py(), words.tobytes(), counts.tobytes(), int(counts.sum()),
                                                      len(words), _histogram(counts))])])

    return (train.select("text").mapInArrow(spread, PACKED_DDL)
            .groupBy("bucket").applyInArrow(add, WORDS_DDL))


def _packed_words(unigrams: DataFrame) -> DataFrame:
    none = F.lit(None)
    return unigrams.select("bucket", F.lit(0).alias("kind"), F.col("words").alias("a"), none.cast("binary").alias("b"), "counts",
                           none.cast("int").alias("sender"))


class Block:
    """The tokens of some texts, given as hashes of their words (which are let go): each distinct word coded once."""

    def __init__(self, held: list[np.ndarray], hot: np.ndarray):
        self.lengths = np.array([len(x) for x in held])
        all_ = np.concatenate(held) | TOP
        held.clear()
        order = np.argsort(all_)
        all_ = all_[order]
        new = np.r_[True, all_[1:] != all_[:-1]][:len(all_)]
        words, rank = all_[new], np.cumsum(new, dtype=np.int32) + np.int32(FIRST - 1)
        place = np.minimum(np.searchsorted(hot, words), max(len(hot) - 1, 0))
        known = hot[place] == words if len(hot) else np.zeros(len(words), bool)
        #: Identities: START, END, then place of a hot word or hash of another.
        self.ids = np.r_[np.array([START, END], np.uint64), np.where(known, place.astype(np.uint64) + np.uint64(FIRST), words)]
        ends = np.cumsum(self.lengths + 1) - 1
        inner = np.ones(len(all_) + len(self.lengths), bool)
        inner[ends] = False
        at = np.empty(len(all_), np.int32)
        at[order] = rank
        self.w = np.full(len(inner), END, np.int32)
        self.w[inner] = at
        self.h = np.r_[np.int32(START), self.w[:-1]]
        self.h[ends[:-1] + 1] = START

    def codes(self) -> np.ndarray:
        return self.h * np.int64(len(self.ids)) + self.w

    def pairs(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.ids[codes // len(self.ids)], self.ids[codes % len(self.ids)]


def bigram_counts(train: DataFrame, unigrams: DataFrame, hot, n_buckets: int) -> DataFrame:
    """Packed rows by bucket of all training bigrams: (h, w, counts) in key order from place `first` on, h and w as places among
    the hot words, then the bucket's own words, then its guests. The bucket's first row also holds the guests, counts of small
    counts and unigram mass by hot history, and the histogram."""
    def spread(batches):
        held, n = [], 0

        def flush():
            block = Block(held, hot.value["words"])
            codes, counts = np.unique(block.codes(), return_counts=True)
            h, w = block.pairs(codes)
            del block, codes
            keys, counts = _pair_keys(h, w), counts.astype(np.uint32)
            b, out = _pair_buckets(h, w, keys, n_buckets), []
            for kind, some in ((3, np.flatnonzero(keys < TOP)), (1, np.flatnonzero(keys >= TOP))):
                some = some[_by_bucket(b[some], n_buckets)]
                first, second, c = (keys if kind == 3 else h)[some], w[some], counts[some]
                out += [(i, kind, first[x:y].tobytes(), second[x:y].tobytes() if kind == 1 else None, c[x:y].tobytes(), None)
                        for i, x, y in _cuts(b[some], n_buckets)]
            return _batch(PACKED, out)

        for batch in batches:
            for text in batch.column("text"):
                held.append(_hashes(text.as_py()))
                n += len(held[-1]) + 1
                if n >= BLOCK_TOKENS:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    def add(key, table):
        m = hot.value
        words, c, size = _joined(table, "a", np.uint64), _joined(table, "counts", np.int64), len(m["p"])
        h, w = _joined(table, "a", np.uint64, 1), _joined(table, "b", np.uint64, 1)
        near, counts, _ = _unique_sum(_joined(table, "a", np.uint64, 3), _joined(table, "counts", np.uint32, 3))
        _, far, first = _unique_sum(_pair_keys(h, w), _joined(table, "counts", np.uint32, 1))
        # Keys of hot words are below all others.
        h, w, counts = np.r_[near >> np.uint64(32), h[first]], np.r_[near & np.uint64(0xFFFFFFFF), w[first]], np.r_[counts, far]
        del near, far, first
        ends = np.r_[words, np.uint64(0)]     # no word hash is 0

        def places(ids):
            out, far = np.where(ids < TOP, ids, 0).astype(np.int32), np.flatnonzero(ids >= TOP)
            there = np.searchsorted(words, ids[far])
            out[far] = size + there
            return out, far[ends[there] != ids[far]]

        (h, _), (places_w, other) = places(h), places(w)
        guests, at = np.unique(w[other], return_inverse=True)
        places_w[other] = size + len(words) + at
        w = places_w
        p = np.r_[m["p"], discounted(c, m["d1"]) / (m["n"] + 1)]
        warm = h < size                       # the words after a hot history are hot or of this bucket
        found, at = np.unique(h[warm], return_inverse=True)
        few = np.minimum(counts[warm], CUT + 1)
        small = np.bincount(at * (CUT + 2) + few, minlength=len(found) * (CUT + 2)).reshape(-1, CUT + 2)[:, 1:CUT + 1]
        cover = np.bincount(at, p[w[warm]], minlength=len(found))
        whole = (guests.tobytes(), found.astype(np.int32).tobytes(), small.astype(np.int64).tobytes(), cover.tobytes(), _histogram(counts))
        rest = (b"", b"", b"", b"", [0] * (CUT + 2))
        return pa.Table.from_batches([_batch(BIGRAMS, [
            (key[0].as_py(), i, *[x[i:i + ROW_BIGRAMS].tobytes() for x in (h, w, counts)], *(rest if i else whole))
            for i in range(0, max(1, len(h)), ROW_BIGRAMS)])])

    return (train.select("text").mapInArrow(spread, PACKED_DDL).unionByName(_packed_words(unigrams))
            .groupBy("bucket").applyInArrow(add, BIGRAMS_DDL))


def guest_counts(bigrams: DataFrame, unigrams: DataFrame, n_buckets: int) -> DataFrame:
    """Packed rows of kind 2: for each bucket, the counts of its guests, from the buckets that hold them."""
    def ask(batches):
        for batch in batches:
            out = []
            for sender, guests in zip(batch.column("bucket").to_pylist(), batch.column("guests").to_pylist()):
                words = np.frombuffer(guests, np.uint64)
                b = _bucket(words, n_buckets)
                order = _by_bucket(b, n_buckets)
                out += [(i, 2, words[order[x:y]].tobytes(), None, None, sender) for i, x, y in _cuts(b[order], n_buckets)]
            yield _batch(PACKED, out)

    def reply(key, table):
        rows = table.to_pylist()
        mine = next(r for r in rows if r["kind"] == 0)
        words, counts = np.frombuffer(mine["a"], np.uint64), np.frombuffer(mine["counts"], np.int64)
        return pa.Table.from_batches([_batch(PACKED, [
            (r["sender"], 2, r["a"], None, counts[np.searchsorted(words, np.frombuffer(r["a"], np.uint64))].tobytes(), None)
            for r in rows if r["kind"] == 2])])

    return (bigrams.where("first = 0").select("bucket", "guests").mapInArrow(ask, PACKED_DDL).unionByName(_packed_words(unigrams))
            .groupBy("bucket").applyInArrow(reply, PACKED_DDL))


def _totals(table: DataFrame, *others: str) -> list[int]:
    """Histogram of small counts, then the sums of other columns."""
    row = table.agg(*[F.sum(F.element_at("histogram", i + 1)) for i in range(CUT + 2)], *[F.sum(c) for c in others]).first()
    return [int(x or 0) for x in row]


def _hot_words(unigrams: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the words with at least `least` tokens."""
    def pick(batches):
        for batch in batches:
            for k, c in zip(batch.column("words"), batch.column("counts")):
                words, counts = np.frombuffer(k.as_py(), np.uint64), np.frombuffer(c.as_py(), np.int64)
                hot = counts >= least
                yield pa.RecordBatch.from_arrays([pa.array(words[hot].astype(np.int64)), pa.array(counts[hot])], names=["k", "n"])

    t = unigrams.select("words", "counts").mapInArrow(pick, "k bigint, n bigint").toArrow()
    k, n = t.column(0).to_numpy().astype(np.uint64), t.column(1).to_numpy()
    order = np.argsort(k)
    return k[order], n[order]


def _history_sums(bigrams: DataFrame, size: int, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hot history: the tokens that the discounts take, unigram mass of the words seen after it."""
    def sums(batches):
        for batch in batches:
            for k, c, u in zip(*(batch.column(x) for x in ("hot", "hot_counts", "hot_cover"))):
                small = np.frombuffer(c.as_py(), np.int64).reshape(-1, CUT)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(k.as_py(), np.int32).astype(np.int64)), pa.array(small @ (np.arange(1, CUT + 1) * (1 - d[1:]))),
                    pa.array(np.frombuffer(u.as_py(), np.float64))], names=["h", "s", "u"])

    rows = (bigrams.where("first = 0").select("hot", "hot_counts", "hot_cover").mapInArrow(sums, "h bigint, s double, u double")
            .groupBy("h").agg(F.sum("s"), F.sum("u")).toArrow())
    out = np.zeros((2, size))
    if rows.num_rows:
        out[:, rows.column(0).to_numpy()] = [rows.column(i).to_numpy() for i in (1, 2)]
    return out[0], out[1]


def _hot_bigrams(bigrams: DataFrame, least: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """History, word and count of bigrams of two hot words."""
    def pick(batches):
        for batch in batches:
            for h, w, c in zip(*(batch.column(x) for x in ("h", "w", "counts"))):
                h, w, c = np.frombuffer(h.as_py(), np.int32), np.frombuffer(w.as_py(), np.int32), np.frombuffer(c.as_py(), np.int64)
                hot = (c >= least) & (h < size) & (w < size)
                yield pa.RecordBatch.from_arrays([pa.array(h[hot]), pa.array(w[hot]), pa.array(c[hot])], names=["h", "w", "n"])

    t = bigrams.select("h", "w", "counts").mapInArrow(pick, "h int, w int, n bigint").toArrow()
    return tuple(t.column(i).to_numpy() for i in range(3))


def _backoff(seen: np.ndarray, taken: np.ndarray, cover: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """log10 of alpha and the factor on the seen bigrams of each history. Where no count is discounted, one token is left to
    the others; the unknown class is never seen, so that at least 1 / (n + 1) of the unigram mass is."""
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.where(seen > 0, 1 - taken / seen, 0.0)
        norm = np.where(s >= 1 - 1e-12, seen / (seen + 1), 1.0)
        alpha = np.where(seen > 0, (1 - s * norm) / np.maximum(1 - cover, 1 / (n + 1)), 1.0)
    return np.log10(alpha), norm


def fit(train: DataFrame, n_buckets: int, folder: str) -> dict:
    """Counts the training texts and returns the model: the stored tables, and the bounded parts
    (hot words and bigrams, their backoff weights, discounts) that every task needs."""
    sc = train.sparkSession.sparkContext
    unigrams = stored(unigram_counts(train, n_buckets), f"{folder}/unigrams")
    ends = train.count()
    *hist, total, types = _totals(unigrams, "total", "types")
    n, v = total + ends, types + (ends > 0)
    words, count = _hot_words(unigrams, max(2, -(-n // HOT_WORDS)))
    d1 = good_turing(hist)
    counts = np.r_[ends, ends, count].astype(float)        # START is as frequent as END
    unknown = (n + 1 - ends - total + sum(hist[r] * r * (1 - d1[r]) for r in range(1, CUT + 1))) / (n + 1)
    p = np.r_[0.0, ends / (n + 1), discounted(count, d1) / (n + 1)]
    bigrams = stored(bigram_counts(train, unigrams, sc.broadcast({"words": words, "p": p, "d1": d1, "n": n}), n_buckets),
                     f"{folder}/bigrams")
    guests = stored(guest_counts(bigrams, unigrams, n_buckets), f"{folder}/guests")
    d2 = good_turing(_totals(bigrams))
    log_alpha, norm = _backoff(counts, *_history_sums(bigrams, len(p), d2), n)
    log_p = np.log10(np.where(p > 0, p, unknown))
    h, w, c = _hot_bigrams(bigrams, max(2, -(-n // HOT_BIGRAMS)), len(p))
    keys = _pair_keys(h.astype(np.uint64), w.astype(np.uint64))
    order = np.argsort(keys)
    small = {"words": words, "n": n, "v": v, "d1": d1, "d2": d2, "counts": counts, "log_p": log_p, "log_alpha": log_alpha,
             "norm": norm, "log_unknown": float(np.log10(unknown)), "hot_keys": keys[order],
             "hot_gain": _gain(h, w, c, d2, counts, log_p, log_alpha, norm)[order]}
    return {"unigrams": unigrams, "bigrams": bigrams, "guests": guests, "n_buckets": n_buckets, "small": small}


def _gain(h, w, c, d2, seen, log_p, log_alpha, norm) -> np.ndarray:
    """log10 of a seen bigram's probability over that by backing off."""
    return np.log10(discounted(c, d2) * norm[h] / seen[h]) - log_alpha[h] - log_p[w]


SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("at", pa.binary()), ("words", pa.binary()),
                  ("word_at", pa.binary()), ("doc", pa.binary())])
SENT_DDL = "bucket int, block bigint, keys binary, at binary, words binary, word_at binary, doc binary"
SUMS = pa.schema([("block", pa.int64()), ("gain", pa.binary()), ("at", pa.binary()), ("base", pa.binary()),
                  ("score", pa.binary()), ("known", pa.binary()), ("doc", pa.binary())])
SUMS_DDL = "block bigint, gain binary, at binary, base binary, score binary, known binary, doc binary"
OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                 ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
OUT_DDL = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
           "base_score double, score double")
DOC = np.dtype([("id", np.int64), ("has", np.bool_), ("held", np.bool_), ("n", np.int64), ("known", np.int64),
                ("base", np.float64), ("score", np.float64)])


def score(docs: DataFrame, model: dict) -> DataFrame:
    """OUT rows for docs(doc_id, text, held): every token through the stored tables."""
    small, n_buckets = docs.sparkSession.sparkContext.broadcast(model["small"]), model["n_buckets"]

    def floor_of(m):
        return np.log10(m["n"] + 0.1 * (m["v"] + 1)) if m["n"] else np.log10(0.1)

    def send(batches):
        m = small.value
        base = np.log10(m["counts"] + 0.1) - floor_of(m)
        known = m["counts"] > 0
        part, block = TaskContext.get().partitionId(), 0
        docs_, held_, n = [], [], 0

        def flush():
            number, rows = part * (1 << 24) + block, {}
            x = Block(held_, m["words"])
            doc_at = np.repeat(np.arange(len(docs_), dtype=np.uint16), x.lengths + 1)
            add = lambda values: np.bincount(doc_at, values, minlength=len(docs_))
            hot = x.ids < TOP
            place = np.where(hot, x.ids, 0).astype(np.int64)
            own = lambda values: np.where(hot, values[place], 0.0)
            # Hot words are resolved here, as words and as histories.
            n_tokens, n_known = x.lengths + 1, add(own(known)[x.w]).astype(np.int64)
            bases, scores = add(own(base)[x.w]), add(own(m["log_p"])[x.w]) + add(own(m["log_alpha"])[x.h])
            codes = x.codes()
            order = np.argsort(codes)
            codes = codes[order]
            new = np.r_[True, codes[1:] != codes[:-1]]
            h, w = x.pairs(codes[new])
            keys, at = _pair_keys(h, w), np.empty(len(codes), np.int32)
            at[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
            del codes, order, new
            left = np.ones(len(keys), bool)
            if len(m["hot_keys"]):
                near = np.minimum(np.searchsorted(m["hot_keys"], keys), len(m["hot_keys"]) - 1)
                left = m["hot_keys"][near] != keys
                scores += add(np.where(left, 0.0, m["hot_gain"][near])[at])
            b = _pair_buckets(h, w, keys, n_buckets)
            del h, w
            rank, order = np.empty(len(keys), np.int32), np.argsort(keys)
            order = order[_by_bucket(b[order], n_buckets)]
            rank[order] = np.arange(len(keys), dtype=np.int32)
            tokens = np.flatnonzero(left[at])
            tokens = tokens[np.argsort(rank[at[tokens]].astype(np.int64))]
            at, where = at[tokens], doc_at[tokens]
            for i, lo, hi in _cuts(b[at], n_buckets):
                rows[i] = [i, number, keys[at[lo:hi]].tobytes(), where[lo:hi].tobytes(), None, None, None]
            b = _bucket(x.ids, n_buckets)
            tokens = np.flatnonzero(~hot[x.w])
            tokens = tokens[np.argsort(x.w[tokens])]
            tokens = tokens[_by_bucket(b[x.w[tokens]], n_buckets)]
            at, where = x.w[tokens], doc_at[tokens]
            for i, lo, hi in _cuts(b[at], n_buckets):
                row = rows.setdefault(i, [i, number] + [None] * 5)
                row[4:6] = x.ids[at[lo:hi]].tobytes(), where[lo:hi].tobytes()
            doc = np.array([(i or 0, i is not None, held, 0, 0, 0.0, 0.0) for i, held in docs_], DOC)
            doc["n"], doc["known"], doc["base"], doc["score"] = n_tokens, n_known, bases, scores
            out = [tuple(r) for r in rows.values()]
            out.append((number % n_buckets, number, None, None, None, None, doc.tobytes()))
            docs_.clear()
            return _batch(SENT, out)

        for batch in batches:
            for i, text, held in zip(batch.column("doc_id"), batch.column("text"), batch.column("held")):
                docs_.append((i.as_py(), held.as_py()))
                held_.append(_hashes(text.as_py()))
                n += len(held_[-1]) + 1
                if n >= SENT_TOKENS or len(docs_) >= BLOCK_DOCS:
                    yield flush()
                    block, n = block + 1, 0
        if docs_:
            yield flush()

    def look_up(sent, tables):
        m = small.value
        words, own = _joined(tables, "a", np.uint64), _joined(tables, "counts", np.int64)
        guest, more, _ = _unique_sum(_joined(tables, "a", np.uint64, 2), _joined(tables, "counts", np.int64, 2))
        tables = tables.take(pc.sort_indices(tables.column("sender")))       # of bigrams their first place: in key order again
        h, w, c = _joined(tables, "a", np.int32, 1), _joined(tables, "b", np.int32, 1), _joined(tables, "counts", np.int64, 1)
        size = len(m["counts"])
        ids = np.r_[np.arange(size, dtype=np.uint64), words, guest]
        log_p = np.r_[m["log_p"], np.log10(discounted(np.r_[own, more], m["d1"]) / (m["n"] + 1))]
        cold, d = h >= size, discounted(c, m["d2"])
        sums = [np.bincount(h[cold] - size, x, minlength=len(words)) for x in ((c - d)[cold], 10.0 ** log_p[w[cold]])]
        log_alpha, norm = _backoff(own, *sums, m["n"])
        gain = _gain(h, w, c, m["d2"], np.r_[m["counts"], own], log_p, np.r_[m["log_alpha"], log_alpha], np.r_[m["norm"], norm])
        keys = _pair_keys(ids[h], ids[w])
        del h, w, c, d, cold, ids, sums
        # One more place for words that are not in training.
        count = np.r_[own, 0]
        base, node = np.log10(count + 0.1) - floor_of(m), np.r_[log_p[size:size + len(words)] + log_alpha, m["log_unknown"]]
        out = []
        for r in sent.to_pylist():
            if r["doc"] is not None:
                out.append((r["block"], None, None, None, None, None, r["doc"]))
            if r["keys"] is not None and len(keys):
                k, at = np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["at"], np.uint16)
                place = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                hit = keys[place] == k
                sums = np.bincount(at[hit], gain[place[hit]])
                some = np.flatnonzero(sums)
                out.append((r["block"], sums[some].tobytes(), some.astype(np.uint16).tobytes(), None, None, None, None))
            if r["words"] is not None:
                k, at = np.frombuffer(r["words"], np.uint64), np.frombuffer(r["word_at"], np.uint16)
                place = np.searchsorted(words, k)
                place[np.r_[words, np.uint64(0)][place] != k] = len(words)
                parts = [np.bincount(at, x[place]) for x in (base, node, count > 0)]
                some = np.unique(at)
                out.append((r["block"], None, some.tobytes(), *[x[some].astype(float).tobytes() for x in parts], None))
        return pa.Table.from_batches([_batch(SUMS, out)])

    def total(key, table):
        n_train = small.value["n"]
        rows = table.to_pylist()
        doc = np.frombuffer(next(r["doc"] for r in rows if r["doc"] is not None), DOC).copy()
        for r in sorted((r for r in rows if r["at"] is not None), key=lambda r: (r["at"], r["gain"] or b"", r["score"] or b"")):
            at = np.frombuffer(r["at"], np.uint16)
            if r["gain"] is not None:
                doc["score"][at] += np.frombuffer(r["gain"], float)
            else:
                doc["base"][at] += np.frombuffer(r["base"], float)
                doc["score"][at] += np.frombuffer(r["score"], float)
                doc["known"][at] += np.frombuffer(r["known"], float).astype(np.int64)
        return pa.table([pa.array(doc["id"], mask=~doc["has"]), pa.array(doc["held"]), pa.array(doc["n"]),
                         pa.array(doc["known"]), pa.array(np.full(len(doc), n_train, np.int64)),
                         pa.array(doc["base"]), pa.array(doc["score"])], schema=OUT)

    bigrams = model["bigrams"].select("bucket", F.lit(1).alias("kind"), F.col("h").alias("a"), F.col("w").alias("b"), "counts",
                                      F.col("first").alias("sender"))
    tables = _packed_words(model["unigrams"]).unionByName(bigrams).unionByName(model["guests"])
    return (docs.select("doc_id", "text", "held").mapInArrow(send, SENT_DDL).groupBy("bucket")
            .cogroup(tables.groupBy("bucket")).applyInArrow(look_up, SUMS_DDL)
            .groupBy("block").applyInArrow(total, OUT_DDL))


def katz_scores(documents: DataFrame, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"),
                            held_out(F.col("doc_id"), folds).alias("held"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0]
    train = docs.where(~F.col("held")).select("text")
    folder = scratch(spark)
    model = fit(train, buckets(chars, CHARS_PER_BUCKET), folder)
    at = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(SLICES))
    scored = [stored(score(docs.where(at == i), model), f"{folder}/scores{i}") for i in range(SLICES)]
    return reduce(DataFrame.unionByName, scored)
