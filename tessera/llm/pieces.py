"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

Greedy merging gives every prefix of a text one last token. A token that ends at a place
is that one exactly if it starts the text, or if the last token of the prefix before it
is compatible with it, i.e. merging the two tokens' characters on their own yields just
these two. So the encoder keeps one token per place: an automaton lists the tokens that
end there, the pair test picks the only fitting one, and the ids are read off backwards.
The pair test unwinds both tokens' merges from the border, the later one first; a pair
on the border that would have merged before them rules the two out.

Where no token runs from a visible character into a space mark, merges never cross the
border between them, and each such stretch is encoded on its own and remembered in a
bounded table. Stretches of any length are encoded whole.

The library normalises the text and decodes the ids; the tables are derived once on the
driver from the model file (a parameter) and broadcast with it: their size is that of the
vocabulary.

Edge cases: a null text counts as empty and gives no ids; malformed UTF-8 counts as
U+FFFD; characters outside the vocabulary become byte tokens; repeated rows and null ids
are kept; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

SPACE = "▁"
#: Stretches remembered by a worker, the longest of them, and remembered pair tests.
REMEMBERED, LONGEST, PAIRS = 1 << 19, 64, 1 << 20
#: Bytes of text that are encoded before their rows are handed on.
BATCH_BYTES = 4 << 20


def merged(text: str, ranks: dict[str, int]) -> list[tuple[str, str, str]]:
    """Greedy merging by definition: (joined, left, right) of each merge in order. Of the neighbours whose
    joined text is a token, the best ranked are joined first, of equal ones the leftmost."""
    at, nxt, prv = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
    heap = [(ranks[p], i, p) for i in range(len(at) - 1) if (p := at[i] + at[i + 1]) in ranks]
    heapify(heap)
    out = []
    while heap:
        _, i, p = heappop(heap)
        j = nxt[i]
        if at[i] is None or j == len(at) or at[i] + at[j] != p:
            continue
        out.append((p, at[i], at[j]))
        at[i], at[j], nxt[i] = p, None, nxt[j]
        if nxt[i] < len(at):
            prv[nxt[i]] = i
        for k in (prv[i], i):
            if k >= 0 and nxt[k] < len(at) and (q := at[k] + at[nxt[k]]) in ranks:
                heappush(heap, (ranks[q], k, q))
    return out


def symbols(text: str, ranks: dict[str, int]) -> list[str]:
    """The tokens that greedy merging leaves."""
    parts = list(text)
    for joined, left, right in merged(text, ranks):
        i = next(i for i in range(len(parts) - 1) if parts[i] == left and parts[i + 1] == right)
        parts[i:i + 2] = [joined]
    return parts


class Tables:
    """What encoding needs of a model: ids, merge ranks, and the last merge of each token."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        kind = pb.ModelProto.SentencePiece
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback:
            raise ValueError("the model must be a BPE model with byte fallback")
        if kinds & {kind.USER_DEFINED, kind.UNUSED}:
            raise ValueError("models with user-defined or unused tokens are not supported")
        self.model = model
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kind.BYTE}
        order = {s: i for i, s in enumerate(sorted({p.score for p in proto.pieces}, reverse=True))}
        self.ranks = {p: order[proto.pieces[i].score] for p, i in self.ids.items() if len(p) > 1}
        #: token -> (rank, left part, right part) of its last merge; tokens that merging never leaves are absent.
        self.splits, self.irregular = {}, set()
        for p, rank in sorted(self.ranks.items(), key=lambda x: len(x[0])):
            steps = merged(p, self.ranks)
            if steps and steps[-1][0] == p:
                _, left, right = steps[-1]
                self.splits[p] = rank, left, right
                if any(part in self.irregular or self.splits.get(part, (-1,))[0] > rank for part in (left, right)):
                    self.irregular.add(p)
        self.separable = not any(b == SPACE != a for p in self.ids for a, b in zip(p, p[1:]))


class Encoder:
    """Ids of texts as packed 32-bit integers. Tokens are numbered: those of the vocabulary, then characters outside it."""

    def __init__(self, tables: Tables):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.tables, self.library = tables, SentencePieceProcessor(model_proto=tables.model)
        self.names = [p for p in tables.ids if len(p) == 1 or p in tables.splits]
        self.numbers = {p: i for i, p in enumerate(self.names)}
        self.sizes = array("i", map(len, self.names))
        self.packs = [array("i", [tables.ids[p]]).tobytes() for p in self.names]
        self.automaton = ahocorasick.Automaton()
        for p, i in self.numbers.items():
            self.automaton.add_word(p, i)
        if self.names:
            self.automaton.make_automaton()
        self.stretches = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.pairs: dict[int, bool] = {}
        self.known = _Known(self)

    def number(self, char: str) -> int:
        """The number of a single character; outside the vocabulary it stands for its byte tokens."""
        if char not in self.numbers:
            self.numbers[char] = len(self.names)
            self.names.append(char)
            self.sizes.append(1)
            self.packs.append(array("i", [self.tables.bytes[b] for b in char.encode()]).tobytes())
        return self.numbers[char]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the characters of two tokens on their own leaves exactly these two."""
        ranks, splits = self.tables.ranks, self.tables.splits
        if a in self.tables.irregular or b in self.tables.irregular:
            return symbols(a + b, ranks) == [a, b]
        limit = len(ranks) + 1
        while True:
            if ranks.get(a + b, limit) < limit:
                return False
            x, y = splits.get(a), splits.get(b)
            if y and (not x or y[0] >= x[0]):    # of merges of one rank the left one comes first, so the right one is undone first
                limit, b = y[0] + 1, y[1]        # and a pair on the border comes before it at equal rank
            elif x:
                limit, a = x[0], x[2]
            else:
                return True

    def remember(self, a: int, b: int, key: int) -> bool:
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[key] = fits = self.compatible(self.names[a], self.names[b])
        return fits

    def tokens(self, text: str) -> list[int]:
        """Numbers of the tokens of a normalised stretch, by its prefix table."""
        sizes, known = self.sizes, self.pairs.get
        last: list[int] = [0] * len(text)        # the last token of the prefix that ends at a place
        place = 0                                # the next place to settle; the automaton lists matches by their end
        for end, token in self.automaton.iter(text) if self.numbers else ():
            if end < place:
                continue
            while place < end:                   # no token ends there: a character outside the vocabulary
                last[place] = self.number(text[place])
                place += 1
            start = end - sizes[token]
            if start >= 0:
                before = last[start]
                key = before << 32 | token
                fits = known(key)
                if not (self.remember(before, token, key) if fits is None else fits):
                    continue
            last[end] = token
            place = end + 1
        for place in range(place, len(text)):
            last[place] = self.number(text[place])
        out, at = [], len(text) - 1
        while at >= 0:
            out.append(last[at])
            at -= sizes[last[at]]
        out.reverse()
        return out

    def packed(self, stretch: str) -> bytes:
        return b"".join([self.packs[t] for t in self.tokens(stretch)])

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        norm = self.library.normalize(text)
        if self.tables.separable:
            return b"".join(map(self.known.__getitem__, self.stretches.findall(norm)))
        return self.packed(norm) if norm else b""

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


class _Known(dict):
    """Packed ids of stretches: at most two generations of REMEMBERED short ones."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.older = encoder, {}

    def __missing__(self, stretch: str) -> bytes:
        out = self.older.get(stretch)
        if out is None:
            out = self.encoder.packed(stretch)
        if len(stretch) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[stretch] = out
        return out


_ENCODER: list = []


def _encoder(broadcast) -> Encoder:
    """One encoder a worker process, kept between tasks of the same model."""
    if not _ENCODER or _ENCODER[0] != broadcast.value.model:
        _ENCODER[:] = [broadcast.value.model, Encoder(broadcast.value)]
    return _ENCODER[1]


def portions(sizes, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `limit` bytes."""
    start, total = 0, 0
    for i, s in enumerate(sizes):
        total += s
        if total >= limit:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def encoded(documents: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ids array<int> (without begin or end ids) and decoded string of every row."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql import functions as F

    with open(model, "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(Tables(f.read()))
    df = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("raw"))
    kind = df.schema["id"].dataType.simpleString()

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            raw = batch.column("raw")
            for lo, hi in portions(pc.fill_null(pc.binary_length(raw), 0).to_pylist()):
                packed = [encoder.encode(x.decode("utf-8", "replace")) if x else b"" for x in raw.slice(lo, hi - lo).to_pylist()]
                ids = np.frombuffer(b"".join(packed), np.int32)
                ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
                texts = [encoder.decode(ids[a:b].tolist()) if b > a else "" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), pa.ListArray.from_arrays(ends, ids), pa.array(texts, pa.string())],
                                                 names=["id", "ids", "decoded"])

    out = df.mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)
