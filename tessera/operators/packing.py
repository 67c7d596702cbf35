"""Ordered next-fit packing of logical inputs into requests.

Semantics (sequential definition): inputs of one settings group are visited in
order; a new request starts when the open one already holds `max_inputs`
items, or when adding the input would push its token sum above `max_tokens`.
The first input of a request is always accepted (oversized inputs are rejected
before packing, see `prepare.oversized_inputs`).

Parallel plan, exact for any data layout:

* item ceiling only: the request number is `rank // max_inputs`, where the rank
  inside the group comes from a distributed range sort (`rank_within`);
* with a token ceiling: the group is range-partitioned on (group, order) and
  checkpointed. Pass 1 summarises each partition with NumPy: for the group
  that opens the partition, the outcome for every possible entry state (at most
  `max_inputs` distinct ones), and for the group that closes it, its exit state.
  A per-group composition over those small summaries yields each partition's
  entry state; pass 2 streams the partition again and numbers requests.

No step holds a whole group: a hot group is cut into many partitions, and only
one summary row per partition travels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.ordered import MID, PART, RANK, range_sorted, rank_within

BATCH = "batch_no"

_SUMMARY_SCHEMA = T.StructType([
    T.StructField("part", T.LongType()),
    T.StructField("grp", T.StringType()),
    T.StructField("role", T.StringType()),          # 'first' or 'last'
    T.StructField("spans", T.BooleanType()),        # first segment reaches the partition end
    T.StructField("m", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("head_p", T.ArrayType(T.LongType())),
    T.StructField("head_d", T.ArrayType(T.LongType())),
    T.StructField("head_c", T.ArrayType(T.LongType())),
    T.StructField("head_s", T.ArrayType(T.LongType())),
])

_ENTRY_SCHEMA = T.StructType([
    T.StructField("part", T.LongType()),
    T.StructField("grp", T.StringType()),
    T.StructField("c", T.LongType()),
    T.StructField("s", T.LongType()),
    T.StructField("b", T.LongType()),
])


def _ends(tok: np.ndarray, max_items: int, max_tok: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and, for a request opened at row j, its exclusive end row."""
    m = len(tok)
    prefix = np.zeros(m + 1, dtype=np.int64)
    np.cumsum(tok, out=prefix[1:])
    idx = np.arange(m, dtype=np.int64)
    end = np.minimum(idx + max_items, m)
    if max_tok is not None:
        fit = np.searchsorted(prefix, prefix[:-1] + max_tok, side="right") - 1
        end = np.minimum(end, np.maximum(fit, idx + 1))
    return prefix, end


def _chains(end: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Pointer jumping: requests opened from row j to the end, and the last opening row."""
    nxt = np.append(end, m)
    depth = np.append(np.ones(m, dtype=np.int64), 0)
    last = np.arange(m + 1, dtype=np.int64)
    while True:
        act = np.nonzero(nxt[:m] != m)[0]
        if act.size == 0:
            break
        q = nxt[act]
        depth[act] = depth[act] + depth[q]
        last[act] = last[q]
        nxt[act] = nxt[q]
    return depth[:m], last[:m]


def _first_break(prefix: np.ndarray, c: int, s: int, max_items: int, max_tok: int | None,
                 limit: int) -> int:
    """First row (< limit) that cannot join an open request holding c items, s tokens."""
    k = np.arange(limit, dtype=np.int64)
    brk = c + k >= max_items
    if max_tok is not None:
        brk = brk | (s + prefix[1:limit + 1] > max_tok)
    hit = np.nonzero(brk)[0]
    return int(hit[0]) if hit.size else limit


def next_fit(tok: np.ndarray, max_items: int, max_tok: int | None,
             entry: tuple[int, int, int] | None) -> tuple[np.ndarray, tuple[int, int, int]]:
    """Number requests for one run of rows of a group.

    `entry` is the open request `(items, tokens, request_no)` carried in, or
    None when the group starts here. Returns per-row request numbers and the
    open request at the end.
    """
    m = len(tok)
    out = np.empty(m, dtype=np.int64)
    prefix, end = _ends(tok, max_items, max_tok)
    start, number = 0, 0
    if entry is not None:
        c, s, b = entry
        k = _first_break(prefix, c, s, max_items, max_tok, m)
        out[:k] = b
        if k == m:
            return out, (c + m, s + int(prefix[m]), b)
        start, number = k, b + 1
    j = start
    while True:
        e = int(end[j])
        out[j:e] = number
        if e >= m:
            return out, (m - j, int(prefix[m] - prefix[j]), number)
        j, number = e, number + 1


def _segments(grp: np.ndarray) -> list[tuple[int, int]]:
    if len(grp) == 0:
        return []
    change = np.nonzero(grp[1:] != grp[:-1])[0] + 1
    bounds = np.concatenate([[0], change, [len(grp)]])
    return [(int(bounds[i]), int(bounds[i + 1])) for i in range(len(bounds) - 1)]


def _summarise(max_items: int, max_tok: int | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        pdf = pd.concat(frames, ignore_index=True)
        part = int(pdf["_part"].iloc[0])
        grp = pdf["_grp"].to_numpy(dtype=object)
        tok = pdf["_tok"].to_numpy(dtype=np.int64)
        segs = _segments(grp)
        rows = []
        a, z = segs[0]
        seg_tok = tok[a:z]
        m = z - a
        prefix, end = _ends(seg_tok, max_items, max_tok)
        depth, last = _chains(end, m)
        # Any open request entering the partition breaks by this row at the latest.
        h = _first_break(prefix, 1, 0, max_items, max_tok, m) + 1
        h = min(h, m)
        rows.append(dict(
            part=part, grp=grp[a], role="first", spans=(len(segs) == 1), m=m,
            total=int(prefix[m]), head_p=prefix[1:h + 1].tolist(), head_d=depth[:h].tolist(),
            head_c=(m - last[:h]).tolist(), head_s=(prefix[m] - prefix[last[:h]]).tolist()))
        if len(segs) > 1:
            a, z = segs[-1]
            _, (c, s, b) = next_fit(tok[a:z], max_items, max_tok, None)
            rows.append(dict(part=part, grp=grp[a], role="last", spans=True, m=z - a,
                             total=int(tok[a:z].sum()), head_p=[], head_d=[b + 1],
                             head_c=[c], head_s=[s]))
        yield pd.DataFrame(rows, columns=[f.name for f in _SUMMARY_SCHEMA.fields])
    return run


def _compose(max_items: int, max_tok: int | None):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["part", "role"])  # 'first' sorts before 'last'
        state = None
        out = []
        for row in pdf.itertuples(index=False):
            if row.role == "last":
                state = (int(row.head_c[0]), int(row.head_s[0]), int(row.head_d[0]) - 1)
                continue
            if state is not None:
                out.append((int(row.part), row.grp, *state))
            head_p = np.asarray(row.head_p, dtype=np.int64)
            if state is None:
                new = (int(row.head_c[0]), int(row.head_s[0]), int(row.head_d[0]) - 1)
            else:
                c, s, b = state
                prefix = np.concatenate([[0], head_p])
                k = _first_break(prefix, c, s, max_items, max_tok, len(head_p))
                if k >= len(head_p):
                    if len(head_p) != row.m:
                        raise AssertionError("packing summary head too short")
                    new = (c + int(row.m), s + int(row.total), b)
                else:
                    new = (int(row.head_c[k]), int(row.head_s[k]), b + int(row.head_d[k]))
            state = new if row.spans else None
        return pd.DataFrame(out, columns=["part", "grp", "c", "s", "b"])
    return run


def _assign(max_items: int, max_tok: int | None, entries: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry_grp, carry = None, None
        first = True
        for pdf in batches:
            if not len(pdf):
                continue
            if first:
                part = int(pdf["_part"].iloc[0])
                got = entries.get(part)
                if got is not None:
                    carry_grp, carry = got[0], got[1:]
                first = False
            grp = pdf["_grp"].to_numpy(dtype=object)
            tok = pdf["_tok"].to_numpy(dtype=np.int64)
            out = np.empty(len(pdf), dtype=np.int64)
            for a, z in _segments(grp):
                entry = carry if grp[a] == carry_grp else None
                out[a:z], carry = next_fit(tok[a:z], max_items, max_tok, entry)
                carry_grp = grp[a]
            yield pdf.drop(columns=["_part", "_mid"]).assign(**{BATCH: out})
    return run


def assign_batches(df: DataFrame, group_col: str, order_cols: Sequence[str], tokens_col: str | None,
                   max_inputs: int, max_tokens: int | None = None,
                   partitions: int | None = None) -> DataFrame:
    """Add `batch_no` (0-based request number inside the group), exact next-fit.

    `group_col` must be a non-null string key; `order_cols` must order rows
    uniquely inside a group. Token counts must be non-negative and not above
    `max_tokens` (reject oversized inputs first).
    """
    if max_inputs < 1:
        raise ValueError("max_inputs must be positive")
    if max_tokens is not None and max_tokens < 1:
        raise ValueError("max_tokens must be positive")
    if max_tokens is not None and tokens_col is None:
        raise ValueError("tokens_col is required with max_tokens")
    if max_tokens is None:
        ranked = rank_within(df, [group_col], list(order_cols), partitions)
        return ranked.withColumn(BATCH, F.floor(F.col(RANK) / F.lit(max_inputs))).drop(
            PART, MID, RANK, "_n")

    base = df.withColumn("_grp", F.col(group_col).cast("string")).withColumn(
        "_tok", F.col(tokens_col).cast("long"))
    x = range_sorted(base, ["_grp"], list(order_cols), partitions)
    summary = x.select(PART, "_grp", "_tok").mapInPandas(
        _summarise(max_inputs, max_tokens), _SUMMARY_SCHEMA)
    entries_df = summary.groupBy("grp").applyInPandas(_compose(max_inputs, max_tokens),
                                                      _ENTRY_SCHEMA)
    # One row per partition at most: the entry state of its first group.
    entries = {int(r["part"]): (r["grp"], int(r["c"]), int(r["s"]), int(r["b"]))
               for r in entries_df.collect()}
    out_schema = T.StructType(
        [f for f in x.schema.fields if f.name not in (PART, MID)]
        + [T.StructField(BATCH, T.LongType(), False)])
    return x.mapInPandas(_assign(max_inputs, max_tokens, entries), out_schema).drop(
        "_grp", "_tok")


def sequential_next_fit(tokens: Sequence[int], max_inputs: int,
                        max_tokens: int | None) -> list[int]:
    """Plain-Python reference of the packing rule (used by tests as the oracle)."""
    out, count, total, number = [], 0, 0, -1
    for t in tokens:
        if count == 0 or count >= max_inputs or (
                max_tokens is not None and total + t > max_tokens):
            number += 1
            count, total = 0, 0
        count += 1
        total += t
        out.append(number)
    return out


def packed_requests(assigned: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                    id_col: str, text_col: str | None, tokens_col: str | None) -> DataFrame:
    """One row per request: ordered ids (and texts), input count, estimated tokens.

    `collect_list` is bounded here by the item ceiling of a request.
    """
    item = F.struct(*[F.col(c) for c in order_cols], F.col(id_col).alias("_id"),
                    *([F.col(text_col).alias("_text")] if text_col else []))
    agg = [F.count(F.lit(1)).alias("input_count"),
           (F.sum(tokens_col).cast("long") if tokens_col else F.lit(0).cast("long")).alias(
               "estimated_tokens"),
           F.sort_array(F.collect_list(item)).alias("_items")]
    out = assigned.groupBy(*group_cols, BATCH).agg(*agg)
    out = out.withColumn("input_ids", F.col("_items._id"))
    if text_col:
        out = out.withColumn("texts", F.col("_items._text"))
    return out.drop("_items")


def passthrough_requests(df: DataFrame) -> DataFrame:
    """P11 packing mode `none`: one request per line, arrays intact, 0 estimated tokens."""
    return df.withColumn("input_count", F.size("input_ids")).withColumn(
        "estimated_tokens", F.lit(0).cast("long"))


def packing_effect(requests: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Requests vs inputs per group: inputs/request and request reduction."""
    return requests.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("input_count").alias("inputs"),
        F.sum("estimated_tokens").alias("estimated_tokens"),
        F.max("input_count").alias("max_batch_inputs"),
        F.min("input_count").alias("min_batch_inputs"),
    ).withColumn("inputs_per_request", F.bround(F.col("inputs") / F.col("requests"), 6)).withColumn(
        "request_reduction", F.bround(1 - F.col("requests") / F.col("inputs"), 6))
