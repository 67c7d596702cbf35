"""Keyed stream state with timers (W2, W3), on Spark's arbitrary-state operator.

`breaker_states` keeps rows that the watermark has not passed yet, so files may bring
them in any order; when it passes, they are folded in event order and the breaker's open
and half-open intervals come out. `response_events_stream` keeps the parts of a response
per item id until all of them are there, however often or in which order they arrive.

Both need a state store with several named states per key; `with_state_store` selects it
for the query being started and restores the session's setting.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from heapq import merge
from itertools import islice

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tessera.streaming.folds import (BREAKER_OPEN_US, BREAKER_THRESHOLD, BREAKER_WINDOW_US, FAILED,
                                     TEXT_DELTA, TOOL_ARGS_DELTA, TOOL_DONE, TOOL_STARTED)

# Spark initialises a processor in a helper process of the driver that has no shipped files,
# so the classes of this module travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OPEN, HALF_OPEN = "open", "half-open"
STATES_SCHEMA = ("backend_id string, state string, from_us long, to_us long, throttles long, "
                 "probe_status int")

INTERVAL = Row(*[c.split()[0] for c in STATES_SCHEMA.split(", ")])


@contextmanager
def with_state_store(spark: SparkSession, empty_batches: bool = True):
    """Settings for a query that is started inside: the state store, and whether batches
    without data run. Expiry by processing time would run those without end."""
    wanted = {STATE_STORE: ROCKS, EMPTY_BATCHES: str(empty_batches).lower()}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def fold_breaker(rows: Iterable[tuple], recent: list[int], open_until: int, probing: bool,
                 window_us: int, open_us: int) -> tuple[list[tuple], list[int], int, bool]:
    """One backend's requests (start_us, sequence, status, retry delay) in event order.

    Closed: the third 429 within the window opens the breaker for the open period or the
    retry delay, if longer. Open: requests are ignored. Half-open: from the end of the open
    period to the next request, whose status is the probe's; it then counts as any other.
    Returns the intervals that ended, and the state to go on with.
    """
    out = []
    for start, _, status, retry in rows:
        if start < open_until:
            continue
        if probing:
            out.append((HALF_OPEN, open_until, start, 0, status))
            probing = False
        if status != 429:
            continue
        recent = [t for t in recent if t > start - window_us] + [start]
        if len(recent) >= BREAKER_THRESHOLD:
            hold = open_us if retry is None else max(open_us, int(retry * 1e6))
            out.append((OPEN, start, start + hold, len(recent), None))
            open_until, recent, probing = start + hold, [], True
    return out, recent, open_until, probing


# Rows of a run, which is sorted in memory, and of a piece, in which it is kept and read back.
RUN_ROWS, PIECE_ROWS = 50_000, 1_000


def event_order(row: tuple) -> tuple:
    start, sequence, status, retry = row
    return start, sequence is not None, sequence or 0, status is not None, status or 0, retry is not None, retry or 0.0


class BreakerProcessor(StatefulProcessor):
    """Rows wait until the watermark passes them; the breaker is one value. They are kept in
    sorted runs, each in small pieces, and merged on the way out, so that a piece of each run
    is in memory, not the rows of a backend."""

    def __init__(self, window_us: int, open_us: int):
        self.window_us, self.open_us = window_us, open_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState(
            "waiting", "run int, piece int",
            "rows array<struct<start_us:long,sequence:long,status:int,retry_after:double>>")
        self.runs = handle.getValueState(
            "runs", "made int, runs array<struct<run:int,piece:int,pieces:int,first_us:long>>")
        self.breaker = handle.getValueState(
            "breaker", "recent array<long>, open_until long, probing boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        made, runs = self.runs.get() if self.runs.exists() else (0, [])
        runs, new = [tuple(r) for r in runs], ((r["start_us"], r["sequence"], r["status_code"], r["retry_after"]) for r in rows)
        known = len(runs)
        while run := sorted(islice(new, RUN_ROWS), key=event_order):
            pieces = range(0, len(run), PIECE_ROWS)
            for i, at in enumerate(pieces):
                self.waiting.updateValue((made, i), (run[at:at + PIECE_ROWS],))
            runs.append((made, 0, len(pieces), run[0][0]))
            made += 1
        if len(runs) > known:
            self.runs.update((made, runs))
            self.handle.registerTimer(min(r[3] for r in runs[known:]) // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.runs.exists():
            return
        passed = timerValues.getCurrentWatermarkInMs()
        made, runs = self.runs.get()
        later, due = [], []
        for r in runs:
            (due if r[3] // 1000 <= passed else later).append(tuple(r))
        if not due:
            return

        def passed_rows(run: int, first: int, pieces: int) -> Iterator[tuple]:
            for piece in range(first, pieces):
                rows = [tuple(r) for r in self.waiting.getValue((run, piece))[0]]
                for n, row in enumerate(rows):
                    if row[0] // 1000 > passed:
                        if n:
                            self.waiting.updateValue((run, piece), (rows[n:],))
                        later.append((run, piece, pieces, row[0]))
                        return
                    yield row
                self.waiting.removeKey((run, piece))

        rows = merge(*(passed_rows(*r[:3]) for r in due), key=event_order)
        recent, open_until, probing = self.breaker.get() if self.breaker.exists() else ([], -1, False)
        out, recent, open_until, probing = fold_breaker((r for r in rows if r[2] is not None), list(recent), open_until, probing,
                                                        self.window_us, self.open_us)
        self.breaker.update((recent, open_until, probing))
        if later:
            self.runs.update((made, later))
            self.handle.registerTimer(min(r[3] for r in later) // 1000)
        else:
            self.runs.clear()
        for interval in out:
            yield INTERVAL(key[0], *interval)

    def close(self) -> None:
        pass


def breaker_states(log: DataFrame, lateness: str, window_us: int = BREAKER_WINDOW_US,
                   open_us: int = BREAKER_OPEN_US) -> DataFrame:
    """Open and half-open intervals per backend over a stream of requests.

    Rows may be late by up to `lateness`; those beyond it are dropped by the watermark. The
    state of a backend is the rows of that span, in sorted runs, and at most two recent 429 times. A row
    with a null status is a heartbeat: it only moves the watermark on.
    """
    rows = log.select("backend_id", "start_us", "sequence", F.col("status_code").cast("int").alias("status_code"),
                      F.col("retry_after").cast("double").alias("retry_after"),
                      F.timestamp_micros("start_us").alias("event_time"))
    return rows.withWatermark("event_time", lateness).groupBy("backend_id").transformWithState(
        BreakerProcessor(window_us, open_us), STATES_SCHEMA, "append", "eventTime")


RESPONSE_SCHEMA = ("response_id string, kind string, item_id string, name string, status string, "
                   "body string, parts long")
#: Fixed value: the event that ends a response well.
RESPONSE_DONE = "response.completed"
PART = Row(*[c.split()[0] for c in RESPONSE_SCHEMA.split(", ")])
MESSAGE, TOOL, ERROR = "message", "tool_call", "error"


class ResponseProcessor(StatefulProcessor):
    """Items of one response by id, the event that ends it, and the fact that it was given out."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        item = "name string, started boolean, done boolean, seqs array<long>, parts array<struct<seq:long,data:string>>"
        self.items = handle.getMapState("items", "item_id string", item, self.ttl_ms)
        self.end = handle.getValueState("end", "seq long, error string, failed boolean", self.ttl_ms)
        self.given = handle.getValueState("given", "parts long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.given.exists():                     # a replay of a finished response
            return
        changed: dict[str, list] = {}
        for r in rows:
            kind, seq = r["event_type"], r["seq"]
            if kind in (RESPONSE_DONE, FAILED):
                if not self.end.exists():
                    self.end.update((seq, r["data"], kind == FAILED))
                continue
            name = "" if kind == TEXT_DELTA else r["item_id"]
            if name not in changed:
                known = self.items.getValue((name,))
                changed[name] = [known[0], known[1], known[2], set(known[3]), {p[0]: p[1] for p in known[4]}] if known else [None, False, False, set(), {}]
            item = changed[name]
            item[3].add(seq)
            if kind == TOOL_STARTED:
                item[0], item[1] = r["data"], True
            elif kind == TOOL_DONE:
                item[2] = True
            elif kind in (TEXT_DELTA, TOOL_ARGS_DELTA):
                item[4][seq] = r["data"]
        for name, (tool, started, done, seqs, parts) in changed.items():
            self.items.updateValue((name,), (tool, started, done, sorted(seqs), sorted(parts.items())))
        if not self.end.exists():
            return
        last, error, failed = self.end.get()
        items = {k[0]: v for k, v in self.items.iterator()}
        seen = sum(len(v[3]) for v in items.values())
        if seen < last:                             # parts before the end are still under way
            return
        for name, (tool, _, done, _, parts) in sorted(items.items()):
            body = "".join(p[1] or "" for p in sorted((p[0], p[1]) for p in parts))
            if name == "":
                yield PART(key[0], MESSAGE, None, None, None, body, len(parts))
            else:
                yield PART(key[0], TOOL, name, tool, "done" if done else "pending", body, len(parts))
        if failed:
            yield PART(key[0], ERROR, None, None, "failed", error, 0)
        self.items.clear()
        self.given.update((seen,))

    def close(self) -> None:
        pass


def response_events_stream(events: DataFrame, ttl_ms: int | None = 24 * 3600 * 1000) -> DataFrame:
    """W2 (stream): message text, tool calls and errors of each response, once it is complete.

    Events carry seq 0, 1, ... within a response, the ending one (completed or failed) the
    highest. Repeats of an event change nothing, also after the response was given out; the
    state of a response is dropped `ttl_ms` after its last change (None: kept). Rows:
    response_id, kind (message, tool_call, error), item_id, name, status, body, parts.
    """
    return events.select("response_id", "seq", "event_type", "item_id", "data").groupBy("response_id").transformWithState(
        ResponseProcessor(ttl_ms), RESPONSE_SCHEMA, "append", "processingTime")


def response_rows(events: DataFrame) -> DataFrame:
    """W2 (batch): the same rows from a finished table of events, by one grouping per item.
    Incomplete responses (an event missing before the end, or no end) give none."""
    ev = events.dropDuplicates(["response_id", "seq"])
    ended = F.col("event_type").isin(RESPONSE_DONE, FAILED)
    whole = (ev.groupBy("response_id").agg(F.count(F.lit(1)).alias("_n"), F.max(F.when(ended, F.col("seq"))).alias("_last"))
             .where(F.col("_n") > F.col("_last")).select("response_id"))
    part = F.when(F.col("event_type").isin(TEXT_DELTA, TOOL_ARGS_DELTA), F.struct("seq", "data"))
    text = F.col("event_type") == TEXT_DELTA
    items = (ev.where(~ended).withColumn("item_id", F.when(~text, F.col("item_id")))
             .groupBy("response_id", "item_id").agg(
                 F.max(F.when(F.col("event_type") == TOOL_STARTED, F.col("data"))).alias("name"),
                 F.max((F.col("event_type") == TOOL_DONE).cast("int")).alias("_done"),
                 F.array_sort(F.collect_list(part)).alias("_parts")))
    items = items.select(
        "response_id", F.when(F.col("item_id").isNull(), MESSAGE).otherwise(TOOL).alias("kind"), "item_id", "name",
        F.when(F.col("item_id").isNotNull(), F.when(F.col("_done") == 1, "done").otherwise("pending")).alias("status"),
        F.array_join("_parts.data", "").alias("body"), F.size("_parts").cast("long").alias("parts"))
    errors = ev.where(F.col("event_type") == FAILED).select(
        "response_id", F.lit(ERROR).alias("kind"), F.lit(None).cast("string").alias("item_id"),
        F.lit(None).cast("string").alias("name"), F.lit("failed").alias("status"), F.col("data").alias("body"),
        F.lit(0).cast("long").alias("parts"))
    return items.unionByName(errors).join(whole, "response_id", "left_semi")
