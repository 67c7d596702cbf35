"""Keyed stream state against the same folds over finished tables."""

import random

from pyspark.sql import functions as F

from tessera.streaming import stateful, windows
from tessera.streaming.runner import run_available_now, staged_stream

EVENTS = "response_id string, seq long, event_type string, item_id string, data string"


def test_breaker_fold():
    """Trip, requests while open, a good probe, a throttled probe, and a long retry delay."""
    s = 1_000_000
    rows = [(0, 1, 429, None), (10 * s, 2, 429, None), (20 * s, 3, 429, None), (25 * s, 4, 200, None), (90 * s, 5, 503, None),
            (91 * s, 6, 429, None), (92 * s, 7, 429, None), (93 * s, 8, 429, 300.0), (200 * s, 9, 429, None), (400 * s, 10, 429, None)]
    out, recent, until, probing = stateful.fold_breaker(rows, [], -1, False, 30 * s, 60 * s)
    assert out == [("open", 20 * s, 80 * s, 3, None), ("half-open", 80 * s, 90 * s, 0, 503),
                   ("open", 93 * s, 393 * s, 3, None), ("half-open", 393 * s, 400 * s, 0, 429)]
    assert (recent, until, probing) == ([400 * s], 393 * s, False)


def test_breaker_stream_over_unordered_files(spark):
    """Rows arrive in any order within the lateness; a row beyond it is dropped."""
    r = random.Random(2)
    s = 1_000_000
    base = 1_700_000_000 * s
    rows = [(f"b{i % 2}", base + i * 3 * s, i, r.choice([200, 429, 429]), r.choice([None, 5.0, 90.0])) for i in range(400)]
    schema = "backend_id string, start_us long, sequence long, status_code int, retry_after double"
    late = [("b0", base - 5000 * s, 9_000, 429, None)]
    parts = [rows[:200], rows[200:]]
    moved = [x for x in parts[0] if x[2] % 5 == 0]
    parts = [[x for x in parts[0] if x[2] % 5], parts[1] + moved + late]
    for p in parts:
        r.shuffle(p)
    end = [(b, base + 10_000 * s, -1, None, None) for b in ("b0", "b1")]
    stream = staged_stream(spark, [spark.createDataFrame(p, schema).coalesce(1) for p in [*parts, end]], "t-breaker")
    out = stateful.breaker_states(stream, "1300 seconds", 30 * s, 60 * s)
    with stateful.with_state_store(spark):
        folder = run_available_now(out, "t-breaker")
    got = {tuple(x) for x in spark.read.schema(out.schema).parquet(f"{folder}/out").collect()}
    want = set()
    for b in ("b0", "b1"):
        own = sorted((x[1], x[2], x[3], x[4]) for x in rows if x[0] == b)
        want |= {(b, *x) for x in stateful.fold_breaker(own, [], -1, False, 30 * s, 60 * s)[0]}
    assert got == want and {x[1] for x in got} == {"open", "half-open"}


def test_response_stream_equals_batch(spark):
    """Events out of order, repeated, and replayed after their response was given out."""
    def response(name, kinds):
        return [(name, i, k, item, data) for i, (k, item, data) in enumerate(kinds)]

    text, start, args, done = stateful.TEXT_DELTA, stateful.TOOL_STARTED, stateful.TOOL_ARGS_DELTA, stateful.TOOL_DONE
    a = response("a", [(text, None, "Hel"), (text, None, "lo"), (stateful.RESPONSE_DONE, None, None)])
    b = response("b", [(start, "c1", "search"), (args, "c1", "{"), (args, "c1", "}"), (done, "c1", None), (start, "c2", "lookup"),
                       (text, None, None), (stateful.FAILED, None, "boom")])
    cut = response("cut", [(text, None, "x"), (text, None, "y"), (stateful.RESPONSE_DONE, None, None)])[1:]
    empty = response("empty", [(stateful.RESPONSE_DONE, None, None)])
    files = [[a[2], a[1], *b[4:], cut[1]], [a[0], a[0], b[0], *b[1:3], cut[0]], [*a, b[3], b[1], *empty]]
    frames = [spark.createDataFrame(f, EVENTS).coalesce(1) for f in files]
    rows = stateful.response_events_stream(staged_stream(spark, frames, "t-response"))
    with stateful.with_state_store(spark, empty_batches=False):
        folder = run_available_now(rows, "t-response")
    got = sorted(map(str, spark.read.schema(rows.schema).parquet(f"{folder}/out").collect()))
    everything = frames[0].unionByName(frames[1]).unionByName(frames[2])
    assert got == sorted(map(str, stateful.response_rows(everything).collect()))
    assert {(r["response_id"], r["kind"], r["item_id"]): (r["name"], r["status"], r["body"]) for r in stateful.response_rows(everything).collect()} == {
        ("a", "message", None): (None, None, "Hello"), ("b", "tool_call", "c1"): ("search", "done", "{}"),
        ("b", "tool_call", "c2"): ("lookup", "pending", ""), ("b", "message", None): (None, None, ""), ("b", "error", None): (None, "failed", "boom")}


def test_clean_runs(spark):
    """Before, at the start of, within, at the end of and after a long window; a null backend; no windows."""
    runs = spark.createDataFrame([("a", i, t) for i, t in enumerate([50, 100, 101, 5000, 9999, 10_000, 12_000])] + [("b", 9, 150), (None, 8, 150)],
                                 "backend_id string, run_id int, run_start_us long")
    sessions = spark.createDataFrame([("a", 100, 10_000), ("a", 11_000, 11_500), (None, 100, 200)], "backend_id string, session_start_us long, session_end_us long")
    got = {r["run_id"]: (r["valid"], r["clear_at_us"]) for r in windows.clean_runs(runs, sessions, bin_us=1000).collect()}
    wait = (False, 10_000)
    assert got == {0: (True, None), 1: (True, None), 2: wait, 3: wait, 4: wait, 5: (True, None), 6: (True, None), 9: (True, None), 8: (False, 200)}
    assert windows.clean_runs(runs, sessions.limit(0)).where(~F.col("valid")).count() == 0


def test_breaker_keeps_waiting_rows_in_small_pieces(monkeypatch):
    """Rows in any order, repeated ones, heartbeats and a watermark that passes some rows only: the
    intervals of the ordered fold, with no more than a piece of rows in one state value."""
    monkeypatch.setattr(stateful, "RUN_ROWS", 50)
    monkeypatch.setattr(stateful, "PIECE_ROWS", 7)

    class State:
        def __init__(self):
            self.held = {}

        def exists(self):
            return () in self.held

        def get(self):
            return self.held[()]

        def update(self, value):
            self.held[()] = value

        def clear(self):
            self.held.clear()

        def updateValue(self, key, value):
            assert len(value[0]) <= stateful.PIECE_ROWS
            self.held[key] = value

        def getValue(self, key):
            return self.held[key]

        def removeKey(self, key):
            del self.held[key]

    class Handle:
        def __init__(self):
            self.states, self.timers = {}, set()

        def getMapState(self, name, *_):
            return self.states.setdefault(name, State())

        def getValueState(self, name, *_):
            return self.states.setdefault(name, State())

        def registerTimer(self, at):
            self.timers.add(at)

    class Clock:
        def getCurrentWatermarkInMs(self):
            return self.at

    s = 1_000_000
    r = random.Random(4)
    rows = [(i * 2 * s, i, r.choice([200, 429, 429, None]), r.choice([None, 5.0, 90.0])) for i in range(900)]
    rows += rows[::9]
    want, *_ = stateful.fold_breaker(sorted((x for x in rows if x[2] is not None), key=stateful.event_order), [], -1, False, 30 * s, 60 * s)
    p, handle, clock, got = stateful.BreakerProcessor(30 * s, 60 * s), Handle(), Clock(), []
    p.init(handle)
    first, late = [x for x in rows if x[0] < 1000 * s and x[1] % 5], [x for x in rows if x[0] >= 1000 * s or x[1] % 5 == 0]
    for part, at in ((first, -1), (late, 777), (late[:0], 1200), (late[:0], 1900)):
        r.shuffle(part)
        p.handleInputRows(("b",), iter([dict(zip(("start_us", "sequence", "status_code", "retry_after"), x)) for x in part]), clock)
        clock.at = at * 1000
        for t in sorted(t for t in handle.timers if t <= clock.at):
            handle.timers.discard(t)
            got += [tuple(x)[1:] for x in p.handleExpiredTimer(("b",), clock, None)]
    assert got == want and len(want) > 10
    assert not handle.states["waiting"].held and not handle.timers
