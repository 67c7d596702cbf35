"""Stateful stream folds (W1–W3, W7, W8) and their batch equivalents.

Batch forms use the skew-safe ordered scans; stream forms keep small per-key
state with `applyInPandasWithState` (event-time timeouts drop abandoned keys).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.functions.ordered import previous_within, running_sum_within

# Stream event types.
DELTA = "thread.message.delta"
COMPLETED = "thread.message.completed"
STEP = "thread.run.step"
DONE = "[DONE]"
SEQ_BASE = 1_000_000
EVENT_EPOCH_US = 1_704_067_200_000_000

BREAKER_THRESHOLD = 3
BREAKER_WINDOW_US = 30_000_000
BREAKER_OPEN_US = 60_000_000

MESSAGE_SCHEMA = "stream_id long, message_no long, text string, n_deltas long"
BREAKER_SCHEMA = "backend_id string, opened_us long, closes_us long, throttles long"


def delta_events(conversations: DataFrame) -> DataFrame:
    """SSE-style events from transcripts: every assistant message becomes word
    deltas plus a completed event; other turns are run steps; each stream ends
    with [DONE]. Columns: stream_id, seq, event_type, data, ts."""
    c = conversations
    asst = c.where(F.col("role") == "assistant")
    words = F.split(F.col("text"), " ", -1)
    deltas = asst.select(F.col("conv_id").alias("stream_id"), "turn",
                         F.posexplode(words).alias("i", "w"), F.size(words).alias("n")).select(
        "stream_id", (F.col("turn") * SEQ_BASE + F.col("i")).alias("seq"),
        F.lit(DELTA).alias("event_type"),
        F.concat(F.col("w"), F.when(F.col("i") < F.col("n") - 1, F.lit(" ")).otherwise(
            F.lit(""))).alias("data"))
    done_msg = asst.select(F.col("conv_id").alias("stream_id"),
                           (F.col("turn") * SEQ_BASE + SEQ_BASE - 1).alias("seq"),
                           F.lit(COMPLETED).alias("event_type"), F.lit(None).cast("string").alias(
                               "data"))
    steps = c.where(F.col("role") != "assistant").select(
        F.col("conv_id").alias("stream_id"), (F.col("turn") * SEQ_BASE).alias("seq"),
        F.lit(STEP).alias("event_type"), F.lit(None).cast("string").alias("data"))
    end = c.groupBy("conv_id").agg(F.max("turn").alias("t")).select(
        F.col("conv_id").alias("stream_id"), ((F.col("t") + 1) * SEQ_BASE).alias("seq"),
        F.lit(DONE).alias("event_type"), F.lit(None).cast("string").alias("data"))
    ev = deltas.unionByName(done_msg).unionByName(steps).unionByName(end)
    # Event time anchored at 2024-01-01 (a row exactly at the initial watermark 0
    # would count as late): one minute per stream plus one microsecond per seq.
    return ev.withColumn("ts", F.timestamp_micros(
        F.lit(EVENT_EPOCH_US) + F.col("stream_id") * 60_000_000 + F.col("seq")))


def assemble_messages(events: DataFrame) -> DataFrame:
    """W1 batch: deltas are appended until any other event flushes them.

    message_no = number of non-delta events before the message (a distributed
    running count, so one long stream is still split across tasks).
    """
    b = events.withColumn("_b", (F.col("event_type") != DELTA).cast("long"))
    cs = running_sum_within(b.select("stream_id", "seq", "event_type", "data", "_b"),
                            ["stream_id"], ["seq"], "_b", "_cb")
    d = cs.where(F.col("event_type") == DELTA).withColumn("message_no", F.col("_cb"))
    return d.groupBy("stream_id", "message_no").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("seq", "data"))).data, "").alias("text"),
        F.count(F.lit(1)).alias("n_deltas"))


def _assemble_state(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
    sid = int(key[0])
    bnd, msg, data = state.get if state.exists else (0, 0, [])
    data = list(data)
    if state.hasTimedOut:
        state.remove()
        if data:
            yield pd.DataFrame([(sid, msg, "".join(data), len(data))],
                               columns=["stream_id", "message_no", "text", "n_deltas"])
        return
    rows = pd.concat(list(pdfs), ignore_index=True).sort_values("seq")
    out, done = [], False
    for et, dat in zip(rows["event_type"], rows["data"]):
        if et == DELTA:
            if not data:
                msg = bnd
            data.append("" if dat is None else str(dat))
        else:
            if data:
                out.append((sid, msg, "".join(data), len(data)))
                data = []
            bnd += 1
            done = done or et == DONE
    if done and not data:
        state.remove()
    else:
        state.update((bnd, msg, data))
        state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + 10 * 60 * 1000)
    if out:
        yield pd.DataFrame(out, columns=["stream_id", "message_no", "text", "n_deltas"])


def assemble_messages_stream(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """W1 stream: per-stream state holds only the open message (its deltas) and
    the boundary count; any non-delta event flushes it. Rows of a micro-batch are
    ordered by `seq`; events of one stream are expected in stream order across
    micro-batches (as an event stream delivers them). An abandoned stream's open
    message is flushed when the watermark passes its timeout."""
    return events.withWatermark("ts", watermark).groupBy("stream_id").applyInPandasWithState(
        _assemble_state, MESSAGE_SCHEMA,
        "boundaries long, msg long, data array<string>", "append",
        GroupStateTimeout.EventTimeTimeout)


def _breaker_state(window_us: int, open_us: int):
    def run(key, pdfs, state):
        yield from _breaker_fold(key, pdfs, state, window_us, open_us)
    return run


def _breaker_fold(key, pdfs: Iterator[pd.DataFrame], state: GroupState, window_us: int,
                  open_us: int):
    backend = key[0]
    recent, open_until = state.get if state.exists else ([], -1)
    recent = list(recent)
    rows = pd.concat(list(pdfs), ignore_index=True).sort_values(["start_us", "sequence"])
    out = []
    for t, ra in zip(rows["start_us"], rows["retry_after"]):
        t = int(t)
        if t < open_until:
            continue
        recent = [x for x in recent if x > t - window_us] + [t]
        if len(recent) >= BREAKER_THRESHOLD:
            hold = open_us if pd.isna(ra) else max(open_us, int(float(ra) * 1e6))
            out.append((backend, t, t + hold, len(recent)))
            open_until, recent = t + hold, []
    state.update((recent, open_until))
    if out:
        yield pd.DataFrame(out, columns=["backend_id", "opened_us", "closes_us", "throttles"])


def breaker_trips_stream(log: DataFrame, window_us: int = BREAKER_WINDOW_US,
                         open_us: int = BREAKER_OPEN_US) -> DataFrame:
    """Breaker per backend over the 429 stream: trip on the 3rd 429 within
    30 s, stay open 60 s or the retry delay, ignore 429s while open. State per
    backend is at most three timestamps."""
    t = log.where(F.col("status_code") == 429).select("backend_id", "sequence", "start_us",
                                                       "retry_after")
    return t.groupBy("backend_id").applyInPandasWithState(
        _breaker_state(window_us, open_us), BREAKER_SCHEMA, "recent array<long>, open_until long",
        "append",
        GroupStateTimeout.NoTimeout)


def new_content(messages: DataFrame, key: str = "conv_id", order: str = "turn",
                id_col: str = "text") -> DataFrame:
    """W8 batch: emit a message only when it differs from the previous one of its key."""
    prev = previous_within(messages.select(key, order, id_col), [key], [order], id_col)
    return prev.where(F.col("_prev").isNull() | (F.col("_prev") != F.col(id_col))).drop("_prev")


def _new_content_state(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
    last = state.get[0] if state.exists else None
    rows = pd.concat(list(pdfs), ignore_index=True).sort_values("turn")
    out = []
    for turn, txt in zip(rows["turn"], rows["text"]):
        if txt != last:
            out.append((int(key[0]), int(turn)))
            last = txt
    state.update((last,))
    if out:
        yield pd.DataFrame(out, columns=["conv_id", "turn"])


def new_content_stream(messages: DataFrame) -> DataFrame:
    """W8 stream: keyed last-message state; emits (conv_id, turn) on change."""
    return messages.select("conv_id", "turn", "text").groupBy("conv_id").applyInPandasWithState(
        _new_content_state, "conv_id long, turn long", "last string", "append",
        GroupStateTimeout.NoTimeout)


def ingest_requests(stream: DataFrame, validate, base_sink: str | None = None):
    """Validated request stream. Every row reaches the sink: rejected rows as they
    are, accepted ones once per input_id and the repeats of an id as rejects with a
    reason. `foreachBatch` keeps the ids accepted so far in a table of the sink and
    writes each micro-batch to a folder of its own, which a replay overwrites."""
    v = validate(stream)

    def write(batch: DataFrame, epoch: int, base: str) -> None:
        spark, out = batch.sparkSession, f"{base}/rows/epoch={epoch}"
        nth = F.row_number().over(Window.partitionBy("input_id").orderBy(*[c for c in ("doc_id", "model") if c in batch.columns]))
        good = batch.where("accepted").withColumn("_nth", nth)
        if epoch:
            before = (spark.read.option("basePath", f"{base}/rows").parquet(f"{base}/rows")
                      .where((F.col("epoch") < epoch) & F.col("accepted")).select("input_id").distinct()
                      .withColumn("_known", F.lit(True)))
            good = good.join(before, "input_id", "left")
        else:
            good = good.withColumn("_known", F.lit(None).cast("boolean"))
        repeat = (F.col("_nth") > 1) | F.coalesce(F.col("_known"), F.lit(False))
        good = good.withColumn("error", F.when(repeat, "duplicate input_id").otherwise(F.col("error"))).withColumn(
            "accepted", ~repeat).select(*batch.columns)
        good.unionByName(batch.where("NOT accepted OR accepted IS NULL")).write.mode("overwrite").parquet(out)
    return v, write


# Response event types of the tool-using agent stream.
TEXT_DELTA = "response.output_text.delta"
TOOL_STARTED = "response.tool_call.started"
TOOL_ARGS_DELTA = "response.tool_call.arguments.delta"
TOOL_DONE = "response.tool_call.done"
FAILED = "response.failed"


def fold_response_events(events: DataFrame) -> dict[str, DataFrame]:
    """W2 (batch): per response, the assembled text; per tool call (item id), its
    status (started → done, otherwise pending) and concatenated argument deltas;
    failed responses as error rows. Duplicated events (same response, item, seq)
    are dropped first. Input: response_id, seq, event_type, item_id, data."""
    ev = events.dropDuplicates(["response_id", "item_id", "seq", "event_type"])
    text = ev.where(F.col("event_type") == TEXT_DELTA).groupBy("response_id").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("seq", "data"))).data, "").alias("text"))
    tools = ev.where(F.col("event_type").isin(TOOL_STARTED, TOOL_ARGS_DELTA, TOOL_DONE)).groupBy(
        "response_id", "item_id").agg(
        F.max(F.when(F.col("event_type") == TOOL_STARTED, F.col("data"))).alias("name"),
        F.array_join(F.sort_array(F.collect_list(F.when(
            F.col("event_type") == TOOL_ARGS_DELTA, F.struct("seq", "data")))).data, "").alias(
            "arguments"),
        F.count_if(F.col("event_type") == TOOL_DONE).alias("_done")).select(
        "response_id", "item_id", "name", "arguments",
        F.when(F.col("_done") > 0, "done").otherwise("pending").alias("status"))
    errors = ev.where(F.col("event_type") == FAILED).select("response_id", F.col("data").alias(
        "error"))
    return {"text": text, "tool_calls": tools, "errors": errors}


def dedupe_stream_events(stream: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """W2 (stream): late duplicates of an event are dropped within the watermark."""
    return stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(
        ["response_id", "item_id", "seq", "event_type"])
