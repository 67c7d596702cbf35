"""Stream queries (W*): windowed rates and sessions (batch-and-stream functions),
delta assembly, new-content polling, and two Structured Streaming jobs run with
`availableNow` whose sink output is returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import prepare
from tessera.plans.common import round_doubles
from tessera.plans.registry import register
from tessera.plans.runlog import log_of
from tessera.plans.sqlparts import MODEL_CASE, REQUEST_LOG_CTE
from tessera.sources.tables import (WORDS_PER_DELTA, WORDS_PER_LINE, document_requests, request_log,
                                    response_events, stream_lines, table)
from tessera.streaming import folds, lines, stateful, windows
from tessera.streaming.runner import run_available_now, staged_stream, stream_table

W1_SQL = f"""
WITH ev AS (
  SELECT conv_id AS stream_id, turn * {folds.SEQ_BASE} + (i - 1) AS seq,
         '{folds.DELTA}' AS event_type, ws[i] || CASE WHEN i < len(ws) THEN ' ' ELSE '' END AS data
  FROM (SELECT conv_id, turn, ws, unnest(range(1, len(ws) + 1)) AS i
        FROM (SELECT conv_id, turn, string_split(text, ' ') AS ws FROM conversations
              WHERE role = 'assistant'))
  UNION ALL SELECT conv_id, turn * {folds.SEQ_BASE} + {folds.SEQ_BASE - 1}, '{folds.COMPLETED}', NULL
    FROM conversations WHERE role = 'assistant'
  UNION ALL SELECT conv_id, turn * {folds.SEQ_BASE}, '{folds.STEP}', NULL
    FROM conversations WHERE role <> 'assistant'
  UNION ALL SELECT conv_id, (max(turn) + 1) * {folds.SEQ_BASE}, '{folds.DONE}', NULL
    FROM conversations GROUP BY conv_id
),
cs AS (SELECT *, sum(CASE WHEN event_type <> '{folds.DELTA}' THEN 1 ELSE 0 END)
         OVER (PARTITION BY stream_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS mn FROM ev)
SELECT stream_id, CAST(mn AS BIGINT) AS message_no, string_agg(data, '' ORDER BY seq) AS text,
       CAST(count(*) AS BIGINT) AS n_deltas
FROM cs WHERE event_type = '{folds.DELTA}' GROUP BY stream_id, mn"""


@register("w1_delta_assembly", W1_SQL)
def w1_delta_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed deltas folded back into finished messages (batch form of the stream fold)."""
    return folds.assemble_messages(folds.delta_events(table(spark, sf_dir, "conversations")))


W4_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT (start_us // 3600000000) * 3600000000 AS window_start_us, backend_id,
       CAST(count(*) AS BIGINT) AS requests,
       CAST(sum(CASE WHEN status_code = 200 THEN prompt_tokens ELSE 0 END) AS BIGINT) AS tokens,
       CAST(count(*) FILTER (WHERE status_code = 429) AS BIGINT) AS throttled,
       round_even(count(*) FILTER (WHERE status_code = 429) / count(*), 9) AS throttle_share,
       round_even(count(*) / 60.0, 9) AS rpm,
       round_even(sum(CASE WHEN status_code = 200 THEN prompt_tokens ELSE 0 END) / 60.0, 9) AS tpm
FROM request_log GROUP BY ALL"""


@register("w4_tumbling_rates", W4_SQL)
def w4_tumbling_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling one-hour RPM / TPM / 429 share per backend (same code runs on a stream)."""
    return round_doubles(windows.tumbling_rates(log_of(spark, sf_dir)), 9)


W5_SQL = "WITH " + REQUEST_LOG_CTE + """,
w AS (SELECT run_id, (start_us // 900000000) * 900000000 - k * 900000000 AS window_start_us
      FROM request_log, (SELECT unnest(range(0, 4)) AS k))
SELECT window_start_us, run_id, CAST(count(*) AS BIGINT) AS starts, count(*) > 6.0 AS alert
FROM w GROUP BY ALL"""


@register("w5_sliding_starts", W5_SQL)
def w5_sliding_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts per sliding 1 h window (15 min slide) with the L_w = 6 alert."""
    return windows.sliding_starts(log_of(spark, sf_dir), "1 hour", "15 minutes", 6.0)


W6_SQL = "WITH " + REQUEST_LOG_CTE + """,
t AS (SELECT backend_id, start_us FROM request_log WHERE status_code = 429),
g AS (SELECT *, CASE WHEN start_us - lag(start_us) OVER (PARTITION BY backend_id ORDER BY start_us)
                     < 1800000000 THEN 0 ELSE 1 END AS new_s FROM t),
s AS (SELECT *, sum(new_s) OVER (PARTITION BY backend_id ORDER BY start_us
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g)
SELECT backend_id, min(start_us) AS session_start_us, max(start_us) + 1800000000 AS session_end_us,
       CAST(count(*) AS BIGINT) AS throttles
FROM s GROUP BY backend_id, sid"""


@register("w6_throttle_sessions", W6_SQL)
def w6_throttle_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Throttle episodes (30 min session windows on 429s) per backend."""
    return windows.throttle_sessions(log_of(spark, sf_dir), "30 minutes")


W8_SQL = """
SELECT conv_id, turn FROM (
  SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev
  FROM conversations WHERE role = 'assistant'
) WHERE prev IS NULL OR prev <> text"""


@register("w8_new_content", W8_SQL)
def w8_new_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polling: emit an assistant message only when it differs from the last one."""
    conv = table(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
    return folds.new_content(conv).select("conv_id", "turn")


W3_WINDOW_US = 6 * 3600 * 1_000_000
W3_OPEN_US = 3600 * 1_000_000
W3_SQL = "WITH RECURSIVE " + REQUEST_LOG_CTE + f""",
t AS (SELECT backend_id, start_us, retry_after,
             row_number() OVER (PARTITION BY backend_id ORDER BY start_us, sequence) AS rn
      FROM request_log WHERE status_code = 429),
walk AS (
  SELECT backend_id, rn, start_us AS t, [start_us] AS recent, CAST(-1 AS BIGINT) AS open_until,
         false AS trip, 1 AS throttles, retry_after
  FROM t WHERE rn = 1
  UNION ALL
  SELECT w.backend_id, x.rn, x.start_us,
    CASE WHEN x.start_us < w.open_until THEN w.recent
         WHEN len(list_filter(w.recent, lambda r: r > x.start_us - {W3_WINDOW_US})) + 1 >= 3
           THEN []
         ELSE list_append(list_filter(w.recent, lambda r: r > x.start_us - {W3_WINDOW_US}),
                          x.start_us) END,
    CASE WHEN x.start_us < w.open_until THEN w.open_until
         WHEN len(list_filter(w.recent, lambda r: r > x.start_us - {W3_WINDOW_US})) + 1 >= 3
           THEN x.start_us + CASE WHEN x.retry_after IS NULL THEN {W3_OPEN_US}
                  ELSE greatest({W3_OPEN_US}, CAST(trunc(x.retry_after * 1e6) AS BIGINT)) END
         ELSE w.open_until END,
    x.start_us >= w.open_until
      AND len(list_filter(w.recent, lambda r: r > x.start_us - {W3_WINDOW_US})) + 1 >= 3,
    len(list_filter(w.recent, lambda r: r > x.start_us - {W3_WINDOW_US})) + 1,
    x.retry_after
  FROM walk w JOIN t x ON x.backend_id = w.backend_id AND x.rn = w.rn + 1
)
SELECT backend_id, t AS opened_us, open_until AS closes_us, CAST(throttles AS BIGINT) AS throttles
FROM walk WHERE trip"""


@register("w3_breaker_trips", W3_SQL)
def w3_breaker_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming job: breaker state per backend over the 429 stream."""
    # One micro-batch: the fold wants the requests of a backend in order.
    log = request_log(stream_table(spark, sf_dir, "events", batches=1))
    # The adapter's clock is sparse (about one 429 per backend per hour), so the
    # registered job uses a 6 h trip window and a 1 h open period.
    base = run_available_now(folds.breaker_trips_stream(log, W3_WINDOW_US, W3_OPEN_US), "breaker")
    return spark.read.parquet(f"{base}/out")


# Trips of the fold above, and for each the first request of its backend after the open period.
W3_STATES_SQL = W3_SQL[:W3_SQL.rindex("SELECT backend_id, t AS opened_us")] + """,
trips AS (SELECT backend_id, t AS opened_us, open_until AS closes_us, throttles FROM walk WHERE trip),
probes AS (
  SELECT t.backend_id, t.closes_us, min(l.start_us) AS to_us, arg_min(l.status_code, (l.start_us, l.sequence)) AS status
  FROM trips t JOIN request_log l ON l.backend_id = t.backend_id AND l.start_us >= t.closes_us
  GROUP BY ALL)
SELECT backend_id, 'open' AS state, opened_us AS from_us, closes_us AS to_us, CAST(throttles AS BIGINT) AS throttles,
       CAST(NULL AS INTEGER) AS probe_status FROM trips
UNION ALL
SELECT backend_id, 'half-open', closes_us, to_us, 0, CAST(status AS INTEGER) FROM probes"""


@register("w3_breaker_states", W3_STATES_SQL)
def w3_breaker_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming job: open and half-open intervals per backend. The log comes in
    two parts by time, with every seventh request one part late; the watermark holds rows
    back until they are in order. A heartbeat per backend ends the stream."""
    log = request_log(table(spark, sf_dir, "events")).select(
        "backend_id", "start_us", "sequence", F.col("status_code").cast("int").alias("status_code"), "retry_after")
    lo, hi = log.agg(F.min("start_us"), F.max("start_us")).head()
    lo, hi = lo or 0, hi or 0
    span = (hi - lo) // 2 + 1
    part = F.floor((F.col("start_us") - lo) / span) + (F.col("sequence") % 7 == 0).cast("int")
    # Late rows are at most two parts older than the newest row before them.
    lateness_us = 2 * span
    end = log.select("backend_id").distinct().select(
        "backend_id", F.lit(hi + lateness_us + 1_000_000).alias("start_us"), F.lit(-1).cast("long").alias("sequence"),
        F.lit(None).cast("int").alias("status_code"), F.lit(None).cast("double").alias("retry_after"))
    stream = staged_stream(spark, [*[log.where(part == i) for i in range(3)], end], "breaker-log")
    states = stateful.breaker_states(stream, f"{lateness_us // 1_000_000 + 1} seconds", W3_WINDOW_US, W3_OPEN_US)
    with stateful.with_state_store(spark):
        base = run_available_now(states, "breaker-states")
    return spark.read.schema(states.schema).parquet(f"{base}/out")


W2_SQL = f"""
WITH turns AS (
  SELECT conv_id || ':' || turn AS response_id, text, length(text) AS n, len(string_split(text, ' ')) AS words
  FROM conversations WHERE role = 'assistant' AND text IS NOT NULL AND length(text) % 13 <> 0)
SELECT response_id, 'message' AS kind, CAST(NULL AS VARCHAR) AS item_id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS status,
       text AS body, CAST((words + {WORDS_PER_DELTA - 1}) // {WORDS_PER_DELTA} AS BIGINT) AS parts FROM turns
UNION ALL
SELECT response_id, 'tool_call', 'call-' || n, CASE WHEN n % 2 = 0 THEN 'search' ELSE 'lookup' END,
       CASE WHEN n % 5 <> 0 THEN 'done' ELSE 'pending' END, '{{"size":' || n || '}}', 2 FROM turns WHERE n % 3 = 0
UNION ALL
SELECT response_id, 'error', NULL, NULL, 'failed', 'rate limited', 0 FROM turns WHERE n % 11 = 0"""


@register("w2_response_fold", W2_SQL)
def w2_response_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming job: responses folded from events that arrive out of order and
    partly twice, in two micro-batches or more."""
    events = response_events(table(spark, sf_dir, "conversations"))
    part = F.pmod(F.hash("response_id", "seq", "copy"), F.lit(2))
    stream = staged_stream(spark, [events.where(part == i) for i in range(2)], "response-events")
    rows = stateful.response_events_stream(stream)
    with stateful.with_state_store(spark, empty_batches=False):
        base = run_available_now(rows, "responses")
    return spark.read.schema(rows.schema).parquet(f"{base}/out")


RUN_SLOT_US = 6 * 3600 * 1_000_000
W6_CLEAN_SQL = W6_SQL[:W6_SQL.rindex("SELECT backend_id")] + f""",
sessions AS (
  SELECT backend_id, min(start_us) AS s, max(start_us) + 1800000000 AS e FROM s GROUP BY backend_id, sid),
runs AS (
  SELECT backend_id, run_id, start_us // {RUN_SLOT_US} AS slot, min(start_us) AS run_start_us
  FROM request_log GROUP BY ALL)
SELECT r.backend_id, r.run_id, slot, run_start_us, x.e IS NULL AS valid, x.e AS clear_at_us
FROM runs r LEFT JOIN sessions x ON x.backend_id = r.backend_id AND x.s < run_start_us AND run_start_us < x.e"""


@register("w6_clean_runs", W6_CLEAN_SQL)
def w6_clean_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs (one per backend, run and six-hour slot) that began after the last throttle window cleared."""
    log = log_of(spark, sf_dir)
    runs = log.groupBy("backend_id", "run_id", F.floor(F.col("start_us") / RUN_SLOT_US).alias("slot")).agg(
        F.min("start_us").alias("run_start_us"))
    return windows.clean_runs(runs, windows.throttle_sessions(log, "30 minutes"))


W7_SQL = f"""
SELECT doc_id, 'doc-' || doc_id AS input_id, {MODEL_CASE} AS model, source AS "user",
       true AS accepted, CAST(NULL AS VARCHAR) AS error, 1 AS input_count
FROM documents WHERE length(text) > 0"""


@register("w7_request_ingest", W7_SQL)
def w7_request_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming job: incremental request ingest with validation and
    dedupe by id; accepted and rejected rows are returned."""
    docs = stream_table(spark, sf_dir, "documents")

    def validate(s: DataFrame) -> DataFrame:
        reqs = document_requests(s)
        return prepare.validate_requests(prepare.normalise_typed(reqs), None).select(
            "doc_id", "input_id", "model", "user", "accepted", "error", "input_count")

    stream, write = folds.ingest_requests(docs, validate)
    base = run_available_now(stream, "ingest", foreach_batch=write)
    return spark.read.parquet(f"{base}/rows").drop("epoch")


LINE_ORDER = ["turn", "part", "i"]
W1_LINES_SQL = f"""
WITH e AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         sum(CASE WHEN role = 'assistant' THEN 2 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS upto FROM conversations)
SELECT conv_id, CAST(upto - 1 AS BIGINT) AS event_no, text,
       (len(string_split(text, ' ')) + {WORDS_PER_LINE - 1}) // {WORDS_PER_LINE} AS n_deltas, true AS closed
FROM e WHERE role = 'assistant' AND text <> ''
UNION ALL
SELECT conv_id, CAST(max(upto) + 1 AS BIGINT), 'cut of', 1, false FROM e WHERE conv_id % 3 = 0 GROUP BY conv_id"""


def _line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations").where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    return lines.parse_lines(stream_lines(conv), "conv_id", LINE_ORDER)


@register("w1_line_messages", W1_LINES_SQL)
def w1_line_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages from event-stream lines: broken data, blanks, lines after [DONE], and streams that break off."""
    return lines.line_messages(_line_events(spark, sf_dir), "conv_id", LINE_ORDER)


W1_IDS_SQL = """
SELECT conv_id, 'message' AS kind, 'msg-' || conv_id || '-' || turn AS id, count(*) AS reports
FROM conversations WHERE role = 'assistant' GROUP BY ALL
UNION ALL
SELECT DISTINCT conv_id, 'run', 'run-' || conv_id, 2 FROM conversations WHERE conv_id % 3 <> 0"""


@register("w1_completed_ids", W1_IDS_SQL)
def w1_completed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed messages and runs of each stream, every id once."""
    return lines.completed_ids(_line_events(spark, sf_dir), "conv_id")
