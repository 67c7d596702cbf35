"""Request-log analytics queries (A*) over the request log derived from `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import runlog
from tessera.plans.common import round_doubles
from tessera.plans.registry import register
from tessera.plans.sqlparts import REQUEST_LOG_CTE
from tessera.sources.tables import (ROOT_MINUTES, TRACE_SPANS, event_spans, measurements,
                                    request_log, table)

MAX_INPUTS = 16
MAX_TOKENS = 4096
TARGET_TPM = 15000
TARGET_IPM = 1200.0


def log_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_log(table(spark, sf_dir, "events"))


def log_with_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds `start_offset_seconds` relative to the run's first start."""
    log = log_of(spark, sf_dir)
    first = log.groupBy("run_id").agg(F.min("start_us").alias("_t0"))
    return log.join(first, "run_id").withColumn(
        "start_offset_seconds", (F.col("start_us") - F.col("_t0")) / 1e6).drop("_t0")


MEAS_CTE = REQUEST_LOG_CTE + """,
meas AS (
  SELECT run_id, sequence, backend_id, status_code, input_count, estimated_tokens, prompt_tokens,
         retry_after, start_us / 1e6 AS started_seconds,
         start_us / 1e6 + duration_ms / 1000 AS completed_seconds
  FROM request_log
)"""

OFFSETS_CTE = REQUEST_LOG_CTE + """,
logo AS (
  SELECT *, (start_us - min(start_us) OVER (PARTITION BY run_id)) / 1e6 AS start_offset_seconds
  FROM request_log
)"""

A1_SQL = "WITH " + MEAS_CTE + f""",
a AS (
  SELECT run_id, count(*) AS attempted, count(*) FILTER (WHERE status_code = 200) AS successful,
         count(*) FILTER (WHERE status_code = 429) AS throttled,
         sum(input_count) AS att_inputs,
         sum(CASE WHEN status_code = 200 THEN input_count ELSE 0 END) AS ok_inputs,
         sum(CASE WHEN status_code = 200 THEN prompt_tokens ELSE 0 END) AS tokens,
         sum(CASE WHEN status_code = 200 THEN estimated_tokens ELSE 0 END) AS est_tokens,
         greatest(max(completed_seconds) - min(started_seconds), 0.0) AS w,
         quantile_cont((completed_seconds - started_seconds) * 1000, 0.5) AS p50,
         quantile_cont((completed_seconds - started_seconds) * 1000, 0.95) AS p95,
         quantile_cont((completed_seconds - started_seconds) * 1000, 0.99) AS p99
  FROM meas GROUP BY run_id
), r AS (SELECT *, CASE WHEN w > 0 THEN 60.0 / w ELSE 0.0 END AS rate FROM a)
SELECT run_id,
  round_even(CAST({TARGET_TPM} AS DOUBLE), 6) AS configured_target_tpm,
  round_even(CAST({TARGET_IPM} AS DOUBLE), 6) AS configured_target_inputs_per_minute,
  round_even(CAST(attempted AS DOUBLE), 6) AS attempted_requests,
  round_even(CAST(successful AS DOUBLE), 6) AS successful_requests,
  round_even(CAST(attempted - successful AS DOUBLE), 6) AS failed_requests,
  round_even(CAST(att_inputs AS DOUBLE), 6) AS attempted_logical_inputs,
  round_even(CAST(ok_inputs AS DOUBLE), 6) AS successful_logical_inputs,
  round_even(CAST(tokens AS DOUBLE), 6) AS prompt_tokens,
  round_even(w, 6) AS request_window_seconds,
  round_even(attempted * rate, 6) AS attempted_rpm,
  round_even(successful * rate, 6) AS successful_rpm,
  round_even(tokens * rate, 6) AS accepted_tpm,
  round_even(ok_inputs * rate, 6) AS logical_inputs_per_minute,
  round_even(successful / attempted, 6) AS success_rate,
  round_even(CAST(throttled AS DOUBLE), 6) AS throttled_requests,
  round_even(throttled / attempted, 6) AS throttle_rate,
  round_even(coalesce(p50, 0.0), 6) AS request_latency_p50_ms,
  round_even(coalesce(p95, 0.0), 6) AS request_latency_p95_ms,
  round_even(coalesce(p99, 0.0), 6) AS request_latency_p99_ms,
  round_even(att_inputs / attempted, 6) AS inputs_per_request,
  round_even(CASE WHEN successful = 0 THEN 0.0 ELSE tokens / successful END, 6)
    AS prompt_tokens_per_successful_request,
  round_even(CASE WHEN successful = 0 THEN 0.0 ELSE tokens / (successful * {MAX_TOKENS}) END, 6)
    AS token_ceiling_fill_ratio,
  round_even(att_inputs / (attempted * {MAX_INPUTS}), 6) AS item_ceiling_fill_ratio,
  round_even(CASE WHEN tokens = 0 THEN 0.0 ELSE est_tokens / tokens END, 6)
    AS estimated_to_actual_token_ratio
FROM r"""


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    meas = measurements(log_of(spark, sf_dir))
    return runlog.run_metrics(meas, MAX_INPUTS, MAX_TOKENS, TARGET_TPM, TARGET_IPM,
                              runs=meas.select("run_id"))


@register("a1_run_metrics", A1_SQL)
def a1_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 24 run measures per run (A1/A2/A3)."""
    return round_doubles(_metrics(spark, sf_dir))


A4_SQL = ("WITH m AS (" + A1_SQL + ")\n"
          "SELECT run_id, 'embedding_batch.' || name AS metric, value FROM "
          "(UNPIVOT m ON COLUMNS(* EXCLUDE (run_id)) INTO NAME name VALUE value)")


@register("a4_publish_metrics", A4_SQL)
def a4_publish_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.publish_metrics(round_doubles(_metrics(spark, sf_dir)))


A6_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT run_id, CAST(status_code AS VARCHAR) AS status, CAST(count(*) AS BIGINT) AS count
FROM request_log GROUP BY ALL"""


@register("a6_status_counts", A6_SQL)
def a6_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.status_counts(log_of(spark, sf_dir))


A7_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT run_id, error_message AS value, CAST(count(*) AS BIGINT) AS count
FROM request_log WHERE error_message IS NOT NULL AND error_message NOT IN ('', 'n/a')
GROUP BY ALL"""


@register("a7_value_counts", A7_SQL)
def a7_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.value_counts(log_of(spark, sf_dir), "error_message")


_CLASSIFY = """
  CASE
    WHEN status_code IS NULL OR status_code <> 429 THEN 'not-throttled'
    WHEN contains(lower(coalesce(error_message, '')), 'call rate')
      OR contains(lower(coalesce(error_message, '')), 'request rate')
      OR contains(lower(coalesce(error_message, '')), 'requests per') THEN 'rpm-explicit'
    WHEN contains(lower(coalesce(error_message, '')), 'token rate')
      OR contains(lower(coalesce(error_message, '')), 'tokens per')
      OR contains(lower(coalesce(error_message, '')), 'token limit') THEN 'tpm-explicit'
    WHEN coalesce(TRY_CAST(remaining_requests AS DOUBLE) <= 0, false)
      AND NOT coalesce(TRY_CAST(remaining_tokens AS DOUBLE) <= 0, false) THEN 'rpm-likely'
    WHEN coalesce(TRY_CAST(remaining_tokens AS DOUBLE) <= 0, false)
      AND NOT coalesce(TRY_CAST(remaining_requests AS DOUBLE) <= 0, false) THEN 'tpm-likely'
    ELSE 'unknown' END"""

_BASIS = """
  CASE
    WHEN status_code IS NULL OR status_code <> 429 THEN 'HTTP status is not 429'
    WHEN contains(lower(coalesce(error_message, '')), 'call rate')
      OR contains(lower(coalesce(error_message, '')), 'request rate')
      OR contains(lower(coalesce(error_message, '')), 'requests per')
      OR contains(lower(coalesce(error_message, '')), 'token rate')
      OR contains(lower(coalesce(error_message, '')), 'tokens per')
      OR contains(lower(coalesce(error_message, '')), 'token limit') THEN 'server error message'
    WHEN coalesce(TRY_CAST(remaining_requests AS DOUBLE) <= 0, false)
      AND NOT coalesce(TRY_CAST(remaining_tokens AS DOUBLE) <= 0, false)
      THEN 'request counter exhausted'
    WHEN coalesce(TRY_CAST(remaining_tokens AS DOUBLE) <= 0, false)
      AND NOT coalesce(TRY_CAST(remaining_requests AS DOUBLE) <= 0, false)
      THEN 'token counter exhausted'
    WHEN coalesce(TRY_CAST(remaining_tokens AS DOUBLE) <= 0, false)
      AND coalesce(TRY_CAST(remaining_requests AS DOUBLE) <= 0, false)
      THEN 'both counters exhausted'
    ELSE 'insufficient response evidence' END"""

A9_SQL = "WITH " + REQUEST_LOG_CTE + f"""
SELECT run_id, sequence, {_CLASSIFY} AS classification, {_BASIS} AS basis
FROM request_log WHERE status_code = 429"""


@register("a9_throttle_classification", A9_SQL)
def a9_throttle_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.throttle_events(log_of(spark, sf_dir))


A10_SQL = "WITH " + REQUEST_LOG_CTE + f"""
SELECT run_id, {_CLASSIFY} AS classification, CAST(count(*) AS BIGINT) AS count
FROM request_log WHERE status_code = 429 GROUP BY ALL"""


@register("a10_throttle_counts", A10_SQL)
def a10_throttle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.throttle_counts(log_of(spark, sf_dir))


A11_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT run_id, header, value, CAST(count(*) AS BIGINT) AS count FROM (
  SELECT run_id, 'remaining_requests' AS header, remaining_requests AS value FROM request_log
  UNION ALL
  SELECT run_id, 'remaining_tokens', remaining_tokens FROM request_log
) WHERE value IS NOT NULL AND value NOT IN ('', 'n/a') GROUP BY ALL"""


@register("a11_rate_limit_evidence", A11_SQL)
def a11_rate_limit_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.rate_limit_evidence(log_of(spark, sf_dir),
                                      ["remaining_requests", "remaining_tokens"])


A12_SQL = "WITH " + REQUEST_LOG_CTE + """,
f AS (SELECT run_id, min(sequence) AS first429 FROM request_log WHERE status_code = 429
      GROUP BY run_id)
SELECT l.run_id,
       CAST(count(*) FILTER (WHERE status_code = 429) AS BIGINT) AS http_429,
       CAST(count(*) FILTER (WHERE status_code = 503) AS BIGINT) AS http_503,
       CAST(count(*) FILTER (WHERE status_code = 503 AND sequence > first429) AS BIGINT)
         AS http_503_after_429
FROM request_log l LEFT JOIN f USING (run_id) GROUP BY l.run_id"""


@register("a12_breaker_signals", A12_SQL)
def a12_breaker_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.breaker_signals(log_of(spark, sf_dir))


TRIP_WINDOW_US = 6 * 3600 * 1_000_000  # the adapter's clock is sparse; 6 h window
A13_SQL = "WITH " + REQUEST_LOG_CTE + f""",
t AS (
  SELECT backend_id, sequence,
         count(*) OVER (PARTITION BY backend_id ORDER BY start_us
                        RANGE BETWEEN {TRIP_WINDOW_US - 1} PRECEDING AND CURRENT ROW) AS c
  FROM request_log WHERE status_code = 429
)
SELECT backend_id, sequence, CAST(c AS BIGINT) AS window_count FROM t WHERE c >= 3"""


@register("a13_trip_candidates", A13_SQL)
def a13_trip_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """429 rows at which a backend has seen >= 3 throttles within the window."""
    return runlog.trip_candidates(log_of(spark, sf_dir), 3, TRIP_WINDOW_US)


A14_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT run_id, CAST(count(*) AS BIGINT) AS request_count,
       CAST(count(*) FILTER (WHERE status_code = 200) AS BIGINT) AS successful_requests,
       CAST(sum(CASE WHEN status_code = 200 THEN coalesce(input_count, 0) ELSE 0 END) AS BIGINT)
         AS logical_inputs,
       CAST(sum(CASE WHEN status_code = 200 THEN coalesce(prompt_tokens, 0) ELSE 0 END) AS BIGINT)
         AS prompt_tokens,
       round_even(count(*) FILTER (WHERE status_code = 200) / count(*), 6) AS success_rate
FROM request_log GROUP BY run_id"""


@register("a14_run_analysis", A14_SQL)
def a14_run_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runlog.run_analysis(log_of(spark, sf_dir))
    return out.select("run_id", "request_count", "successful_requests",
                      F.col("logical_inputs").cast("long"), F.col("prompt_tokens").cast("long"),
                      "success_rate")


def _five_sql(col: str, name: str, where: str) -> str:
    return f"""
  SELECT run_id, CAST(min({col}) AS DOUBLE) AS {name}_min, avg({col}) AS {name}_mean,
         CAST(max({col}) AS DOUBLE) AS {name}_max, CAST(sum({col}) AS DOUBLE) AS {name}_total,
         quantile_cont({col}, 0.5) AS {name}_p50, quantile_cont({col}, 0.95) AS {name}_p95
  FROM request_log WHERE {col} IS NOT NULL AND {where} GROUP BY run_id"""


A15_SQL = "WITH " + REQUEST_LOG_CTE + f""",
e AS ({_five_sql('estimated_tokens', 'estimated', 'true')}),
a AS ({_five_sql('prompt_tokens', 'actual', 'status_code = 200')}),
i AS ({_five_sql('input_count', 'inputs', 'status_code = 200')})
SELECT run_id,
  round_even(estimated_min, 3) AS estimated_min, round_even(estimated_mean, 3) AS estimated_mean,
  round_even(estimated_p50, 3) AS estimated_p50, round_even(estimated_p95, 3) AS estimated_p95,
  round_even(estimated_max, 3) AS estimated_max,
  round_even(actual_min, 3) AS actual_min, round_even(actual_mean, 3) AS actual_mean,
  round_even(actual_p50, 3) AS actual_p50, round_even(actual_p95, 3) AS actual_p95,
  round_even(actual_max, 3) AS actual_max,
  round_even(inputs_min, 3) AS inputs_min, round_even(inputs_mean, 3) AS inputs_mean,
  round_even(inputs_p50, 3) AS inputs_p50, round_even(inputs_p95, 3) AS inputs_p95,
  round_even(inputs_max, 3) AS inputs_max,
  CASE WHEN actual_total > 0 AND estimated_total > 0
       THEN round_even(estimated_total / actual_total, 6) END AS estimate_to_actual_ratio
FROM e LEFT JOIN a USING (run_id) LEFT JOIN i USING (run_id)"""


def _batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = log_of(spark, sf_dir)
    ok = F.col("status_code") == 200
    return runlog.five_numbers(log, {"estimated": ("estimated_tokens", None), "actual": ("prompt_tokens", ok),
                                     "inputs": ("input_count", ok)})


@register("a15_batch_stats", A15_SQL)
def a15_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-number batch statistics (rounded to 3 dp, half-even as the reference)."""
    s = _batch_stats(spark, sf_dir)
    cols = [F.bround(F.col(f"{n}_{k}"), 3).alias(f"{n}_{k}")
            for n in ("estimated", "actual", "inputs")
            for k in ("min", "mean", "p50", "p95", "max")]
    ratio = F.when((F.col("actual_total") > 0) & (F.col("estimated_total") > 0),
                   F.bround(F.col("estimated_total") / F.col("actual_total"), 6))
    return s.select("run_id", *cols, ratio.alias("estimate_to_actual_ratio"))


A16_SQL = "WITH " + OFFSETS_CTE + f""",
s AS (
  SELECT run_id, count(*) AS request_count,
         avg(input_count) FILTER (WHERE status_code = 200) AS inputs_mean,
         sum(input_count) FILTER (WHERE status_code = 200) AS inputs_total,
         avg(estimated_tokens) AS est_mean,
         avg(prompt_tokens) FILTER (WHERE status_code = 200) AS act_mean
  FROM logo GROUP BY run_id
),
ok AS (
  SELECT run_id, count(*) AS n, min(start_offset_seconds) AS f, max(start_offset_seconds) AS l,
         sum(prompt_tokens) AS tok,
         arg_min(prompt_tokens, (start_offset_seconds, sequence)) AS tok_first
  FROM logo WHERE status_code = 200 GROUP BY run_id
),
ss AS (SELECT run_id, CASE WHEN n >= 2 AND l - f > 0 THEN (tok - tok_first) * 60.0 / (l - f) END
         AS steady FROM ok)
SELECT run_id,
  round_even(inputs_mean / {MAX_INPUTS}, 6) AS item_capacity_fill_ratio,
  round_even(est_mean / {MAX_TOKENS}, 6) AS estimated_token_fill_ratio,
  round_even(act_mean / {MAX_TOKENS}, 6) AS actual_token_fill_ratio,
  round_even(inputs_total / request_count, 6) AS logical_inputs_per_http_request,
  round_even(steady / {TARGET_TPM}, 6) AS steady_state_capacity_utilization,
  round_even(steady, 6) AS steady_state_tpm
FROM s LEFT JOIN ss USING (run_id)"""


@register("a16_scorecard", A16_SQL)
def a16_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optimisation scorecard: fills, inputs per HTTP request, steady-state use."""
    log = log_with_offsets(spark, sf_dir)
    ok = F.col("status_code") == 200
    s = log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("request_count"),
        F.avg(F.when(ok, F.col("input_count"))).alias("inputs_mean"),
        F.sum(F.when(ok, F.col("input_count"))).alias("inputs_total"),
        F.avg("estimated_tokens").alias("est_mean"),
        F.avg(F.when(ok, F.col("prompt_tokens"))).alias("act_mean"))
    steady = runlog.steady_state_rate(log, "start_offset_seconds")
    j = s.join(steady, "run_id", "left")
    return j.select(
        "run_id",
        F.bround(F.col("inputs_mean") / MAX_INPUTS, 6).alias("item_capacity_fill_ratio"),
        F.bround(F.col("est_mean") / MAX_TOKENS, 6).alias("estimated_token_fill_ratio"),
        F.bround(F.col("act_mean") / MAX_TOKENS, 6).alias("actual_token_fill_ratio"),
        F.bround(F.col("inputs_total") / F.col("request_count"), 6).alias(
            "logical_inputs_per_http_request"),
        F.bround(F.col("steady_state_tpm") / TARGET_TPM, 6).alias(
            "steady_state_capacity_utilization"),
        F.bround(F.col("steady_state_tpm"), 6).alias("steady_state_tpm"))


A17_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT run_id, round_even(avg(duration_ms), 3) AS latency_mean,
       round_even(quantile_cont(duration_ms, 0.5), 3) AS latency_p50,
       round_even(quantile_cont(duration_ms, 0.95), 3) AS latency_p95,
       round_even(quantile_cont(duration_ms, 0.99), 3) AS latency_p99
FROM request_log WHERE status_code = 200 GROUP BY run_id"""


@register("a17_success_latency", A17_SQL)
def a17_success_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency over successful rows only (differs from A1's all-attempt population)."""
    log = log_of(spark, sf_dir).where(F.col("status_code") == 200)
    mean = log.groupBy("run_id").agg(F.avg("duration_ms").alias("latency_mean"))
    pct = runlog.exact_percentiles(log, ["run_id"], "duration_ms",
                                   {"latency_p50": 50, "latency_p95": 95, "latency_p99": 99})
    j = mean.join(pct, "run_id")
    return j.select("run_id", *[F.bround(F.col(c), 3).alias(c) for c in
                                ("latency_mean", "latency_p50", "latency_p95", "latency_p99")])


A18_SQL = "WITH " + OFFSETS_CTE + """,
d AS (
  SELECT run_id, start_offset_seconds - lag(start_offset_seconds)
           OVER (PARTITION BY run_id ORDER BY sequence) AS d
  FROM logo
)
SELECT run_id, round_even(avg(d), 3) AS spacing_mean, round_even(min(d), 3) AS spacing_min,
       round_even(max(d), 3) AS spacing_max
FROM d WHERE d >= 0 GROUP BY run_id"""


@register("a18_request_spacing", A18_SQL)
def a18_request_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = runlog.request_spacing(log_with_offsets(spark, sf_dir), "start_offset_seconds")
    return s.select("run_id", *[F.bround(F.col(c), 3).alias(c) for c in
                                ("spacing_mean", "spacing_min", "spacing_max")])


A19_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT run_id, CAST(count(DISTINCT backend_id) AS BIGINT) AS backend_ids,
       count(backend_id) > 0 AS selected_member_attribution_available
FROM request_log GROUP BY run_id"""


@register("a19_backend_context", A19_SQL)
def a19_backend_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backend context: ids seen; member attribution when ids exist and the only
    recorded backend type is not the pool (no types are recorded here)."""
    log = log_of(spark, sf_dir)
    return log.groupBy("run_id").agg(
        F.count_distinct("backend_id").alias("backend_ids"),
        (F.count("backend_id") > 0).alias("selected_member_attribution_available"))


PEAK_WINDOW_US = 3600 * 1_000_000
A21_SQL = "WITH " + REQUEST_LOG_CTE + f""",
c AS (
  SELECT run_id, count(*) OVER (PARTITION BY run_id ORDER BY start_us
                                RANGE BETWEEN {PEAK_WINDOW_US - 1} PRECEDING AND CURRENT ROW) AS c
  FROM request_log
)
SELECT run_id, CAST(max(c) AS BIGINT) AS peak_starts FROM c GROUP BY run_id"""


@register("a21_peak_starts", A21_SQL)
def a21_peak_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peak number of request starts inside any rolling one-hour window per run."""
    return runlog.peak_window(log_of(spark, sf_dir), PEAK_WINDOW_US)


A23_SQL = "WITH " + REQUEST_LOG_CTE + """,
r AS (SELECT error_message, sequence,
             row_number() OVER (PARTITION BY error_message ORDER BY sequence) AS rn,
             count(*) OVER (PARTITION BY error_message) AS n
      FROM request_log WHERE error_message IS NOT NULL)
SELECT error_message, list_sort(list(sequence)) AS sample_sequences, CAST(max(n) AS BIGINT) AS count,
       CAST(greatest(max(n) - 5, 0) AS BIGINT) AS omitted
FROM r WHERE rn <= 5 GROUP BY error_message"""


@register("a23_error_samples", A23_SQL)
def a23_error_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.error_samples(log_of(spark, sf_dir), "error_message")


A29_SQL = "WITH " + MEAS_CTE + """
SELECT run_id, round_even(min(completed_seconds + retry_after), 6) AS retry_clock_min,
       round_even(max(completed_seconds + retry_after), 6) AS retry_clock_max,
       round_even(max(completed_seconds + retry_after) - min(completed_seconds + retry_after), 6)
         AS retry_clock_range
FROM meas WHERE status_code = 429 AND retry_after IS NOT NULL GROUP BY run_id"""


@register("a29_retry_convergence", A29_SQL)
def a29_retry_convergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = log_of(spark, sf_dir)
    meas = measurements(log).join(log.select("run_id", "sequence", "retry_after"),
                                  ["run_id", "sequence"])
    return round_doubles(runlog.retry_convergence(meas))


A30_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT run_id, min(sequence) FILTER (WHERE status_code = 429) AS first_throttled_sequence,
       max(sequence) FILTER (WHERE status_code = 200) AS last_succeeded_sequence
FROM request_log GROUP BY run_id"""


@register("a30_throttle_bounds", A30_SQL)
def a30_throttle_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.throttle_bounds(log_of(spark, sf_dir))


A32_SQL = "WITH " + REQUEST_LOG_CTE + """,
p AS (SELECT run_id, backend_id, count(*) AS requests, sum(prompt_tokens) AS tokens
      FROM request_log GROUP BY ALL)
SELECT run_id, backend_id, CAST(requests AS BIGINT) AS requests, CAST(tokens AS BIGINT) AS tokens,
       round_even(requests / sum(requests) OVER (PARTITION BY run_id), 6) AS request_share,
       round_even(CASE WHEN sum(tokens) OVER (PARTITION BY run_id) > 0
                  THEN tokens / sum(tokens) OVER (PARTITION BY run_id) END, 6) AS token_share
FROM p"""


@register("a32_backend_share", A32_SQL)
def a32_backend_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runlog.backend_share(log_of(spark, sf_dir))
    return round_doubles(out.withColumn("tokens", F.col("tokens").cast("long")))


A20_SQL = ("SELECT * FROM (" + A14_SQL + ") a JOIN (" + A17_SQL + ") b USING (run_id) JOIN ("
           + A16_SQL + ") c USING (run_id)")


@register("a20_run_comparison", A20_SQL)
def a20_run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-run comparison: analysis, success latency and scorecard in one row per run."""
    return a14_run_analysis(spark, sf_dir).join(a17_success_latency(spark, sf_dir), "run_id").join(
        a16_scorecard(spark, sf_dir), "run_id")


A22_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT run_id,
  round_even((max(start_us + duration_ms * 1000) - min(start_us)) / 1e6, 6) AS duration_s,
  round_even((max(start_us) - min(start_us)) / 1e6, 6) AS start_spread_s,
  CAST(count(*) AS BIGINT) AS requests,
  round_even(min(retry_after), 6) AS retry_min, round_even(max(retry_after), 6) AS retry_max,
  list_sort(list(DISTINCT remaining_requests) FILTER (WHERE remaining_requests IS NOT NULL))
    AS remaining_requests_values,
  round_even(CASE WHEN max(start_us + duration_ms * 1000) - min(start_us) > 0
    THEN count(*) / ((max(start_us + duration_ms * 1000) - min(start_us)) / 1e6) END, 6)
    AS requests_per_second
FROM request_log GROUP BY run_id"""


@register("a22_output_summary", A22_SQL)
def a22_output_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(runlog.output_summary(log_of(spark, sf_dir)))


A27_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT run_id, CAST(count(*) AS BIGINT) AS requests,
  CAST(count(*) FILTER (WHERE status_code = 429) AS BIGINT) AS http_429,
  CAST(count(*) FILTER (WHERE status_code = 503) AS BIGINT) AS http_503,
  round_even(avg(duration_ms), 6) AS latency_mean,
  CAST(sum(CASE WHEN status_code = 200 THEN input_count ELSE 0 END) AS BIGINT) AS inputs,
  round_even(quantile_cont(duration_ms, 0.5), 6) AS latency_p50,
  round_even(quantile_cont(duration_ms, 0.95), 6) AS latency_p95,
  round_even(quantile_cont(duration_ms, 0.99), 6) AS latency_p99,
  round_even(CASE WHEN max(start_us) > min(start_us)
    THEN count(*) / ((max(start_us) - min(start_us)) / 6e7) END, 6) AS window_rpm
FROM request_log GROUP BY run_id"""


@register("a27_load_report", A27_SQL)
def a27_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = runlog.load_report(log_of(spark, sf_dir))
    return round_doubles(r.withColumn("inputs", F.col("inputs").cast("long")))


A28_SQL = "WITH m AS (" + A1_SQL + """),
c AS (SELECT * FROM m WHERE run_id = 0)
SELECT m.run_id, round_even(1 - m.attempted_requests / c.attempted_requests, 6) AS request_reduction,
       round_even(m.accepted_tpm / c.accepted_tpm - 1, 6) AS tpm_increase,
       round_even(m.throttle_rate * 100, 6) AS throttle_pct
FROM m, c"""


@register("a28_experiment_deltas", A28_SQL)
def a28_experiment_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deltas of every run against run 0 as the control."""
    # Deltas are derived from the published (rounded) run metrics, as in a1.
    return round_doubles(runlog.experiment_deltas(round_doubles(_metrics(spark, sf_dir)), 0))


A33_SQL = "WITH m AS (" + A1_SQL + """),
c AS (SELECT * FROM m WHERE run_id = 0),
e AS (SELECT m.run_id, m.accepted_tpm, m.throttle_rate, m.request_latency_p95_ms,
             m.throttle_rate < 0.01 AND m.request_latency_p95_ms <= c.request_latency_p95_ms * 1.5
               AS eligible
      FROM m, c)
SELECT e.*, coalesce(e.run_id = (SELECT arg_max(run_id, accepted_tpm) FROM e WHERE eligible), false)
         AS chosen
FROM e"""


@register("a33_operating_point", A33_SQL)
def a33_operating_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operating-point choice: < 1 % throttling, p95 within 1.5x of run 0, max TPM."""
    return runlog.operating_point(round_doubles(_metrics(spark, sf_dir)), 0)


A24_SQL = "WITH " + REQUEST_LOG_CTE + """
SELECT run_id, sequence,
       CASE WHEN CAST(retry_after AS VARCHAR) IS NOT NULL
            THEN CASE WHEN TRY_CAST(CAST(retry_after AS VARCHAR) AS DOUBLE) IS NOT NULL
                      THEN greatest(TRY_CAST(CAST(retry_after AS VARCHAR) AS DOUBLE), 0.0) END
       END AS retry_after_seconds,
       CAST(NULL AS VARCHAR) AS error_code, left(error_message, 500) AS error_message
FROM request_log WHERE status_code = 429"""


@register("a24_retry_and_errors", A24_SQL)
def a24_retry_and_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A24 + A25 on every throttled row: the seconds header normalised (no ms
    header is recorded) and code/message from the (non-JSON) error body."""
    log = log_of(spark, sf_dir).where(F.col("status_code") == 429)
    out = log.withColumn("retry_after_seconds", runlog.retry_after_seconds(
        F.lit(None).cast("string"), F.col("retry_after").cast("string")))
    out = runlog.error_metadata(out.withColumnRenamed("error_message", "_body"), "_body")
    return out.select("run_id", "sequence", "retry_after_seconds", "error_code", "error_message")


A8_SQL = "WITH " + REQUEST_LOG_CTE + """,
h AS (SELECT 'remaining_requests' AS header, remaining_requests AS v FROM request_log
      UNION ALL SELECT 'remaining_tokens', remaining_tokens FROM request_log)
SELECT header, CAST(count(TRY_CAST(v AS DOUBLE)) AS BIGINT) AS numeric_values,
       CAST(count(v) - count(TRY_CAST(v AS DOUBLE)) AS BIGINT) AS non_numeric_values,
       min(TRY_CAST(v AS DOUBLE)) AS minimum, max(TRY_CAST(v AS DOUBLE)) AS maximum
FROM h GROUP BY header"""


@register("a8_numeric_coercion", A8_SQL)
def a8_numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient numeric coercion of the string rate-limit headers."""
    log = log_of(spark, sf_dir)
    long = log.select(F.explode(F.array(
        F.struct(F.lit("remaining_requests").alias("header"), F.col("remaining_requests").alias("v")),
        F.struct(F.lit("remaining_tokens").alias("header"), F.col("remaining_tokens").alias("v")),
    )).alias("h")).select("h.header", "h.v").withColumn("n", runlog.lenient_number(F.col("v")))
    return long.groupBy("header").agg(
        F.count("n").alias("numeric_values"),
        (F.count("v") - F.count("n")).alias("non_numeric_values"),
        F.min("n").alias("minimum"), F.max("n").alias("maximum"))


A31_SQL = f"""
WITH RECURSIVE spans AS (
  SELECT event_id // {TRACE_SPANS} AS trace_id, event_id AS span_id, event_type AS name,
         CASE WHEN event_id % {TRACE_SPANS} > 0 THEN event_id // {TRACE_SPANS} * {TRACE_SPANS} +
           CASE WHEN event_id // {TRACE_SPANS} % 4 = 0 THEN event_id % {TRACE_SPANS} - 1 ELSE (event_id % {TRACE_SPANS} - 1) // 3 END END AS parent,
         epoch_us(ts) * 1000 AS a,
         epoch_us(ts) * 1000 + CAST(floor(CASE WHEN event_id % {TRACE_SPANS} = 0 THEN {ROOT_MINUTES} ELSE value END * 60000) AS BIGINT) * 1000000 AS z
  FROM events),
up AS (
  SELECT trace_id, span_id, span_id AS top, 0 AS depth FROM spans
  UNION ALL
  SELECT u.trace_id, u.span_id, s.parent, u.depth + 1 FROM up u JOIN spans s ON s.span_id = u.top AND s.trace_id = u.trace_id
  WHERE s.parent IS NOT NULL AND EXISTS (SELECT 1 FROM spans p WHERE p.span_id = s.parent AND p.trace_id = u.trace_id)),
rooted AS (SELECT trace_id, span_id, arg_max(top, depth) AS root, max(depth) AS depth FROM up GROUP BY ALL),
cut AS (
  SELECT r.trace_id, r.root, r.depth, c.span_id, (c.z - c.a) / 1e6 AS ms, least(greatest(c.a, o.a), o.z) AS s,
         greatest(least(c.z, o.z), least(greatest(c.a, o.a), o.z)) AS e, o.name, (o.z - o.a) / 1e6 AS root_ms
  FROM rooted r JOIN spans c USING (trace_id, span_id) JOIN spans o ON o.trace_id = r.trace_id AND o.span_id = r.root
  WHERE r.depth > 0),
fresh AS (
  SELECT *, greatest(e - greatest(s, coalesce(max(e) OVER (PARTITION BY trace_id, root ORDER BY s, e, span_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s)), 0) AS new FROM cut)
SELECT trace_id, root AS root_span_id, name AS root_name, root_ms AS root_duration_ms, count(*) AS descendants,
       CAST(max(depth) AS BIGINT) AS max_depth, round_even(sum(ms), 3) AS child_ms, round_even(sum(new) / 1e6, 3) AS covered_ms,
       round_even(sum(new) / 1e6 / root_ms, 6) AS coverage
FROM fresh GROUP BY trace_id, root, name, root_ms"""


@register("a31_span_coverage", A31_SQL)
def a31_span_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of each root span by its descendants (chains of 63, trees of four levels)."""
    t = runlog.span_tree(event_spans(table(spark, sf_dir, "events")))
    return t.select("trace_id", "root_span_id", "root_name", "root_duration_ms", "descendants", "max_depth",
                    F.bround("child_ms", 3).alias("child_ms"), F.bround("covered_ms", 3).alias("covered_ms"),
                    F.bround("coverage", 6).alias("coverage"))
