"""Response evidence queries (A8, A11, A12, A19, A22–A25, A32, A33) over the log with headers,
backend context, retry headers and error bodies derived from `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import responses, runlog
from tessera.operators.pacing import capacity_plan, planned_share
from tessera.plans.common import round_doubles
from tessera.plans.pacing import BACKENDS_CTE, PLAN_RPM, UTILIZATION, backends
from tessera.plans.registry import register
from tessera.plans.runlog import A1_SQL, MAX_INPUTS, MAX_TOKENS, TARGET_IPM, TARGET_TPM, log_of
from tessera.plans.sqlparts import REQUEST_LOG_CTE
from tessera.sources.tables import RATE_LIMIT_HEADERS, RESPONSE_COLUMNS, measurements, response_log, table

CONTEXT = ("backend_id", "backend_type", "backend_region")
IN_LOG = ("remaining_requests", "remaining_tokens", "backend_id")

RESPONSE_CTE = REQUEST_LOG_CTE + ", response_log AS (SELECT * REPLACE (" + ", ".join(
    f"{RESPONSE_COLUMNS[n]} AS {n}" for n in IN_LOG) + "), " + ", ".join(
    f"{e} AS {n}" for n, e in RESPONSE_COLUMNS.items() if n not in IN_LOG) + " FROM request_log)"


def _values_cte(columns, name: str) -> str:
    return "vals AS (SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT run_id, '{c}' AS {name}, {c} AS value FROM response_log" for c in columns
    ) + ") WHERE value IS NOT NULL AND value NOT IN ('', 'n/a'))"


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return response_log(table(spark, sf_dir, "events"))


A8_SQL = "WITH " + RESPONSE_CTE + ", " + _values_cte(RATE_LIMIT_HEADERS, "header") + """
SELECT header, count(TRY_CAST(value AS DOUBLE)) AS numeric_values,
       count(*) - count(TRY_CAST(value AS DOUBLE)) AS non_numeric_values,
       min(TRY_CAST(value AS DOUBLE)) AS minimum, max(TRY_CAST(value AS DOUBLE)) AS maximum
FROM vals GROUP BY header"""


@register("a8_header_ranges", A8_SQL)
def a8_header_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric and non-numeric values of the six headers, and their range."""
    return responses.lenient_ranges(_log(spark, sf_dir), RATE_LIMIT_HEADERS)


A11_SQL = "WITH " + RESPONSE_CTE + ", " + _values_cte(RATE_LIMIT_HEADERS, "header") + """
SELECT run_id, header, value, count(*) AS count FROM vals GROUP BY ALL"""


@register("a11_header_evidence", A11_SQL)
def a11_header_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value counts of the six rate-limit headers per run."""
    return responses.value_evidence(_log(spark, sf_dir), RATE_LIMIT_HEADERS, name="header")


A11_FLAGS_SQL = "WITH " + RESPONSE_CTE + ", " + _values_cte(RATE_LIMIT_HEADERS, "header") + """
SELECT r.run_id, count(v.value) FILTER (WHERE v.header LIKE '%requests') > 0 AS request_headers_available,
       count(v.value) FILTER (WHERE v.header LIKE '%tokens') > 0 AS token_headers_available
FROM (SELECT DISTINCT run_id FROM request_log) r LEFT JOIN vals v USING (run_id) GROUP BY r.run_id"""


@register("a11_header_flags", A11_FLAGS_SQL)
def a11_header_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which kinds of rate-limit header a run shows at all."""
    return responses.header_flags(_log(spark, sf_dir), RATE_LIMIT_HEADERS)


RETRY_CTE = RESPONSE_CTE + """, waits AS (
  SELECT run_id, sequence,
         CASE WHEN retry_after_ms IS NOT NULL THEN
                CASE WHEN TRY_CAST(retry_after_ms AS DOUBLE) IS NOT NULL THEN greatest(TRY_CAST(retry_after_ms AS DOUBLE) / 1000, 0.0) END
              WHEN TRY_CAST(retry_after_s AS DOUBLE) IS NOT NULL THEN greatest(TRY_CAST(retry_after_s AS DOUBLE), 0.0)
         END AS retry_after_seconds
  FROM response_log WHERE status_code = 429)"""


@register("a24_retry_after_forms", "WITH " + RETRY_CTE + " SELECT * FROM waits")
def a24_retry_after_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry delay of every throttled response: either header, unreadable and negative values."""
    log = _log(spark, sf_dir).where(F.col("status_code") == 429)
    return log.select("run_id", "sequence", runlog.retry_after_seconds(
        F.col("retry_after_ms"), F.col("retry_after_s")).alias("retry_after_seconds"))


A12_SQL = "WITH " + RETRY_CTE + """
SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY sequence) AS position, sequence, retry_after_seconds
FROM waits WHERE retry_after_seconds IS NOT NULL"""


@register("a12_retry_delays", A12_SQL)
def a12_retry_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retry delays of each run in log order."""
    return responses.retry_delays(_log(spark, sf_dir), "retry_after_ms", "retry_after_s")


A19_SQL = "WITH " + RESPONSE_CTE + ", " + _values_cte(CONTEXT, "field") + """
SELECT run_id, field, value, count(*) AS count FROM vals GROUP BY ALL"""


@register("a19_backend_values", A19_SQL)
def a19_backend_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of backend ids, types and regions per run."""
    return responses.value_evidence(_log(spark, sf_dir), CONTEXT)


A19_FLAG_SQL = "WITH " + RESPONSE_CTE + ", " + _values_cte(CONTEXT, "field") + """,
d AS (SELECT run_id, field, list_sort(list(DISTINCT value)) AS seen FROM vals GROUP BY ALL),
w AS (SELECT r.run_id, max(seen) FILTER (WHERE field = 'backend_id') AS ids, max(seen) FILTER (WHERE field = 'backend_type') AS types,
             max(seen) FILTER (WHERE field = 'backend_region') AS regions
      FROM (SELECT DISTINCT run_id FROM request_log) r LEFT JOIN d USING (run_id) GROUP BY r.run_id)
SELECT run_id, coalesce(len(ids), 0) AS backend_ids, coalesce(len(types), 0) AS backend_types, coalesce(len(regions), 0) AS backend_regions,
       coalesce(len(ids), 0) > 0 AND coalesce(types <> ['Pool'], true) AS selected_member_attribution
FROM w"""


@register("a19_member_attribution", A19_FLAG_SQL)
def a19_member_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether responses can be put down to pool members: runs without ids and pool-only runs cannot."""
    return responses.member_attribution(_log(spark, sf_dir))


PEAK_US = 600 * 1_000_000
A22_SQL = "WITH " + RESPONSE_CTE + f""",
s AS (SELECT run_id, string_agg(status_code || '=' || n, ', ' ORDER BY status_code) AS statuses
      FROM (SELECT run_id, status_code, count(*) AS n FROM response_log GROUP BY ALL) GROUP BY run_id),
p AS (SELECT run_id, max(c) AS peak_starts FROM (
        SELECT run_id, count(*) OVER (PARTITION BY run_id ORDER BY start_us RANGE BETWEEN {PEAK_US - 1} PRECEDING AND CURRENT ROW) AS c
        FROM response_log) GROUP BY run_id),
a AS (
  SELECT run_id, count(*) AS requests, (max(start_us) - min(start_us)) / 1000 AS start_spread_ms,
         max(start_us + duration_ms * 1000) - min(start_us) AS us,
         min(TRY_CAST(retry_after_ms AS DOUBLE)) AS retry_after_ms_min, max(TRY_CAST(retry_after_ms AS DOUBLE)) AS retry_after_ms_max,
         quantile_cont(duration_ms, 0.5) AS latency_ms_p50, quantile_cont(duration_ms, 0.95) AS latency_ms_p95,
""" + ",\n".join(
    f"         CAST(min({c}) {w} AS DOUBLE) AS {n}_min, quantile_cont({c}, 0.5) {w} AS {n}_p50, "
    f"quantile_cont({c}, 0.95) {w} AS {n}_p95, CAST(max({c}) {w} AS DOUBLE) AS {n}_max"
    for n, c, w in (("estimated", "estimated_tokens", ""), ("actual", "prompt_tokens", "FILTER (WHERE status_code = 200)"))
) + """
  FROM response_log GROUP BY run_id)
SELECT run_id, requests, statuses, peak_starts, """ + ", ".join(
    f"round_even({c}, 6) AS {c}" for c in (
        "start_spread_ms", "retry_after_ms_min", "retry_after_ms_max", "latency_ms_p50", "latency_ms_p95",
        *(f"{n}_{k}" for n in ("estimated", "actual") for k in ("min", "p50", "p95", "max")))
) + """, round_even(us / 1000, 6) AS duration_ms, round_even(CASE WHEN us > 0 THEN requests * 1e6 / us END, 6) AS requests_per_second
FROM a JOIN s USING (run_id) JOIN p USING (run_id)"""


@register("a22_run_summary", A22_SQL)
def a22_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of each run: rates, statuses, token spreads, busiest ten minutes, retry header range."""
    return round_doubles(responses.run_summary(_log(spark, sf_dir), PEAK_US))


A22_VALUES_SQL = "WITH " + RESPONSE_CTE + ", " + _values_cte(RATE_LIMIT_HEADERS, "header") + """
SELECT run_id, header, row_number() OVER (PARTITION BY run_id, header ORDER BY value) AS position, value
FROM (SELECT DISTINCT * FROM vals)"""


@register("a22_header_values", A22_VALUES_SQL)
def a22_header_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sorted values of each of the six headers per run."""
    return responses.header_values(_log(spark, sf_dir), RATE_LIMIT_HEADERS)


ERRORS_CTE = RESPONSE_CTE + """,
parsed AS (SELECT run_id, sequence, error_body, CASE WHEN json_valid(error_body) THEN CAST(error_body AS JSON) END AS j
           FROM response_log WHERE status_code <> 200),
inner_ AS (SELECT *, coalesce(json_extract(j, '$.error'), j) AS e FROM parsed),
errs AS (
  SELECT run_id, sequence, CASE WHEN json_type(e) = 'OBJECT' THEN json_extract_string(e, '$.code') END AS error_code,
         left(CASE WHEN j IS NULL THEN error_body
              WHEN json_type(e) = 'OBJECT' THEN coalesce(json_extract_string(e, '$.message'), CAST(e AS VARCHAR))
              ELSE json_extract_string(e, '$') END, 500) AS error_message
  FROM inner_)"""


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = _log(spark, sf_dir).where(F.col("status_code") != 200).select("run_id", "sequence", "error_body")
    return runlog.error_metadata(failed, "error_body").drop("error_body")


@register("a25_error_bodies", "WITH " + ERRORS_CTE + " SELECT * FROM errs")
def a25_error_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and message of every failed response: error objects, whole bodies, error texts, plain text."""
    return _errors(spark, sf_dir)


@register("a23_error_counts", "WITH " + ERRORS_CTE + " SELECT run_id, error_code, count(*) AS count FROM errs GROUP BY ALL")
def a23_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.error_counts(_errors(spark, sf_dir))


A23_FIRST_SQL = "WITH " + ERRORS_CTE + """
SELECT run_id, sequence, error_code, error_message, CAST(position AS INTEGER) AS position, errors, greatest(errors - 5, 0) AS omitted
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY sequence) AS position,
             count(*) OVER (PARTITION BY run_id) AS errors FROM errs)
WHERE position <= 5"""


@register("a23_first_errors", A23_FIRST_SQL)
def a23_first_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five errors of each run over all codes, and how many are left out."""
    return responses.first_errors(_errors(spark, sf_dir), ["error_code", "error_message"])


A32_SQL = "WITH " + BACKENDS_CTE + """,
p AS (SELECT run_id, backend_id, count(*) AS requests, sum(prompt_tokens) AS tokens FROM request_log GROUP BY ALL),
s AS (SELECT run_id, backend_id, requests / sum(requests) OVER (PARTITION BY run_id) AS rs,
             CASE WHEN sum(tokens) OVER (PARTITION BY run_id) > 0 THEN tokens / sum(tokens) OVER (PARTITION BY run_id) END AS ts FROM p)
SELECT run_id, backend_id, round_even(rs, 6) AS request_share, round_even(ts, 6) AS token_share, w.weight_percent,
       round_even(w.target_tpm / w.total_target_tpm, 6) AS planned_share,
       round_even(rs - w.target_tpm / w.total_target_tpm, 6) AS request_excess,
       round_even(ts - w.target_tpm / w.total_target_tpm, 6) AS token_excess
FROM s LEFT JOIN weights w USING (backend_id)"""


@register("a32_planned_share", A32_SQL)
def a32_planned_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each backend's share of requests and tokens against its share of the capacity plan."""
    plan = capacity_plan(backends(spark, sf_dir), UTILIZATION, PLAN_RPM)
    out = planned_share(runlog.backend_share(log_of(spark, sf_dir)), plan)
    return round_doubles(out.drop("requests", "tokens"))


# Settings repeat over runs (run mod 4); settings 1 to 3 throttle rarely; setting 3 has one run only.
QUIET = "(run_id % 4 = 0 OR status_code <> 429 OR sequence % 97 = 0) AND run_id <> 7"
A33_SQL = "WITH m AS (" + A1_SQL.replace("  FROM request_log\n)", f"  FROM request_log WHERE {QUIET}\n)") + """),
s AS (SELECT run_id % 4 AS setting, count(*) AS runs, avg(accepted_tpm) AS accepted_tpm, avg(throttle_rate) AS throttle_rate,
             avg(request_latency_p95_ms) AS request_latency_p95_ms FROM m GROUP BY ALL),
e AS (SELECT *, runs >= 2 AND throttle_rate < 0.01 AND request_latency_p95_ms <=
             1.5 * (SELECT request_latency_p95_ms FROM s WHERE setting = 0) AS eligible FROM s)
SELECT setting, runs, round_even(accepted_tpm, 6) AS accepted_tpm, round_even(throttle_rate, 6) AS throttle_rate,
       round_even(request_latency_p95_ms, 6) AS request_latency_p95_ms, eligible,
       coalesce(setting = (SELECT setting FROM e WHERE eligible ORDER BY accepted_tpm DESC, setting LIMIT 1), false) AS chosen
FROM e"""


@register("a33_operating_setting", A33_SQL)
def a33_operating_setting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The choice among repeated settings: setting 0 throttles, setting 3 was not repeated."""
    meas = measurements(log_of(spark, sf_dir).where(QUIET))
    runs = round_doubles(runlog.run_metrics(meas, MAX_INPUTS, MAX_TOKENS, TARGET_TPM, TARGET_IPM))
    return round_doubles(responses.operating_setting(
        runs.withColumn("setting", F.col("run_id") % 4), "setting", 0))
