"""Capacity planning and pacing queries (Q*) over the request log from `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.ordered import rolling_counts
from tessera.operators import pacing
from tessera.plans.common import round_doubles
from tessera.plans.registry import register
from tessera.plans.runlog import log_of
from tessera.plans.sqlparts import MODEL_CASE, REQUEST_LOG_CTE
from tessera.sources.tables import model_for_lang, table

UTILIZATION = 0.6
PLAN_RPM = 60.0
TARGET_TPM = 15000
TARGET_IPM = 1200
ALLOWANCE_RPM = 0.1
ALLOWANCE_WINDOW_S = 3600


def backends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per backend; capacity units sized from the tokens it served."""
    log = log_of(spark, sf_dir)
    return log.groupBy("backend_id").agg(
        F.ceil(F.sum("prompt_tokens") / F.lit(100000.0)).cast("long").alias("capacity_units"))


BACKENDS_CTE = REQUEST_LOG_CTE + """,
backends AS (
  SELECT backend_id, CAST(ceil(sum(prompt_tokens) / 100000.0) AS BIGINT) AS capacity_units
  FROM request_log GROUP BY backend_id
),
plan AS (
  SELECT backend_id, capacity_units, capacity_units * 1000 AS assigned_tpm,
         CAST(floor(capacity_units * 1000 * 0.6) AS BIGINT) AS target_tpm
  FROM backends
),
plan2 AS (
  SELECT *, CAST(greatest(floor(target_tpm / 60.0), 1) AS BIGINT) AS tokens_per_request,
         sum(target_tpm) OVER () AS total_target_tpm,
         CAST(round_even(100.0 * target_tpm / sum(target_tpm) OVER (), 0) AS BIGINT) AS raw,
         row_number() OVER (ORDER BY backend_id) = count(*) OVER () AS is_last
  FROM plan
),
weights AS (
  SELECT backend_id, capacity_units, assigned_tpm, target_tpm, tokens_per_request,
         CAST(total_target_tpm AS BIGINT) AS total_target_tpm,
         CAST(CASE WHEN is_last THEN 100 - (sum(raw) OVER (ORDER BY backend_id) - raw)
              ELSE raw END AS BIGINT) AS weight_percent
  FROM plan2
)"""

Q4_SQL = "WITH " + BACKENDS_CTE + "\nSELECT * FROM weights"


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pacing.capacity_plan(backends(spark, sf_dir), UTILIZATION, PLAN_RPM)


@register("q4_capacity_plan", Q4_SQL)
def q4_capacity_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1–Q4: units → TPM → target → tokens/request, integer weights summing to 100."""
    return _plan(spark, sf_dir).select("backend_id", "capacity_units", "assigned_tpm",
                                       "target_tpm", "tokens_per_request", "total_target_tpm",
                                       "weight_percent")


Q5_SQL = "WITH " + BACKENDS_CTE + """,
ranges AS (
  SELECT backend_id, sum(weight_percent) OVER (ORDER BY backend_id) - weight_percent AS lo,
         sum(weight_percent) OVER (ORDER BY backend_id) AS hi FROM weights
),
req AS (
  SELECT sequence,
         CAST(('0x' || substr(md5(CAST(sequence AS VARCHAR)), 1, 8)) AS BIGINT) % 100 AS bucket
  FROM request_log
)
SELECT r.backend_id, CAST(count(*) AS BIGINT) AS routed_requests
FROM req JOIN ranges r ON req.bucket >= r.lo AND req.bucket < r.hi GROUP BY r.backend_id"""


@register("q5_weighted_routing", Q5_SQL)
def q5_weighted_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = pacing.route_by_weight(log_of(spark, sf_dir).select("sequence"),
                                    _plan(spark, sf_dir), "sequence")
    return routed.groupBy("backend_id").agg(F.count(F.lit(1)).alias("routed_requests"))


Q5_TOKENS_SQL = """
WITH plan AS (
  SELECT s_suppkey AS backend_id, CAST(floor(greatest(s_acctbal, 0) * 100) AS BIGINT) AS w FROM supplier),
ranges AS (SELECT backend_id, sum(w) OVER (ORDER BY backend_id) - w AS lo, sum(w) OVER (ORDER BY backend_id) AS hi FROM plan WHERE w > 0),
req AS (
  SELECT CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 15)) AS BIGINT) % (SELECT sum(w) FROM plan) AS token FROM events)
SELECT r.backend_id, CAST(count(*) AS BIGINT) AS routed_requests, CAST(min(token) AS BIGINT) AS first_token
FROM req JOIN ranges r ON req.token >= r.lo AND req.token < r.hi GROUP BY r.backend_id"""


@register("q5_token_routing", Q5_TOKENS_SQL)
def q5_token_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact weighted routing of all requests to the suppliers as backends, weighed by balance in cents."""
    plan = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("backend_id"),
        F.floor(F.greatest("s_acctbal", F.lit(0.0)) * 100).cast("long").alias("target_tpm"))
    routed = pacing.route_by_tokens(table(spark, sf_dir, "events").select("event_id"), plan, "event_id")
    return routed.groupBy("backend_id").agg(F.count(F.lit(1)).alias("routed_requests"), F.min("token").alias("first_token"))


Q9_SQL = "WITH " + REQUEST_LOG_CTE + f""",
iv AS (
  SELECT run_id, backend_id, sequence, start_us,
         greatest(CAST(estimated_tokens AS BIGINT) * 60000000 // {TARGET_TPM},
                  CAST(input_count AS BIGINT) * 60000000 // {TARGET_IPM}) AS interval_us
  FROM request_log
),
c AS (
  SELECT *, coalesce(sum(interval_us) OVER (PARTITION BY run_id, backend_id
              ORDER BY start_us, sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cc
  FROM iv
)
SELECT run_id, backend_id, sequence, start_us, interval_us,
       CAST(cc + max(start_us - cc) OVER (PARTITION BY run_id, backend_id ORDER BY start_us, sequence
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS paced_start,
       CAST(cc + max(start_us - cc) OVER (PARTITION BY run_id, backend_id ORDER BY start_us, sequence
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - start_us AS BIGINT) AS wait
FROM c"""


@register("q9_paced_schedule", Q9_SQL)
def q9_paced_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6–Q9: dual pacing interval (integer µs) and the paced start of every request."""
    log = log_of(spark, sf_dir)
    tok_iv = F.expr(f"CAST(estimated_tokens AS BIGINT) * 60000000 div {TARGET_TPM}")
    inp_iv = F.expr(f"CAST(input_count AS BIGINT) * 60000000 div {TARGET_IPM}")
    req = log.select("run_id", "backend_id", "sequence", "start_us",
                     pacing.dual_interval(tok_iv, inp_iv).cast("long").alias("interval_us"))
    sched = pacing.paced_schedule(req, ["run_id", "backend_id"], "start_us", "interval_us",
                                  ["start_us", "sequence"])
    return sched.select("run_id", "backend_id", "sequence", "start_us", "interval_us",
                        "paced_start", "wait")


Q11_SQL = "WITH " + REQUEST_LOG_CTE + f""",
c AS (
  SELECT backend_id, sequence,
         count(*) OVER (PARTITION BY backend_id ORDER BY start_us
           RANGE BETWEEN {ALLOWANCE_WINDOW_S * 1_000_000 - 1} PRECEDING AND CURRENT ROW) AS n
  FROM request_log
)
SELECT backend_id, sequence, CAST(n AS BIGINT) AS window_count,
       {ALLOWANCE_RPM} * {ALLOWANCE_WINDOW_S} / 60 AS allowance
FROM c WHERE n > {ALLOWANCE_RPM} * {ALLOWANCE_WINDOW_S} / 60"""


@register("q11_window_allowance", Q11_SQL)
def q11_window_allowance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at which a backend's rolling-window starts exceed L_w = RPM * w / 60."""
    log = log_of(spark, sf_dir).select("backend_id", "sequence", "start_us")
    allowance = ALLOWANCE_RPM * ALLOWANCE_WINDOW_S / 60
    c = rolling_counts(log, ["backend_id"], "start_us", ALLOWANCE_WINDOW_S * 1_000_000, "sequence")
    return c.where(F.col("window_count") > allowance).withColumn("allowance", F.lit(allowance))


ALLOWANCE_TPM = 40.0
Q11_TOKENS_SQL = "WITH " + REQUEST_LOG_CTE + f""",
c AS (
  SELECT backend_id, sequence,
         sum(estimated_tokens) OVER (PARTITION BY backend_id ORDER BY start_us
           RANGE BETWEEN {ALLOWANCE_WINDOW_S * 1_000_000 - 1} PRECEDING AND CURRENT ROW) AS n
  FROM request_log
)
SELECT backend_id, sequence, CAST(n AS BIGINT) AS window_tokens,
       {ALLOWANCE_TPM} * {ALLOWANCE_WINDOW_S} / 60 AS allowance
FROM c WHERE n > {ALLOWANCE_TPM} * {ALLOWANCE_WINDOW_S} / 60"""


@register("q11_token_allowance", Q11_TOKENS_SQL)
def q11_token_allowance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at which a backend's rolling-window tokens exceed TPM * w / 60."""
    allowance = ALLOWANCE_TPM * ALLOWANCE_WINDOW_S / 60
    c = rolling_counts(log_of(spark, sf_dir), ["backend_id"], "start_us", ALLOWANCE_WINDOW_S * 1_000_000,
                       "sequence", "estimated_tokens").withColumnRenamed("window_count", "window_tokens")
    return c.where(F.col("window_tokens") > allowance).withColumn("allowance", F.lit(allowance))


Q12_SQL = "WITH " + REQUEST_LOG_CTE + f""",
r AS (
  SELECT run_id, count(*) AS requests, sum(input_count) AS inputs, sum(prompt_tokens) AS tokens,
         (max(start_us) - min(start_us)) / 1e6 AS window_seconds
  FROM request_log GROUP BY run_id
)
SELECT run_id, CAST(requests AS BIGINT) AS requests, CAST(inputs AS BIGINT) AS inputs,
  CAST(tokens AS BIGINT) AS tokens, round_even(window_seconds, 6) AS window_seconds,
  round_even(CASE WHEN window_seconds > 0 THEN requests / (window_seconds / 60) END, 6)
    AS batches_per_minute,
  round_even(CASE WHEN window_seconds > 0 THEN 60.0 / (requests / (window_seconds / 60)) END, 6)
    AS batch_spacing_seconds,
  round_even(CASE WHEN window_seconds > 0 THEN tokens / (window_seconds / 60) / {TARGET_TPM} END, 6)
    AS tpm_utilization,
  round_even(inputs / requests / 16, 6) AS batching_efficiency
FROM r"""


@register("q12_run_rates", Q12_SQL)
def q12_run_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = log_of(spark, sf_dir)
    runs = log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("input_count").cast("long").alias("inputs"),
        F.sum("prompt_tokens").cast("long").alias("tokens"),
        ((F.max("start_us") - F.min("start_us")) / 1e6).alias("window_seconds"))
    return round_doubles(pacing.run_rates(runs, 16, TARGET_TPM))


Q13_SQL = f"""
SELECT 'embeddings-rpm-' || {MODEL_CASE} || '-packed-input-array' AS experiment,
       CAST(count(*) AS BIGINT) AS documents
FROM documents GROUP BY ALL"""


@register("q13_experiment_names", Q13_SQL)
def q13_experiment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    name = pacing.experiment_name(model_for_lang(F.col("lang")), "packed", "rpm")
    return docs.groupBy(name.alias("experiment")).agg(F.count(F.lit(1)).alias("documents"))


JOB_SQL = f"""
SELECT 'embeddings-rpm-' || model || '-packed-input-array-records-' || records || '-items-16-tokens-' ||
       CASE WHEN ceiling > 0 THEN CAST(ceiling AS VARCHAR) ELSE 'off' END || '-retries-3-workers-8-' ||
       strftime(started, '%Y-%m-%d-%H%M%Sz') AS job, records
FROM (SELECT {MODEL_CASE} AS model, doc_id % 2 * 4096 AS ceiling, count(*) AS records,
             (SELECT max(ts) FROM events) AS started FROM documents GROUP BY ALL)"""


@register("q13_job_names", JOB_SQL)
def q13_job_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job per model and ceiling (4,096 tokens or none), started at the last event."""
    started = table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    groups = table(spark, sf_dir, "documents").groupBy(
        model_for_lang(F.col("lang")).alias("model"), (F.col("doc_id") % 2 * 4096).alias("ceiling")).agg(
        F.count(F.lit(1)).alias("records"))
    name = pacing.job_name(F.col("model"), "packed", "rpm", F.col("records"), 16, F.col("ceiling"), 3, 8,
                           F.lit(started).cast("timestamp_ntz"))
    return groups.select(name.alias("job"), "records")
