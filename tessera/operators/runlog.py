"""Request-log analytics (A*): run metrics, percentiles, throttle classification,
breaker signals, rolling peaks, scorecards. All keyed by `run_id`.

Aggregates are single `groupBy` jobs (partial aggregation on the map side).
Percentiles, rolling windows and consecutive differences use the range-sorted
helpers in `tessera.functions.ordered`, so one hot run never lands in one task.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordered import (exact_percentiles, exact_quantiles, join_small, previous_within,
                                       rank_within, rolling_counts, running_max_within)
from tessera.session import ensure_checkpoint_dir

# HTTP statuses and metric naming.
SUCCESS = 200
THROTTLED = 429
UNAVAILABLE = 503
DEFAULT_METRIC_PREFIX = "embedding_batch"
METRIC_PREFIX_PATTERN = r"^[A-Za-z][A-Za-z0-9_.-]{0,63}$"

# The 24 run-metric names in their published order.
METRIC_NAMES = (
    "configured_target_tpm", "configured_target_inputs_per_minute", "attempted_requests",
    "successful_requests", "failed_requests", "attempted_logical_inputs",
    "successful_logical_inputs", "prompt_tokens", "request_window_seconds", "attempted_rpm",
    "successful_rpm", "accepted_tpm", "logical_inputs_per_minute", "success_rate",
    "throttled_requests", "throttle_rate", "request_latency_p50_ms", "request_latency_p95_ms",
    "request_latency_p99_ms", "inputs_per_request", "prompt_tokens_per_successful_request",
    "token_ceiling_fill_ratio", "item_ceiling_fill_ratio", "estimated_to_actual_token_ratio",
)

# Throttle phrases (matched case-insensitively as substrings).
REQUEST_RATE_PHRASES = ("call rate", "request rate", "requests per")
TOKEN_RATE_PHRASES = ("token rate", "tokens per", "token limit")

# Throttle classifications and their basis texts.
NOT_THROTTLED, RPM_EXPLICIT, TPM_EXPLICIT = "not-throttled", "rpm-explicit", "tpm-explicit"
RPM_LIKELY, TPM_LIKELY, UNKNOWN = "rpm-likely", "tpm-likely", "unknown"
BASIS_NOT_429 = "HTTP status is not 429"
BASIS_MESSAGE = "server error message"
BASIS_REQ = "request counter exhausted"
BASIS_TOK = "token counter exhausted"
BASIS_BOTH = "both counters exhausted"
BASIS_NONE = "insufficient response evidence"


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def run_metrics(meas: DataFrame, max_inputs: int = 0, max_tokens: int = 0, target_tpm: int = 0,
                target_ipm: float = 0.0, runs: DataFrame | None = None,
                key: str = "run_id", exact: bool = True) -> DataFrame:
    """A1 + A2: the 24 run measures per run; runs without rows get the zero row.

    Latency percentiles are over all attempts (A1), exact and interpolated by
    default; `exact=False` opts into `percentile_approx` (one pass, bounded
    memory per run) for very large runs.
    """
    ok = F.col("status_code") == SUCCESS
    lat = (F.col("completed_seconds") - F.col("started_seconds")) * 1000
    base = meas.withColumn("_lat", lat)
    agg = base.groupBy(key).agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(ok).alias("successful"),
        F.count_if(F.col("status_code") == THROTTLED).alias("throttled"),
        F.sum("input_count").alias("att_inputs"),
        F.sum(F.when(ok, F.col("input_count")).otherwise(0)).alias("ok_inputs"),
        F.sum(F.when(ok, F.col("prompt_tokens")).otherwise(0)).alias("tokens"),
        F.sum(F.when(ok, F.col("estimated_tokens")).otherwise(0)).alias("est_tokens"),
        F.max("completed_seconds").alias("_last"),
        F.min("started_seconds").alias("_first"),
    )
    if exact:
        pct = exact_percentiles(base, [key], "_lat", {"p50": 50, "p95": 95, "p99": 99})
    else:
        q = F.percentile_approx("_lat", [0.5, 0.95, 0.99], 10000)
        pct = base.groupBy(key).agg(q.alias("_q")).select(
            key, *[F.col("_q")[i].alias(n) for i, n in enumerate(("p50", "p95", "p99"))])
    m = agg.join(pct, key, "left")
    window = F.greatest(F.col("_last") - F.col("_first"), F.lit(0.0))
    m = m.withColumn("_w", window).withColumn(
        "_rate", F.when(F.col("_w") > 0, F.lit(60.0) / F.col("_w")).otherwise(0.0))
    cols = {
        "configured_target_tpm": F.lit(float(target_tpm)),
        "configured_target_inputs_per_minute": F.lit(float(target_ipm)),
        "attempted_requests": F.col("attempted").cast("double"),
        "successful_requests": F.col("successful").cast("double"),
        "failed_requests": (F.col("attempted") - F.col("successful")).cast("double"),
        "attempted_logical_inputs": F.col("att_inputs").cast("double"),
        "successful_logical_inputs": F.col("ok_inputs").cast("double"),
        "prompt_tokens": F.col("tokens").cast("double"),
        "request_window_seconds": F.col("_w"),
        "attempted_rpm": F.col("attempted") * F.col("_rate"),
        "successful_rpm": F.col("successful") * F.col("_rate"),
        "accepted_tpm": F.col("tokens") * F.col("_rate"),
        "logical_inputs_per_minute": F.col("ok_inputs") * F.col("_rate"),
        "success_rate": F.col("successful") / F.col("attempted"),
        "throttled_requests": F.col("throttled").cast("double"),
        "throttle_rate": F.col("throttled") / F.col("attempted"),
        "request_latency_p50_ms": F.coalesce(F.col("p50"), F.lit(0.0)),
        "request_latency_p95_ms": F.coalesce(F.col("p95"), F.lit(0.0)),
        "request_latency_p99_ms": F.coalesce(F.col("p99"), F.lit(0.0)),
        "inputs_per_request": F.col("att_inputs") / F.col("attempted"),
        "prompt_tokens_per_successful_request": _ratio(F.col("tokens"), F.col("successful")),
        "token_ceiling_fill_ratio": (
            _ratio(F.col("tokens"), F.col("successful") * F.lit(max_tokens)) if max_tokens
            else F.lit(0.0)),
        "item_ceiling_fill_ratio": (
            F.col("att_inputs") / (F.col("attempted") * F.lit(max_inputs)) if max_inputs
            else F.lit(0.0)),
        "estimated_to_actual_token_ratio": _ratio(F.col("est_tokens"), F.col("tokens")),
    }
    out = m.select(key, *[c.cast("double").alias(n) for n, c in cols.items()])
    if runs is not None:
        zero = {n: F.lit(0.0) for n in METRIC_NAMES}
        zero["configured_target_tpm"] = F.lit(float(target_tpm))
        zero["configured_target_inputs_per_minute"] = F.lit(float(target_ipm))
        out = runs.select(key).distinct().join(out, key, "left").select(
            key, *[F.coalesce(F.col(n), zero[n]).alias(n) for n in METRIC_NAMES])
    return out


def validate_metric_prefix(prefix: str) -> str:
    if not re.match(METRIC_PREFIX_PATTERN, prefix):
        raise ValueError(f"invalid metric prefix {prefix!r}")
    return prefix


def publish_metrics(metrics: DataFrame, prefix: str = DEFAULT_METRIC_PREFIX,
                    enabled: bool = True, key: str = "run_id") -> DataFrame:
    """A4: wide metrics → long `(run, metric, value)` with `prefix.name`."""
    validate_metric_prefix(prefix)
    names = [c for c in metrics.columns if c != key]
    long = metrics.unpivot([key], names, "name", "value")
    out = long.select(key, F.concat(F.lit(prefix + "."), F.col("name")).alias("metric"),
                      F.col("value").cast("double").alias("value"))
    return out if enabled else out.limit(0)


def export_metrics(long: DataFrame, prefix: str) -> DataFrame:
    """A5: metrics under one prefix, sorted by name."""
    return long.where(F.col("metric").startswith(prefix + ".")).orderBy("metric")


def status_counts(log: DataFrame, key: str = "run_id") -> DataFrame:
    """Integer statuses only, keyed as strings."""
    return log.where(F.col("status_code").isNotNull()).groupBy(
        key, F.col("status_code").cast("string").alias("status")).agg(
        F.count(F.lit(1)).alias("count"))


def value_counts(log: DataFrame, column: str, key: str = "run_id") -> DataFrame:
    """Counts of a column's values, excluding null, '' and 'n/a'."""
    v = F.col(column).cast("string")
    return log.where(v.isNotNull() & ~v.isin("", "n/a")).groupBy(key, v.alias("value")).agg(
        F.count(F.lit(1)).alias("count"))


def lenient_number(c: Column) -> Column:
    """A8 lenient coercion: a number, or a string parsed as double, else null."""
    return c.try_cast("double")


def classify_throttle(status: Column, message: Column, remaining_requests: Column,
                      remaining_tokens: Column) -> Column:
    """Ordered rules → struct(classification, basis)."""
    msg = F.lower(F.coalesce(message.cast("string"), F.lit("")))
    req_phrase = None
    for p in REQUEST_RATE_PHRASES:
        c = msg.contains(p)
        req_phrase = c if req_phrase is None else (req_phrase | c)
    tok_phrase = None
    for p in TOKEN_RATE_PHRASES:
        c = msg.contains(p)
        tok_phrase = c if tok_phrase is None else (tok_phrase | c)
    rr = F.coalesce(lenient_number(remaining_requests) <= 0, F.lit(False))
    rt = F.coalesce(lenient_number(remaining_tokens) <= 0, F.lit(False))

    def res(c, b):
        return F.struct(F.lit(c).alias("classification"), F.lit(b).alias("basis"))

    return (F.when(F.coalesce(status != THROTTLED, F.lit(True)), res(NOT_THROTTLED, BASIS_NOT_429))
            .when(req_phrase, res(RPM_EXPLICIT, BASIS_MESSAGE))
            .when(tok_phrase, res(TPM_EXPLICIT, BASIS_MESSAGE))
            .when(rr & ~rt, res(RPM_LIKELY, BASIS_REQ))
            .when(rt & ~rr, res(TPM_LIKELY, BASIS_TOK))
            .when(rr & rt, res(UNKNOWN, BASIS_BOTH))
            .otherwise(res(UNKNOWN, BASIS_NONE)))


def throttle_events(log: DataFrame, key: str = "run_id") -> DataFrame:
    """A10 events: every 429 row with its classification."""
    c = classify_throttle(F.col("status_code"), F.col("error_message"),
                          F.col("remaining_requests"), F.col("remaining_tokens"))
    return log.where(F.col("status_code") == THROTTLED).select(
        key, "sequence", c.classification.alias("classification"), c.basis.alias("basis"))


def throttle_counts(log: DataFrame, key: str = "run_id") -> DataFrame:
    return throttle_events(log, key).groupBy(key, "classification").agg(
        F.count(F.lit(1)).alias("count"))


def rate_limit_evidence(log: DataFrame, headers: Sequence[str], key: str = "run_id") -> DataFrame:
    """Distinct header values with counts (long form)."""
    long = log.select(key, *[F.col(h).cast("string").alias(h) for h in headers]).unpivot(
        [key], list(headers), "header", "value")
    return long.where(F.col("value").isNotNull() & ~F.col("value").isin("", "n/a")).groupBy(
        key, "header", "value").agg(F.count(F.lit(1)).alias("count"))


def breaker_signals(log: DataFrame, key: str = "run_id") -> DataFrame:
    """429s, 503s, and 503s after any earlier 429 (by sequence).

    "After an earlier 429" is `sequence > first 429 sequence`, so a partial
    aggregate plus a per-run join replaces a per-run ordered window.
    """
    first429 = log.where(F.col("status_code") == THROTTLED).groupBy(key).agg(
        F.min("sequence").alias("_first429"))
    j = join_small(log.select(key, "sequence", "status_code"), first429, [key], "left")
    return j.groupBy(key).agg(
        F.count_if(F.col("status_code") == THROTTLED).alias("http_429"),
        F.count_if(F.col("status_code") == UNAVAILABLE).alias("http_503"),
        F.count_if((F.col("status_code") == UNAVAILABLE)
                   & (F.col("sequence") > F.col("_first429"))).alias("http_503_after_429"),
    )


def trip_candidates(log: DataFrame, threshold: int = 3, window_us: int = 30_000_000,
                    key: str = "backend_id") -> DataFrame:
    """429 rows at which a backend has seen >= threshold 429s within the window."""
    t = log.where(F.col("status_code") == THROTTLED).select(key, "sequence", "start_us")
    counts = rolling_counts(t, [key], "start_us", window_us, "sequence")
    return counts.where(F.col("window_count") >= threshold)


def peak_window(log: DataFrame, window_us: int, key: str = "run_id",
                time_col: str = "start_us", id_col: str = "sequence") -> DataFrame:
    """Peak number of starts within a rolling window (starts strictly < w apart)."""
    counts = rolling_counts(log.select(key, time_col, id_col), [key], time_col, window_us, id_col)
    return counts.groupBy(key).agg(F.max("window_count").alias("peak_starts"))


def request_spacing(log: DataFrame, offset_col: str, key: str = "run_id",
                    order_col: str = "sequence") -> DataFrame:
    """Differences of consecutive known start offsets in log order, negatives dropped."""
    given = log.select(key, order_col, offset_col).where(F.col(offset_col).isNotNull())
    prev = previous_within(given, [key], [order_col], offset_col)
    d = prev.select(key, (F.col(offset_col) - F.col("_prev")).alias("_d")).where(F.col("_d") >= 0)
    return d.groupBy(key).agg(F.avg("_d").alias("spacing_mean"), F.min("_d").alias("spacing_min"),
                              F.max("_d").alias("spacing_max"))


def run_analysis(log: DataFrame, key: str = "run_id") -> DataFrame:
    """Request count, successes, success rate (6 dp), logical inputs, tokens."""
    ok = F.col("status_code") == SUCCESS
    inputs = F.coalesce(F.col("correlated_inputs"), F.col("input_count"), F.lit(0)) if (
        "correlated_inputs" in log.columns) else F.coalesce(F.col("input_count"), F.lit(0))
    return log.groupBy(key).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.count_if(ok).alias("successful_requests"),
        F.sum(F.when(ok, inputs).otherwise(0)).alias("logical_inputs"),
        F.sum(F.when(ok, F.coalesce(F.col("prompt_tokens"), F.lit(0))).otherwise(0)).alias(
            "prompt_tokens"),
    ).withColumn("success_rate", F.bround(F.col("successful_requests") / F.col("request_count"), 6))


def five_numbers(log: DataFrame, measures: dict[str, tuple[str, Column | None]],
                 key: str = "run_id") -> DataFrame:
    """A15 helper: min, mean, p50, p95, max and total of several columns, each over the rows
    of its own condition (None: all). One aggregate, and one set of percentile passes."""
    aggs, wanted = [], {}
    for name, (col, where) in measures.items():
        v = F.col(col) if where is None else F.when(where, F.col(col))
        aggs += [F.min(v).cast("double").alias(f"{name}_min"), F.avg(v).alias(f"{name}_mean"),
                 F.max(v).cast("double").alias(f"{name}_max"), F.sum(v).cast("double").alias(f"{name}_total")]
        wanted[name] = (v, {f"{name}_p50": 50, f"{name}_p95": 95})
    return join_small(log.groupBy(key).agg(*aggs), exact_quantiles(log, [key], wanted), [key], "left")


def steady_state_rate(log: DataFrame, offset_col: str, key: str = "run_id") -> DataFrame:
    """Tokens after the first success / (last - first success offset); null if < 2."""
    ok = log.where(F.col("status_code") == SUCCESS)
    agg = ok.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.min(offset_col).alias("_first"),
        F.max(offset_col).alias("_last"), F.sum("prompt_tokens").alias("_tok"),
        F.min_by("prompt_tokens", F.struct(offset_col, "sequence")).alias("_tok_first"))
    span = F.col("_last") - F.col("_first")
    rate = F.when((F.col("_n") >= 2) & (span > 0),
                  (F.col("_tok") - F.col("_tok_first")) * 60.0 / span)
    return agg.select(key, rate.alias("steady_state_tpm"))


def throttle_bounds(log: DataFrame, key: str = "run_id") -> DataFrame:
    """First throttled sequence and last succeeded sequence per run."""
    return log.groupBy(key).agg(
        F.min(F.when(F.col("status_code") == THROTTLED, F.col("sequence"))).alias(
            "first_throttled_sequence"),
        F.max(F.when(F.col("status_code") == SUCCESS, F.col("sequence"))).alias(
            "last_succeeded_sequence"))


def retry_convergence(meas_log: DataFrame, key: str = "run_id") -> DataFrame:
    """Range of (completion + retry delay) over 429 rows per run."""
    t = meas_log.where((F.col("status_code") == THROTTLED) & F.col("retry_after").isNotNull())
    clock = F.col("completed_seconds") + F.col("retry_after")
    return t.groupBy(key).agg(F.min(clock).alias("retry_clock_min"),
                              F.max(clock).alias("retry_clock_max")).withColumn(
        "retry_clock_range", F.col("retry_clock_max") - F.col("retry_clock_min"))


def backend_share(log: DataFrame, key: str = "run_id", backend: str = "backend_id") -> DataFrame:
    """Each backend's share of requests and of tokens inside its run."""
    per = log.groupBy(key, backend).agg(F.count(F.lit(1)).alias("requests"),
                                        F.sum("prompt_tokens").alias("tokens"))
    tot = per.groupBy(key).agg(F.sum("requests").alias("_rq"), F.sum("tokens").alias("_tk"))
    out = per.join(tot, key)
    return out.select(key, backend, "requests", "tokens",
                      (F.col("requests") / F.col("_rq")).alias("request_share"),
                      F.when(F.col("_tk") > 0, F.col("tokens") / F.col("_tk")).alias("token_share"))


def error_samples(log: DataFrame, code_col: str, sample: int = 5) -> DataFrame:
    """Error counts by code, first `sample` rows (by sequence), omitted count."""
    errs = log.where(F.col(code_col).isNotNull()).select(code_col, "sequence")
    ranked = rank_within(errs, [code_col], ["sequence"])
    first = ranked.where(F.col("_rank") < sample).groupBy(code_col).agg(
        F.sort_array(F.collect_list("sequence")).alias("sample_sequences"),
        F.first("_n").alias("count"))
    return first.withColumn("omitted", F.greatest(F.col("count") - sample, F.lit(0)))


def retry_after_seconds(ms_header: Column, s_header: Column) -> Column:
    """A present ms header wins (even when unparsable → null); else the
    seconds header; clamped at 0; unparsable → null."""
    ms = ms_header.try_cast("double")
    s = s_header.try_cast("double")
    # `greatest` skips nulls, so an unparsable value is kept null explicitly.
    return (F.when(ms_header.isNotNull(), F.when(ms.isNotNull(), F.greatest(ms / 1000, F.lit(0.0))))
            .when(s_header.isNotNull(), F.when(s.isNotNull(), F.greatest(s, F.lit(0.0)))))


def error_metadata(df: DataFrame, body_col: str) -> DataFrame:
    """`error_code`, `error_message` from a JSON error body: the `error`
    object if present, else the whole body; a non-JSON body is the message;
    messages are capped at 500 characters."""
    v = df.withColumn("_v", F.try_parse_json(F.col(body_col)))
    v = v.withColumn("_e", F.coalesce(F.expr("try_variant_get(_v, '$.error', 'variant')"),
                                      F.col("_v")))
    is_obj = F.coalesce(F.schema_of_variant(F.col("_e")).startswith("OBJECT"), F.lit(False))
    code = F.when(is_obj, F.expr("try_variant_get(_e, '$.code', 'string')"))
    msg = (F.when(F.col("_v").isNull(), F.col(body_col))
           .when(is_obj, F.coalesce(F.expr("try_variant_get(_e, '$.message', 'string')"),
                                    F.to_json(F.col("_e"))))
           .otherwise(F.expr("try_variant_get(_e, '$', 'string')")))
    return v.withColumn("error_code", code).withColumn(
        "error_message", F.left(msg, F.lit(500))).drop("_v", "_e")


def output_summary(log: DataFrame, key: str = "run_id") -> DataFrame:
    """Duration, spread of starts, requests per second, retry range and the
    sorted set of observed remaining-request header values per run."""
    dur = (F.max(F.col("start_us") + F.col("duration_ms") * 1000) - F.min("start_us")) / 1e6
    return log.groupBy(key).agg(
        dur.alias("duration_s"),
        ((F.max("start_us") - F.min("start_us")) / 1e6).alias("start_spread_s"),
        F.count(F.lit(1)).alias("requests"),
        F.min("retry_after").alias("retry_min"), F.max("retry_after").alias("retry_max"),
        F.array_sort(F.collect_set("remaining_requests")).alias("remaining_requests_values"),
    ).withColumn("requests_per_second", F.when(F.col("duration_s") > 0,
                                               F.col("requests") / F.col("duration_s")))


def load_report(log: DataFrame, key: str = "run_id") -> DataFrame:
    """Window rate, 429 / 503 counts, latency mean and percentiles, inputs."""
    base = log.groupBy(key).agg(
        F.count(F.lit(1)).alias("requests"),
        ((F.max("start_us") - F.min("start_us")) / 6e7).alias("_minutes"),
        F.count_if(F.col("status_code") == THROTTLED).alias("http_429"),
        F.count_if(F.col("status_code") == UNAVAILABLE).alias("http_503"),
        F.avg("duration_ms").alias("latency_mean"),
        F.sum(F.when(F.col("status_code") == SUCCESS, F.col("input_count")).otherwise(0)).alias(
            "inputs"))
    pct = exact_percentiles(log, [key], "duration_ms",
                            {"latency_p50": 50, "latency_p95": 95, "latency_p99": 99})
    return base.join(pct, key, "left").withColumn(
        "window_rpm", F.when(F.col("_minutes") > 0, F.col("requests") / F.col("_minutes"))).drop(
        "_minutes")


def experiment_deltas(metrics: DataFrame, control, key: str = "run_id") -> DataFrame:
    """A28 (null where the control's metric is zero): request reduction, throughput increase and throttle percentage of
    every run against a control run (the control's metrics are one row)."""
    c = metrics.where(F.col(key) == control).first()
    if c is None:
        raise ValueError(f"control {control!r} not found")
    return metrics.select(
        key,
        (1 - F.try_divide(F.col("attempted_requests"), F.lit(c["attempted_requests"]))).alias("request_reduction"),
        (F.try_divide(F.col("accepted_tpm"), F.lit(c["accepted_tpm"])) - 1).alias("tpm_increase"),
        (F.col("throttle_rate") * 100).alias("throttle_pct"))


def operating_point(metrics: DataFrame, control, max_throttle: float = 0.01,
                    p95_bound: float = 1.5, key: str = "run_id") -> DataFrame:
    """Eligible settings keep throttle share below 1 % and p95 within a bound
    of the control's; the chosen one is the eligible setting with the highest
    accepted TPM (all settings are returned with their flags)."""
    c = metrics.where(F.col(key) == control).first()
    if c is None:
        raise ValueError(f"control {control!r} not found")
    elig = (F.col("throttle_rate") < max_throttle) & (
        F.col("request_latency_p95_ms") <= F.lit(c["request_latency_p95_ms"] * p95_bound))
    m = metrics.select(key, "accepted_tpm", "throttle_rate", "request_latency_p95_ms",
                       elig.alias("eligible"))
    best = m.where("eligible").agg(F.max_by(key, "accepted_tpm").alias("_best")).first()["_best"]
    return m.withColumn("chosen", F.coalesce(F.col(key) == F.lit(best), F.lit(False)))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def span_roots(spans: DataFrame) -> DataFrame:
    """trace_id, span_id, root_span_id, depth of every span, at any depth.

    Pointer jumping: each round a span takes over the ancestor of its ancestor, so the
    distance covered doubles and a chain of a million spans takes twenty rounds. A span
    whose parent is unknown is a root. A round that settles no span leaves only those on or
    below a cycle of parents: they have no root (null).
    """
    folder = f"{ensure_checkpoint_dir(spans.sparkSession).rstrip('/')}/spans-{uuid.uuid4().hex}"
    ids = spans.select("trace_id", "span_id", "parent_span_id").dropDuplicates(["trace_id", "span_id"])
    known = ids.select("trace_id", F.col("span_id").alias("parent_span_id"), F.lit(True).alias("_known"))
    at = ids.join(known, ["trace_id", "parent_span_id"], "left").select(
        "trace_id", "span_id", F.when(F.col("_known"), F.col("parent_span_id")).alias("_up"),
        F.when(F.col("_known"), 1).otherwise(0).cast("long").alias("depth"))
    # _up: an ancestor `depth` steps above; null once the span itself is a root. _top: reached a root.
    at = _stored(at.withColumn("_root", F.when(F.col("_up").isNull(), F.col("span_id"))), f"{folder}/0")
    n = left = 0
    while True:
        open_ = at.where(F.col("_root").isNull())
        before, left = left, open_.count()
        if left in (0, before):
            break
        n += 1
        above = at.select("trace_id", F.col("span_id").alias("_up"), F.col("_up").alias("_next"),
                          F.col("_root").alias("_found"), F.col("depth").alias("_more"))
        moved = open_.join(above, ["trace_id", "_up"]).select(
            "trace_id", "span_id", F.coalesce("_next", "_up").alias("_up"), (F.col("depth") + F.col("_more")).alias("depth"),
            F.col("_found").alias("_root"))
        at = _stored(at.where(F.col("_root").isNotNull()).unionByName(moved), f"{folder}/{n}")
    return at.select("trace_id", "span_id", F.col("_root").alias("root_span_id"),
                     F.when(F.col("_root").isNotNull(), F.col("depth")).alias("depth"))


def span_links(spans: DataFrame) -> DataFrame:
    """Every span with its duration, its parent's name and duration, its root and depth."""
    s = spans.select("trace_id", "span_id", "parent_span_id", "name", "start_time_unix_nano", "end_time_unix_nano",
                     ((F.col("end_time_unix_nano") - F.col("start_time_unix_nano")) / 1e6).alias("duration_ms"))
    parent = s.select("trace_id", F.col("span_id").alias("parent_span_id"), F.col("name").alias("parent_name"),
                      F.col("duration_ms").alias("parent_duration_ms")).dropDuplicates(["trace_id", "parent_span_id"])
    return s.join(parent, ["trace_id", "parent_span_id"], "left").join(span_roots(spans), ["trace_id", "span_id"])


def span_tree(spans: DataFrame) -> DataFrame:
    """Per root with descendants, their number, greatest depth, and the share of the root's
    time that they cover: the length of the union of their intervals, cut to the root's, so
    overlapping and nested spans count once. The union comes from a running latest end over
    range-sorted spans, so a root with very many descendants is spread over many tasks.
    Spans: trace_id, span_id, parent_span_id, name, start/end nanos."""
    tree = span_links(spans)
    roots = tree.where(F.col("depth") == 0).select(
        "trace_id", F.col("span_id").alias("root_span_id"), F.col("name").alias("root_name"),
        F.col("duration_ms").alias("root_duration_ms"), F.col("start_time_unix_nano").alias("_a"), F.col("end_time_unix_nano").alias("_z")
    ).dropDuplicates(["trace_id", "root_span_id"])
    below = tree.where(F.col("depth") > 0).select("trace_id", "root_span_id", "span_id", "depth", "duration_ms",
                                                  "start_time_unix_nano", "end_time_unix_nano").join(roots, ["trace_id", "root_span_id"])
    cut = below.withColumn("_s", F.least(F.greatest("start_time_unix_nano", "_a"), F.col("_z"))).withColumn(
        "_e", F.greatest(F.least("end_time_unix_nano", "_z"), F.col("_s")))
    keys = ["trace_id", "root_span_id"]
    ends = running_max_within(cut, keys, ["_s", "_e", "span_id"], "_e", "_latest")
    before = previous_within(ends, keys, ["_s", "_e", "span_id"], "_latest")
    new = F.greatest(F.col("_e") - F.greatest(F.col("_s"), F.coalesce("_prev", F.col("_s"))), F.lit(0))
    return before.groupBy(*keys, "root_name", "root_duration_ms").agg(
        F.count(F.lit(1)).alias("descendants"), F.max("depth").alias("max_depth"), F.sum("duration_ms").alias("child_ms"),
        (F.sum(new) / 1e6).alias("covered_ms")).withColumn(
        "coverage", F.when(F.col("root_duration_ms") > 0, F.col("covered_ms") / F.col("root_duration_ms")))
