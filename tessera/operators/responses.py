"""What the responses of a run tell (A8, A11, A12, A19, A22, A23, A33): header evidence,
retry delays, backend context, run summaries, error reports, and the choice among settings.

Lists that grow with the log (delays, header values) are rows with a position, never arrays.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ordered import join_small, rank_within
from tessera.operators.runlog import (SUCCESS, five_numbers, lenient_number, peak_window,
                                      retry_after_seconds)

# What stands for an unrecorded value, and the type of a backend that is a pool.
UNRECORDED = ("", "n/a")
POOL = "Pool"


def recorded(c: Column) -> Column:
    """The value as text; null where nothing was recorded."""
    v = c.cast("string")
    return F.when(~v.isin(*UNRECORDED), v)


def _long(log: DataFrame, columns: Sequence[str], key: str, name: str) -> DataFrame:
    wide = log.select(key, *[recorded(F.col(c)).alias(c) for c in columns])
    return wide.unpivot([key], list(columns), name, "value").where(F.col("value").isNotNull())


def value_evidence(log: DataFrame, columns: Sequence[str], key: str = "run_id", name: str = "field") -> DataFrame:
    """(run, field, value, count) over the recorded values of several columns."""
    return _long(log, columns, key, name).groupBy(key, name, "value").agg(F.count(F.lit(1)).alias("count"))


def header_flags(log: DataFrame, headers: Sequence[str], key: str = "run_id") -> DataFrame:
    """Whether a run shows any request header, and any token header. Runs without either stay."""
    def seen(kind):
        cols = [recorded(F.col(h)).isNotNull() for h in headers if kind in h]
        return F.bool_or(reduce(lambda a, b: a | b, cols)) if cols else F.lit(False)
    return log.groupBy(key).agg(seen("requests").alias("request_headers_available"),
                                seen("tokens").alias("token_headers_available"))


def lenient_ranges(log: DataFrame, columns: Sequence[str], key: str = "run_id") -> DataFrame:
    """Per column how many recorded values are numbers, how many are not, and the range."""
    v = _long(log, columns, key, "header").withColumn("_n", lenient_number(F.col("value")))
    return v.groupBy("header").agg(
        F.count("_n").alias("numeric_values"), (F.count(F.lit(1)) - F.count("_n")).alias("non_numeric_values"),
        F.min("_n").alias("minimum"), F.max("_n").alias("maximum"))


def retry_delays(log: DataFrame, ms: str, seconds: str, key: str = "run_id", order: str = "sequence") -> DataFrame:
    """The list of retry delays of a run in log order, a row each (position from 1).
    Unreadable delays are left out."""
    d = log.select(key, order, retry_after_seconds(F.col(ms), F.col(seconds)).alias("retry_after_seconds"))
    ranked = rank_within(d.where(F.col("retry_after_seconds").isNotNull()), [key], [order])
    return ranked.select(key, (F.col("_rank") + 1).alias("position"), order, "retry_after_seconds")


def member_attribution(log: DataFrame, key: str = "run_id", ids: str = "backend_id",
                       types: str = "backend_type", regions: str = "backend_region") -> DataFrame:
    """How many ids, types and regions a run shows, and whether responses can be put down to
    members of the pool: ids are there, and the types are not just the pool itself."""
    i, t, r = (recorded(F.col(c)) for c in (ids, types, regions))
    only_pool = (F.count(t) > 0) & (F.min(t) == POOL) & (F.max(t) == POOL)
    return log.groupBy(key).agg(
        F.count_distinct(i).alias("backend_ids"), F.count_distinct(t).alias("backend_types"),
        F.count_distinct(r).alias("backend_regions"),
        ((F.count(i) > 0) & ~F.coalesce(only_pool, F.lit(False))).alias("selected_member_attribution"))


def run_summary(log: DataFrame, peak_window_us: int = 10_000_000, key: str = "run_id") -> DataFrame:
    """Duration, start spread, rate, statuses, latency percentiles, token spreads of the planned
    and of the successful requests, peak starts, and the range of the retry header."""
    numbers = five_numbers(log, {"latency_ms": ("duration_ms", None), "estimated": ("estimated_tokens", None),
                                 "actual": ("prompt_tokens", F.col("status_code") == SUCCESS)}, key)
    keep = [F.col(f"{n}_{k}") for n in ("estimated", "actual") for k in ("min", "p50", "p95", "max")]
    by_status = log.where(F.col("status_code").isNotNull()).groupBy(key, "status_code").agg(F.count(F.lit(1)).alias("_c"))
    statuses = by_status.groupBy(key).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("status_code", "_c"))),
        lambda x: F.concat_ws("=", x["status_code"], x["_c"])), ", ").alias("statuses"))
    wait = lenient_number(F.col("retry_after_ms"))
    base = log.groupBy(key).agg(
        F.count(F.lit(1)).alias("requests"),
        (F.max(F.col("start_us") + F.col("duration_ms") * 1000) - F.min("start_us")).alias("_us"),
        ((F.max("start_us") - F.min("start_us")) / 1000).alias("start_spread_ms"),
        F.min(wait).alias("retry_after_ms_min"), F.max(wait).alias("retry_after_ms_max"))
    base = base.select("*", (F.col("_us") / 1000).alias("duration_ms"), F.when(
        F.col("_us") > 0, F.col("requests") * 1e6 / F.col("_us")).alias("requests_per_second")).drop("_us")
    out = join_small(base, numbers.select(key, "latency_ms_p50", "latency_ms_p95", *keep), [key], "left")
    out = join_small(out, statuses, [key], "left")
    return join_small(out, peak_window(log, peak_window_us, key), [key], "left")


def header_values(log: DataFrame, headers: Sequence[str], key: str = "run_id") -> DataFrame:
    """The sorted distinct values of each header, a row each (position from 1)."""
    ranked = rank_within(_long(log, headers, key, "header").distinct(), [key, "header"], ["value"])
    return ranked.select(key, "header", (F.col("_rank") + 1).alias("position"), "value")


def error_counts(errors: DataFrame, key: str = "run_id", code: str = "error_code") -> DataFrame:
    """Errors by code; errors without a code count under null."""
    return errors.groupBy(key, code).agg(F.count(F.lit(1)).alias("count"))


def first_errors(errors: DataFrame, columns: Sequence[str], sample: int = 5, key: str = "run_id",
                 order: str = "sequence") -> DataFrame:
    """The first `sample` errors of a run over all codes, with the run's number of errors and
    how many are left out. Spark keeps `sample` rows a run in every task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    first = errors.select(key, order, *columns).withColumn("position", place).where(F.col("position") <= sample)
    total = errors.groupBy(key).agg(F.count(F.lit(1)).alias("errors"))
    return join_small(first, total, [key], "left").withColumn(
        "omitted", F.greatest(F.col("errors") - sample, F.lit(0)))


def operating_setting(metrics: DataFrame, setting: str, control, max_throttle: float = 0.01,
                      p95_bound: float = 1.5, min_runs: int = 2) -> DataFrame:
    """A33 over repeats: settings with at least `min_runs` runs, a mean throttle share below the
    limit and a mean p95 within the bound of the control's are eligible; the one with the highest
    mean accepted rate is chosen (ties: smallest setting)."""
    per = metrics.groupBy(setting).agg(
        F.count(F.lit(1)).alias("runs"), F.avg("accepted_tpm").alias("accepted_tpm"),
        F.avg("throttle_rate").alias("throttle_rate"), F.avg("request_latency_p95_ms").alias("request_latency_p95_ms"))
    base = per.where(F.col(setting) == F.lit(control)).first()
    if base is None:
        raise ValueError(f"no run of the control setting {control!r}")
    out = per.withColumn("eligible", F.coalesce(
        (F.col("runs") >= min_runs) & (F.col("throttle_rate") < max_throttle)
        & (F.col("request_latency_p95_ms") <= base["request_latency_p95_ms"] * p95_bound), F.lit(False)))
    best = out.where("eligible").orderBy(F.desc("accepted_tpm"), setting).select(setting).first()
    return out.withColumn("chosen", F.col(setting) == F.lit(best[0]) if best else F.lit(False))
