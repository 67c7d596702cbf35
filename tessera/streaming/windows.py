"""Event-time windows over the request log (W4–W6). Every function works on a
batch DataFrame and, unchanged, on a streaming one (watermark set by caller)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_micros(ts: Column) -> Column:
    """Epoch microseconds of a timestamp_ntz (time-zone independent)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def tumbling_rates(log: DataFrame, width: str = "1 hour", key: str = "backend_id",
                   minutes: float = 60.0) -> DataFrame:
    """Per window and key: requests, accepted tokens, 429 share, RPM and TPM."""
    g = log.groupBy(F.window("ts", width).alias("w"), key).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.when(F.col("status_code") == 200, F.col("prompt_tokens")).otherwise(0)).alias(
            "tokens"),
        F.count_if(F.col("status_code") == 429).alias("throttled"))
    return g.select(epoch_micros(F.col("w.start")).alias("window_start_us"), key, "requests",
                    F.col("tokens").cast("long").alias("tokens"), "throttled",
                    (F.col("throttled") / F.col("requests")).alias("throttle_share"),
                    (F.col("requests") / F.lit(minutes)).alias("rpm"),
                    (F.col("tokens") / F.lit(minutes)).alias("tpm"))


def sliding_starts(log: DataFrame, width: str, slide: str, allowance: float,
                   key: str = "run_id") -> DataFrame:
    """Request starts per sliding window with an alert above the allowance L_w."""
    g = log.groupBy(F.window("ts", width, slide).alias("w"), key).agg(
        F.count(F.lit(1)).alias("starts"))
    return g.select(epoch_micros(F.col("w.start")).alias("window_start_us"), key, "starts",
                    (F.col("starts") > F.lit(allowance)).alias("alert"))


def throttle_sessions(log: DataFrame, gap: str = "30 minutes", key: str = "backend_id"
                      ) -> DataFrame:
    """Throttle episodes as session windows over 429 rows; a run is clean only
    after the previous episode's window has closed (session end = last 429 + gap)."""
    t = log.where(F.col("status_code") == 429)
    g = t.groupBy(F.session_window("ts", gap).alias("s"), key).agg(
        F.count(F.lit(1)).alias("throttles"))
    return g.select(key, epoch_micros(F.col("s.start")).alias("session_start_us"),
                    epoch_micros(F.col("s.end")).alias("session_end_us"), "throttles")


def clean_runs(runs: DataFrame, sessions: DataFrame, key: str = "backend_id",
               bin_us: int = 3_600_000_000) -> DataFrame:
    """A run is valid only if it starts after the throttle windows begun before it have cleared.

    Sessions (key, session_start_us, session_end_us) of one key do not overlap, so a run meets
    at most one. Both sides are keyed by time bins: a session by every bin it touches, a run by
    the bin of its start, so the join is on (key, bin) and no range is paired with another.
    Adds `valid` and `clear_at_us` (end of the window it must wait for, else null).
    """
    start, end = F.col("session_start_us"), F.col("session_end_us")
    binned = sessions.select(
        F.col(key).alias("_key"), start.alias("_from"), end.alias("clear_at_us"),
        F.explode(F.sequence(F.floor(start / bin_us), F.floor((end - 1) / bin_us))).alias("_bin"))
    r = runs.withColumn("_at", F.floor(F.col("run_start_us") / bin_us))
    j = r.join(binned, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_bin"))
               & (F.col("_from") < F.col("run_start_us")) & (F.col("run_start_us") < F.col("clear_at_us")), "left")
    return j.withColumn("valid", F.col("clear_at_us").isNull()).drop("_at", "_key", "_bin", "_from")
