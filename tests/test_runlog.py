import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.ordered import exact_percentiles, rolling_counts
from tessera.operators import pacing, runlog


def py_percentile(values, p):
    s = sorted(values)
    if not s:
        return None
    pos = (len(s) - 1) * p / 100
    lo = int(pos)
    hi = min(lo + 1, len(s) - 1)
    return s[lo] + (s[hi] - s[lo]) * (pos - lo)


def test_two_row_run_metrics(spark):
    rows = [("r", 1, 0.0, 1.5, 30, 700, 700, 200), ("r", 2, 1.5, 3.0, 50, 300, 0, 429)]
    meas = spark.createDataFrame(rows, "run_id string, sequence long, started_seconds double, "
                                 "completed_seconds double, input_count long, estimated_tokens long, "
                                 "prompt_tokens long, status_code int")
    m = runlog.run_metrics(meas, max_inputs=100, max_tokens=1200).collect()[0].asDict()
    assert m["attempted_rpm"] == 40 and m["successful_rpm"] == 20
    assert m["accepted_tpm"] == 14000
    assert m["success_rate"] == 0.5 and m["throttle_rate"] == 0.5
    assert m["logical_inputs_per_minute"] == 600
    assert m["token_ceiling_fill_ratio"] == pytest.approx(700 / 1200)
    assert m["item_ceiling_fill_ratio"] == pytest.approx(0.4)
    assert m["request_latency_p95_ms"] == 1500


def test_empty_run_gets_zero_row(spark):
    meas = spark.createDataFrame([], "run_id string, sequence long, started_seconds double, "
                                 "completed_seconds double, input_count long, estimated_tokens long, "
                                 "prompt_tokens long, status_code int")
    runs = spark.createDataFrame([("empty",)], "run_id string")
    m = runlog.run_metrics(meas, target_tpm=7, runs=runs).collect()[0].asDict()
    assert m["configured_target_tpm"] == 7.0 and m["attempted_requests"] == 0.0


def test_metric_prefix_and_namespacing(spark):
    runlog.validate_metric_prefix("embedding_batch")
    with pytest.raises(ValueError):
        runlog.validate_metric_prefix("1bad prefix")
    wide = spark.createDataFrame([("r", 1.0, 2.0)], "run_id string, a double, b double")
    names = sorted(r["metric"] for r in runlog.publish_metrics(wide, "pre").collect())
    assert names == ["pre.a", "pre.b"]
    assert runlog.publish_metrics(wide, "pre", enabled=False).count() == 0


CASES = [
    (200, None, None, None, "not-throttled"),
    (429, "Exceeded call rate limit", None, None, "rpm-explicit"),
    (429, "Exceeded token rate limit", None, None, "tpm-explicit"),
    (429, "", "0", "10", "rpm-likely"),
    (429, "", "5", "0", "tpm-likely"),
    (429, "", None, None, "unknown"),
    (429, "", "0", "0", "unknown"),
]


def test_throttle_classification(spark):
    df = spark.createDataFrame(CASES, "status_code int, error_message string, "
                               "remaining_requests string, remaining_tokens string, expect string")
    c = runlog.classify_throttle(F.col("status_code"), F.col("error_message"),
                                 F.col("remaining_requests"), F.col("remaining_tokens"))
    for r in df.select("expect", c.classification.alias("got")).collect():
        assert r["got"] == r["expect"]


def test_exact_percentiles_match_python_with_hot_key(spark):
    rnd = random.Random(7)
    rows = [("hot", rnd.random() * 100) for _ in range(4000)] + \
           [(f"k{i % 5}", float(rnd.randint(0, 50))) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in exact_percentiles(df, ["k"], "v", {"p50": 50, "p95": 95, "p99": 99},
                                                partitions=8).collect()}
    for k in got:
        vals = [v for kk, v in rows if kk == k]
        for name, p in (("p50", 50), ("p95", 95), ("p99", 99)):
            assert got[k][name] == pytest.approx(py_percentile(vals, p), abs=1e-9)


def test_peak_window_matches_two_pointer(spark):
    rnd = random.Random(3)
    starts = sorted(rnd.randint(0, 100_000) for _ in range(500))
    df = spark.createDataFrame([("r", i, t) for i, t in enumerate(starts)],
                               "run_id string, sequence long, start_us long")
    got = runlog.peak_window(df, 5000).collect()[0]["peak_starts"]
    peak, left = 0, 0
    for right, s in enumerate(starts):
        while s - starts[left] >= 5000:
            left += 1
        peak = max(peak, right - left + 1)
    assert got == peak


def test_breaker_503_after_429(spark):
    rows = [("r", 1, 200), ("r", 2, 503), ("r", 3, 429), ("r", 4, 503), ("r", 5, 503)]
    df = spark.createDataFrame(rows, "run_id string, sequence long, status_code int")
    r = runlog.breaker_signals(df).collect()[0]
    assert (r["http_429"], r["http_503"], r["http_503_after_429"]) == (1, 3, 2)


def test_retry_after_headers(spark):
    df = spark.createDataFrame([("1500", None), (None, "12"), (None, "invalid"), ("x", "3")],
                               "ms string, s string")
    got = [r[0] for r in df.select(runlog.retry_after_seconds(F.col("ms"), F.col("s"))).collect()]
    assert got == [1.5, 12.0, None, None]


def test_error_metadata(spark):
    df = spark.createDataFrame([('{"error": {"code": "429", "message": "slow down"}}',),
                                ("not json",)], "body string")
    got = [(r["error_code"], r["error_message"]) for r in runlog.error_metadata(df, "body").collect()]
    assert got == [("429", "slow down"), (None, "not json")]


def test_pacing_formulas_and_capacity_chain(spark):
    df = spark.createDataFrame([(1400, 24000)], "tok long, tpm long")
    assert df.select(pacing.pacing_interval_seconds(F.col("tok"), F.col("tpm"))).first()[0] == 3.5
    b = spark.createDataFrame([("a", 15), ("b", 15)], "backend_id string, capacity_units long")
    plan = {r["backend_id"]: r for r in pacing.capacity_plan(b, 0.6, 15).collect()}
    assert plan["a"]["total_target_tpm"] == 18000
    assert sum(r["assigned_tpm"] for r in plan.values()) == 30000
    assert plan["a"]["tokens_per_request"] == 600
    assert sum(r["weight_percent"] for r in plan.values()) == 100


def test_paced_schedule_equals_recurrence(spark):
    rnd = random.Random(11)
    rows, exp = [], {}
    for key in ("a", "b"):
        arr = sorted(rnd.randint(0, 10_000) for _ in range(400))
        ivs = [rnd.randint(0, 80) for _ in arr]
        nxt = None
        for i, (t, iv) in enumerate(zip(arr, ivs)):
            start = t if nxt is None else max(t, nxt)
            nxt = start + iv
            exp[(key, i)] = start
            rows.append((key, i, t, iv))
    df = spark.createDataFrame(rows, "k string, i long, arrival long, iv long")
    out = pacing.paced_schedule(df, ["k"], "arrival", "iv", ["arrival", "i"])
    for r in out.collect():
        assert r["paced_start"] == exp[(r["k"], r["i"])]


def test_rolling_counts_range_frame(spark):
    df = spark.createDataFrame([("b", 1, 0), ("b", 2, 10), ("b", 3, 10), ("b", 4, 25)],
                               "k string, id long, t long")
    got = {r["id"]: r["window_count"] for r in rolling_counts(df, ["k"], "t", 15, "id").collect()}
    assert got == {1: 1, 2: 3, 3: 3, 4: 1}  # (10, 25] excludes the t=10 peers


def test_approx_percentiles_opt_in(spark):
    rows = [("r", i, 0.0, i / 1000.0, 1, 1, 1, 200) for i in range(1, 1001)]
    meas = spark.createDataFrame(rows, "run_id string, sequence long, started_seconds double, "
                                 "completed_seconds double, input_count long, estimated_tokens long, "
                                 "prompt_tokens long, status_code int")
    ex = runlog.run_metrics(meas).collect()[0]
    ap = runlog.run_metrics(meas, exact=False).collect()[0]
    assert ex["request_latency_p50_ms"] == pytest.approx(500.5)
    assert ap["request_latency_p50_ms"] == pytest.approx(500.5, abs=2.0)
