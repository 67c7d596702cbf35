"""Response evidence on small logs with known answers."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import pacing, responses
from tessera.operators.runlog import error_metadata
from tessera.plans import responses as plans

HEADERS = ("limit_requests", "reset_tokens")


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(
        [(1, 1, 200, "60", None, "Pool", "a", None, None),
         (1, 2, 429, "n/a", None, "Pool", "a", "1500", "9"),
         (1, 3, 429, "60", None, "Pool", None, "soon", "9"),
         (2, 1, 429, "", "5", "Pool", "b", None, "-3"),
         (2, 2, 503, None, "x", "Single", "n/a", None, "7"),
         (3, 1, 200, None, "", None, "", None, None),
         (4, 1, 200, None, None, "", "c", None, None),
         (None, 1, 429, None, "1", None, None, "-20", None)],
        "run_id long, sequence long, status_code int, limit_requests string, reset_tokens string, backend_type string,"
        "backend_id string, retry_after_ms string, retry_after_s string")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_evidence_flags_and_ranges(log):
    assert rows(responses.value_evidence(log, HEADERS, name="header"), "run_id", "header", "value", "count") == sorted(
        [(1, "limit_requests", "60", 2), (2, "reset_tokens", "5", 1), (2, "reset_tokens", "x", 1),
         (None, "reset_tokens", "1", 1)], key=repr)
    flags = {r[0]: r[1:] for r in rows(responses.header_flags(log, HEADERS), "run_id", "request_headers_available",
                                       "token_headers_available")}
    assert flags == {1: (True, False), 2: (False, True), 3: (False, False), 4: (False, False), None: (False, True)}
    assert rows(responses.lenient_ranges(log, HEADERS), "header", "numeric_values", "non_numeric_values", "minimum",
                "maximum") == [("limit_requests", 2, 0, 60.0, 60.0), ("reset_tokens", 2, 1, 1.0, 5.0)]


def test_retry_delays_keep_order_and_drop_unreadable(log):
    got = rows(responses.retry_delays(log, "retry_after_ms", "retry_after_s"), "run_id", "position", "sequence",
               "retry_after_seconds")
    assert got == sorted([(1, 1, 2, 1.5), (2, 1, 1, 0.0), (2, 2, 2, 7.0), (None, 1, 1, 0.0)], key=repr)


def test_member_attribution(log):
    got = {r[0]: r[1:] for r in rows(responses.member_attribution(log.withColumn("backend_region", F.lit("eu"))),
                                     "run_id", "backend_ids", "backend_types", "selected_member_attribution")}
    # only the pool; ids with two types; neither; ids without any type; nothing recorded
    assert got == {1: (1, 1, False), 2: (1, 2, True), 3: (0, 0, False), 4: (1, 0, True), None: (0, 0, False)}


def test_header_values_are_distinct_and_sorted(spark):
    log = spark.createDataFrame([(1, "9"), (1, "10"), (1, "9"), (1, None), (2, "n/a")], "run_id long, limit_requests string")
    assert rows(responses.header_values(log, ["limit_requests"]), "run_id", "header", "position", "value") == [
        (1, "limit_requests", 1, "10"), (1, "limit_requests", 2, "9")]


def test_run_summary(spark):
    log = spark.createDataFrame(
        [(1, 1, 0, 100.0, 200, 10, 8, None), (1, 2, 5_000_000, 300.0, 429, 30, 0, "250"),
         (1, 3, 10_000_000, 200.0, 200, 20, 16, "bad"), (2, 1, 7, 0.0, None, 5, 0, None)],
        "run_id long, sequence long, start_us long, duration_ms double, status_code int, estimated_tokens long,"
        "prompt_tokens long, retry_after_ms string")
    got = {r["run_id"]: r.asDict() for r in responses.run_summary(log).collect()}
    one, two = got[1], got[2]
    assert (one["requests"], one["statuses"], one["peak_starts"]) == (3, "200=2, 429=1", 2)
    assert (one["duration_ms"], one["start_spread_ms"]) == (10200.0, 10000.0)
    assert one["requests_per_second"] == pytest.approx(3 / 10.2)
    assert [one[f"estimated_{k}"] for k in ("min", "p50", "p95", "max")] == pytest.approx([10, 20, 29, 30])
    assert [one[f"actual_{k}"] for k in ("min", "p50", "p95", "max")] == pytest.approx([8, 12, 15.6, 16])
    assert (one["retry_after_ms_min"], one["retry_after_ms_max"]) == (250.0, 250.0)
    assert (two["requests_per_second"], two["statuses"], two["actual_p50"]) == (None, None, None)


def test_error_report(spark):
    errs = spark.createDataFrame([(1, i, "a" if i % 2 else None, f"m{i}") for i in range(8)] + [(2, 0, "b", "x"), (2, 1, "b", "y")],
                                 "run_id long, sequence long, error_code string, error_message string")
    assert rows(responses.error_counts(errs), "run_id", "error_code", "count") == [(1, "a", 4), (1, None, 4), (2, "b", 2)]
    first = rows(responses.first_errors(errs, ["error_message"]), "run_id", "position", "error_message", "errors", "omitted")
    assert first == [(1, i + 1, f"m{i}", 8, 3) for i in range(5)] + [(2, 1, "x", 2, 0), (2, 2, "y", 2, 0)]


def test_first_errors_are_cut_before_the_shuffle(spark):
    errs = spark.range(100).select((F.col("id") % 3).alias("run_id"), F.col("id").alias("sequence"), F.lit("c").alias("error_code"))
    plan = responses.first_errors(errs, ["error_code"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_error_bodies(spark):
    df = spark.createDataFrame([(1, '{"error": {"code": 7, "message": "m"}}'), (2, '{"code": "c", "message": "whole"}'),
                                (3, '{"error": "text"}'), (4, "x" * 600), (5, '{"error": {"message": "n"}}')], "i int, b string")
    got = {r["i"]: (r["error_code"], r["error_message"]) for r in error_metadata(df, "b").collect()}
    assert got == {1: ("7", "m"), 2: ("c", "whole"), 3: (None, "text"), 4: (None, "x" * 500), 5: (None, "n")}


def test_operating_setting(spark):
    m = spark.createDataFrame(
        [(0, 100.0, 0.2, 10.0), (0, 100.0, 0.2, 10.0), (1, 90.0, 0.0, 12.0), (1, 110.0, 0.018, 12.0),
         (2, 100.0, 0.0, 9.0), (2, 100.0, 0.0, 9.0), (3, 500.0, 0.0, 9.0), (4, 400.0, 0.0, 16.0), (4, 400.0, 0.0, 16.0)],
        "s int, accepted_tpm double, throttle_rate double, request_latency_p95_ms double")
    got = {r["s"]: (r["runs"], r["eligible"], r["chosen"]) for r in responses.operating_setting(m, "s", 0).collect()}
    # 0 throttles, 3 was not repeated, 4 is slow; 1 and 2 tie
    assert got == {0: (2, False, False), 1: (2, True, True), 2: (2, True, False), 3: (1, False, False), 4: (2, False, False)}
    none = responses.operating_setting(m, "s", 0, max_throttle=0.0)
    assert none.where("chosen").count() == 0
    with pytest.raises(ValueError):
        responses.operating_setting(m, "s", 9)


def test_planned_share_keeps_unplanned_backends(spark):
    shares = spark.createDataFrame([(1, "a", 0.5, 0.2), (1, "z", 0.5, 0.8)], "run_id int, backend_id string, request_share double, token_share double")
    plan = spark.createDataFrame([("a", 25, 100, 400)], "backend_id string, weight_percent long, target_tpm long, total_target_tpm long")
    got = {r["backend_id"]: (r["planned_share"], r["request_excess"]) for r in pacing.planned_share(shares, plan).collect()}
    assert got == {"a": (0.25, 0.25), "z": (None, None)}


def test_job_name(spark):
    df = spark.sql("SELECT 'ada' m, 12L r, 0L t, TIMESTAMP_NTZ'2024-02-03 04:05:06' ts UNION ALL SELECT 'ada', 1L, 512L, TIMESTAMP_NTZ'2024-02-03 04:05:06'")
    got = {r[0] for r in df.select(pacing.job_name(F.col("m"), "none", "tpm", F.col("r"), 16, F.col("t"), 3, 8, F.col("ts"))).collect()}
    head = "embeddings-tpm-ada-one-input-per-request-records-"
    assert got == {head + "12-items-16-tokens-off-retries-3-workers-8-2024-02-03-040506z",
                   head + "1-items-16-tokens-512-retries-3-workers-8-2024-02-03-040506z"}
    with pytest.raises(ValueError):
        pacing.packing_label("loose")


def test_every_case_occurs_in_the_derived_log(spark, sf_small):
    flags = {tuple(r)[1:] for r in plans.a11_header_flags(spark, sf_small).collect()}
    assert {(True, True), (False, True), (True, False)} <= flags
    assert {r["selected_member_attribution"] for r in plans.a19_member_attribution(spark, sf_small).collect()} == {True, False}
    assert min(r["non_numeric_values"] for r in plans.a8_header_ranges(spark, sf_small).where("header = 'remaining_requests'").collect()) > 0
    waits = [r["retry_after_seconds"] for r in plans.a24_retry_after_forms(spark, sf_small).collect()]
    assert None in waits and 0.0 in waits and any(w for w in waits)
    assert {r["error_code"] for r in plans.a25_error_bodies(spark, sf_small).collect()} >= {None, "Busy", "429"}
    settings = plans.a33_operating_setting(spark, sf_small)
    assert {r["runs"] for r in settings.collect()} == {1, 2}
