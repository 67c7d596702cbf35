
import pytest

from tessera.operators import packing, runlog


def test_one_packed_request_rates(spark):
    # 100 inputs, 1,030 tokens in one request over a 1030 * 60 / 25595.218 s window.
    window = 1030 * 60 / 25595.218
    meas = spark.createDataFrame([("r", 1, 0.0, window, 100, 1030, 1030, 200)],
                                 "run_id string, sequence long, started_seconds double, "
                                 "completed_seconds double, input_count long, estimated_tokens long, "
                                 "prompt_tokens long, status_code int")
    m = runlog.run_metrics(meas, max_inputs=2048, max_tokens=1200).collect()[0]
    assert m["successful_rpm"] == pytest.approx(24.850, abs=5e-4)
    assert m["accepted_tpm"] == pytest.approx(25595.218, abs=1e-3)
    assert m["token_ceiling_fill_ratio"] == pytest.approx(0.85833, abs=5e-6)


def test_hundred_inputs_one_request(spark):
    rows = [("g", i, f"id-{i}", 10 + (i % 3)) for i in range(100)]
    df = spark.createDataFrame(rows, "grp string, ord long, id string, tok long")
    assigned = packing.assign_batches(df, "grp", ["ord"], "tok", 2048, 8192, partitions=4)
    req = packing.packed_requests(assigned, ["grp"], ["ord"], "id", None, "tok")
    eff = packing.packing_effect(req, ["grp"]).collect()[0]
    assert (eff["requests"], eff["inputs"]) == (1, 100)
    assert eff["request_reduction"] == 0.99


def test_direct_vs_pool_tpm_increase(spark):
    m = spark.createDataFrame([("direct", 7946.988, 16.0, 0.0, 1082.512),
                               ("pool", 15867.064, 16.0, 0.0, 1690.912)],
                              "run_id string, accepted_tpm double, attempted_requests double, "
                              "throttle_rate double, request_latency_p95_ms double")
    d = {r["run_id"]: r for r in runlog.experiment_deltas(m, "direct").collect()}
    assert d["pool"]["tpm_increase"] * 100 == pytest.approx(99.661, abs=5e-4)
    assert d["pool"]["request_reduction"] == 0.0
