import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import vectors as V


def vec(seed):
    return [float(seed), seed + 1.0, seed + 2.0, seed + 3.0]


def route(spark, items, model="m"):
    return spark.createDataFrame([(i, p, v, model) for p, (i, v) in enumerate(items)],
                                 "input_id string, pos long, embedding array<double>, model string")


def issues(spark, base, cand, require_identical=False):
    b, c = route(spark, base), route(spark, cand)
    comp = V.comparison(V.compare_pairs(V.first_vectors(b), V.first_vectors(c)))
    return {r["issue"]: r["count"] for r in V.gate_issues(
        V.route_summary(b, "b", 4), V.route_summary(c, "c", 4), comp, V.one_sided(b, c),
        require_identical).collect()}


def test_identical_passes(spark):
    items = [("chunk-1", vec(1)), ("chunk-2", vec(2))]
    assert issues(spark, items, items, require_identical=True) == {}


def test_tiny_drift_passes_default_gates(spark):
    base = [("a", vec(1))]
    cand = [("a", [x + 1e-9 for x in vec(1)])]
    assert issues(spark, base, cand) == {}
    assert "not bit-identical" in issues(spark, base, cand, require_identical=True)


def test_orthogonal_fails_cosine(spark):
    got = issues(spark, [("a", [1.0, 0.0, 0.0, 0.0])], [("a", [0.0, 1.0, 0.0, 0.0])])
    assert got.get("below cosine min") == 1


def test_id_sets_differ_and_join_by_id(spark):
    base = [("a", vec(1)), ("b", vec(2))]
    cand = [("b", vec(2)), ("a", vec(1)), ("c", vec(3))]
    got = issues(spark, base, cand)
    assert got == {"input_id sets differ": 1}
    pairs = V.compare_pairs(route(spark, base), route(spark, cand)).collect()
    assert all(r["identical"] for r in pairs)


def test_duplicates_and_nan(spark):
    got = issues(spark, [("a", vec(1)), ("a", vec(5)), ("n", [math.nan, 0.0, 0.0, 1.0])],
                 [("a", vec(1)), ("n", [0.0, 0.0, 0.0, 1.0])])
    assert got.get("duplicate input_id") == 1
    assert got.get("non-finite values") == 1


def test_zero_vectors_and_error_records_are_issues(spark):
    zero = [("a", [0.0] * 4)]
    assert issues(spark, zero, zero) == {"zero-magnitude vectors": 1}
    b = route(spark, zero)
    empty = b.where("false")
    failed = spark.createDataFrame([("b",), ("b",)], "label string")
    comp = V.comparison(V.compare_pairs(empty, empty))
    rows = V.gate_issues(V.route_summary(empty, "b", 4), V.route_summary(empty, "c", 4), comp, V.one_sided(empty, empty), errors=failed)
    assert {(r["label"], r["issue"], r["count"]) for r in rows.collect()} == {
        ("b", "error records", 2), ("b", "no vectors", 1), ("c", "no vectors", 1), ("both", "no shared input_id values", 1)}


def test_first_vector_wins(spark):
    r = route(spark, [("a", vec(1)), ("a", vec(9))])
    assert V.first_vectors(r).collect()[0]["embedding"] == vec(1)


def test_distinct_vectors_per_text(spark):
    items = [("chunk-01-repeat-01", vec(1)), ("chunk-01-repeat-02", vec(1)),
             ("chunk-02-repeat-01", vec(2)), ("chunk-02-repeat-02", vec(3))]
    got = {r["base"]: r["distinct_vectors"] for r in
           V.distinct_vectors_by_group(route(spark, items)).collect()}
    assert got == {"chunk-01": 1, "chunk-02": 2}


def test_cosine_expression(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [2.0, 4.0, 6.0])], "a array<double>, b array<double>")
    assert df.select(V.cosine(F.col("a"), F.col("b"))).first()[0] == pytest.approx(1.0)
    z = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert z.select(V.cosine(F.col("a"), F.col("b"))).first()[0] is None
