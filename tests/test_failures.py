"""Index mismatches, failed requests and vector checks on small tables."""

import pyarrow as pa
from pyspark.sql import functions as F

from tessera.operators import correlate, prepare

RESPONSES = ("id int, input_ids array<string>, data array<struct<index:int,embedding:array<double>>>, prompt_tokens long, "
             "error struct<code:string,message:string>")


def test_indexes_and_errors(spark):
    """In order, swapped, missing, repeated and foreign indexes; an error of the request itself; no data."""
    def items(*ix):
        return [(i, [float(i or 0)]) for i in ix]

    rows = [(1, ["a", "b"], items(0, 1), 1, None), (2, ["c", "d"], items(1, 0), 1, None), (3, ["e", "f"], items(0), 1, None),
            (4, ["g", "h"], items(0, 0), 1, None), (5, ["i", "j"], items(0, 2), 1, None), (6, ["k"], None, None, ("boom", "x")),
            (7, ["l"], None, 1, None)]
    df = spark.createDataFrame(rows, RESPONSES)
    good = {r["input_id"]: r["embedding"] for r in correlate.correlate(df).collect()}
    assert good == {"a": [0.0], "b": [1.0], "c": [0.0], "d": [1.0]}
    failed = {r["id"]: (r["input_ids"], r["error"]["code"]) for r in correlate.failed_requests(df, ["id"]).collect()}
    assert failed == {3: (["e", "f"], "index_mismatch"), 4: (["g", "h"], "index_mismatch"), 5: (["i", "j"], "index_mismatch"),
                      6: (["k"], "boom"), 7: (["l"], "index_mismatch")}
    inputs = df.select(F.explode("input_ids").alias("input_id"))
    assert tuple(correlate.completeness(inputs, correlate.correlate(df)).first()) == (12, 4, 8, 0, 0)


def test_vector_checks(spark):
    inf = float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.0]), (3, [float("nan"), 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, None), (7, [])]
    got = {r["id"]: (r["dimension_ok"], r["finite"]) for r in correlate.vector_checks(
        spark.createDataFrame(rows, "id int, embedding array<double>"), 2).collect()}
    assert got == {1: (True, True), 2: (False, True), 3: (True, False), 4: (True, False), 5: (True, False), 6: (False, False), 7: (False, True)}


def test_encoder_errors_stay_with_their_request(spark):
    def encoder(texts):
        if "bad" in texts:
            raise KeyError("bad")
        return [[1.0] for _ in texts], 3

    df = spark.createDataFrame([(["a"], ["ok"]), (["b", "c"], ["ok", "bad"])], "input_ids array<string>, texts array<string>")
    out = correlate.embed_with(df, encoder)
    assert [r["error"]["code"] for r in correlate.failed_requests(out).collect()] == ["KeyError"]
    assert [r["input_id"] for r in correlate.correlate(out).collect()] == ["a"]


def test_split_by_ceiling(spark):
    fits, rejected = prepare.split_by_ceiling(spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, tokens long"), 5)
    assert [r["id"] for r in fits.collect()] == [1]
    assert sorted((r["id"], r["reason"]) for r in rejected.collect()) == [(2, "token_ceiling"), (3, "token_ceiling")]


def test_encoder_output_goes_out_in_steps(spark):
    """Vectors of a batch are not held together; a NaN is a missing number; null texts are an error of their request."""
    def encoder(texts):
        return [[1.0] * 999 + [float("nan")] for _ in texts], len(texts)

    rows = [(i, [f"i{i}"], None if i == 7 else [f"t{i}"]) for i in range(100)]
    frame = spark.createDataFrame(rows, "id int, input_ids array<string>, texts array<string>").coalesce(1)
    got = correlate.embed_with(frame, encoder).collect()
    assert [r["id"] for r in got] == list(range(100))
    assert [r["error"] and r["error"]["code"] for r in got] == ["TypeError" if i == 7 else None for i in range(100)]
    assert all(r["prompt_tokens"] == 1 and r["data"][0]["embedding"] == [1.0] * 999 + [None] for r in got if r["id"] != 7)

    class Rows:
        schema = frame.schema

        def mapInArrow(self, run, schema):
            return list(run([frame.toArrow().combine_chunks().to_batches()[0]]))

    steps = [b.num_rows for b in correlate.embed_with(Rows(), encoder)]
    assert sum(steps) == 100 and max(steps) < 25
