"""Embed stage and response correlation.

A packed request is embedded by a caller-supplied encoder (`mapInArrow`, one
call per request, failures isolated per request) or by the native dry-run
encoder (zero vectors, no Python). Responses are correlated back to inputs by
`index`, never by position in the output file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRY_RUN_DIMENSIONS = 2

RESPONSE_FIELDS = [
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("index", T.IntegerType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType()))]))),
    T.StructField("prompt_tokens", T.LongType()),
    T.StructField("error", T.StructType([T.StructField("code", T.StringType()),
                                         T.StructField("message", T.StringType())])),
]

RESPONSE_ARROW = [pa.list_(pa.struct([("index", pa.int32()), ("embedding", pa.list_(pa.float64()))])), pa.int64(),
                  pa.struct([("code", pa.string()), ("message", pa.string())])]

# Numbers of vectors, about, that a task holds as Python objects at a time (see embed_with).
NUMBERS_PER_STEP = 20_000


def dry_run_embed(requests: DataFrame, dims_col: str | None = None) -> DataFrame:
    """E1 dry run: zero vectors of `dimensions` (default 2) and 0 tokens, native."""
    dims = (F.coalesce(F.col(dims_col), F.lit(DRY_RUN_DIMENSIONS)) if dims_col
            else F.lit(DRY_RUN_DIMENSIONS))
    data = F.transform(F.sequence(F.lit(0), F.col("input_count") - 1), lambda i: F.struct(
        i.cast("int").alias("index"), F.array_repeat(F.lit(0.0), dims).alias("embedding")))
    return requests.withColumn("data", data).withColumn("prompt_tokens", F.lit(0).cast("long")
                                                        ).withColumn("error", F.lit(None).cast(
        "struct<code:string,message:string>"))


def embed_with(requests: DataFrame, encoder: Callable[[list[str]], tuple[list[list[float]], int]],
               texts_col: str = "texts") -> DataFrame:
    """E1 with a caller encoder `texts -> (vectors, prompt_tokens)`; an exception
    becomes an error row for that request only (E3). Texts become Python objects one
    request at a time, and vectors go out in steps, whatever a batch holds."""
    schema = T.StructType(requests.schema.fields + RESPONSE_FIELDS)

    def answer(texts):
        try:
            vecs, used = encoder(list(texts))
            return [{"index": i, "embedding": [float(x) for x in v]} for i, v in enumerate(vecs)], int(used), None
        except Exception as e:  # noqa: BLE001 - isolate the failing request
            return None, None, {"code": type(e).__name__, "message": str(e)[:500]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, start, out, size = batch.column(texts_col), 0, [], 0
            for i in range(batch.num_rows):
                made = answer(texts[i].as_py())
                out.append(made)
                size += 1 + sum(1 + len(x["embedding"]) for x in made[0] or ())
                if size >= NUMBERS_PER_STEP or i + 1 == batch.num_rows:
                    # As from pandas, a NaN of a vector becomes a missing number.
                    cols = [pa.array(c, t, from_pandas=True) for c, t in zip(zip(*out), RESPONSE_ARROW)]
                    yield pa.RecordBatch.from_arrays([*batch.slice(start, i + 1 - start).columns, *cols], schema.names)
                    start, out, size = i + 1, [], 0
    return requests.mapInArrow(run, schema)


def checked(responses: DataFrame) -> DataFrame:
    """Items sorted by index into `_items`; requests whose indexes are not exactly
    0..n-1 get `error.code = 'index_mismatch'`, all others keep their error."""
    items = F.array_sort(F.col("data"), lambda a, b: F.when(a.index < b.index, -1).when(
        a.index > b.index, 1).otherwise(0))
    ok_idx = F.transform(items, lambda x: x.index) == F.sequence(
        F.lit(0), F.size("input_ids") - 1).cast("array<int>")
    return responses.withColumn("_items", items).withColumn(
        "error", F.when(F.col("error").isNull() & ~F.coalesce(ok_idx, F.lit(False)),
                        F.struct(F.lit("index_mismatch").alias("code"),
                                 F.lit("response indexes do not match the inputs").alias("message"))
                        ).otherwise(F.col("error")))


def correlate(responses: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per returned vector of the requests without error, with
    `input_ids[index]`. The other requests are given by `failed_requests`."""
    good = checked(responses).where(F.col("error").isNull()).select(
        *keep, "input_ids", F.posexplode("_items").alias("_pos", "_it"))
    return good.select(
        *keep, F.col("_it.index").alias("item_index"),
        F.element_at("input_ids", F.col("_it.index") + 1).alias("input_id"),
        F.col("_it.embedding").alias("embedding"))


def failed_requests(responses: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Failed and mismatched requests keep their input ids."""
    return checked(responses).where(F.col("error").isNotNull()).select(*keep, "input_ids", "error")


def vector_checks(vectors: DataFrame, expected_dim: int) -> DataFrame:
    """E5: dimension, finiteness per returned vector. A missing number (as Arrow hands on a
    NaN from pandas) is not finite, a missing vector neither finite nor of the dimension."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.withColumn("dimension_ok", F.coalesce(F.size("embedding") == expected_dim, F.lit(False))).withColumn(
        "finite", F.coalesce(finite, F.lit(False)))


def completeness(inputs: DataFrame, outputs: DataFrame, id_col: str = "input_id") -> DataFrame:
    """Every input returned exactly once and nothing extra — one full outer
    join of distinct inputs with per-id output counts, then one aggregate."""
    i = inputs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_ni"))
    o = outputs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_no"))
    j = i.join(o, id_col, "full_outer")
    return j.agg(
        F.coalesce(F.sum("_ni"), F.lit(0)).cast("long").alias("inputs"),
        F.coalesce(F.sum("_no"), F.lit(0)).cast("long").alias("outputs"),
        F.count_if(F.col("_no").isNull()).alias("missing"),
        F.count_if(F.col("_ni").isNull()).alias("extra"),
        F.count_if(F.col("_no") > 1).alias("duplicated"))


def run_counters(source_lines: DataFrame, responses: DataFrame) -> DataFrame:
    """Source lines, requests, inputs, failed requests (one row): two one-row
    aggregates stacked and folded, no join."""
    r = responses.agg(F.count(F.lit(1)).alias("requests"),
                      F.sum("input_count").cast("long").alias("inputs"),
                      F.count_if(F.col("error").isNotNull()).alias("failed"))
    s = source_lines.agg(F.count(F.lit(1)).alias("source_lines"))
    both = s.unionByName(r, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("source_lines", "requests", "inputs", "failed")])
