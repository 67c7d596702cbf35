"""Request preparation and packing queries (S1/P* family) over `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import estimate_tokens
from tessera.operators import packing, prepare
from tessera.plans.registry import register
from tessera.plans.sqlparts import MODEL_CASE, chunks_cte
from tessera.sources.tables import document_chunks, document_requests, table

WORDS_PER_CHUNK = 200
MAX_INPUTS = 16
MAX_TOKENS = 4096


def validated_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = document_chunks(table(spark, sf_dir, "documents"), WORDS_PER_CHUNK)
    return prepare.validate_requests(prepare.normalise_typed(chunks, "input_id", "text"), None)


def packable_chunks(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """Accepted chunks under the token ceiling; texts are carried only on request
    (the packer needs ids and token counts, not the text). The chunks above it are the
    reject table of `p10_rejected_chunks`."""
    ok, _ = prepare.split_by_ceiling(validated_chunks(spark, sf_dir).where("accepted"), MAX_TOKENS)
    return ok.select("doc_id", "chunk_no", "input_id", *(["text"] if with_text else []), "model",
                     "user", "tokens", prepare.settings_key().alias("settings"))


def _request_report(assigned: DataFrame) -> DataFrame:
    req = packing.packed_requests(assigned, ["model", "user"], ["doc_id", "chunk_no"],
                                  "input_id", None, "tokens")
    return req.select("model", "user", packing.BATCH, "input_count", "estimated_tokens",
                      F.col("input_ids")[0].alias("first_input_id"),
                      F.element_at("input_ids", -1).alias("last_input_id"))


def packed_chunk_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = packable_chunks(spark, sf_dir)
    assigned = packing.assign_batches(items, "settings", ["doc_id", "chunk_no"], "tokens",
                                      MAX_INPUTS, MAX_TOKENS)
    return _request_report(assigned)


_PACK_ITEMS_CTE = chunks_cte(WORDS_PER_CHUNK) + f""",
items AS (
  SELECT model, "user", doc_id, chunk_no, input_id, tokens,
         row_number() OVER (PARTITION BY model, "user" ORDER BY doc_id, chunk_no) AS rn
  FROM chunk_tokens WHERE length(text) > 0 AND tokens <= {MAX_TOKENS}
)"""

_REPORT = """
SELECT i.model, i."user", CAST(w.batch_no AS BIGINT) AS batch_no,
       CAST(count(*) AS BIGINT) AS input_count, CAST(sum(i.tokens) AS BIGINT) AS estimated_tokens,
       arg_min(i.input_id, i.rn) AS first_input_id, arg_max(i.input_id, i.rn) AS last_input_id
FROM walk w JOIN items i ON i.model = w.model AND i."user" = w."user" AND i.rn = w.rn
GROUP BY ALL"""

P9_SQL = "WITH RECURSIVE " + _PACK_ITEMS_CTE + f""",
walk AS (
  SELECT model, "user", rn, 0 AS batch_no, 1 AS cnt, tokens AS tok FROM items WHERE rn = 1
  UNION ALL
  SELECT i.model, i."user", i.rn,
         CASE WHEN w.cnt >= {MAX_INPUTS} OR w.tok + i.tokens > {MAX_TOKENS}
              THEN w.batch_no + 1 ELSE w.batch_no END,
         CASE WHEN w.cnt >= {MAX_INPUTS} OR w.tok + i.tokens > {MAX_TOKENS}
              THEN 1 ELSE w.cnt + 1 END,
         CASE WHEN w.cnt >= {MAX_INPUTS} OR w.tok + i.tokens > {MAX_TOKENS}
              THEN i.tokens ELSE w.tok + i.tokens END
  FROM walk w JOIN items i ON i.model = w.model AND i."user" = w."user" AND i.rn = w.rn + 1
)""" + _REPORT


@register("p9_pack_requests", P9_SQL)
def p9_pack_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: chunks packed in order under an item and a token ceiling."""
    return packed_chunk_requests(spark, sf_dir)


P9_ITEMS_SQL = "WITH " + _PACK_ITEMS_CTE + f""",
walk AS (SELECT model, "user", rn, (rn - 1) // {MAX_INPUTS} AS batch_no FROM items)""" + _REPORT


@register("p9_pack_items", P9_ITEMS_SQL)
def p9_pack_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-ceiling-only packing: request = rank // max_inputs (distributed rank)."""
    items = packable_chunks(spark, sf_dir)
    assigned = packing.assign_batches(items, "settings", ["doc_id", "chunk_no"], "tokens",
                                      MAX_INPUTS, None)
    return _request_report(assigned)


P14_SQL = "WITH RECURSIVE " + _PACK_ITEMS_CTE + f""",
walk AS (
  SELECT model, "user", rn, 0 AS batch_no, 1 AS cnt, tokens AS tok FROM items WHERE rn = 1
  UNION ALL
  SELECT i.model, i."user", i.rn,
         CASE WHEN w.cnt >= {MAX_INPUTS} OR w.tok + i.tokens > {MAX_TOKENS}
              THEN w.batch_no + 1 ELSE w.batch_no END,
         CASE WHEN w.cnt >= {MAX_INPUTS} OR w.tok + i.tokens > {MAX_TOKENS}
              THEN 1 ELSE w.cnt + 1 END,
         CASE WHEN w.cnt >= {MAX_INPUTS} OR w.tok + i.tokens > {MAX_TOKENS}
              THEN i.tokens ELSE w.tok + i.tokens END
  FROM walk w JOIN items i ON i.model = w.model AND i."user" = w."user" AND i.rn = w.rn + 1
),
req AS (
  SELECT i.model, w.batch_no, i."user", count(*) AS input_count, sum(i.tokens) AS tokens
  FROM walk w JOIN items i ON i.model = w.model AND i."user" = w."user" AND i.rn = w.rn
  GROUP BY ALL
)
SELECT model, CAST(count(*) AS BIGINT) AS requests, CAST(sum(input_count) AS BIGINT) AS inputs,
       CAST(sum(tokens) AS BIGINT) AS estimated_tokens,
       CAST(max(input_count) AS BIGINT) AS max_batch_inputs,
       CAST(min(input_count) AS BIGINT) AS min_batch_inputs,
       round_even(sum(input_count) / count(*), 6) AS inputs_per_request,
       round_even(1 - count(*) / sum(input_count), 6) AS request_reduction
FROM req GROUP BY model"""


@register("p14_packing_effect", P14_SQL)
def p14_packing_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_effect(packed_chunk_requests(spark, sf_dir), ["model"])


P4_SQL = "WITH " + chunks_cte(WORDS_PER_CHUNK) + """
SELECT model, length(text) > 0 AS accepted,
       CASE WHEN length(text) = 0 THEN 'empty_input' END AS error,
       CAST(count(*) AS BIGINT) AS requests
FROM chunks GROUP BY ALL"""


@register("p4_validate_requests", P4_SQL)
def p4_validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation outcome per model and first failing rule over all chunk requests."""
    v = validated_chunks(spark, sf_dir)
    return v.groupBy("model", "accepted", "error").agg(F.count(F.lit(1)).alias("requests"))


P5_SQL = """
WITH r AS (SELECT doc_id, 'md5-' || md5(text) AS input_id FROM documents),
f AS (SELECT input_id, min(doc_id) AS first_doc, count(*) AS occurrences
      FROM r GROUP BY input_id HAVING count(*) > 1)
SELECT r.input_id, r.doc_id, CAST(f.occurrences AS BIGINT) AS occurrences, f.first_doc AS first_doc_id
FROM r JOIN f USING (input_id) WHERE r.doc_id <> f.first_doc"""


@register("p5_duplicate_inputs", P5_SQL)
def p5_duplicate_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content-addressed ids: every later copy of an exact duplicate text offends."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("md5-"), F.md5("text")).alias("input_id"))
    dup = prepare.duplicate_inputs(docs, ["doc_id"])
    first = docs.groupBy("input_id").agg(F.min("doc_id").alias("first_doc_id"))
    return dup.join(first, "input_id").select("input_id", "doc_id", "occurrences", "first_doc_id")


P10_SQL = f"""
SELECT doc_id, 'doc-' || doc_id AS input_id, CAST(ceil(length(text) / 4) AS BIGINT) AS tokens
FROM documents WHERE ceil(length(text) / 4) > {prepare.MAX_TOKENS_PER_INPUT}"""


@register("p10_oversized_inputs", P10_SQL)
def p10_oversized_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    reqs = document_requests(table(spark, sf_dir, "documents")).withColumn(
        "tokens", estimate_tokens(F.col("input")))
    return prepare.oversized_inputs(reqs, "tokens", prepare.MAX_TOKENS_PER_INPUT).select(
        "doc_id", "input_id", "tokens")


P1_SQL = f"""
SELECT 'doc-' || doc_id || '-repeat-' || lpad(CAST(r AS VARCHAR), 2, '0') AS input_id,
       CAST(r AS INTEGER) AS repeat_no, 'text-embedding-3-large' AS model
FROM documents, range(1, 4) t(r)"""


@register("p1_fan_out", P1_SQL)
def p1_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    reqs = document_requests(table(spark, sf_dir, "documents"))
    out = prepare.fan_out(reqs, 3, "text-embedding-3-large")
    return out.select("input_id", "repeat_no", "model")


P6_SQL = "WITH " + chunks_cte(WORDS_PER_CHUNK) + f"""
SELECT CAST(count(*) AS BIGINT) AS total_inputs, {prepare.MAX_BATCH_INPUTS} AS ceiling,
       count(*) > {prepare.MAX_BATCH_INPUTS} AS exceeds
FROM chunks WHERE length(text) > 0"""


@register("p6_input_ceiling", P6_SQL)
def p6_input_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validated_chunks(spark, sf_dir).where("accepted")
    return prepare.input_ceiling(v)


P15_SQL = f"""
WITH r AS (
  SELECT {MODEL_CASE} AS model, source AS "user", doc_id,
         CAST(ceil(length(text) / 4) AS BIGINT) AS tokens,
         (row_number() OVER (PARTITION BY {MODEL_CASE}, source ORDER BY doc_id) - 1)
           // {prepare.MAX_ARRAY_INPUTS} AS batch_no
  FROM documents
),
req AS (
  SELECT model, "user", batch_no, count(*) AS input_count, sum(tokens) AS estimated_tokens,
         max(tokens) AS max_input_tokens
  FROM r GROUP BY ALL
)
SELECT model, "user", CAST(batch_no AS BIGINT) AS batch_no, rule, CAST("limit" AS BIGINT) AS "limit"
FROM (
  SELECT *, 'max_inputs' AS rule, {prepare.MAX_ARRAY_INPUTS} AS "limit" FROM req
    WHERE input_count > {prepare.MAX_ARRAY_INPUTS}
  UNION ALL
  SELECT *, 'max_request_tokens', {prepare.MAX_REQUEST_TOKENS} FROM req
    WHERE estimated_tokens > {prepare.MAX_REQUEST_TOKENS}
  UNION ALL
  SELECT *, 'max_input_tokens', {prepare.MAX_TOKENS_PER_INPUT} FROM req
    WHERE max_input_tokens > {prepare.MAX_TOKENS_PER_INPUT}
)"""


@register("p15_shape_violations", P15_SQL)
def p15_shape_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents packed 2,048 per request, checked against the shape limits."""
    reqs = document_requests(table(spark, sf_dir, "documents")).withColumn(
        "tokens", estimate_tokens(F.col("input"))).withColumn(
        "settings", prepare.settings_key())
    assigned = packing.assign_batches(reqs, "settings", ["doc_id"], "tokens",
                                      prepare.MAX_ARRAY_INPUTS, None)
    req = assigned.groupBy("model", "user", packing.BATCH).agg(
        F.count(F.lit(1)).alias("input_count"), F.sum("tokens").alias("estimated_tokens"),
        F.max("tokens").alias("max_input_tokens"))
    hits = prepare.shape_violations(req, "estimated_tokens", F.col("max_input_tokens"))
    return hits.select("model", "user", packing.BATCH, "rule", "limit")


def embedded_chunks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Packed chunk requests embedded by the native dry-run encoder."""
    from tessera.operators import correlate
    items = packable_chunks(spark, sf_dir)
    assigned = packing.assign_batches(items, "settings", ["doc_id", "chunk_no"], "tokens",
                                      MAX_INPUTS, MAX_TOKENS)
    # The dry-run encoder needs only the item count; a real encoder would carry
    # `text` (packable_chunks(..., with_text=True)) into `texts`.
    req = packing.packed_requests(assigned, ["model", "user"], ["doc_id", "chunk_no"],
                                  "input_id", None, "tokens")
    return items, correlate.dry_run_embed(req)


E2_SQL = P9_SQL.split("\nSELECT i.model")[0] + """
SELECT i.input_id, i.model, i."user", CAST(w.batch_no AS BIGINT) AS batch_no,
       CAST(i.rn - min(i.rn) OVER (PARTITION BY i.model, i."user", w.batch_no) AS INTEGER)
         AS item_index, 2 AS dimensions
FROM walk w JOIN items i ON i.model = w.model AND i."user" = w."user" AND i.rn = w.rn"""


@register("e2_correlated_outputs", E2_SQL)
def e2_correlated_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + E2 + E5: dry-run embed every packed request and correlate each vector
    back to its input id by response index."""
    from tessera.operators import correlate
    _, resp = embedded_chunks(spark, sf_dir)
    out = correlate.correlate(resp, keep=["model", "user", packing.BATCH])
    return out.select("input_id", "model", "user", packing.BATCH, "item_index",
                      F.size("embedding").alias("dimensions"))


E6_SQL = "WITH " + chunks_cte(WORDS_PER_CHUNK) + f""",
i AS (SELECT input_id, count(*) AS n FROM chunk_tokens WHERE length(text) > 0 GROUP BY input_id),
o AS (SELECT input_id, count(*) AS n FROM chunk_tokens WHERE length(text) > 0 AND tokens <= {MAX_TOKENS} GROUP BY input_id)
SELECT CAST(sum(i.n) AS BIGINT) AS inputs, CAST(sum(o.n) AS BIGINT) AS outputs, count(*) FILTER (o.n IS NULL) AS missing,
       count(*) FILTER (i.n IS NULL) AS extra, count(*) FILTER (o.n > 1) AS duplicated
FROM i FULL JOIN o USING (input_id)"""


@register("e6_completeness", E6_SQL)
def e6_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every accepted input returned exactly once, nothing extra (anti-joins both ways);
    chunks over the token ceiling, which are not packed, count as missing."""
    from tessera.operators import correlate
    _, resp = embedded_chunks(spark, sf_dir)
    outs = correlate.correlate(resp)
    return correlate.completeness(validated_chunks(spark, sf_dir).where("accepted"), outs)


def array_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array request per document: its chunk ids and texts in chunk order
    (collect_list is bounded by one document's chunks)."""
    ch = document_chunks(table(spark, sf_dir, "documents"), WORDS_PER_CHUNK)
    g = ch.groupBy("doc_id").agg(F.sort_array(F.collect_list(
        F.struct("chunk_no", "input_id", "text"))).alias("_c"))
    return g.select("doc_id", F.col("_c.input_id").alias("input_ids"),
                    F.col("_c.text").alias("texts"))


P12_SQL = "WITH " + chunks_cte(WORDS_PER_CHUNK) + """
SELECT doc_id, CAST(chunk_no AS INTEGER) AS input_pos, input_id FROM chunks"""


@register("p12_unpack_inputs", P12_SQL)
def p12_unpack_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array requests unpacked to one row per logical input (strict parallel zip)."""
    return prepare.explode_inputs(array_requests(spark, sf_dir), ["doc_id"]).select(
        "doc_id", "input_pos", "input_id")


P11_SQL = "WITH " + chunks_cte(WORDS_PER_CHUNK) + """
SELECT doc_id, CAST(count(*) AS INTEGER) AS input_count, CAST(0 AS BIGINT) AS estimated_tokens
FROM chunks GROUP BY doc_id"""


@register("p11_passthrough", P11_SQL)
def p11_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing mode `none`: every array request passes as is, 0 estimated tokens."""
    return packing.passthrough_requests(array_requests(spark, sf_dir)).select(
        "doc_id", "input_count", "estimated_tokens")


P8_SQL = "WITH " + chunks_cte(WORDS_PER_CHUNK) + """
SELECT model, 'float' AS encoding_format, "user", CAST(count(*) AS BIGINT) AS inputs
FROM chunks GROUP BY ALL"""


@register("p8_settings_groups", P8_SQL)
def p8_settings_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs per settings group (null-safe key; absent encoding means float)."""
    ch = document_chunks(table(spark, sf_dir, "documents"), WORDS_PER_CHUNK)
    g = ch.groupBy(prepare.settings_key().alias("k")).agg(F.count(F.lit(1)).alias("inputs"))
    return g.select(F.get_json_object("k", "$.model").alias("model"),
                    F.get_json_object("k", "$.encoding_format").alias("encoding_format"),
                    F.get_json_object("k", "$.user").alias("user"), "inputs")


E4_SQL = P14_SQL.split("\nSELECT model, CAST(count(*)")[0] + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM chunks) AS source_lines,
       CAST(count(*) AS BIGINT) AS requests, CAST(sum(input_count) AS BIGINT) AS inputs,
       CAST(0 AS BIGINT) AS failed
FROM req"""


@register("e4_run_counters", E4_SQL)
def e4_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run counters of the dry-run embed: source lines, requests, inputs, failures."""
    from tessera.operators import correlate
    lines = validated_chunks(spark, sf_dir)
    _, resp = embedded_chunks(spark, sf_dir)
    return correlate.run_counters(lines, resp)


_J11_WALK = P9_SQL.split("\nSELECT i.model")[0]
J11_SQL = _J11_WALK + f""",
tok AS (SELECT i.model, i."user", w.batch_no, count(*) AS size
        FROM walk w JOIN items i ON i.model = w.model AND i."user" = w."user" AND i.rn = w.rn
        GROUP BY ALL),
itm AS (SELECT model, "user", (rn - 1) // {MAX_INPUTS} AS batch_no, count(*) AS size
        FROM items GROUP BY ALL),
j AS (SELECT coalesce(a.model, b.model) AS model, coalesce(a."user", b."user") AS "user",
             a.size AS sa, b.size AS sb
      FROM tok a FULL OUTER JOIN itm b
        ON a.model = b.model AND a."user" = b."user" AND a.batch_no = b.batch_no)
SELECT model, "user", CAST(count(sa) AS BIGINT) AS token_requests,
       CAST(count(sb) AS BIGINT) AS item_requests,
       bool_and(coalesce(sa = sb, false)) AS identical_batching
FROM j GROUP BY ALL"""


@register("j11_batch_shapes", J11_SQL)
def j11_batch_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same-batch-shape test between two packings of the same inputs (token and
    item ceilings vs item ceiling only): ordered batch sizes compared per group
    by an outer join on the batch number."""
    items = packable_chunks(spark, sf_dir)
    tok = packing.assign_batches(items, "settings", ["doc_id", "chunk_no"], "tokens",
                                 MAX_INPUTS, MAX_TOKENS)
    itm = packing.assign_batches(items, "settings", ["doc_id", "chunk_no"], "tokens",
                                 MAX_INPUTS, None)

    def sizes(a: DataFrame, name: str) -> DataFrame:
        return a.groupBy("model", "user", packing.BATCH).agg(F.count(F.lit(1)).alias(name))
    j = sizes(tok, "sa").join(sizes(itm, "sb"), ["model", "user", packing.BATCH], "full_outer")
    return j.groupBy("model", "user").agg(
        F.count("sa").alias("token_requests"), F.count("sb").alias("item_requests"),
        F.bool_and(F.coalesce(F.col("sa") == F.col("sb"), F.lit(False))).alias(
            "identical_batching"))
