"""Queries in which rules fire: rejected request lines, rejected chunks, failing requests.

The inputs are the given tables with a defect put into each row, chosen by its id or
length, so every rule and every kind of failure occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import correlate, prepare
from tessera.plans.registry import register
from tessera.plans.requests import WORDS_PER_CHUNK, array_requests, validated_chunks
from tessera.plans.sqlparts import chunks_cte
from tessera.sources.files import parse_requests
from tessera.sources.tables import table

MODEL = "text-embedding-3-small"

# One line per defect; %s is the document's id. The field names of a request.
LINES = (
    ("{broken", "invalid_json"),
    ("[%s]", "not_object"),
    ('{"input_id":"d-%s","input":"x","model":"M","colour":"red"}', "unknown_fields"),
    ('{"input_id":"d-%s","input":"x","model":"other"}', "model_mismatch"),
    ('{"input_id":"d-%s","input":"","model":"M"}', "empty_input"),
    ('{"input_id":"","input":"x%s","model":"M"}', "bad_input_id"),
    ('{"input_id":"d-%s","input":7,"model":"M"}', "bad_input"),
    ('{"input_id":["d-%s"],"input":["x",2],"model":"M"}', "non_string_input"),
    ('{"input_id":["d-%s"],"input":["x","y"],"model":"M"}', "id_count_mismatch"),
    ('{"input_id":["d-%s",""],"input":["x","y"],"model":"M"}', "bad_input_ids"),
    ('{"input_id":["d-%s","d-%s"],"input":["x","y"],"model":"M"}', "duplicate_ids_in_row"),
    ('{"input_id":"d-%s","input":"x","model":"M","encoding_format":"hex"}', "bad_encoding"),
    ('{"input_id":"d-%s","input":"x","model":"M","dimensions":0}', "bad_dimensions"),
    ('{"input_id":"d-%s","input":"x","model":"M","user":5}', "bad_user"),
    (None, "too_many_inputs"),
    ('{"input_id":["d-%s","e-%s"],"input":["x","y"],"model":"M"}', None),
)


def _cases() -> str:
    rows = ", ".join(f"({i}, {'NULL' if e is None else repr(e)})" for i, (_, e) in enumerate(LINES))
    return f"(VALUES {rows}) AS v(k, error)"


P4_REJECTS_SQL = f"""
SELECT d.doc_id, v.error IS NULL AS accepted, v.error, CASE WHEN v.error IS NULL THEN 2 END AS input_count
FROM documents d JOIN {_cases()} ON v.k = d.doc_id % {len(LINES)}"""


@register("p4_rejected_lines", P4_REJECTS_SQL)
def p4_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + P4 on JSON request lines, one per document, each with one of 15 defects or none."""
    doc = F.col("doc_id").cast("string")
    big = prepare.MAX_ARRAY_INPUTS + 1
    many = F.concat(F.lit('{"model":"M","input_id":['), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(big)), lambda i: F.concat(
        F.lit('"'), doc, F.lit("-"), i.cast("string"), F.lit('"'))), ","), F.lit('],"input":['), F.array_join(F.array_repeat(F.lit('"x"'), big), ","), F.lit("]}"))
    line = None
    for i, (text, _) in enumerate(LINES):
        made = many if text is None else F.replace(F.lit(text), F.lit("%s"), doc)
        hit = F.col("doc_id") % len(LINES) == i
        line = F.when(hit, made) if line is None else line.when(hit, made)
    lines = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("file"), F.col("doc_id").alias("line_no"), F.replace(line, F.lit('"M"'), F.lit(f'"{MODEL}"')).alias("line"))
    r = parse_requests(lines, MODEL)
    return r.select(F.col("line_no").alias("doc_id"), "accepted", "error", F.when(F.col("accepted"), F.col("input_count")).alias("input_count"))


LOW_CEILING = 300
P10_REJECTS_SQL = "WITH " + chunks_cte(WORDS_PER_CHUNK) + f"""
SELECT input_id, tokens, '{prepare.TOKEN_CEILING}' AS reason FROM chunk_tokens WHERE length(text) > 0 AND tokens > {LOW_CEILING}"""


@register("p10_rejected_chunks", P10_REJECTS_SQL)
def p10_rejected_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject table of a packer with a low token ceiling."""
    _, rejected = prepare.split_by_ceiling(validated_chunks(spark, sf_dir).where("accepted"), LOW_CEILING)
    return rejected.select("input_id", "tokens", "reason")


# Fixed rules of the trial encoder below, in SQL: which requests fail, and how.
FAILURES_CTE = "WITH " + chunks_cte(WORDS_PER_CHUNK) + """,
reqs AS (
  SELECT doc_id, count(*) AS n, sum(length(text)) AS size, list(input_id ORDER BY chunk_no) AS ids FROM chunks GROUP BY doc_id),
fate AS (
  SELECT *, CASE WHEN size % 7 = 0 THEN 'ValueError' WHEN n > 1 AND size % 5 = 0 THEN 'index_mismatch' END AS code FROM reqs)"""


def trial_encoder(texts: list[str]) -> tuple[list[list[float]], int]:
    """Vectors (length, 1); refuses some requests, loses an item of others, and gives some a bad number or size."""
    size = sum(map(len, texts))
    if size % 7 == 0:
        raise ValueError("refused")
    vectors = [[float("nan") if len(t) % 11 == 0 else float(len(t)), 1.0][:1 if len(t) % 13 == 0 else 2] for t in texts]
    return (vectors[:-1] if len(texts) > 1 and size % 5 == 0 else vectors), size


def trial_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = array_requests(spark, sf_dir).withColumn("input_count", F.size("input_ids"))
    return correlate.embed_with(requests, trial_encoder).drop("texts")


E3_SQL = FAILURES_CTE + """
SELECT doc_id, array_to_string(ids, ',') AS input_ids, code FROM fate WHERE code IS NOT NULL"""


@register("e3_failed_requests", E3_SQL)
def e3_failed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 with a caller's encoder: requests that it refused or answered in part, with their input ids."""
    failed = correlate.failed_requests(trial_responses(spark, sf_dir), ["doc_id"])
    return failed.select("doc_id", F.array_join("input_ids", ",").alias("input_ids"), F.col("error.code").alias("code"))


E5_SQL = FAILURES_CTE + """
SELECT c.input_id, length(c.text) % 13 <> 0 AS dimension_ok, length(c.text) % 11 <> 0 AS finite
FROM chunks c JOIN fate f USING (doc_id) WHERE f.code IS NULL AND (length(c.text) % 13 = 0 OR length(c.text) % 11 = 0)"""


@register("e5_bad_vectors", E5_SQL)
def e5_bad_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned vectors of a wrong size or with a number that is not finite."""
    v = correlate.vector_checks(correlate.correlate(trial_responses(spark, sf_dir)), 2)
    return v.where(~F.col("dimension_ok") | ~F.col("finite")).select("input_id", "dimension_ok", "finite")


E6_FAILURES_SQL = FAILURES_CTE + """
SELECT CAST(sum(n) AS BIGINT) AS inputs, CAST(sum(n) FILTER (code IS NULL) AS BIGINT) AS outputs,
       CAST(sum(n) FILTER (code IS NOT NULL) AS BIGINT) AS missing, 0 AS extra, 0 AS duplicated FROM fate"""


@register("e6_failure_completeness", E6_FAILURES_SQL)
def e6_failure_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness where requests fail: their inputs are missing."""
    inputs = array_requests(spark, sf_dir).select(F.explode("input_ids").alias("input_id"))
    return correlate.completeness(inputs, correlate.correlate(trial_responses(spark, sf_dir)))


E4_FAILURES_SQL = FAILURES_CTE + """
SELECT (SELECT count(*) FROM documents) AS source_lines, count(*) AS requests, CAST(sum(n) AS BIGINT) AS inputs,
       count(*) FILTER (code = 'ValueError') AS failed FROM fate"""


@register("e4_failure_counters", E4_FAILURES_SQL)
def e4_failure_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run counters with refused requests."""
    return correlate.run_counters(table(spark, sf_dir, "documents"), trial_responses(spark, sf_dir))
