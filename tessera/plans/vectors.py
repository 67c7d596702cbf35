"""Route-comparison queries (J*) over `embeddings` (baseline) and its re-normalised,
partly drifted and partly renamed candidate route."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import vectors as V
from tessera.plans.registry import register
from tessera.sources.tables import drifted_route, faulty_routes, table, vector_route

ROUTES_CTE = """
base AS (
  SELECT 'label-' || label || '-repeat-' || vec_id AS input_id, vec_id AS pos,
         CAST(embedding AS DOUBLE[]) AS embedding, 'text-embedding-3-small' AS model
  FROM embeddings
),
cand0 AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
         sqrt(list_reduce(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x),
                          lambda x, y: x + y)) AS n
  FROM embeddings
),
cand AS (
  SELECT CASE WHEN vec_id % 50 = 49 THEN 'label-' || label || '-repeat-' || vec_id || '-b'
              ELSE 'label-' || label || '-repeat-' || vec_id END AS input_id,
         vec_id AS pos,
         list_transform(range(1, len(e) + 1),
           lambda i: CASE WHEN i = 1 AND vec_id % 10 = 0 THEN e[i] / n + 1e-4 ELSE e[i] / n END)
           AS embedding,
         'text-embedding-3-small' AS model
  FROM cand0
),
pairs AS (
  SELECT b.input_id, b.embedding AS a, c.embedding AS bb FROM base b JOIN cand c USING (input_id)
),
m AS (
  SELECT input_id, len(a) = len(bb) AS same_length, a = bb AS identical,
    list_reduce(list_transform(range(1, len(a) + 1), lambda i: a[i] * bb[i]), lambda x, y: x + y) AS dot,
    sqrt(list_reduce(list_transform(a, lambda x: x * x), lambda x, y: x + y)) AS na,
    sqrt(list_reduce(list_transform(bb, lambda x: x * x), lambda x, y: x + y)) AS nb,
    list_max(list_transform(range(1, len(a) + 1), lambda i: abs(a[i] - bb[i]))) AS mad,
    sqrt(list_reduce(list_transform(range(1, len(a) + 1), lambda i: (a[i] - bb[i]) * (a[i] - bb[i])),
                     lambda x, y: x + y)) AS l2
  FROM pairs
),
metrics AS (
  SELECT input_id, same_length, identical,
         CASE WHEN na * nb <> 0 THEN dot / (na * nb) END AS cosine, mad AS max_abs_diff,
         l2 AS l2_distance
  FROM m
),
flags AS (
  SELECT *, same_length AND cosine < 0.999999 AS below_cosine_min,
         NOT same_length OR max_abs_diff > 1e-6 AS above_abs_tolerance
  FROM metrics
)"""


def routes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    emb = table(spark, sf_dir, "embeddings")
    return vector_route(emb), drifted_route(emb)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, cand = routes(spark, sf_dir)
    return V.compare_pairs(V.first_vectors(base), V.first_vectors(cand))


J5_SQL = "WITH " + ROUTES_CTE + """
SELECT input_id, same_length, identical, round_even(cosine, 9) AS cosine,
       round_even(max_abs_diff, 12) AS max_abs_diff, round_even(l2_distance, 12) AS l2_distance,
       below_cosine_min, above_abs_tolerance
FROM flags"""


@register("j5_pair_metrics", J5_SQL)
def j5_pair_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + J5–J8: id join, cosine, max abs diff, L2, identical, gate flags."""
    p = _pairs(spark, sf_dir)
    return p.select("input_id", "same_length", "identical", F.bround("cosine", 9).alias("cosine"),
                    F.bround("max_abs_diff", 12).alias("max_abs_diff"),
                    F.bround("l2_distance", 12).alias("l2_distance"),
                    "below_cosine_min", "above_abs_tolerance")


J9_SQL = "WITH " + ROUTES_CTE + """
SELECT CAST(count(*) AS BIGINT) AS common,
       CAST(count(*) FILTER (WHERE identical) AS BIGINT) AS identical,
       round_even(min(cosine), 9) AS cosine_min, round_even(avg(cosine), 9) AS cosine_mean,
       round_even(CASE WHEN count(cosine) > 0 THEN max(max_abs_diff) END, 12) AS max_abs_diff,
       round_even(CASE WHEN count(cosine) > 0 THEN max(l2_distance) END, 12) AS max_l2_distance,
       CAST(count(*) FILTER (WHERE below_cosine_min) AS BIGINT) AS below_cosine_min,
       CAST(count(*) FILTER (WHERE above_abs_tolerance) AS BIGINT) AS above_abs_tolerance
FROM flags"""


@register("j9_comparison", J9_SQL)
def j9_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = V.comparison(_pairs(spark, sf_dir))
    return c.select("common", "identical", F.bround("cosine_min", 9).alias("cosine_min"),
                    F.bround("cosine_mean", 9).alias("cosine_mean"),
                    F.bround("max_abs_diff", 12).alias("max_abs_diff"),
                    F.bround("max_l2_distance", 12).alias("max_l2_distance"),
                    "below_cosine_min", "above_abs_tolerance")


J4_SQL = "WITH " + ROUTES_CTE + """
SELECT input_id, 'only_baseline' AS side FROM (SELECT input_id FROM base EXCEPT SELECT input_id FROM cand)
UNION ALL
SELECT input_id, 'only_candidate' FROM (SELECT input_id FROM cand EXCEPT SELECT input_id FROM base)"""


@register("j4_one_sided_ids", J4_SQL)
def j4_one_sided_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, cand = routes(spark, sf_dir)
    return V.one_sided(base, cand)


J2_SQL = "WITH " + ROUTES_CTE + """,
r AS (SELECT 'baseline' AS label, * FROM base UNION ALL SELECT 'candidate', * FROM cand),
f AS (SELECT label, input_id, count(*) AS occ, arg_min(embedding, pos) AS embedding,
             arg_min(model, pos) AS model FROM r GROUP BY ALL)
SELECT label, CAST(count(*) AS BIGINT) AS vectors,
       CAST(coalesce(sum(occ - 1), 0) AS BIGINT) AS duplicate_ids,
       CAST(list_sort(list(DISTINCT len(embedding))) AS INTEGER[]) AS dimensions,
       list_sort(list(DISTINCT model)) AS models,
       CAST(count(*) FILTER (WHERE NOT list_bool_and(list_transform(embedding,
            lambda x: NOT isnan(x) AND NOT isinf(x)))) AS BIGINT) AS nonfinite,
       CAST(count(*) FILTER (WHERE list_sum(list_transform(embedding, lambda x: x * x)) = 0)
            AS BIGINT) AS zero_magnitude,
       count(DISTINCT len(embedding)) = 1 AND min(len(embedding)) = 64 AS dimension_ok
FROM f GROUP BY label"""


@register("j2_route_validation", J2_SQL)
def j2_route_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + J2: first-vector-wins load and the validation facts of each route."""
    base, cand = routes(spark, sf_dir)
    return V.route_summary(base, "baseline", 64).unionByName(
        V.route_summary(cand, "candidate", 64))


J10_SQL = "WITH " + ROUTES_CTE + """
SELECT 'baseline' AS route, regexp_replace(input_id, '-repeat-[^-]*$', '') AS base,
       CAST(count(DISTINCT embedding) AS BIGINT) AS distinct_vectors
FROM base GROUP BY ALL
UNION ALL
SELECT 'candidate', regexp_replace(regexp_replace(input_id, '-b$', ''), '-repeat-[^-]*$', ''),
       CAST(count(DISTINCT embedding) AS BIGINT)
FROM cand GROUP BY ALL"""


@register("j10_distinct_vectors", J10_SQL)
def j10_distinct_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct vectors per source text (id up to the last `-repeat-`)."""
    base, cand = routes(spark, sf_dir)
    return V.distinct_vectors_by_group(base).withColumn("route", F.lit("baseline")).unionByName(
        V.distinct_vectors_by_group(cand).withColumn("route", F.lit("candidate")))


J12_SQL = "WITH " + ROUTES_CTE + """,
s AS (SELECT (SELECT count(*) FROM (SELECT input_id FROM base EXCEPT SELECT input_id FROM cand))
           + (SELECT count(*) FROM (SELECT input_id FROM cand EXCEPT SELECT input_id FROM base)) AS n),
c AS (SELECT count(*) AS common, count(*) FILTER (WHERE below_cosine_min) AS below,
             count(*) FILTER (WHERE above_abs_tolerance) AS above FROM flags)
SELECT 'both' AS label, 6 AS ord, 'input_id sets differ' AS issue, CAST(n AS BIGINT) AS count
FROM s WHERE n > 0
UNION ALL SELECT 'both', 8, 'below cosine min', CAST(below AS BIGINT) FROM c
  WHERE common > 0 AND below > 0
UNION ALL SELECT 'both', 9, 'above max abs diff', CAST(above AS BIGINT) FROM c
  WHERE common > 0 AND above > 0"""


@register("j12_gate_issues", J12_SQL)
def j12_gate_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue rows in fixed order; `passed` is the absence of rows."""
    base, cand = routes(spark, sf_dir)
    comp = V.comparison(V.compare_pairs(V.first_vectors(base), V.first_vectors(cand)))
    return V.gate_issues(V.route_summary(base, "baseline", 64),
                         V.route_summary(cand, "candidate", 64), comp, V.one_sided(base, cand))


J13_SQL = "WITH " + ROUTES_CTE + """
SELECT * FROM (SELECT 'below_cosine_min' AS list, input_id FROM flags WHERE below_cosine_min
               ORDER BY input_id LIMIT 5)
UNION ALL
SELECT * FROM (SELECT 'above_abs_tolerance', input_id FROM flags WHERE above_abs_tolerance
               ORDER BY input_id LIMIT 5)
UNION ALL
SELECT * FROM (SELECT 'only_baseline', input_id FROM
               (SELECT input_id FROM base EXCEPT SELECT input_id FROM cand)
               ORDER BY input_id LIMIT 5)"""


@register("j13_report_samples", J13_SQL)
def j13_report_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded samples (first 5 by id) of each report list — a top-k feature."""
    base, cand = routes(spark, sf_dir)
    p = V.compare_pairs(V.first_vectors(base), V.first_vectors(cand))
    only_b = V.one_sided(base, cand).where(F.col("side") == "only_baseline")
    return (V.samples(p.where("below_cosine_min"), "input_id").withColumn(
        "list", F.lit("below_cosine_min"))
        .unionByName(V.samples(p.where("above_abs_tolerance"), "input_id").withColumn(
            "list", F.lit("above_abs_tolerance")))
        .unionByName(V.samples(only_b, "input_id").withColumn("list", F.lit("only_baseline"))))


J14_SQL = "WITH " + ROUTES_CTE + """,
lb AS (SELECT pos // 16 AS request_id, pos % 16 AS idx, embedding FROM base),
lc AS (SELECT pos // 16 AS request_id, pos % 16 AS idx, embedding FROM cand),
pm AS (
  SELECT lb.request_id,
    list_reduce(list_transform(range(1, len(lb.embedding) + 1),
      lambda i: lb.embedding[i] * lc.embedding[i]), lambda x, y: x + y) AS dot,
    sqrt(list_reduce(list_transform(lb.embedding, lambda x: x * x), lambda x, y: x + y)) AS na,
    sqrt(list_reduce(list_transform(lc.embedding, lambda x: x * x), lambda x, y: x + y)) AS nb,
    list_max(list_transform(range(1, len(lb.embedding) + 1),
      lambda i: abs(lb.embedding[i] - lc.embedding[i]))) AS mad
  FROM lb JOIN lc USING (request_id, idx)
)
SELECT request_id, round_even(min(dot / (na * nb)), 9) AS min_cosine,
       round_even(max(mad), 12) AS max_abs_diff
FROM pm GROUP BY request_id"""


@register("j14_positional_pairs", J14_SQL)
def j14_positional_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors paired by (request, index) of 16-vector responses; per-request gates."""
    base, cand = routes(spark, sf_dir)

    def shape(r):
        return r.select((F.expr("pos div 16")).alias("request_id"), (F.expr("pos % 16")).alias("idx"),
                        "embedding")
    p = V.positional_pairs(shape(base), shape(cand), ["request_id", "idx"])
    return p.groupBy("request_id").agg(F.bround(F.min("cos"), 9).alias("min_cosine"),
                                       F.bround(F.max("mad"), 12).alias("max_abs_diff"))


J16_SQL = """
SELECT label, round_even(max(abs(sqrt(list_reduce(list_transform(CAST(embedding AS DOUBLE[]),
         lambda x: x * x), lambda x, y: x + y)) - 1)), 12) AS max_norm_deviation,
       CAST(count(*) FILTER (WHERE abs(sqrt(list_reduce(list_transform(CAST(embedding AS DOUBLE[]),
         lambda x: x * x), lambda x, y: x + y)) - 1) > 1.2e-7) AS BIGINT) AS outside_tolerance
FROM embeddings GROUP BY label"""


@register("j16_unit_norm", J16_SQL)
def j16_unit_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings").select(
        "label", F.col("embedding").cast("array<double>").alias("embedding"))
    out = V.unit_norm_check(emb, "label")
    return out.select("label", F.bround("max_norm_deviation", 12).alias("max_norm_deviation"),
                      "outside_tolerance")


J17_SQL = "WITH " + ROUTES_CTE + """,
sz AS (SELECT regexp_replace(input_id, '-repeat-[^-]*$', '') AS base, embedding, count(*) AS size
       FROM base GROUP BY ALL)
SELECT base, CAST(count(*) AS BIGINT) AS clusters,
       list_reverse(list_sort(list(CAST(size AS BIGINT)))) AS sizes
FROM sz GROUP BY base"""


@register("j17_vector_clusters", J17_SQL)
def j17_vector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = routes(spark, sf_dir)
    return V.clusters_by_group(base)


FAULTS_CTE = """
r AS (
  SELECT vec_id, vec_id % 5 AS k, ['clean', 'repeated', 'mixed', 'short', 'failed'][vec_id % 5 + 1] AS label,
         CASE WHEN vec_id % 5 = 1 THEN vec_id // 10 ELSE vec_id END AS input_id,
         CASE WHEN vec_id % 5 = 3 OR (vec_id % 5 = 2 AND vec_id % 3 = 0) THEN 32 ELSE len(embedding) END AS dim,
         CASE WHEN vec_id % 5 = 2 AND vec_id % 2 = 0 THEN 'text-embedding-3-large' ELSE 'text-embedding-3-small' END AS model,
         vec_id % 50 <> 3 AS finite, vec_id % 50 = 13 AS zero
  FROM embeddings),
f AS (SELECT label, input_id, count(*) AS n, arg_min(dim, vec_id) AS dim, arg_min(model, vec_id) AS model,
             arg_min(finite, vec_id) AS finite, arg_min(zero, vec_id) AS zero FROM r WHERE k <> 4 GROUP BY ALL),
a AS (SELECT label, count(*) AS vectors, sum(n - 1) AS duplicate_ids, list_sort(list(DISTINCT dim)) AS dimensions,
             list_sort(list(DISTINCT model)) AS models, count(*) FILTER (WHERE NOT finite) AS nonfinite,
             count(*) FILTER (WHERE zero) AS zero_magnitude FROM f GROUP BY label),
e AS (SELECT label, count(*) AS error_records FROM r WHERE k = 4 OR (k = 1 AND vec_id % 20 = 1) GROUP BY label),
facts AS (
  SELECT label, coalesce(vectors, 0) AS vectors, CAST(coalesce(duplicate_ids, 0) AS BIGINT) AS duplicate_ids,
         CAST(coalesce(dimensions, []) AS INTEGER[]) AS dimensions, coalesce(models, []) AS models, coalesce(nonfinite, 0) AS nonfinite,
         coalesce(zero_magnitude, 0) AS zero_magnitude, coalesce(error_records, 0) AS error_records
  FROM a FULL JOIN e USING (label))"""


def _fault_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.route_facts(*faulty_routes(table(spark, sf_dir, "embeddings")))


@register("j2_faulty_routes", "WITH " + FAULTS_CTE + " SELECT * FROM facts")
def j2_faulty_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation facts of five routes: sound, repeated ids, mixed, of an unexpected length, failed."""
    return _fault_facts(spark, sf_dir)


FAULT_ISSUES_SQL = "WITH " + FAULTS_CTE + """,
i AS (
  SELECT label, 0 AS ord, 'no vectors' AS issue, 0 AS count FROM facts WHERE vectors = 0
  UNION ALL SELECT label, 1, 'duplicate input_id', duplicate_ids FROM facts WHERE vectors > 0 AND duplicate_ids > 0
  UNION ALL SELECT label, 2, 'error records', error_records FROM facts WHERE vectors > 0 AND error_records > 0
  UNION ALL SELECT label, 3, 'mixed dimensions', len(dimensions) FROM facts WHERE len(dimensions) > 1
  UNION ALL SELECT label, 4, 'unexpected dimension', dimensions[1] FROM facts WHERE len(dimensions) = 1 AND dimensions[1] <> 64
  UNION ALL SELECT label, 5, 'mixed models', len(models) FROM facts WHERE len(models) > 1
  UNION ALL SELECT label, 6, 'non-finite values', nonfinite FROM facts WHERE nonfinite > 0
  UNION ALL SELECT label, 7, 'zero-magnitude vectors', zero_magnitude FROM facts WHERE zero_magnitude > 0)
SELECT label, ord, issue, CAST(count AS BIGINT) AS count FROM i"""


@register("j12_faulty_routes", FAULT_ISSUES_SQL)
def j12_faulty_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issues of the five routes."""
    return V.route_issues(_fault_facts(spark, sf_dir), 64)
