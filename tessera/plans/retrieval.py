"""Corpus, search and routing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import retrieval as R
from tessera.plans.registry import register
from tessera.plans.sqlparts import chunks_cte
from tessera.sources.tables import document_chunks, table

TOP_K_VECTORS = 5
TOP_K_DOCS = 10

C8_SQL = "WITH " + chunks_cte(200) + """
SELECT doc_id, CAST(count(*) AS BIGINT) AS chunks, CAST(sum(tokens) AS BIGINT) AS tokens,
       min(input_id) FILTER (WHERE chunk_no = 0) AS first_chunk_id
FROM chunk_tokens GROUP BY doc_id"""


@register("c8_document_chunks", C8_SQL)
def c8_document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents cut into 200-word chunks with ids `doc-N:chunk-M`."""
    ch = document_chunks(table(spark, sf_dir, "documents"), 200)
    return ch.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum("tokens").cast("long").alias("tokens"),
        F.min(F.when(F.col("chunk_no") == 0, F.col("input_id"))).alias("first_chunk_id"))


def label_centroids(emb: DataFrame) -> DataFrame:
    """Query vectors: the mean embedding of each label (one row per label)."""
    cells = emb.select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias(
        "i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    return cells.groupBy("label").agg(
        F.sort_array(F.collect_list(F.struct("i", "x"))).alias("_c")).select(
        F.col("label").cast("long").alias("query_id"), F.col("_c.x").alias("embedding"))


R1_SQL = f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
c AS (SELECT label, i, avg(v[i]) AS x
      FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY label, i),
q AS (SELECT CAST(label AS BIGINT) AS query_id, list(x ORDER BY i) AS qv FROM c GROUP BY label),
s AS (
  SELECT q.query_id, e.vec_id,
    list_reduce(list_transform(range(1, len(e.v) + 1), lambda i: e.v[i] * q.qv[i]),
                lambda a, b: a + b)
    / (sqrt(list_reduce(list_transform(e.v, lambda x: x * x), lambda a, b: a + b))
       * sqrt(list_reduce(list_transform(q.qv, lambda x: x * x), lambda a, b: a + b))) AS score
  FROM q, e
)
SELECT query_id, vec_id, round_even(score, 9) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= {TOP_K_VECTORS}"""


@register("r1_vector_search", R1_SQL)
def r1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact cosine top-5 of all embeddings for each label-centroid query."""
    emb = table(spark, sf_dir, "embeddings")
    top = R.vector_top_k(emb, label_centroids(emb), TOP_K_VECTORS, "vec_id")
    return top.select("query_id", "vec_id", F.bround("score", 9).alias("score"),
                      F.col("rank").cast("int").alias("rank"))


R2_SQL = f"""
WITH toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term
              FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY ALL),
dl AS (SELECT doc_id, count(*) AS dl FROM toks GROUP BY doc_id),
st AS (SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM dl),
dft AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
idf AS (SELECT term, ln((n_docs - df + 0.5) / (df + 0.5) + 1) AS idf, avgdl FROM dft, st),
qt AS (SELECT item_id AS query_id, term, count(*) AS qtf FROM (
         SELECT item_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term
         FROM benchmark) GROUP BY ALL),
part AS (SELECT tf.doc_id, tf.term,
                idf * tf * {R.BM25_K1 + 1} / (tf + {R.BM25_K1} * ({1 - R.BM25_B} + {R.BM25_B} * dl / avgdl)) AS w
         FROM tf JOIN dl USING (doc_id) JOIN idf USING (term)),
sc AS (SELECT query_id, doc_id, round_even(sum(w * qtf), 9) AS score
       FROM qt JOIN part USING (term) GROUP BY ALL)
SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc
) WHERE rank <= {TOP_K_DOCS}"""


@register("r2_keyword_search", R2_SQL)
def r2_keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 top-10 documents for every benchmark passage used as a query."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    qs = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    top = R.bm25_top_k(docs, qs, TOP_K_DOCS)
    return top.select("query_id", "doc_id", "score", F.col("rank").cast("int").alias("rank"))


R3_SQL = """
SELECT doc_id, lang, n_chars, (SELECT count(*) FROM documents) AS total_count
FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10"""


@register("r3_top_documents", R3_SQL)
def r3_top_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 longest documents with a column subset and the total count (a top-N feature)."""
    docs = table(spark, sf_dir, "documents")
    return R.top_n(docs, [F.col("n_chars").desc(), F.col("doc_id")], ["doc_id", "lang", "n_chars"])


def _routes_sql() -> str:
    cases = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in R.ROUTES)
    return f"""
SELECT CASE {cases} ELSE '{R.DEFAULT_ROUTE}' END AS route, CAST(count(*) AS BIGINT) AS questions
FROM conversations WHERE role = 'user' GROUP BY ALL"""


@register("r4_question_routing", _routes_sql())
def r4_question_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly one tool route per user question, by ordered keyword rules."""
    conv = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return conv.groupBy(R.route_question(F.col("text")).alias("route")).agg(
        F.count(F.lit(1)).alias("questions"))
