"""Evaluation queries (V*) over `conversations`, `benchmark`, `labels`, `documents`, `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import evals as E
from tessera.operators.transcripts import transcript_rows
from tessera.plans.registry import register
from tessera.sources.tables import recorded_messages, table


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


EVAL_ROWS_CTE = """
er AS (
  SELECT conv_id,
    coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS query,
    coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant' AND length(text) > 0), '')
      AS response,
    coalesce(string_agg(text, ' | ' ORDER BY turn) FILTER (WHERE role = 'system'), '') AS context,
    CAST(8.5 AS DOUBLE) AS latency
  FROM conversations GROUP BY conv_id
),
rows AS (
  SELECT er.*, CAST(length(response) AS INTEGER) AS response_length, b.text AS ground_truth
  FROM er LEFT JOIN benchmark b ON b.item_id = er.conv_id % (SELECT count(*) FROM benchmark)
)"""


def eval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 rows with ground truth: benchmark item `conv_id mod |benchmark|`."""
    conv = table(spark, sf_dir, "conversations")
    bench = table(spark, sf_dir, "benchmark")
    n = bench.count()  # one scalar: the benchmark size
    rows = E.eval_rows(conv)
    gt = bench.select(F.col("item_id").alias("_item"), F.col("text").alias("ground_truth"))
    return rows.join(F.broadcast(gt) if n <= 1_000_000 else gt,
                     (rows.conv_id % F.lit(max(n, 1))) == gt._item, "left").drop("_item")


@register("v1_eval_rows", "WITH " + EVAL_ROWS_CTE + "\nSELECT * FROM rows")
def v1_eval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript → evaluation row per conversation."""
    return eval_rows(spark, sf_dir)


V2_SQL = """
SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text
FROM conversations WHERE role = 'assistant' GROUP BY conv_id"""


@register("v2_last_assistant", V2_SQL)
def v2_last_assistant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.last_message(table(spark, sf_dir, "conversations"), "assistant")


def _norm_sql(x: str) -> str:
    t = f"regexp_replace(lower(coalesce({x}, '')), {_lit(E.PUNCT)}, '', 'g')"
    t = f"regexp_replace({t}, '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g')"
    return f"list_filter(string_split_regex({t}, {_lit(E.WS)}), lambda w: length(w) > 0 AND w NOT IN ('a', 'an', 'the'))"


V3_SQL = "WITH " + EVAL_ROWS_CTE + f""",
nt AS (SELECT conv_id, {_norm_sql('response')} AS p, {_norm_sql('ground_truth')} AS t FROM rows),
cp AS (SELECT conv_id, token, count(*) AS cp FROM (SELECT conv_id, unnest(p) AS token FROM nt)
       GROUP BY ALL),
ct AS (SELECT conv_id, token, count(*) AS ct FROM (SELECT conv_id, unnest(t) AS token FROM nt)
       GROUP BY ALL),
cm AS (SELECT conv_id, sum(least(cp, ct)) AS common FROM cp JOIN ct USING (conv_id, token)
       GROUP BY conv_id),
j AS (SELECT nt.conv_id, CAST(coalesce(common, 0) AS BIGINT) AS common,
             CAST(len(p) AS INTEGER) AS pred_len, CAST(len(t) AS INTEGER) AS truth_len
      FROM nt LEFT JOIN cm USING (conv_id))
SELECT conv_id, common, pred_len, truth_len,
       round_even(CASE WHEN common = 0 THEN 0.0
            ELSE 2 * (common / pred_len) * (common / truth_len)
                 / ((common / pred_len) + (common / truth_len)) END, 9) AS f1_score,
       CASE WHEN common = 0 THEN 0.0
            ELSE 2 * (common / pred_len) * (common / truth_len)
                 / ((common / pred_len) + (common / truth_len)) END >= {E.F1_THRESHOLD} AS f1_pass
FROM j"""


@register("v3_token_f1", V3_SQL)
def v3_token_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token F1 of each response against its ground truth (threshold 0.2)."""
    f1 = E.token_f1(eval_rows(spark, sf_dir), "conv_id", "response", "ground_truth")
    return f1.withColumn("f1_score", F.bround("f1_score", 9))


def _tok(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), {_lit(E.WORD)})"


V4_SQL = "WITH " + EVAL_ROWS_CTE + f""",
base AS (SELECT conv_id, {_tok('response')} AS h, {_tok('ground_truth')} AS r
         FROM rows),
ns AS (SELECT unnest([1, 2, 3, 4]) AS n),
hg AS (SELECT conv_id, n, g, count(*) AS ch FROM (
         SELECT conv_id, n, unnest(list_transform(range(1, len(h) - n + 2),
                  lambda i: array_to_string(h[i:i + n - 1], ' '))) AS g FROM base, ns)
       GROUP BY ALL),
rg AS (SELECT conv_id, n, g, count(*) AS cr FROM (
         SELECT conv_id, n, unnest(list_transform(range(1, len(r) - n + 2),
                  lambda i: array_to_string(r[i:i + n - 1], ' '))) AS g FROM base, ns)
       GROUP BY ALL),
m AS (SELECT conv_id, n, sum(least(ch, cr)) AS m FROM hg JOIN rg USING (conv_id, n, g)
      GROUP BY ALL),
j AS (
  SELECT b.conv_id, len(b.h) AS hyp_len, len(b.r) AS ref_len,
    coalesce(sum(m) FILTER (WHERE n = 1), 0) AS m1, coalesce(sum(m) FILTER (WHERE n = 2), 0) AS m2,
    coalesce(sum(m) FILTER (WHERE n = 3), 0) AS m3, coalesce(sum(m) FILTER (WHERE n = 4), 0) AS m4
  FROM base b LEFT JOIN m USING (conv_id) GROUP BY b.conv_id, b.h, b.r
),
s AS (
  SELECT conv_id, CAST(hyp_len AS INTEGER) AS hyp_len, CAST(ref_len AS INTEGER) AS ref_len,
    CASE WHEN hyp_len < 4 THEN 0.0 ELSE
      (CASE WHEN hyp_len > ref_len THEN 1.0 ELSE exp(1 - ref_len / hyp_len) END)
      * exp((ln(CASE WHEN m1 > 0 THEN m1 / (hyp_len - 0) ELSE 0.1 / (hyp_len - 0) END)
           + ln(CASE WHEN m2 > 0 THEN m2 / (hyp_len - 1) ELSE 0.1 / (hyp_len - 1) END)
           + ln(CASE WHEN m3 > 0 THEN m3 / (hyp_len - 2) ELSE 0.1 / (hyp_len - 2) END)
           + ln(CASE WHEN m4 > 0 THEN m4 / (hyp_len - 3) ELSE 0.1 / (hyp_len - 3) END)) / 4)
    END AS bleu_score
  FROM j
)
SELECT conv_id, hyp_len, ref_len, round_even(bleu_score, 9) AS bleu_score,
       bleu_score >= {E.BLEU_THRESHOLD} AS bleu_pass
FROM s"""


@register("v4_bleu", V4_SQL)
def v4_bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence BLEU of each response against its ground truth (threshold 0.01)."""
    b = E.bleu(eval_rows(spark, sf_dir), "conv_id", "response", "ground_truth")
    return b.withColumn("bleu_score", F.bround("bleu_score", 9))


V5_SQL = "WITH " + EVAL_ROWS_CTE + f""",
base AS (SELECT conv_id, {_tok('response')} AS h, {_tok('ground_truth')} AS r
         FROM rows),
ht AS (SELECT conv_id, i - 1 AS h_pos, h[i] AS token
       FROM (SELECT conv_id, h, unnest(range(1, len(h) + 1)) AS i FROM base)),
rt AS (SELECT conv_id, i - 1 AS r_pos, r[i] AS token
       FROM (SELECT conv_id, r, unnest(range(1, len(r) + 1)) AS i FROM base)),
hn AS (SELECT *, row_number() OVER (PARTITION BY conv_id, token ORDER BY h_pos) AS nth FROM ht),
rn AS (SELECT *, row_number() OVER (PARTITION BY conv_id, token ORDER BY r_pos) AS nth FROM rt),
al AS (SELECT conv_id, h_pos, r_pos FROM hn JOIN rn USING (conv_id, token, nth)),
lg AS (SELECT *, lag(h_pos) OVER (PARTITION BY conv_id ORDER BY h_pos) AS ph,
              lag(r_pos) OVER (PARTITION BY conv_id ORDER BY h_pos) AS pr FROM al),
ag AS (SELECT conv_id, count(*) AS matches,
              count(*) FILTER (WHERE NOT coalesce(ph = h_pos - 1 AND pr = r_pos - 1, false)) AS chunks
       FROM lg GROUP BY conv_id),
j AS (SELECT b.conv_id, CAST(coalesce(matches, 0) AS BIGINT) AS matches,
             CAST(coalesce(chunks, 0) AS BIGINT) AS chunks,
             CAST(len(h) AS INTEGER) AS hyp_len, CAST(len(r) AS INTEGER) AS ref_len
      FROM base b LEFT JOIN ag USING (conv_id)),
s AS (SELECT *, CASE WHEN matches = 0 THEN 0.0 ELSE
        ((matches / hyp_len) * (matches / ref_len)
          / (0.9 * (matches / hyp_len) + {1 - 0.9!r} * (matches / ref_len)))
        * (1 - 0.5 * pow(chunks / matches, 3.0)) END AS meteor_score FROM j)
SELECT conv_id, matches, chunks, hyp_len, ref_len, round_even(meteor_score, 9) AS meteor_score,
       meteor_score >= {E.METEOR_THRESHOLD} AS meteor_pass
FROM s"""


@register("v5_meteor", V5_SQL)
def v5_meteor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """METEOR exact-match stage of each response against its ground truth (threshold 0.4)."""
    m = E.meteor(eval_rows(spark, sf_dir), "conv_id", "response", "ground_truth")
    return m.withColumn("meteor_score", F.bround("meteor_score", 9))


V6_SQL = """
WITH r AS (
  SELECT doc_id, 'quality' AS name, CASE WHEN quality = 1 THEN 'pass' ELSE 'fail' END AS label,
         CAST(quality AS DOUBLE) AS score FROM labels
  UNION ALL
  SELECT doc_id, 'toxic', CASE WHEN toxic = 0 THEN 'pass' ELSE 'fail' END, CAST(toxic AS DOUBLE)
  FROM labels
)
SELECT name, CAST(count(*) FILTER (WHERE label = 'pass') AS BIGINT) AS passed,
       CAST(count(*) FILTER (WHERE label = 'fail') AS BIGINT) AS failed,
       CAST(count(*) FILTER (WHERE label IS NULL OR label NOT IN ('pass', 'fail')) AS BIGINT)
         AS errored,
       CAST(count(*) AS BIGINT) AS total, round_even(avg(score), 9) AS mean_score
FROM r GROUP BY name"""


@register("v6_result_counts", V6_SQL)
def v6_result_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass/fail/errored counts and mean score per criterion (labels as results)."""
    lab = table(spark, sf_dir, "labels")
    results = lab.select("doc_id", F.explode(F.array(
        F.struct(F.lit("quality").alias("name"),
                 F.when(F.col("quality") == 1, "pass").otherwise("fail").alias("label"),
                 F.col("quality").cast("double").alias("score")),
        F.struct(F.lit("toxic").alias("name"),
                 F.when(F.col("toxic") == 0, "pass").otherwise("fail").alias("label"),
                 F.col("toxic").cast("double").alias("score")))).alias("r")).select(
        "doc_id", "r.*")
    return E.result_counts(results).withColumn("mean_score", F.bround("mean_score", 9))


MAPPING = {"query": "{{item.query}}", "response": "{{item.response}}",
           "context": "${data.context}", "ground_truth": "{{item.ground_truth}}"}


@register("v7_field_mapping", "WITH " + EVAL_ROWS_CTE +
          "\nSELECT query, response, context, ground_truth FROM rows")
def v7_field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluator input built from a `{{item.x}}` / `${data.x}` field mapping."""
    return E.apply_mapping(eval_rows(spark, sf_dir), MAPPING)


V8_SQL = """
WITH s AS (
  SELECT event_id, epoch_us(ts) // 3600000000 AS hour_bucket FROM events
  WHERE CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 30
)
SELECT event_id, hour_bucket FROM (
  SELECT *, row_number() OVER (PARTITION BY hour_bucket ORDER BY event_id) AS rn FROM s
) WHERE rn <= 3"""


@register("v8_eval_sampling", V8_SQL)
def v8_eval_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30 % deterministic sample of events, at most 3 per hour (a sampling operator)."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) "
                           "div 3600000000").alias("hour_bucket"))
    return E.sample_for_eval(ev, "event_id", 30, 3, "hour_bucket").select("event_id", "hour_bucket")


V14_SQL = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, i - 1 AS line_no, ls[i] AS line
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)),
w AS (SELECT doc_id, line_no,
             string_split_regex(regexp_replace(line, '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g'),
                                '[ \\t\\n\\r]+') AS ws FROM x)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
       ws[list_position(list_transform(ws, lambda s: length(s)),
                        list_max(list_transform(ws, lambda s: length(s))))] AS longest_word
FROM w"""


@register("v14_longest_words", V14_SQL)
def v14_longest_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest word of every line of every document (first wins ties)."""
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("doc_id", "line_no", E.longest_words(F.col("line")).alias("longest_word"))


TRANSCRIPT_SQL = """
WITH m AS (
  SELECT conv_id, turn, role,
         CASE WHEN conv_id % 6 = 3 THEN 'messages' WHEN conv_id % 6 = 4 THEN 'conversation' WHEN role = 'assistant' THEN 'response'
              WHEN conv_id % 6 = 5 AND role = 'user' THEN 'messages' ELSE 'query' END AS section,
         CASE WHEN conv_id % 6 = 2 AND role = 'user' AND turn % 2 = 1 THEN NULL
              WHEN conv_id % 6 = 5 AND role = 'assistant' AND turn % 2 = 1 THEN '' ELSE coalesce(text, '') END AS text
  FROM conversations),
a AS (
  SELECT conv_id, arg_max(text, turn) FILTER (WHERE section = 'query' AND role = 'user' AND text IS NOT NULL) AS q,
         arg_max(text, turn) FILTER (WHERE section = 'response' AND text <> '') AS r, bool_or(section = 'messages') AS has,
         arg_min(text, turn) FILTER (WHERE section = 'messages' AND role = 'user') AS mq,
         arg_min(text, turn) FILTER (WHERE section = 'messages' AND role = 'assistant') AS mr,
         arg_min(text, turn) FILTER (WHERE section = 'conversation') AS cq,
         arg_max(text, turn) FILTER (WHERE section = 'conversation' AND role = 'assistant') AS cr,
         string_agg(text, ' | ' ORDER BY turn) FILTER (WHERE section = 'query' AND role = 'system') AS context
  FROM m GROUP BY conv_id),
c AS (SELECT conv_id, coalesce(CASE WHEN q <> '' THEN q WHEN has THEN mq ELSE cq END, '') AS query,
             coalesce(CASE WHEN r <> '' THEN r WHEN has THEN mr ELSE cr END, '') AS response, coalesce(context, '') AS context FROM a)
SELECT *, CAST(8.5 AS DOUBLE) AS latency, CAST(length(response) AS INTEGER) AS response_length FROM c"""


@register("v1_recorded_transcripts", TRANSCRIPT_SQL)
def v1_recorded_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation rows from recorded messages: part lists, and the fallbacks of query and response."""
    return transcript_rows(recorded_messages(table(spark, sf_dir, "conversations")))
