"""Shared SQL fragments for the DuckDB oracles (mirror the adapters)."""

MODEL_CASE = ("CASE lang WHEN 'en' THEN 'text-embedding-3-small' "
              "WHEN 'de' THEN 'text-embedding-3-large' "
              "WHEN 'fr' THEN 'text-embedding-3-large' "
              "WHEN 'es' THEN 'text-embedding-ada-002' ELSE 'text-embedding-3-small' END")


def chunks_cte(words_per_chunk: int = 200) -> str:
    w = words_per_chunk
    return f"""
doc_words AS (
  SELECT doc_id, source, lang,
         string_split_regex(regexp_replace(text, '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g'),
                            '[ \\t\\n\\r]+') AS w
  FROM documents
),
doc_chunk_idx AS (
  SELECT doc_id, source, lang, w,
         unnest(range(0, CAST(greatest(ceil(len(w) / {w}), 1) AS BIGINT))) AS chunk_no
  FROM doc_words
),
chunks AS (
  SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no,
         'doc-' || doc_id || ':chunk-' || chunk_no AS input_id,
         array_to_string(w[chunk_no * {w} + 1 : (chunk_no + 1) * {w}], ' ') AS text,
         {MODEL_CASE} AS model, source AS "user"
  FROM doc_chunk_idx
),
chunk_tokens AS (
  SELECT *, CAST(ceil(length(text) / 4) AS BIGINT) AS tokens FROM chunks
)"""


REQUEST_LOG_CTE = """
request_log AS (
  SELECT user_id % 8 AS run_id, event_id AS sequence,
         'backend-' || (user_id % 3) AS backend_id,
         CASE event_type WHEN 'error' THEN 429 WHEN 'signup' THEN 503 ELSE 200 END AS status_code,
         epoch_us(ts) AS start_us, value AS duration_ms,
         1 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 16 AS input_count,
         CAST(json_extract_string(props, '$.k') AS INTEGER) * 10 + 1
           + CAST(json_extract_string(props, '$.k') AS INTEGER) % 16 AS estimated_tokens,
         CASE WHEN event_type IN ('error', 'signup') THEN 0
              ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) * 10 END AS prompt_tokens,
         CASE WHEN event_type = 'error' THEN value / 10 END AS retry_after,
         CASE WHEN event_type = 'error' THEN
           CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 3
             WHEN 0 THEN 'Requests to the Embeddings API have exceeded call rate limit'
             WHEN 1 THEN 'Requests have exceeded token rate limit of your current tier'
             ELSE 'Rate limit is exceeded. Try again later.' END END AS error_message,
         CASE WHEN event_type = 'error' THEN
           CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 - 1 AS VARCHAR) END
           AS remaining_requests,
         CASE WHEN event_type = 'error' THEN
           CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 - 1 AS VARCHAR) END
           AS remaining_tokens
  FROM events
)"""
