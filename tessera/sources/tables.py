"""Driver tables and the deterministic adapters that turn them into engine inputs.

Every adapter is a projection (plus, where noted, a join or aggregate) over the
whole table; nothing is sampled or capped, so work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import chunk_words, estimate_tokens, words

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Embedding model per document language used by the adapter.
MODEL_BY_LANG = {
    "en": "text-embedding-3-small",
    "de": "text-embedding-3-large",
    "fr": "text-embedding-3-large",
    "es": "text-embedding-ada-002",
}
DEFAULT_MODEL = "text-embedding-3-small"

# Status code per event type in the request-log adapter.
STATUS_BY_EVENT = {"error": 429, "signup": 503}
RUNS = 8
BACKENDS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def model_for_lang(lang_col) -> F.Column:
    expr = None
    for lang, model in MODEL_BY_LANG.items():
        expr = (F.when(lang_col == lang, model) if expr is None
                else expr.when(lang_col == lang, model))
    return expr.otherwise(DEFAULT_MODEL)


def document_requests(docs: DataFrame) -> DataFrame:
    """One scalar request line per document (S1 shape, typed)."""
    return docs.select(
        F.col("doc_id"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("input_id"),
        F.col("text").alias("input"),
        model_for_lang(F.col("lang")).alias("model"),
        F.lit(None).cast("int").alias("dimensions"),
        F.lit(None).cast("string").alias("encoding_format"),
        F.col("source").alias("user"),
    )


def document_chunks(docs: DataFrame, words_per_chunk: int = 200) -> DataFrame:
    """Documents cut into word windows, one logical input per chunk."""
    # Words are materialised once per document, then sliced into chunks.
    split = docs.select("doc_id", "lang", "source", words(F.col("text")).alias("_w"))
    chunks = split.select(
        "doc_id", "lang", "source",
        F.posexplode(chunk_words(F.col("_w"), words_per_chunk)).alias("chunk_no", "text"))
    return chunks.select(
        "doc_id", "chunk_no",
        F.format_string("doc-%d:chunk-%d", F.col("doc_id"), F.col("chunk_no")).alias("input_id"),
        F.col("text"),
        model_for_lang(F.col("lang")).alias("model"),
        F.lit(None).cast("int").alias("dimensions"),
        F.lit(None).cast("string").alias("encoding_format"),
        F.col("source").alias("user"),
        estimate_tokens(F.col("text")).alias("tokens"),
    )


def request_log(events: DataFrame) -> DataFrame:
    """Request-log records derived from `events` (one row per attempt).

    run = user_id mod 8, backend = user_id mod 3, status by event type,
    start = event time, latency = value (ms), tokens from props.k.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    status = F.when(F.col("event_type") == "error", 429).when(
        F.col("event_type") == "signup", 503).otherwise(200)
    start_us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return events.select(
        (F.col("user_id") % RUNS).alias("run_id"),
        F.col("event_id").alias("sequence"),
        F.col("ts"),
        F.format_string("backend-%d", F.col("user_id") % BACKENDS).alias("backend_id"),
        status.alias("status_code"),
        start_us.alias("start_us"),
        F.col("value").alias("duration_ms"),
        (F.lit(1) + k % 16).alias("input_count"),
        (k * 10 + F.lit(1) + k % 16).alias("estimated_tokens"),
        F.when(status == 200, k * 10).otherwise(0).alias("prompt_tokens"),
        F.when(status == 429, F.col("value") / 10).alias("retry_after"),
        F.when(status == 429, F.when(k % 3 == 0, "Requests to the Embeddings API have exceeded call rate limit")
               .when(k % 3 == 1, "Requests have exceeded token rate limit of your current tier")
               .otherwise("Rate limit is exceeded. Try again later.")).alias("error_message"),
        F.when(status == 429, (k % 4 - 1).cast("string")).alias("remaining_requests"),
        F.when(status == 429, (k % 5 - 1).cast("string")).alias("remaining_tokens"),
    )


# The six rate-limit headers of a response, as log columns.
RATE_LIMIT_HEADERS = ("limit_requests", "remaining_requests", "reset_requests",
                      "limit_tokens", "remaining_tokens", "reset_tokens")

# What the request log does not record, as SQL that Spark and DuckDB read alike. Run 6 has no
# request headers, run 7 no token headers, run 5 no backend ids; runs 0 and 4 name only the pool.
RESPONSE_COLUMNS = {
    "limit_requests": "CASE WHEN run_id = 6 OR sequence % 7 = 0 THEN NULL WHEN sequence % 7 = 1 THEN 'n/a' "
                      "WHEN sequence % 7 = 2 THEN '' ELSE CAST(60 * (1 + run_id % 3) AS STRING) END",
    "remaining_requests": "CASE WHEN run_id = 6 THEN NULL WHEN sequence % 11 = 0 THEN 'unknown' "
                          "ELSE coalesce(remaining_requests, CAST(sequence % 9 AS STRING)) END",
    "reset_requests": "CASE WHEN run_id <> 6 THEN CAST(sequence % 6 AS STRING) || 's' END",
    "limit_tokens": "CASE WHEN run_id <> 7 THEN CAST(15000 * (1 + run_id % 2) AS STRING) END",
    "remaining_tokens": "CASE WHEN run_id <> 7 THEN coalesce(remaining_tokens, CAST(sequence % 13 * 100 AS STRING)) END",
    "reset_tokens": "CASE WHEN run_id <> 7 AND sequence % 5 < 4 THEN CAST(sequence % 4 AS STRING) || 'ms' END",
    "backend_id": "CASE WHEN run_id <> 5 THEN backend_id END",
    "backend_type": "CASE WHEN run_id % 4 = 0 OR (run_id % 4 = 1 AND sequence % 2 = 0) THEN 'Pool' "
                    "WHEN run_id % 4 = 3 THEN 'n/a' ELSE 'Single' END",
    "backend_region": "CASE sequence % 3 WHEN 0 THEN 'eastus' WHEN 1 THEN 'westeurope' END",
    "retry_after_ms": "CASE WHEN status_code = 429 THEN CASE sequence % 4 WHEN 0 THEN CAST(sequence % 5000 AS STRING) "
                      "WHEN 1 THEN 'soon' WHEN 2 THEN '-250' END END",
    "retry_after_s": "CASE WHEN status_code = 429 THEN CASE sequence % 5 WHEN 0 THEN 'later' WHEN 1 THEN '-4' "
                     "ELSE CAST(sequence % 30 AS STRING) END END",
    "error_body": "CASE WHEN status_code <> 200 THEN CASE sequence % 5 "
                  "WHEN 0 THEN '{\"error\": {\"code\": \"' || CAST(status_code AS STRING) || '\", \"message\": \"Rate limit of run ' "
                  "|| CAST(run_id AS STRING) || '\"}}' "
                  "WHEN 1 THEN '{\"code\": \"Busy\", \"message\": \"All backends are busy\"}' "
                  "WHEN 2 THEN repeat('Service unavailable. ', 30) "
                  "WHEN 3 THEN '{\"error\": \"Quota used up\"}' ELSE '{\"error\": {\"message\": \"No code given\"}}' END END",
}


def response_log(events: DataFrame) -> DataFrame:
    """The request log with response headers, backend context, retry headers and error bodies."""
    return request_log(events).withColumns({n: F.expr(e) for n, e in RESPONSE_COLUMNS.items()})


def measurements(log: DataFrame) -> DataFrame:
    """A1 measurement rows: seconds relative to the epoch plus counts."""
    return log.select(
        "run_id", "sequence", "backend_id",
        (F.col("start_us") / 1e6).alias("started_seconds"),
        ((F.col("start_us") / 1e6) + F.col("duration_ms") / 1000).alias("completed_seconds"),
        "input_count", "estimated_tokens", "prompt_tokens", "status_code")


def vector_route(emb: DataFrame) -> DataFrame:
    """Baseline route from `embeddings`: id names the source text via `-repeat-`."""
    return emb.select(
        F.format_string("label-%d-repeat-%d", F.col("label"), F.col("vec_id")).alias("input_id"),
        F.col("vec_id").alias("pos"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.lit("text-embedding-3-small").alias("model"),
    )


def drifted_route(emb: DataFrame) -> DataFrame:
    """Candidate route: every vector re-normalised in double precision; one id in
    50 renamed (so both one-sided lists are exercised); every 10th drifted by 1e-4
    on its first component."""
    base = vector_route(emb)
    norm = F.sqrt(F.aggregate(F.col("embedding"), F.lit(0.0), lambda acc, x: acc + x * x))
    vid = F.col("pos")
    renorm = F.transform(F.col("embedding"), lambda x: x / norm)
    drift = F.transform(renorm, lambda x, i: F.when((i == 0) & (vid % 10 == 0), x + 1e-4)
                        .otherwise(x))
    return base.select(
        F.when(vid % 50 == 49, F.concat(F.col("input_id"), F.lit("-b"))).otherwise(
            F.col("input_id")).alias("input_id"),
        "pos", drift.alias("embedding"), "model")


def cohort_base(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Cohort rows: customers joined 1:1 with their order aggregate (T1 input)."""
    agg = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("o_totalprice").alias("order_total"),
        F.avg("o_totalprice").alias("order_mean"),
        F.max("o_totalprice").alias("order_max"),
    )
    return customer.join(agg, customer.c_custkey == agg.o_custkey, "inner").drop("o_custkey")


TRACE_SPANS = 64            # events per trace in the span adapter
ROOT_MINUTES = 240


def event_spans(events: DataFrame) -> DataFrame:
    """Spans from `events`: 64 consecutive events are a trace, its first event the root. In
    every fourth trace each span is the child of the one before it (a chain), in the others
    a tree of three children per span. A span lasts `value` minutes, a root four hours, so
    siblings overlap and some reach beyond their root."""
    trace, i = F.floor(F.col("event_id") / TRACE_SPANS), F.col("event_id") % TRACE_SPANS
    parent = trace * TRACE_SPANS + F.when(trace % 4 == 0, i - 1).otherwise(F.floor((i - 1) / 3))
    start = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") * 1000
    minutes = F.when(i == 0, F.lit(float(ROOT_MINUTES))).otherwise(F.col("value"))
    return events.select(
        trace.alias("trace_id"), F.col("event_id").alias("span_id"), F.when(i > 0, parent).alias("parent_span_id"),
        F.col("event_type").alias("name"), start.alias("start_time_unix_nano"),
        (start + F.floor(minutes * 60_000) * 1_000_000).alias("end_time_unix_nano"))


WORDS_PER_DELTA = 8


def response_events(conversations: DataFrame) -> DataFrame:
    """Response events from assistant turns (W2): text in deltas of eight words, then an end.

    By the length of the text: a third call a tool first, a fifth of those without its
    done event; every 11th fails; every 13th loses an event and so never ends. Every fourth
    event comes twice. Columns: response_id, seq, event_type, item_id, data, copy.
    """
    turns = conversations.where((F.col("role") == "assistant") & F.col("text").isNotNull()).select(
        F.concat_ws(":", "conv_id", "turn").alias("response_id"), F.length("text").cast("long").alias("n"),
        F.split("text", " ", -1).alias("w"))
    none = F.lit(None).cast("string")

    def event(kind, item, data):
        return F.struct(F.lit(kind).alias("event_type"), item.alias("item_id"), data.alias("data"))

    item = F.concat(F.lit("call-"), F.col("n").cast("string"))
    empty = F.array().cast("array<struct<event_type:string,item_id:string,data:string>>")
    call = F.array(event("response.tool_call.started", item, F.when(F.col("n") % 2 == 0, "search").otherwise("lookup")),
                   event("response.tool_call.arguments.delta", item, F.lit('{"size":')),
                   event("response.tool_call.arguments.delta", item, F.concat(F.col("n").cast("string"), F.lit("}"))))
    done = F.array(event("response.tool_call.done", item, none))
    last = F.floor((F.size("w") - 1) / WORDS_PER_DELTA)
    deltas = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: event(
        "response.output_text.delta", none, F.concat(
            F.array_join(F.slice("w", (i * WORDS_PER_DELTA + 1).cast("int"), WORDS_PER_DELTA), " "),
            F.when(i < last, " ").otherwise(""))))
    failed = F.col("n") % 11 == 0
    end = F.array(F.struct(F.when(failed, "response.failed").otherwise("response.completed").alias("event_type"),
                           none.alias("item_id"), F.when(failed, "rate limited").alias("data")))
    events = F.concat(F.when(F.col("n") % 3 == 0, call).otherwise(empty),
                      F.when((F.col("n") % 3 == 0) & (F.col("n") % 5 != 0), done).otherwise(empty), deltas, end)
    rows = turns.select("response_id", "n", F.posexplode(events).alias("seq", "e"))
    rows = rows.where(~((F.col("n") % 13 == 0) & (F.col("seq") == 1)))
    twice = F.when((F.col("seq") + F.col("n")) % 4 == 0, 1).otherwise(0)
    return rows.select("response_id", F.col("seq").cast("long").alias("seq"), "e.*",
                       F.explode(F.sequence(F.lit(0), twice)).alias("copy"))


def recorded_messages(conversations: DataFrame) -> DataFrame:
    """Messages as runs record them, by conversation mod 6: texts (0), parts (1), parts where every
    other user turn has no text (2), only `messages` (3), only `conversation` (4), users in `messages`
    and every other answer empty (5)."""
    shape, role, odd = F.col("conv_id") % 6, F.col("role"), F.col("turn") % 2 == 1
    text = F.coalesce("text", F.lit(""))
    section = (F.when(shape == 3, "messages").when(shape == 4, "conversation")
               .when(role == "assistant", "response").when((shape == 5) & (role == "user"), "messages").otherwise("query"))
    said = F.when((shape == 5) & (role == "assistant") & odd, F.lit("")).otherwise(text)
    image = F.lit('{"type":"image"}')
    # to_json of a struct quotes the text; the surrounding object is cut off again.
    quoted = F.expr("substring(to_json(struct(_said AS t)), 6, length(to_json(struct(_said AS t))) - 6)")
    part = F.concat(F.lit('[{"type":"image"},{"type":"text","text":'), quoted, F.lit("}]"))
    rows = conversations.withColumn("_said", said)
    content = (F.when((shape == 2) & (role == "user") & odd, F.concat(F.lit("["), image, F.lit("]")))
               .when(shape.isin(1, 2) & (role != "system"), part).otherwise(quoted))
    return rows.select("conv_id", section.alias("section"), F.col("turn").cast("long").alias("pos"), "role", content.alias("content"))


WORDS_PER_LINE = 16


def stream_lines(conversations: DataFrame) -> DataFrame:
    """Event-stream lines (conv_id, turn, part, i, line): assistant turns are delta events of some
    words a line, with a broken and a blank line, then a completed event; other turns are run steps.
    Two streams in three report their run twice, end with [DONE], and say more after it; the others break off inside a delta."""
    def data(value):
        return F.concat(F.lit("data: "), F.to_json(value))

    def delta(text):
        return data(F.struct(F.struct(F.array(F.struct(
            F.lit("text").alias("type"), F.struct(text.alias("value")).alias("text"))).alias("content")).alias("delta")))

    def line(part, i, text):
        return F.struct(F.lit(part).alias("part"), i.cast("int").alias("i"), text.alias("line"))
    zero = F.lit(0)
    words = F.split(F.coalesce("text", F.lit("")), " ", -1)
    starts = F.sequence(F.lit(0), F.size(words) - 1, F.lit(WORDS_PER_LINE))
    deltas = F.transform(starts, lambda i: line(1, i, delta(F.concat(
        F.array_join(F.slice(words, i + 1, WORDS_PER_LINE), " "), F.when(i + WORDS_PER_LINE < F.size(words), " ").otherwise("")))))
    mid = F.concat_ws("-", F.lit("msg"), "conv_id", "turn")
    answer = F.concat(F.array(line(0, zero, F.lit("event: thread.message.delta"))), deltas, F.array(
        line(2, zero, F.lit('data: {"broken')), line(3, zero, F.lit("  ")), line(4, zero, F.lit("event: thread.message.completed")),
        line(5, zero, data(F.struct(mid.alias("id"))))))
    step = F.array(line(0, zero, F.lit("event: thread.run.step")), line(1, zero, F.lit('data: {"id": "step"}')))
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.explode(
        F.when(F.col("role") == "assistant", answer).otherwise(step)).alias("l"))
    run = F.concat_ws("-", F.lit("run"), "conv_id")
    ended = F.array(line(0, zero, F.lit("event: thread.run.completed")), line(1, zero, data(F.struct(run.alias("id")))),
                    line(2, zero, data(F.struct(run.alias("id")))), line(3, zero, F.lit("data: [DONE]")),
                    line(4, zero, F.lit("event: thread.message.delta")), line(5, zero, delta(F.lit("after the end"))))
    broken = F.array(line(0, zero, F.lit("event: thread.message.delta")), line(1, zero, delta(F.lit("cut of"))))
    last = conversations.groupBy("conv_id").agg((F.max("turn") + 1).cast("long").alias("turn")).select(
        "conv_id", "turn", F.explode(F.when(F.col("conv_id") % 3 == 0, broken).otherwise(ended)).alias("l"))
    return turns.unionByName(last).select("conv_id", "turn", "l.*")


def faulty_routes(emb: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Five routes from `embeddings` by vec_id mod 5, and their failed records: sound, ids given twice,
    mixed lengths and models, one unexpected length with NaN and zero vectors, and nothing but failures."""
    k, v = F.col("vec_id") % 5, F.col("embedding").cast("array<double>")
    names = F.array(*[F.lit(n) for n in ("clean", "repeated", "mixed", "short", "failed")])
    label = F.element_at(names, (k + 1).cast("int")).alias("label")
    cut = F.when((k == 3) | ((k == 2) & (F.col("vec_id") % 3 == 0)), F.slice(v, 1, 32)).otherwise(v)
    broken = F.when(F.col("vec_id") % 50 == 3, F.transform(cut, lambda x: F.lit(float("nan")))).when(
        F.col("vec_id") % 50 == 13, F.transform(cut, lambda x: F.lit(0.0))).otherwise(cut)
    routes = emb.where(k != 4).select(
        label, F.when(k == 1, F.floor(F.col("vec_id") / 10)).otherwise(F.col("vec_id")).alias("input_id"),
        F.col("vec_id").alias("pos"), broken.alias("embedding"),
        F.when((k == 2) & (F.col("vec_id") % 2 == 0), "text-embedding-3-large").otherwise("text-embedding-3-small").alias("model"))
    return routes, emb.where((k == 4) | ((k == 1) & (F.col("vec_id") % 20 == 1))).select(label)


IMAGE_NAMES = 40


def illustrated(documents: DataFrame) -> DataFrame:
    """Documents with image references put around their text: by file name in a path, with a query,
    unknown, in data, on the web, and as an HTML element."""
    name = F.concat(F.lit("fig-"), (F.col("doc_id") % (2 * IMAGE_NAMES)).cast("string"), F.lit(".png"))
    return documents.select("doc_id", F.concat(
        F.lit("![chart](sandbox:/mnt/data/"), name, F.lit(") "), F.col("text"), F.lit(" [see]("), name,
        F.lit("?size=2) ![](none.png) ![d](data:image/png;base64,AA) [w](https://example.org/"), name,
        F.lit(')<IMG src="a.png">')).alias("text"))


def image_files(parts: DataFrame) -> DataFrame:
    """Image files (name, uri) from `part`: forty names, several files each."""
    number = (F.col("p_partkey") % IMAGE_NAMES).cast("string")
    return parts.select(F.concat(F.lit("fig-"), number, F.lit(".png")).alias("name"),
                        F.concat(F.lit("data:image/png;base64,"), F.md5(F.col("p_partkey").cast("string"))).alias("uri"))
