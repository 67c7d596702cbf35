"""Transcripts as they are recorded (V1): messages whose content is a text or a list of typed
parts, filed under one of several sections, folded into one evaluation row a conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.evals import DEFAULT_LATENCY

# Where a recorded run keeps its messages.
SECTIONS = ("query", "response", "messages", "conversation")


def part_text(content: Column) -> Column:
    """Text of a message content (JSON): of a list, its first part of type text (empty if that part
    has none); of a string, the string itself. Null where there is no text."""
    v = F.try_parse_json(content)
    parts = F.try_variant_get(v, "$", "array<variant>")
    texts = F.filter(parts, lambda p: F.try_variant_get(p, "$.type", "string") == "text")
    first = F.coalesce(F.try_variant_get(F.get(texts, F.lit(0)), "$.text", "string"), F.lit(""))
    return F.when(parts.isNotNull(), F.when(F.size(texts) > 0, first)).when(
        F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def transcript_messages(runs: DataFrame, body: str, key: str = "conv_id") -> DataFrame:
    """Messages of recorded runs (one JSON object a row): key, section, pos, role, content (JSON).
    A section that is a string is one message without a role; bodies that are no JSON give none."""
    v = F.try_parse_json(F.col(body))

    def listed(s):
        one = F.array(F.when(F.schema_of_variant(F.try_variant_get(v, f"$.{s}", "variant")) == "STRING",
                             F.try_variant_get(v, f"$.{s}", "variant")))
        items = F.coalesce(F.try_variant_get(v, f"$.{s}", "array<variant>"), F.filter(one, lambda x: x.isNotNull()))

        def row(m, i):
            plain = F.schema_of_variant(m) == "STRING"
            given = F.coalesce(F.try_variant_get(m, "$.content", "variant"), F.try_variant_get(m, "$.message", "variant"))
            return F.struct(F.lit(s).alias("section"), i.cast("long").alias("pos"), F.when(
                ~plain, F.try_variant_get(m, "$.role", "string")).alias("role"),
                F.to_json(F.when(plain, m).otherwise(given)).alias("content"))
        return F.transform(items, row)
    return runs.select(key, F.explode(F.flatten(F.array(*[listed(s) for s in SECTIONS]))).alias("m")).select(key, "m.*")


def transcript_rows(messages: DataFrame, key: str = "conv_id", latency: float = DEFAULT_LATENCY) -> DataFrame:
    """V1 with its fallbacks. Context: the system texts of the query section, joined by ` | `.
    Query: the last user text of the query section, else the first user message of `messages`, else,
    where there is no `messages`, the first of `conversation`. Response: the last assistant text of
    the response section that is not empty (a section that is a string: that), else the first assistant
    message of `messages`, else the last of `conversation`. Nothing found: empty texts."""
    m = messages.withColumn("text", part_text(F.col("content")))
    sec, role, text, pos = F.col("section"), F.col("role"), F.col("text"), F.col("pos")

    def at(where):
        return F.when(where, pos)
    said = (role == "assistant") | role.isNull()
    out = m.groupBy(key).agg(
        F.max_by(text, at((sec == "query") & (role == "user") & text.isNotNull())).alias("_q"),
        F.max_by(text, at((sec == "response") & said & (F.length(text) > 0))).alias("_r"),
        F.bool_or(sec == "messages").alias("_has"),
        F.min_by(text, at((sec == "messages") & (role == "user"))).alias("_mq"),
        F.min_by(text, at((sec == "messages") & (role == "assistant"))).alias("_mr"),
        F.min_by(text, at(sec == "conversation")).alias("_cq"),
        F.max_by(text, at((sec == "conversation") & (role == "assistant"))).alias("_cr"),
        F.array_sort(F.collect_list(F.when((sec == "query") & (role == "system") & text.isNotNull(),
                                           F.struct(pos.alias("p"), text.alias("x"))))).alias("_s"))

    def choose(own, first, other):
        return F.coalesce(F.when(F.length(own) > 0, F.col(own)).when(F.col("_has"), F.col(first)).otherwise(F.col(other)), F.lit(""))
    response = choose("_r", "_mr", "_cr")
    return out.select(key, choose("_q", "_mq", "_cq").alias("query"), response.alias("response"),
                      F.array_join("_s.x", " | ").alias("context"), F.lit(latency).cast("double").alias("latency"),
                      F.length(response).alias("response_length"))
