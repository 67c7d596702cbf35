"""Event-stream lines (W1): `event:` and `data:` lines into events, messages and completed ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordered import join_small, running_sum_within
from tessera.streaming.folds import COMPLETED, DELTA, DONE

# Line prefixes, and the event that ends a run.
EVENT_LINE, DATA_LINE = "event:", "data:"
RUN_COMPLETED = "thread.run.completed"


def parse_lines(lines: DataFrame, stream: str, order: Sequence[str], line: str = "line") -> DataFrame:
    """Events and their data: stream, the order columns, event_no, event_type, data (JSON object as text;
    null on an `event:` line), last_event, done.

    A data line belongs to the latest event line above it (event_no 0 and no type: none yet). Blank
    lines, lines of other kinds and data that is no JSON object are skipped; so is all from a stream's
    first `[DONE]` on. `done`: the stream has one. `last_event`: the highest event_no before it. The
    running count is a distributed scan, so one stream may hold a third of all lines.
    """
    order = list(order)
    text = F.trim(F.regexp_replace(F.col(line), "[\\t\\r\\n]+", " "))
    body = lines.select(stream, *order, text.alias("_t")).select(
        stream, *order,
        F.when(F.col("_t").startswith(EVENT_LINE), F.trim(F.substr("_t", F.lit(len(EVENT_LINE) + 1)))).alias("_event"),
        F.when(F.col("_t").startswith(DATA_LINE), F.trim(F.substr("_t", F.lit(len(DATA_LINE) + 1)))).alias("_data"))
    is_object = F.schema_of_variant(F.try_parse_json(F.col("_data"))).startswith("OBJECT")
    kept = body.where(F.col("_event").isNotNull() | (F.col("_data") == DONE) | is_object)
    counted = running_sum_within(kept.withColumn("_one", F.col("_event").isNotNull().cast("long")), [stream], order, "_one", "event_no")
    here = F.struct(*order)
    end = counted.groupBy(stream).agg(
        F.min(F.when(F.col("_data") == DONE, here)).alias("_end"))
    cut = join_small(counted, end, [stream], "left").where(F.col("_end").isNull() | (here < F.col("_end")))
    types = cut.where(F.col("_event").isNotNull()).select(stream, "event_no", F.col("_event").alias("event_type"))
    last = types.groupBy(stream).agg(F.max("event_no").alias("last_event"))
    out = join_small(join_small(cut, types, [stream, "event_no"], "left"), last, [stream], "left")
    return out.select(stream, *order, "event_no", "event_type", F.col("_data").alias("data"),
                      F.coalesce("last_event", F.lit(0)).alias("last_event"), F.col("_end").isNotNull().alias("done"))


def line_messages(events: DataFrame, stream: str, order: Sequence[str]) -> DataFrame:
    """The text of every delta event, its text parts joined in order; empty ones are left out.
    `closed`: another event or `[DONE]` came after it, so the text is whole."""
    content = F.try_variant_get(F.try_parse_json(F.col("data")), "$.delta.content", "array<variant>")
    texts = F.transform(F.filter(content, lambda p: F.try_variant_get(p, "$.type", "string") == "text"),
                        lambda p: F.coalesce(F.try_variant_get(p, "$.text.value", "string"), F.lit("")))
    d = events.where((F.col("event_type") == DELTA) & F.col("data").isNotNull()).withColumn(
        "_x", F.array_join(texts, "")).where(F.col("_x") != "")
    out = d.groupBy(stream, "event_no").agg(
        F.array_sort(F.collect_list(F.struct(*order, "_x"))).alias("_p"), F.count(F.lit(1)).alias("n_deltas"),
        (F.first("done") | (F.col("event_no") < F.first("last_event"))).alias("closed"))
    return out.select(stream, "event_no", F.array_join("_p._x", "").alias("text"), "n_deltas", "closed")


def completed_ids(events: DataFrame, stream: str) -> DataFrame:
    """Ids of completed runs and messages, each once a stream, with how often it was reported."""
    kind = F.when(F.col("event_type") == RUN_COMPLETED, "run").when(F.col("event_type") == COMPLETED, "message")
    ids = events.select(stream, kind.alias("kind"), F.try_variant_get(F.try_parse_json(F.col("data")), "$.id", "string").alias("id"))
    return ids.where(F.col("kind").isNotNull() & (F.length("id") > 0)).groupBy(stream, "kind", "id").agg(
        F.count(F.lit(1)).alias("reports"))
