"""Recorded transcripts and event-stream lines on small cases with known answers."""

import json

from pyspark.sql import functions as F

from tessera.operators.transcripts import part_text, transcript_messages, transcript_rows
from tessera.streaming.lines import completed_ids, line_messages, parse_lines


def msg(role, content):
    return {"role": role, "content": content}


def parts(*texts):
    return [{"type": "image", "url": "u"}, *[{"type": "text", "text": t} for t in texts]]


RUNS = {
    1: ({"query": [msg("system", "be brief"), msg("user", "a"), msg("system", "be kind"), msg("user", "b")],
         "response": [msg("assistant", "x"), msg("assistant", ""), msg("user", "z")]}, ("b", "x", "be brief | be kind")),
    2: ({"query": [msg("user", parts("p", "q")), msg("user", [{"type": "image"}])],
         "response": [msg("assistant", parts("one")), msg("assistant", parts("", "two")), msg("assistant", [])]}, ("p", "one", "")),
    3: ({"query": [msg("user", "a")], "response": "plain"}, ("a", "plain", "")),
    4: ({"messages": [msg("system", "s"), msg("user", "u1"), msg("assistant", parts("a1")), msg("user", "u2"), msg("assistant", "a2")],
         "conversation": [msg("user", "other")]}, ("u1", "a1", "")),
    5: ({"conversation": [{"role": "user", "message": "m"}, msg("assistant", "a1"), msg("assistant", "a2"), msg("user", "u")]},
        ("m", "a2", "")),
    6: ({"query": [msg("user", "")], "messages": [msg("user", "late")], "response": []}, ("late", "", "")),
    7: ({"query": [], "messages": [msg("system", "only")], "conversation": [msg("user", "not used")]}, ("", "", "")),
}


def test_transcript_rows_and_fallbacks(spark):
    df = spark.createDataFrame([(i, json.dumps(b)) for i, (b, _) in RUNS.items()] + [(8, "no json"), (9, None)], "conv_id long, body string")
    got = {r["conv_id"]: r for r in transcript_rows(transcript_messages(df, "body")).collect()}
    assert {i: (r["query"], r["response"], r["context"]) for i, r in got.items()} == {i: want for i, (_, want) in RUNS.items()}
    assert (got[3]["response_length"], got[3]["latency"]) == (5, 8.5)
    assert transcript_rows(transcript_messages(df.limit(0), "body")).count() == 0


def test_part_text(spark):
    cases = ['"a"', json.dumps(parts("b", "c")), '[{"type":"text"}]', "[]", '{"type":"text","text":"d"}', "7", None, "{"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    got = {r["i"]: r["t"] for r in df.select("i", part_text(F.col("c")).alias("t")).collect()}
    assert got == {0: "a", 1: "b", 2: "", 3: None, 4: None, 5: None, 6: None, 7: None}


def delta(*texts):
    return "data: " + json.dumps({"delta": {"content": [{"type": "image"}, *[{"type": "text", "text": {"value": t}} for t in texts]]}})


STREAM = ["data: {\"id\": \"no event yet\"}", "event: thread.message.delta", delta("He", "l"), "", "  ", "data: {broken", "data: [1]",
          "noise", delta("lo"), "event: thread.message.completed", 'data: {"id": "m1"}', "event: thread.message.delta", delta(""),
          "event:thread.message.delta ", delta("two"), "event: thread.run.completed", 'data: {"id": "r1"}', 'data: {"id": "r1"}',
          "data: {}", "data: [DONE]", "event: thread.message.delta", delta("late"), "data: [DONE]"]


def lines_of(spark, streams):
    return spark.createDataFrame([(s, i, x) for s, ls in streams.items() for i, x in enumerate(ls)], "sid long, n int, line string")


def test_messages_and_ids_from_lines(spark):
    ev = parse_lines(lines_of(spark, {1: STREAM, 2: STREAM[:15], 3: ["", "noise"], 4: ["data: [DONE]", *STREAM], None: STREAM[1:3]}), "sid", ["n"])
    got = {(r["sid"], r["event_no"]): (r["text"], r["n_deltas"], r["closed"]) for r in line_messages(ev, "sid", ["n"]).collect()}
    assert got == {(1, 1): ("Hello", 2, True), (1, 4): ("two", 1, True), (2, 1): ("Hello", 2, True), (2, 4): ("two", 1, False),
                   (None, 1): ("Hel", 1, False)}
    ids = {(r["sid"], r["kind"], r["id"]): r["reports"] for r in completed_ids(ev, "sid").collect()}
    assert ids == {(1, "message", "m1"): 1, (1, "run", "r1"): 2, (2, "message", "m1"): 1}


def test_a_long_stream_keeps_its_order_over_many_partitions(spark):
    n = 3000
    rows = spark.range(n).select(F.lit(5).cast("long").alias("sid"), (F.col("id") + 1).cast("int").alias("n"), F.concat(
        F.lit('data: {"delta":{"content":[{"type":"text","text":{"value":"'), F.col("id").cast("string"),
        F.lit(' "}}]}}')).alias("line"))
    head = spark.createDataFrame([(5, 0, "event: thread.message.delta"), (5, n + 1, "data: [DONE]")], "sid long, n int, line string")
    ev = parse_lines(rows.unionByName(head).repartition(7), "sid", ["n"])
    got = line_messages(ev, "sid", ["n"]).collect()
    assert [(r["text"], r["n_deltas"], r["closed"]) for r in got] == [("".join(f"{i} " for i in range(n)), n, True)]
