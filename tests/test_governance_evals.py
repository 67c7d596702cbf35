import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import evals as E
from tessera.operators import governance as G


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expr(F.col("v"))).first()[0]


def test_masks(spark):
    assert one(spark, "7f3e1a20-5b6c-4d7e-8f90-a1b2c3d4e5f6", G.mask_guid) == "7f3e…e5f6"
    assert one(spark, "tiny1", G.mask_guid) == "…" * 5
    assert one(spark, "", G.mask_guid) == ""
    assert one(spark, "172.18.4.9", G.mask_ip) == "172.x.x.x"
    assert one(spark, "host.local", G.mask_ip) == "host.local"
    assert one(spark, "client-172-18-4-9-28", G.mask_ip_in_name) == "client-172-x-x-x-28"
    assert (one(spark, "/subscriptions/7f3e1a20-5b6c-4d7e-8f90-a1b2c3d4e5f6/resourceGroups/blue/",
                G.mask_arm_id) == "/subscriptions/7f3e…e5f6/resourceGroups/blue/")
    assert (one(spark, "https://files.example.org/box?se=2031&sig=q1w2e3",
                G.mask_sas_token) == "https://files.example.org/box?se=2031&sig=…REDACTED…")


def test_redact_text_order(spark):
    text = ("plan /subscriptions/7f3e1a20-5b6c-4d7e-8f90-a1b2c3d4e5f6/y key "
            "c0ffee00-1357-4246-9bdf-02468ace1357 from client-172-18-4-9-28 at 192.0.2.77 "
            "link ?k=9&sig=HUSH")
    df = spark.createDataFrame([(text,)], "t string")
    red, hits = G.redact(F.col("t"))
    r = df.select(red.alias("r"), *[c.alias(n) for n, c in hits.items()]).first()
    assert r["r"] == ("plan /subscriptions/7f3e…e5f6/y key c0ff…1357 from client-172-x-x-x-28 "
                      "at 192.x.x.x link ?k=9&sig=…REDACTED…")
    assert (r["arm_subscription"], r["guid"], r["ipv4_dashed"], r["ipv4"], r["sas_signature"]) == \
        (1, 1, 1, 1, 1)


def test_blocklist(spark):
    df = spark.createDataFrame([("We moved from AWS Lambda to Google Cloud Platform",), ("clean",)],
                               "t string")
    got = [r[0] for r in df.select(G.blocklist_matches(F.col("t"))).collect()]
    assert got[0] == ["aws", "google", "google-cloud", "lambda-aws"]
    assert got[1] == []
    lit = df.select(G.blocklist_matches(F.col("t"), [("moved", "MOVED", False)])).first()[0]
    assert lit == ["moved"]


def test_images_and_markers(spark):
    s = "a ![x](img.png) b ![y](data:image/png;base64,AA) c <IMG src='data:x'> d [z](gone.html)."
    assert one(spark, s, G.strip_broken_images) == "a  b ![y](data:image/png;base64,AA) c  d ."
    assert one(spark, "see 【53:6†source】 and 【1:2†doc】", G.inline_markers) == \
        ["【53:6†source】", "【1:2†doc】"]


def test_paragraphs_without_end_tags(spark):
    page = "<div><p>one<p class='x'>two</p>tail<P>three<ul><li>four</li></ul></div>"
    assert one(spark, page, G.paragraphs) == ["one", "two", "three"]
    assert one(spark, "<pre>no</pre>", G.paragraphs) == [""] and one(spark, None, G.paragraphs) == [""]


def test_eval_rows_from_transcript(spark):
    rows = [(1, 0, "system", "ctx A"), (1, 1, "user", "q1"), (1, 2, "assistant", "r1"),
            (1, 3, "system", "ctx B"), (1, 4, "user", "q2"), (1, 5, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = E.eval_rows(df).collect()[0]
    assert (r["query"], r["response"], r["context"], r["latency"], r["response_length"]) == \
        ("q2", "r1", "ctx A | ctx B", 8.5, 2)


def test_text_scores(spark):
    df = spark.createDataFrame([(1, "The cat sat on the mat", "the cat sat on the mat"),
                                (2, "a b c d e", "x y z w v")], "id long, h string, r string")
    f1 = {r["id"]: r["f1_score"] for r in E.token_f1(df, "id", "h", "r").collect()}
    assert f1 == {1: 1.0, 2: 0.0}
    bl = {r["id"]: r["bleu_score"] for r in E.bleu(df, "id", "h", "r").collect()}
    smoothed = math.exp(sum(math.log(0.1 / (5 - k)) for k in range(4)) / 4)
    assert bl[1] == pytest.approx(1.0) and bl[2] == pytest.approx(smoothed)
    me = {r["id"]: r for r in E.meteor(df, "id", "h", "r").collect()}
    assert me[1]["chunks"] == 1 and me[1]["meteor_score"] == pytest.approx(
        1.0 * (1 - 0.5 * (1 / 6) ** 3))
    assert me[2]["meteor_score"] == 0.0


def test_review_routing_and_temperature(spark):
    df = spark.createDataFrame([('{"score": 75, "feedback": "x"}',), ('{"score": 90}',), ("oops",)],
                               "t string")
    assert [r["decision"] for r in E.review_routing(df, "t").collect()] == \
        ["edit", "approve", "approve"]
    assert one(spark, "-5.5°C", E.convert_temperature) == "131.0°F"
    assert one(spark, "-5.5°C", lambda c: E.convert_temperature(c, signed=True)) == "22.1°F"
    assert one(spark, "77°F", E.convert_temperature) == "25.0°C"


def test_record_jobs(spark):
    assert one(spark, "aa bbb cc ddd", E.longest_words) == "bbb"
    assert one(spark, "", E.longest_words) == ""
    m = spark.createDataFrame([({"a": 1, "b": 2}, {"b": 5, "c": 3})],
                              "l map<string,int>, r map<string,int>")
    r = m.select(E.sum_map_values(F.col("l")).alias("s"),
                 E.merge_maps(F.col("l"), F.col("r")).alias("m")).first()
    assert r["s"] == 3 and r["m"] == {"a": 1, "b": 5, "c": 3}


def test_field_mapping(spark):
    df = spark.createDataFrame([("q", "r")], "query string, response string")
    out = E.apply_mapping(df, {"question": "{{item.query}}", "answer": "${data.response}"})
    assert out.columns == ["question", "answer"]
    with pytest.raises(ValueError):
        E.apply_mapping(df, {"x": "{{item.missing}}"})
