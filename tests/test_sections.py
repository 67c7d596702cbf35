"""Exact routing, markdown sections and text citations."""

from pyspark.sql import functions as F

from tessera.operators import governance, pacing


def test_routing_by_tokens(spark):
    """20,000 equal backends, a few unequal ones, weightless ones; no cap and no rounding."""
    requests = spark.range(40_000)
    many = spark.range(20_000).select(F.col("id").alias("backend_id"), F.lit(7).alias("target_tpm"))
    got = pacing.route_by_tokens(requests, many, "id")
    assert got.count() == 40_000
    assert got.where(F.floor(F.col("token") / 7) != F.col("backend_id")).count() == 0
    few = spark.createDataFrame([("a", 1), ("b", 0), ("c", None), ("d", 599), ("e", 400), ("f", -3)], "backend_id string, target_tpm long")
    for bins in (None, 1, 50):
        share = {r["backend_id"]: r["count"] / 40_000 for r in pacing.route_by_tokens(requests, few, "id", bins=bins).groupBy("backend_id").count().collect()}
        assert set(share) <= {"a", "d", "e"} and abs(share["d"] - 0.599) < 0.01 and abs(share["e"] - 0.4) < 0.01
    assert pacing.route_by_tokens(requests, few.limit(0), "id").count() == 0


def test_sections_of_markdown(spark):
    text = "lead\n# A\none\n### C ##\ntwo\n```\n# code\n```\n## B\n#tag\n# D\n####### seven"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "# only")], "doc_id long, text string")
    got = {(r["doc_id"], r["section_no"]): (r["level"], r["title"], r["path"], r["body"]) for r in governance.markdown_sections(df).collect()}
    assert got == {(1, 0): (0, "", [], "lead"), (1, 1): (1, "A", ["A"], "one"), (1, 2): (3, "C", ["A", "C"], "two\n```\n# code\n```"),
                   (1, 3): (2, "B", ["A", "B"], "#tag"), (1, 4): (1, "D", ["D"], "####### seven"), (3, 0): (0, "", [], ""),
                   (4, 1): (1, "only", ["only"], "")}


def test_citations_with_spans(spark):
    text = "é one 【3:1†a.md】 two [T](https://x.y/z)\nthree 【4:0†b.md】【4:1†a.md】 [no](ftp://q)"
    df = spark.createDataFrame([(1, text), (2, "none"), (3, None)], "doc_id long, text string")
    files = spark.createDataFrame([("a.md", "f-1"), ("a.md", "f-1")], "title string, file_id string")
    got = [r for r in governance.text_citations(df, files).orderBy("pos").collect()]
    assert [(r["kind"], r["title"], r["target"], r["quote"]) for r in got] == [
        ("file", "a.md", "f-1", "é one"), ("url", "T", "https://x.y/z", "two"), ("file", "b.md", None, "three"), ("file", "a.md", "f-1", "")]
    assert all(text[r["start_index"]:r["end_index"]] == r["marker"] for r in got)
    assert got[1]["formatted"] == f" [two T](https://x.y/z) ({got[1]['start_index']}-{got[1]['end_index']})"
    assert governance.text_citations(df).where("kind = 'file' AND target IS NOT NULL").count() == 0
