"""Route issues, replaced images, policy cells and distributions on small cases with known answers."""

import pytest

from tessera.operators import cohort, governance, vectors
from tessera.plans.cohort import t10_status_by_priority
from tessera.plans.governance import c6_replaced_images, g6_policy_grid
from tessera.plans.vectors import j12_faulty_routes

NAN = float("nan")


def test_route_facts_and_issues(spark):
    routes = spark.createDataFrame(
        [("ok", "a", 0, [1.0, 0.0], "m"), ("ok", "b", 1, [0.0, 1.0], "m"),
         ("twice", "a", 5, [NAN], "n"), ("twice", "a", 2, [1.0, 1.0], "m"), ("twice", "a", 9, None, "m"),
         ("mixed", "a", 0, [1.0], "m"), ("mixed", "b", 1, [1.0, NAN], "n"), ("mixed", "c", 2, [0.0, 0.0], "m"),
         ("odd", "a", 0, [1.0, 2.0, 3.0], None)], "label string, input_id string, pos long, embedding array<double>, model string")
    errors = spark.createDataFrame([("twice",), ("none",), ("none",)], "label string")
    facts = vectors.route_facts(routes, errors)
    got = {r["label"]: r for r in facts.collect()}
    assert got["twice"]["duplicate_ids"] == 1 and got["twice"]["dimensions"] == [2] and got["twice"]["models"] == ["m"]
    assert (got["none"]["vectors"], got["none"]["dimensions"], got["none"]["error_records"]) == (0, [], 2)
    issues = sorted((r["label"], r["ord"], r["issue"], r["count"]) for r in vectors.route_issues(facts, 2).collect())
    assert issues == [("mixed", 3, "mixed dimensions", 2), ("mixed", 5, "mixed models", 2), ("mixed", 6, "non-finite values", 1),
                      ("mixed", 7, "zero-magnitude vectors", 1), ("none", 0, "no vectors", 0), ("odd", 4, "unexpected dimension", 3),
                      ("twice", 1, "duplicate input_id", 1), ("twice", 2, "error records", 1)]
    assert vectors.route_issues(vectors.route_facts(routes)).where("issue = 'unexpected dimension'").count() == 0


def test_no_vector_is_shuffled(spark):
    routes = spark.createDataFrame([("a", "x", 0, [1.0], "m")], "label string, input_id string, pos long, embedding array<double>, model string")
    plan = vectors.route_facts(routes)._jdf.queryExecution().executedPlan().toString()
    cut = [line for line in plan.splitlines() if "Exchange" in line or "partial_min_by" in line]
    assert cut and not any("embedding" in line for line in cut)


def test_replaced_images(spark):
    texts = spark.createDataFrame(
        [(1, "a ![one](box:/mnt/p.png) b [two](p.png?x=1) c"), (2, "![gone](q.png)<img src='p.png'> [in](data:p.png) [web](http://h/p.png)"),
         (3, "no image (p.png)"), (4, None), (5, ""), (6, "![](p.png)![x](r.png/p.png)"), (7, "[not p](xp.png)"), (8, "$1 \\ ![a$1\\](p.png)")],
        "id long, text string")
    images = spark.createDataFrame([("p.png", "data:P"), ("p.png", "data:Q"), ("r.png", "data:$R"), (None, "data:N")], "name string, uri string")
    got = {r["id"]: r["text"] for r in governance.replace_broken_images(texts, images, "id").collect()}
    assert got == {1: "a \n\n![one](data:P) b \n\n![two](data:P) c", 2: " [in](data:p.png) [web](http://h/p.png)",
                   3: "no image (p.png)", 4: None, 5: "", 6: "\n\n![](data:P)\n\n![x](data:$R)", 7: "", 8: "$1 \\ \n\n![a$1\\](data:P)"}
    assert governance.replace_broken_images(texts, images.limit(0), "id").where("text LIKE '%data:P%'").count() == 0


def test_policy_cells(spark):
    scores = spark.createDataFrame([("hate", "prompt", "low"), ("hate", "prompt", "Medium"), ("hate", "completion", "high"),
                                    ("sexual", "prompt", "high"), ("hate", "prompt", None), ("hate", "prompt", "odd")],
                                   "category string, source string, severity string")
    got = governance.apply_policy_cells(scores, {("hate", "prompt"): "Medium", ("sexual", "prompt"): "high"})
    assert {(r[0], r[1], r[2]): r[3] for r in got.collect()} == {
        ("hate", "prompt", "low"): False, ("hate", "prompt", "Medium"): True, ("hate", "completion", "high"): False,
        ("sexual", "prompt", "high"): True, ("hate", "prompt", None): False, ("hate", "prompt", "odd"): False}


def test_distributions(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 5, "y"), ("a", None, None), (None, 7, "x"), ("c", None, "x")],
                               "g string, v int, k string")
    got = {r["g"]: r for r in cohort.group_distribution(df, ["g"], "v", (50, 90)).collect()}
    a = got["a"]
    assert (a["rows"], a["known"], a["least"], a["greatest"], a["p50"]) == (4, 3, 1.0, 5.0, 2.0)
    assert a["mean"] == pytest.approx(8 / 3) and a["p90"] == pytest.approx(4.4)
    assert (got[None]["p50"], got["c"]["p50"], got["c"]["known"]) == (7.0, None, 0)
    n = {(r["g"], r["k"]): (r["rows"], r["share"]) for r in cohort.category_counts(df, "g", "k").collect()}
    assert n == {("a", "x"): (2, 0.5), ("a", "y"): (1, 0.25), ("a", None): (1, 0.25), (None, "x"): (1, 1.0), ("c", "x"): (1, 1.0)}


def test_cases_occur_in_the_tables(spark, sf_small):
    assert {r["ord"] for r in j12_faulty_routes(spark, sf_small).collect()} == set(range(8))
    assert {r["blocked"] for r in g6_policy_grid(spark, sf_small).collect()} == {True, False}
    assert g6_policy_grid(spark, sf_small).select("category", "source").distinct().count() == 8
    texts = c6_replaced_images(spark, sf_small)
    assert texts.where("contains(text, '![chart](data:')").count() > 0 < texts.where("NOT contains(text, 'chart')").count()
    assert t10_status_by_priority(spark, sf_small).count() > 5
