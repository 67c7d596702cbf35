import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import cohort as T
from tessera.operators import evals as E
from tessera.streaming import folds


def test_guideline_lookup(spark):
    pats = spark.createDataFrame(
        [(1, "Stage_IIIA", 75, "Yes", "No", "No"), (2, "Stage_I", 45, "No", "No", "Yes")],
        "PATIENT_ID int, CANCER_STAGE string, AGE int, SMOKING string, CHRONIC_DISEASE string, "
        "ANXIETY string")
    secs = spark.createDataFrame([("Stage IIIA treatment", "chemoradiation"),
                                  ("Stage I surgery", "lobectomy"),
                                  ("Smoking cessation", "all smokers"),
                                  ("Anxiety support", "counselling"),
                                  ("Older patients", "age over 70: reduced doses")],
                                 "title string, body string")
    got = {(r["PATIENT_ID"], r["reason"], r["title"]) for r in T.guideline_lookup(pats, secs).collect()}
    assert (1, "stage", "Stage IIIA treatment") in got
    assert (2, "stage", "Stage IIIA treatment") not in got
    assert (1, "smoking", "Smoking cessation") in got
    assert (1, "age_over_70", "Older patients") in got
    assert (2, "anxiety", "Anxiety support") in got
    assert (2, "age_under_50", "Older patients") not in got


def test_response_event_fold(spark):
    ev = spark.createDataFrame([
        ("r1", 1, folds.TEXT_DELTA, None, "Hel"), ("r1", 2, folds.TEXT_DELTA, None, "lo"),
        ("r1", 2, folds.TEXT_DELTA, None, "lo"),
        ("r1", 3, folds.TOOL_STARTED, "c1", "search"), ("r1", 4, folds.TOOL_ARGS_DELTA, "c1", '{"q":'),
        ("r1", 5, folds.TOOL_ARGS_DELTA, "c1", '"x"}'), ("r1", 6, folds.TOOL_DONE, "c1", None),
        ("r1", 7, folds.TOOL_STARTED, "c2", "fetch"),
        ("r2", 1, folds.FAILED, None, "rate limited")],
        "response_id string, seq long, event_type string, item_id string, data string")
    out = folds.fold_response_events(ev)
    assert out["text"].collect()[0]["text"] == "Hello"
    calls = {r["item_id"]: (r["name"], r["arguments"], r["status"]) for r in out["tool_calls"].collect()}
    assert calls == {"c1": ("search", '{"q":"x"}', "done"), "c2": ("fetch", "", "pending")}
    assert out["errors"].collect()[0]["error"] == "rate limited"


def test_red_team_tools_and_lookups(spark):
    df = spark.createDataFrame([("abc",)], "t string")
    got = {r["strategy"]: r["prompt"] for r in E.attack_prompts(df, "t").collect()}
    assert got == {"baseline": "abc", "reversal": "cba", "base64": E.b64("abc")}
    res = spark.createDataFrame([("base64", "violence", True), ("base64", "violence", False),
                                 ("reversal", "violence", False)],
                                "strategy string, criterion string, attack_success boolean")
    asr = {(r["strategy"], r["criterion"]): r["attack_success_rate"]
           for r in E.attack_success_rate(res).collect()}
    assert asr[("base64", "violence")] == 0.5 and asr[(None, None)] == 1 / 3
    calls = spark.createDataFrame([("c1", "fetch_weather"), ("c2", "unknown_fn"), ("c3", "opening_hours")],
                                  "call_id string, function string")
    outs = spark.createDataFrame([("c1", "sunny")], "call_id string, output string")
    st = {r["call_id"]: r["status"] for r in E.pair_tool_calls(
        calls, outs, ["fetch_weather", "opening_hours"]).collect()}
    assert st == {"c1": "done", "c2": "error", "c3": "pending"}
    loc = spark.createDataFrame([("paris",), ("nowhere",)], "city string")
    lk = spark.createDataFrame([("paris", "sunny")], "city string, weather string")
    w = {r["city"]: r["weather"] for r in E.lookup_with_default(loc, lk, "city", "weather",
                                                                "not available").collect()}
    assert w == {"paris": "sunny", "nowhere": "not available"}


def test_freshness_specs():
    from tessera.operators.retrieval import freshness_window
    now = dt.datetime(2024, 5, 10, 12, 0)
    assert freshness_window("Week", now) == (dt.datetime(2024, 5, 3, 12, 0), now)
    lo, hi = freshness_window("2024-01-01..2024-01-31")
    assert lo == dt.datetime(2024, 1, 1) and hi.day == 31 and hi.hour == 23


SPANS = ("trace_id string, span_id string, parent_span_id string, name string, "
         "start_time_unix_nano long, end_time_unix_nano long")


def test_span_tree(spark):
    from tessera.operators import runlog
    spans = spark.createDataFrame([
        ("t", "root", None, "run", 0, 10_000_000),
        ("t", "a", "root", "request", 0, 4_000_000),
        ("t", "b", "root", "request", 4_000_000, 9_000_000),
        ("t", "c", "a", "http", 0, 1_000_000)], SPANS)
    r = runlog.span_tree(spans).collect()
    assert len(r) == 1 and r[0]["root_span_id"] == "root" and r[0]["descendants"] == 3 and r[0]["max_depth"] == 2
    assert r[0]["coverage"] == 0.9 and r[0]["child_ms"] == 10.0


def test_span_coverage_counts_overlaps_once(spark):
    """Parallel, nested and overhanging children; an unknown parent; a cycle; a deep chain."""
    from tessera.operators import runlog
    ms = 1_000_000
    rows = [("t", "r", None, "run", 0, 10 * ms), ("t", "p1", "r", "x", 1 * ms, 6 * ms), ("t", "p2", "r", "x", 1 * ms, 6 * ms),
            ("t", "in", "p1", "x", 2 * ms, 3 * ms), ("t", "over", "r", "x", 9 * ms, 50 * ms), ("t", "late", "r", "x", 60 * ms, 70 * ms),
            ("u", "orphan", "gone", "run", 0, 4 * ms), ("u", "kid", "orphan", "x", 0, 1 * ms),
            ("c", "a", "b", "x", 0, ms), ("c", "b", "a", "x", 0, ms), ("z", "alone", None, "run", 0, ms)]
    rows += [("d", f"s{i}", f"s{i - 1}" if i else None, "x", 0, (200 - i) * ms) for i in range(100)]
    df = spark.createDataFrame(rows, SPANS)
    got = {(r["trace_id"], r["root_span_id"]): (r["descendants"], r["max_depth"], r["covered_ms"], r["coverage"]) for r in runlog.span_tree(df).collect()}
    assert got == {("t", "r"): (5, 2, 6.0, 0.6), ("u", "orphan"): (1, 1, 1.0, 0.25), ("d", "s0"): (99, 99, 199.0, 199 / 200)}
    roots = {(r["trace_id"], r["span_id"]): (r["root_span_id"], r["depth"]) for r in runlog.span_roots(df).collect()}
    assert roots["c", "a"] == (None, None) and roots["d", "s70"] == ("s0", 70) and roots["z", "alone"] == ("alone", 0)
    links = {(r["trace_id"], r["span_id"]): r["parent_name"] for r in runlog.span_links(df).collect()}
    assert links["t", "in"] == "x" and links["u", "orphan"] is None and len(links) == len(rows)


def test_first_request_over_ceiling(spark):
    from tessera.operators import prepare
    df = spark.createDataFrame([(i, 10) for i in range(100)], "pos long, input_count long")
    got = prepare.first_over_ceiling(df, ["pos"], 255).collect()
    assert [(r["pos"], r["running_inputs"]) for r in got] == [(25, 260)]
    assert prepare.first_over_ceiling(df, ["pos"], 5000).count() == 0


def test_completeness_counts_chunks_over_the_token_ceiling(spark, tmp_path):
    from tessera.plans.requests import MAX_TOKENS, e6_completeness
    from tessera.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    rows = [(1, "one two three", "en", "a"), (2, "x" * (4 * MAX_TOKENS + 1), "en", "a"), (3, "four", "de", "b")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert tuple(e6_completeness(spark, str(tmp_path)).first()) == (3, 2, 1, 0, 0)
