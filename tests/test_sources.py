import json

import pytest
from pyspark.sql import functions as F

from tessera.sources import files, sinks


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_read_requests_rules(spark, tmp_path):
    ok = {"input_id": "a", "input": "hello", "model": "m"}
    lines = [
        json.dumps(ok),
        "",
        json.dumps([1, 2]),
        json.dumps({**ok, "input_id": "b", "extra": 1}),
        json.dumps({**ok, "input_id": "c", "model": "other"}),
        json.dumps({**ok, "input_id": "d", "input": ""}),
        json.dumps({"input_id": "", "input": "x", "model": "m"}),
        json.dumps({"input_id": ["e1", "e2"], "input": ["x", "y"], "model": "m", "dimensions": 8}),
        json.dumps({"input_id": ["f1"], "input": ["x", 3], "model": "m"}),
        json.dumps({"input_id": ["g1"], "input": ["x", "y"], "model": "m"}),
        json.dumps({"input_id": ["h", "h"], "input": ["x", "y"], "model": "m"}),
        json.dumps({**ok, "input_id": "i", "encoding_format": "hex"}),
        json.dumps({**ok, "input_id": "j", "dimensions": True}),
        json.dumps({**ok, "input_id": "k", "user": 5}),
        "{not json",
    ]
    write(tmp_path / "in" / "b.jsonl", lines)
    write(tmp_path / "in" / "sub" / "a.jsonl", [json.dumps({**ok, "input_id": "z"})])
    write(tmp_path / "in" / "skip.txt", [json.dumps(ok)])
    df = files.read_requests(spark, str(tmp_path / "in"), "m")
    got = {r["source"]: (r["accepted"], r["error"]) for r in df.collect()}
    assert got["b.jsonl:1"] == (True, None)
    assert "b.jsonl:2" not in got
    assert got["b.jsonl:3"] == (False, "not_object")
    assert got["b.jsonl:4"] == (False, "unknown_fields")
    assert got["b.jsonl:5"] == (False, "model_mismatch")
    assert got["b.jsonl:6"] == (False, "empty_input")
    assert got["b.jsonl:7"] == (False, "bad_input_id")
    assert got["b.jsonl:8"] == (True, None)
    assert got["b.jsonl:9"] == (False, "non_string_input")
    assert got["b.jsonl:10"] == (False, "id_count_mismatch")
    assert got["b.jsonl:11"] == (False, "duplicate_ids_in_row")
    assert got["b.jsonl:12"] == (False, "bad_encoding")
    assert got["b.jsonl:13"] == (False, "bad_dimensions")
    assert got["b.jsonl:14"] == (False, "bad_user")
    assert got["b.jsonl:15"] == (False, "invalid_json")
    assert got["a.jsonl:1"] == (True, None)
    assert len(got) == 15


def test_load_route_and_one_file_rule(spark, tmp_path):
    recs = [{"object": "list", "model": "m", "usage": {"prompt_tokens": 3, "total_tokens": 3},
             "data": [{"object": "embedding", "index": 0, "input_id": "a", "embedding": [1.0, 0.0]},
                      {"object": "embedding", "index": 1, "input_id": "b", "embedding": [0.0, 1.0]}]},
            {"input_ids": ["c"], "error": {"code": "429", "message": "slow"}}]
    write(tmp_path / "r1" / "out.jsonl", [json.dumps(r) for r in recs])
    got = files.load_route(spark, str(tmp_path / "r1"), "base")
    assert got["vectors"].count() == 2 and got["errors"].count() == 1
    assert [r["batch_size"] for r in got["batch_sizes"].collect()] == [2]
    assert got["rejects"].count() == 0
    write(tmp_path / "r2" / "out.jsonl", [json.dumps(recs[0]), '{"model": "m", "data": [{"input_id"',
                                          '{"model": "m", "data": [{"index": 0, "embedding": [1.0]}]}'])
    bad = files.load_route(spark, str(tmp_path / "r2"), "base")
    assert bad["vectors"].count() == 2 and bad["errors"].count() == 0
    assert sorted(r["reason"] for r in bad["rejects"].collect()) == ["invalid_json", "missing_input_id"]
    write(tmp_path / "r1" / "other.jsonl", [json.dumps(recs[0])])
    with pytest.raises(ValueError):
        files.load_route(spark, str(tmp_path / "r1"), "base")


def test_read_runs_inline_fallback(spark, tmp_path):
    (tmp_path / "run1").mkdir()
    (tmp_path / "run1" / "summary.json").write_text(json.dumps(
        {"mode": "direct", "requests": [{"sequence": 1, "status_code": 200}]}))
    (tmp_path / "run1" / "requests.jsonl").write_text("")
    (tmp_path / "run2").mkdir()
    (tmp_path / "run2" / "summary.json").write_text(json.dumps({"mode": "pool", "requests": []}))
    write(tmp_path / "run2" / "requests.jsonl", [json.dumps({"sequence": 1, "status_code": 429}),
                                                json.dumps({"sequence": 2, "status_code": 200})])
    _, logs = files.read_runs(spark, [str(tmp_path / "run1"), str(tmp_path / "run2")])
    got = sorted((r["run_id"], r["sequence"]) for r in logs.collect())
    assert got == [("run1", 1), ("run2", 1), ("run2", 2)]


def test_metric_reports_and_counts(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.json").write_text(json.dumps(
        {"metric_job_status": "ok", "metric_prefix": "x",
         "metrics": {"x.accepted_tpm": 10.5, "y.other": 1.0}}))
    rows = files.read_metric_reports(spark, str(tmp_path / "m")).collect()
    assert [(r["metric"], r["value"]) for r in rows] == [("accepted_tpm", 10.5)]
    write(tmp_path / "c.jsonl", ["{}", "  ", "{}"])
    assert files.count_records(spark, str(tmp_path / "c.jsonl")) == 2
    write(tmp_path / "e.jsonl", [" "])
    with pytest.raises(ValueError):
        files.count_records(spark, str(tmp_path / "e.jsonl"))


def test_failure_trace(spark, tmp_path):
    write(tmp_path / "logs" / "a.log", [f"line {i} ERROR" if i % 2 else f"line {i}" for i in range(40)])
    write(tmp_path / "logs" / "b.txt", ["x" * 5000 + " Traceback"])
    got = {r["file"].split("/")[-1]: r["trace"] for r in
           files.failure_trace(spark, str(tmp_path / "logs"), "ERROR|Traceback").collect()}
    assert got["a.log"].splitlines()[0] == "line 17 ERROR"
    assert len(got["a.log"].splitlines()) == 12
    assert len(got["b.txt"]) == 4000


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.0, None), (2, 3.5, "x")], "run long, tpm double, note string")
    rows = [r[0] for r in sinks.markdown_rows(df, ["run", "tpm", "note"]).collect()]
    assert rows == ["| 1 | n/a | n/a |", "| 2 | 3.5 | x |"]
    res = spark.createDataFrame([("Base64+Flip", 1)], "run_label string, v long")
    sinks.write_results_by_label(res, str(tmp_path / "res"))
    assert (tmp_path / "res" / "run_label=base64_flip").exists()
    parts = spark.createDataFrame(
        [("m", 1, "second", [("u2", "")]), ("m", 0, "first", [("u1", "T1"), ("u2", "T2")])],
        "message_id string, part_no int, text string, refs array<struct<url:string,title:string>>")
    doc = sinks.summary_documents(parts).first()["document"]
    assert doc == "first\n\nsecond\n\n## References\n- [T1](u1)\n- [T2](u2)"


def test_more_readers(spark, tmp_path):
    write(tmp_path / "spans.jsonl", [json.dumps({"name": "run", "trace_id": "t", "span_id": "a"}),
                                     json.dumps({"name": "request", "trace_id": "t", "span_id": "b",
                                                 "parent_span_id": "a"})])
    root, reqs = files.read_spans(spark, str(tmp_path / "spans.jsonl"), "run")
    assert root.count() == 1 and reqs.collect()[0]["parent_span_id"] == "a"
    write(tmp_path / "cohort" / "s.csv", ["PATIENT_ID,CANCER_STAGE,TUMOR_SIZE_CM,DIAGNOSIS_DATE,"
                                          "TREATMENT_RECEIVED", "1,Stage_I,2.5,2024-01-05,Surgery"])
    write(tmp_path / "cohort" / "notes.txt", ["ignored"])
    r = files.read_cohort_csv(spark, str(tmp_path / "cohort"), files.COHORT_SYMPTOMS).collect()
    assert len(r) == 1 and str(r[0]["DIAGNOSIS_DATE"]) == "2024-01-05"
    write(tmp_path / "corpus" / "hr.md", ["# HR", "", "Policy text"])
    docs = files.read_corpus(spark, str(tmp_path / "corpus")).collect()
    assert docs[0]["name"] == "hr.md" and docs[0]["text"].startswith("# HR\n")
    write(tmp_path / "eval.jsonl", [json.dumps({"query": "q", "response": "r", "latency": 1.5})])
    ev = files.read_eval_rows(spark, str(tmp_path / "eval.jsonl")).collect()[0]
    assert ev["query"] == "q" and ev["latency"] == 1.5 and ev["ground_truth"] is None


def test_more_writers(spark, tmp_path):
    resp = spark.createDataFrame([(2, None), (1, None), (3, ("429", "slow"))],
                                 "seq long, error struct<code:string,message:string>")
    sinks.write_responses(resp, str(tmp_path / "out"), ["seq"])
    seqs = []
    for f in sorted((tmp_path / "out" / "status=ok").glob("part-*.json")):
        seqs += [json.loads(line)["seq"] for line in f.read_text().splitlines() if line]
    assert seqs == [1, 2]
    assert spark.read.json(str(tmp_path / "out" / "status=error")).count() == 1
    lines = spark.createDataFrame([("a/b.jsonl", "x")], "source_file string, input string")
    sinks.write_inputs_by_source(lines, str(tmp_path / "inputs"))
    assert (tmp_path / "inputs" / "source_file=a%2Fb.jsonl").exists()
    sinks.write_eval_dataset(lines, str(tmp_path / "ds"))
    assert spark.read.json(str(tmp_path / "ds")).count() == 1


def test_line_numbers_exact_when_files_split(spark, tmp_path):
    lines = [json.dumps({"n": i, "pad": "x" * (i % 37)}) for i in range(3000)]
    write(tmp_path / "big" / "a.jsonl", lines)
    write(tmp_path / "big" / "b.jsonl", lines[:50])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = files.file_lines(spark, str(tmp_path / "big"), "*.jsonl").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for r in got:
        assert json.loads(r["line"])["n"] == r["line_no"] - 1
    assert len(got) == 3050
