from pyspark.sql import functions as F

from tessera.sources.tables import request_log, table
from tessera.streaming import folds
from tessera.streaming.runner import run_available_now, stream_table


def test_delta_assembly_rebuilds_messages(spark, sf_small):
    conv = table(spark, sf_small, "conversations")
    msgs = folds.assemble_messages(folds.delta_events(conv))
    got = {(r["stream_id"], r["text"]) for r in msgs.collect()}
    want = {(r["conv_id"], r["text"]) for r in conv.where("role = 'assistant'").collect()}
    assert got == want


def test_stream_fold_equals_batch(spark, sf_small, tmp_path):
    conv = table(spark, sf_small, "conversations")
    events = folds.delta_events(conv)
    batch = {tuple(r) for r in folds.assemble_messages(events).select(
        "stream_id", "message_no", "text", "n_deltas").collect()}
    src = tmp_path / "ev"
    # Each stream arrives in order (its [DONE] last), split over several files.
    events.repartition(3, "stream_id").sortWithinPartitions("stream_id", "seq").write.parquet(str(src))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    # Files are not in event-time order here, so the watermark delay covers the feed.
    base = run_available_now(folds.assemble_messages_stream(stream, "1 day"), "w1test")
    out = {tuple(r) for r in spark.read.parquet(f"{base}/out").select(
        "stream_id", "message_no", "text", "n_deltas").collect()}
    assert out == batch


def test_breaker_matches_sequential(spark, sf_small):
    log = request_log(stream_table(spark, sf_small, "events"))
    window, hold = 6 * 3600 * 1_000_000, 3600 * 1_000_000
    base = run_available_now(folds.breaker_trips_stream(log, window, hold), "w3test")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{base}/out").select(
        "backend_id", "opened_us").collect())
    rows = request_log(table(spark, sf_small, "events")).where("status_code = 429").select(
        "backend_id", "sequence", "start_us", "retry_after").collect()
    want = []
    for b in sorted({r["backend_id"] for r in rows}):
        recent, open_until = [], -1
        for r in sorted((r for r in rows if r["backend_id"] == b),
                        key=lambda r: (r["start_us"], r["sequence"])):
            t = r["start_us"]
            if t < open_until:
                continue
            recent = [x for x in recent if x > t - window] + [t]
            if len(recent) >= 3:
                want.append((b, t))
                open_until = t + max(hold, int(r["retry_after"] * 1e6))
                recent = []
    assert got == sorted(want)


def test_new_content_stream_equals_batch(spark, sf_small, tmp_path):
    conv = table(spark, sf_small, "conversations").where("role = 'assistant'")
    batch = {tuple(r) for r in folds.new_content(conv).select("conv_id", "turn").collect()}
    src = tmp_path / "c"
    conv.write.parquet(str(src))
    s = spark.readStream.schema(conv.schema).parquet(str(src))
    base = run_available_now(folds.new_content_stream(s), "w8test")
    assert {tuple(r) for r in spark.read.parquet(f"{base}/out").collect()} == batch


def test_tumbling_rates_stream_equals_batch(spark, sf_small):
    from tessera.streaming import windows
    batch = {tuple(r) for r in windows.tumbling_rates(
        request_log(table(spark, sf_small, "events"))).collect()}
    s = windows.tumbling_rates(request_log(stream_table(spark, sf_small, "events")))
    q = (s.writeStream.format("memory").queryName("w4_test").outputMode("complete")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {tuple(r) for r in spark.table("w4_test").collect()}
    assert got == batch


def test_ingest_keeps_every_row(spark, tmp_path):
    from tessera.streaming.folds import ingest_requests
    schema = "doc_id bigint, input_id string, model string, accepted boolean, error string"
    _, write = ingest_requests(spark.createDataFrame([], schema), lambda s: s)
    first = [(1, "a", "m", True, None), (2, "a", "m", True, None), (3, None, "m", False, "bad"), (4, None, "m", False, "bad")]
    second = [(5, "a", "m", True, None), (6, "b", "m", True, None)]
    base = str(tmp_path)
    for epoch, rows in ((0, first), (1, second), (1, second)):      # the second batch is replayed
        write(spark.createDataFrame(rows, schema), epoch, base)
    got = {r["doc_id"]: (r["accepted"], r["error"]) for r in spark.read.parquet(f"{base}/rows").collect()}
    assert spark.read.parquet(f"{base}/rows").count() == 6
    assert got == {1: (True, None), 2: (False, "duplicate input_id"), 3: (False, "bad"), 4: (False, "bad"),
                   5: (False, "duplicate input_id"), 6: (True, None)}


def test_stream_of_a_table_in_a_file_or_a_folder(spark, tmp_path):
    """Every row once; a folder of files comes in several micro-batches, or in one."""
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "made"))
    next((tmp_path / "made").glob("part-*.parquet")).rename(tmp_path / "orders.parquet")
    spark.range(40).repartition(20).write.parquet(str(tmp_path / "events.parquet"))
    for name, batches, want, steps in (("orders", 8, 10, [1]), ("events", 8, 40, range(2, 9)), ("events", 1, 40, [1])):
        seen = []
        run_available_now(stream_table(spark, str(tmp_path), name, batches), "t-table",
                          foreach_batch=lambda b, epoch, base: seen.append([r["id"] for r in b.collect()]))
        assert sorted(i for s in seen for i in s) == list(range(want)) and len(seen) in steps


def test_ingest_and_breaker_over_folders(spark, tmp_path):
    """W7 and W3 on tables that are folders of files, as on single files."""
    from tessera.plans.streams import w3_breaker_trips, w7_request_ingest
    docs = [(i % 18, "en", f"s{i % 3}", "" if i == 7 else "some text") for i in range(20)]
    docs = spark.createDataFrame(docs, "doc_id bigint, lang string, source string, text string")
    events = spark.range(400).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, id * 20) AS ts", "id % 7 AS user_id",
        "if(id % 3 = 0, 'error', 'view') AS event_type", "10.5D AS value", "'{\"k\": 5}' AS props")
    out = {}
    for kind, n in (("one", 1), ("many", 10)):
        docs.repartition(n).write.parquet(str(tmp_path / kind / "documents.parquet"))
        events.repartition(n).write.parquet(str(tmp_path / kind / "events.parquet"))
        rows = w7_request_ingest(spark, str(tmp_path / kind)).collect()
        trips = w3_breaker_trips(spark, str(tmp_path / kind)).collect()
        out[kind] = sorted((r["doc_id"], r["accepted"], r["error"] or "") for r in rows), sorted(map(tuple, trips))
    assert out["one"] == out["many"] and out["one"][1]
    assert len(out["one"][0]) == 20 and sum(a for _, a, _ in out["one"][0]) == 17
