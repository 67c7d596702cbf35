"""What stored steps leave on disk and hold in memory: shuffle files, Arrow batches, packed keys, slices."""

import glob
import os
import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import katz, parity
from tessera.llm.common import WHILE_STORED, scratch, settings, stored
from tests.llm.test_parity import brute, texts


def shuffle_files(spark):
    top = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", "/tmp")
    return {f for d in top.split(",") for f in glob.glob(f"{d}/**/blockmgr-*/*/shuffle_*.data", recursive=True)}


def test_stored_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = stored(spark.range(50_000).repartition(4, "id").groupBy(F.col("id") % 1000).count(), f"{scratch(spark)}/x")
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert table.count() == 1000 and table.agg(F.sum("count")).first()[0] == 50_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_texts_reach_python_in_small_batches(spark):
    before = {k: spark.conf.get(k) for k in WHILE_STORED}
    docs = spark.range(0, 1500, 1, 1).select(F.repeat(F.col("id").cast("string"), 5000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    n, most = stored(docs.mapInArrow(sizes, "n bigint, bytes bigint"), f"{scratch(spark)}/x").agg(F.sum("n"), F.max("bytes")).first()
    assert n == 1500 and most < 6_000_000
    assert {k: spark.conf.get(k) for k in WHILE_STORED} == before


def test_keys_are_packed_tightly_and_written_once(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i * k % 9973}" for k in range(1, 700))) for i in range(1, 61)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sent = parity.sketched(docs, 85, 4, 8).where("keys is not null").select(
        *[F.sum(F.length(c)) for c in ("keys", "classes", "bands", "folds")]).first()
    assert sum(sent) == 3 * sent[0] and sent[0] > 60 * 100 * 4       # 4 bytes of key, 8 of class
    written = []
    monkeypatch.setattr(parity, "stored", lambda df, path: written.append(df.columns) or stored(df, path))
    assert parity.jaccard_components(docs).count() == 60
    assert not any("keys" in columns for columns in written)


def test_scores_of_slices_are_those_of_the_whole(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * k) % (7 + i % 11)}" for k in range(i % 40))) for i in range(120)] + [(None, "a w1 w2"), (3, None), (5, "w1 w2")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = []

    def counted(df, path):
        out = stored(df, path)
        if "/scores" in path:
            counts.append(out.count())
        return out

    def result():
        return sorted((tuple(r) for r in katz.katz_scores(docs).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))

    monkeypatch.setattr(katz, "stored", counted)
    got = result()
    assert len(counts) == 3 and sum(counts) == len(rows) and max(counts) < len(rows) / 2
    monkeypatch.setattr(katz, "SLICES", 1)
    want = result()
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for i in (5, 6):
        assert [r[i] for r in got] == pytest.approx([r[i] for r in want], abs=1e-9)


def test_texts_of_kept_documents_stay_in_place(spark):
    rows = [(i, " ".join(f"w{(i // 2 if i < 6 else i) * 7919 + k}" for k in range(3000))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").union(spark.createDataFrame([(None, "a b"), (7, "c d")], "doc_id bigint, text string"))
    docs = stored(docs, f"{scratch(spark)}/docs")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        kept = parity.deduplicated(docs, 80, 5)
        before = shuffle_files(spark)
        kept = kept.withColumn("text", F.length("text")).localCheckpoint()
        sent = sum(os.path.getsize(f) for f in shuffle_files(spark) - before if os.path.exists(f))
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([i for i in range(200) if i not in (1, 3, 5)] + [None], key=str)
    assert sent < 500_000, sent


def test_marked_ids_are_never_missed(spark, monkeypatch):
    ids = spark.range(0, 300_000, 3).toDF("x")
    for most in (parity.MARKS, 1 << 14):                  # a full bitmap only lets more rows through
        monkeypatch.setattr(parity, "MARKS", most)
        docs = spark.range(300_000).withColumn("hit", parity.marked(ids, F.col("id")))
        assert docs.where("id % 3 = 0 and not hit").count() == 0
    monkeypatch.undo()
    others = spark.range(300_000).withColumn("hit", parity.marked(ids, F.col("id"))).where("id % 3 > 0 and hit").count()
    assert others < 40_000
    assert spark.range(10).where(parity.marked(ids.limit(0), F.col("id"))).count() == 0


def test_settled_groups_leave_the_search(spark, monkeypatch):
    rows = texts(1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    opened, further = [], [None]

    def kept(df, path):
        out = stored(df, path)
        name = path.rsplit("/", 1)[1]
        if name.startswith("open"):
            opened.append({r["key"] for r in out.select("key").distinct().collect()})
        if name.startswith("across"):
            further.append({r["open"] for r in out.where("open is not null").collect()})
        return out

    monkeypatch.setattr(parity, "stored", kept)
    assert {r["doc_id"]: r["component_id"] for r in parity.jaccard_components(docs, 85, 4, 1).collect()} == brute(rows, 85, 4)
    assert not further[-1] and len(opened) == len(further) - 1
    assert all(now <= flagged for now, flagged in zip(opened[1:], further[1:]))


def test_groups_with_further_pairs_are_named(spark):
    spread = spark.createDataFrame([(k, i, i, i, 1) for k, i in ((1, 10), (1, 11), (1, 12), (2, 20), (2, 21), (3, 30), (3, 31))],
                                   "key bigint, class bigint, id bigint, root bigint, chunks int")
    classes = spark.createDataFrame([(i, i, 100, bytearray(b"\xff" * 64 if i == 31 else bytes(64))) for i in (10, 11, 12, 20, 21, 30, 31)],
                                    "class bigint, id bigint, n bigint, sketch binary")
    rows = parity.across(spread, classes, 85, 1).collect()
    assert [r["open"] for r in rows if r["open"] is not None] == [1]
    assert {(r["a"], r["b"]) for r in rows if r["a"] is not None} >= {(20, 21)}
    rows = parity.across(spread, classes, 85, 64).collect()
    assert {tuple(r) for r in rows} == {(10, 11, None), (10, 12, None), (11, 12, None), (20, 21, None)}


def test_settled_members_leave_their_groups(spark, monkeypatch):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base, rows = [word() for _ in range(100)], []
    for i in range(120):
        w = list(base)
        for _ in range(r.choice((1, 2, 4, 6, 6))):
            w[r.randrange(100)] = word()
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    opened, left, written = [], [set()], []

    def kept(df, path):
        out = stored(df, path)
        name = path.rsplit("/", 1)[1]
        written.append(name)
        if name.startswith("open"):
            opened.append({(r["key"], r["class"]) for r in out.collect()})
        if name.startswith("across"):
            left.append({(r["open"], c) for r in out.where("open is not null").collect() for c in r["classes"]})
        return out

    monkeypatch.setattr(parity, "stored", kept)
    assert {r["doc_id"]: r["component_id"] for r in parity.jaccard_components(docs, 85, 4, 4).collect()} == brute(rows, 85, 4)
    assert len(opened) > 1 and all(now <= some for now, some in zip(opened[1:], left[1:]))
    assert sum(map(len, opened[1:])) < len(opened[0]) / 2
    assert sum(x.startswith("rooted") for x in written) == len(opened)     # members meet their roots once a round


def test_members_with_further_pairs_are_listed(spark):
    # 10, 11 and 12 are near each other, 30 is far from all, 40 and 41 are a pair that is offered at once.
    sketch = {i: b for ids, b in (((10, 11, 12), b"\x00"), ((30,), b"\xaa"), ((40, 41), b"\xff")) for i in ids}
    spread = spark.createDataFrame([(1, i, i, i, 1) for i in sketch], "key bigint, class bigint, id bigint, root bigint, chunks int")
    classes = spark.createDataFrame([(i, i, 100, bytearray(64 * b)) for i, b in sketch.items()], "class bigint, id bigint, n bigint, sketch binary")
    rows = parity.across(spread, classes, 85, 1, listed=True).collect()
    assert [(r["open"], r["classes"]) for r in rows if r["open"] is not None] == [(1, [10, 11, 12])]
    assert {(r["a"], r["b"]) for r in rows if r["a"] is not None} >= {(40, 41)}


def test_tables_of_bigrams_have_small_rows(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * k) % (7 + i % 11)}" for k in range(i % 40))) for i in range(120)] + [(None, "a w1 w2"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    tables = []

    def kept(df, path):
        out = stored(df, path)
        if path.endswith("/bigrams"):
            tables.append(out.select("bucket", "first", F.length("h").alias("h"), F.length("w").alias("w"), F.length("counts").alias("counts")).collect())
        return out

    def result():
        return sorted((tuple(r) for r in katz.katz_scores(docs).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))

    want = result()
    monkeypatch.setattr(katz, "stored", kept)
    monkeypatch.setattr(katz, "ROW_BIGRAMS", 7)
    monkeypatch.setattr(katz, "SENT_TOKENS", 50)
    got = result()
    assert max(r["h"] for r in tables[0]) == 28 and all(r["h"] == r["w"] == r["counts"] // 2 for r in tables[0])
    assert len(tables[0]) > 2 * len({r["bucket"] for r in tables[0]})
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for i in (5, 6):
        assert [r[i] for r in got] == pytest.approx([r[i] for r in want], abs=1e-9)
