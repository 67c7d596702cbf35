import random

from pyspark.sql import functions as F

from tessera.functions.ordered import (previous_within, rank_within, rolling_counts,
                                       running_max_within, running_sum_within)


def _rows(seed=9):
    rnd = random.Random(seed)
    rows = [("hot", i, rnd.randint(0, 5)) for i in range(2500)]
    rows += [(f"k{j}", i, rnd.randint(0, 5)) for j in range(6) for i in range(rnd.randint(1, 40))]
    rnd.shuffle(rows)
    return rows


def _expected(rows):
    by = {}
    for k, i, v in rows:
        by.setdefault(k, []).append((i, v))
    return {k: sorted(v) for k, v in by.items()}


def test_running_sum_and_rank_across_partitions(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, i long, v long")
    exp = _expected(rows)
    got = {(r["k"], r["i"]): r["c"] for r in
           running_sum_within(df, ["k"], ["i"], "v", "c", partitions=9).collect()}
    for k, seq in exp.items():
        acc = 0
        for i, v in seq:
            acc += v
            assert got[(k, i)] == acc
    ranks = {(r["k"], r["i"]): (r["_rank"], r["_n"]) for r in
             rank_within(df, ["k"], ["i"], partitions=9).collect()}
    for k, seq in exp.items():
        for pos, (i, _) in enumerate(seq):
            assert ranks[(k, i)] == (pos, len(seq))


def test_previous_within_carries_across_partitions(spark):
    rows = _rows(4)
    df = spark.createDataFrame([(k, i, f"s{v}-{i}") for k, i, v in rows], "k string, i long, s string")
    got = {(r["k"], r["i"]): r["_prev"] for r in
           previous_within(df, ["k"], ["i"], "s", partitions=11).collect()}
    for k, seq in _expected(rows).items():
        prev = None
        for i, v in seq:
            assert got[(k, i)] == prev
            prev = f"s{v}-{i}"


def test_null_keys_keep_their_rows(spark):
    from tessera.functions.ordered import rank_within, running_sum_within
    rows = [(None, 1, 5), (None, 2, 7), ("a", 1, 3)]
    df = spark.createDataFrame(rows, "k string, o int, v bigint")
    assert sorted((r["k"] or "", r["o"], r["_rank"]) for r in rank_within(df, ["k"], ["o"]).collect()) == [
        ("", 1, 0), ("", 2, 1), ("a", 1, 0)]
    assert running_sum_within(df, ["k"], ["o"], "v", "s").count() == 3


BIG = (1 << 53) + 1


def _null_key_rows(n=400):
    rnd = random.Random(5)
    keys = [(None, 1), (None, None), (BIG, 1), (BIG - 1, 1), (7, None)]
    return [(*rnd.choice(keys), i, rnd.randint(0, 9)) for i in range(n)]


def test_scans_keep_null_and_large_integer_keys_apart(spark):
    """Null in either of two integer keys, and ids that a double cannot tell apart."""
    rows = _null_key_rows()
    df = spark.createDataFrame(rows, "a bigint, b bigint, o bigint, v bigint")
    want, last, total, top = {}, {}, {}, {}
    for a, b, o, v in rows:
        total[a, b] = total.get((a, b), 0) + v
        top[a, b] = max(top.get((a, b), 0), v)
        want[o] = (total[a, b], top[a, b], last.get((a, b)))
        last[a, b] = v
    for parts in (1, 6):
        sums = {r["o"]: r["s"] for r in running_sum_within(df, ["a", "b"], ["o"], "v", "s", parts).collect()}
        tops = {r["o"]: r["m"] for r in running_max_within(df, ["a", "b"], ["o"], "v", "m", parts).collect()}
        prev = {r["o"]: r["_prev"] for r in previous_within(df, ["a", "b"], ["o"], "v", parts).collect()}
        assert {o: (sums[o], tops[o], prev[o]) for o in want} == want


def test_one_null_integer_key(spark):
    df = spark.createDataFrame([(None, i, 1) for i in range(1, 5)], "k bigint, o int, v bigint")
    assert sorted(r["s"] for r in running_sum_within(df, ["k"], ["o"], "v", "s").collect()) == [1, 2, 3, 4]
    assert sorted(str(r["_prev"]) for r in previous_within(df, ["k"], ["o"], "o").collect()) == ["1", "2", "3", "None"]


def test_rolling_sums_over_many_partitions(spark):
    """Windows within a partition, over a few and over all of them; equal times; null and large keys."""
    rnd = random.Random(6)
    rows = [(rnd.choice([None, BIG, BIG - 1, 3]) if rnd.random() < 0.4 else BIG, rnd.randint(0, 300), i, rnd.randint(0, 9)) for i in range(700)]
    df = spark.createDataFrame(rows, "k bigint, t bigint, id bigint, w bigint")
    for width in (1, 20, 150, 10_000):
        got = {r["id"]: r["window_count"] for r in rolling_counts(df, ["k"], "t", width, "id", "w", partitions=9).collect()}
        want = {i: sum(w2 for k2, t2, _, w2 in rows if k2 == k and t - width < t2 <= t) for k, t, i, _ in rows}
        assert got == want


def test_rolling_counts_without_rows_or_times(spark):
    df = spark.createDataFrame([(1, None, 1)], "k bigint, t bigint, id bigint")
    assert rolling_counts(df, ["k"], "t", 5, "id").collect() == []


def test_percentiles_by_counting(spark, monkeypatch):
    """Against a sort, with few values gathered at a time; spread, equal, null and single values."""
    from tessera.functions import ordered
    monkeypatch.setattr(ordered, "BUCKETS", 8)
    monkeypatch.setattr(ordered, "GATHERED", 5)
    rnd = random.Random(8)
    rows = [(k, v, rnd.choice([None, 1.5, 2.5, -3.0]))
            for k, vs in {"spread": [10.0 ** rnd.uniform(-200, 200) * rnd.choice([1, -1]) for _ in range(300)], "same": [4.0] * 50, None: [1.0, 2.0],
                          "one": [7.0], "none": [None, float("nan")], "dense": [float(rnd.randint(0, 40)) for _ in range(500)]}.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double, u double")
    got = {r["k"]: r for r in ordered.exact_quantiles(df, ["k"], {"v": ("v", {"p0": 0, "p50": 50, "p99": 99, "p100": 100}), "u": ("u", {"u95": 95})}).collect()}

    def at(values, p):
        xs = sorted(x for x in values if x is not None and x == x)
        if not xs:
            return None
        pos = (len(xs) - 1) * p / 100
        lo = int(pos)
        return xs[lo] + (xs[min(lo + 1, len(xs) - 1)] - xs[lo]) * (pos - lo)

    for k in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == k]
        want = [at([r[1] for r in mine], p) for p in (0, 50, 99, 100)] + [at([r[2] for r in mine], 95)]
        if all(w is None for w in want):
            assert k not in got
        else:
            assert [got[k][c] for c in ("p0", "p50", "p99", "p100", "u95")] == want
