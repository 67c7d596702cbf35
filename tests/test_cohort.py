import numpy as np
import pytest

from tessera.operators import cohort as T


def brute_lof(pts, k):
    n = len(pts)
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    kd = np.sort(d, axis=1)[:, k - 1]
    nb = [np.nonzero(d[i] <= kd[i])[0] for i in range(n)]
    lrd = np.array([1 / np.mean(np.maximum(kd[nb[i]], d[i, nb[i]])) for i in range(n)])
    return np.array([np.mean(lrd[nb[i]]) / lrd[i] for i in range(n)]), kd


def test_lof_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(0, 1, (250, 2)), rng.normal(6, 0.3, (40, 2)), [[20.0, -20.0]]])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)],
                               "id long, x double, y double")
    got = {r["id"]: r for r in T.local_outlier_factor(df, "id", ["x", "y"], 5).collect()}
    lof, kd = brute_lof(pts, 5)
    assert len(got) == len(pts)
    for i in range(len(pts)):
        assert got[i]["kdist"] == pytest.approx(kd[i], rel=1e-12)
        assert got[i]["lof"] == pytest.approx(lof[i], rel=1e-9)
    assert got[len(pts) - 1]["outlier"]


def test_impute_median_and_mode(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "b"), (10.0, None)],
                               "v double, c string")
    out, fills = T.impute(df, ["v"], ["c"])
    assert fills["v"] == 3.0 and fills["c"] == "b"
    assert fills["_affected_ratio"] == 0.5
    assert sorted(r["v"] for r in out.collect()) == [1.0, 3.0, 3.0, 10.0]


def brute_lof_dups(pts, k):
    n = len(pts)
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    kd = np.sort(d, axis=1)[:, k - 1]
    nb = [np.nonzero(d[i] <= kd[i])[0] for i in range(n)]
    with np.errstate(divide="ignore"):
        lrd = np.array([1 / np.mean(np.maximum(kd[nb[i]], d[i, nb[i]])) for i in range(n)])
    lof = [None if (np.isinf(lrd[i]) or np.isinf(lrd[nb[i]]).any())
           else float(np.mean(lrd[nb[i]]) / lrd[i]) for i in range(n)]
    return lof, kd


def test_adaptive_lof_with_duplicates_and_dense_cluster(spark):
    rng = np.random.default_rng(8)
    pts = np.vstack([rng.normal(0, 1, (200, 2)),
                     rng.normal(3, 0.001, (120, 2)),          # very dense cluster
                     np.tile([[-2.0, 2.0]], (30, 1)),          # pile of exact duplicates
                     np.tile([[1.5, -1.5]], (3, 1)),           # a few duplicates (< k)
                     [[25.0, 25.0]]])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)],
                               "id long, x double, y double")
    got = {r["id"]: r for r in T.lof_adaptive(df, "id", ["x", "y"], 5).collect()}
    lof, kd = brute_lof_dups(pts, 5)
    assert len(got) == len(pts)
    for i in range(len(pts)):
        assert got[i]["kdist"] == pytest.approx(kd[i], rel=1e-9, abs=1e-12)
        if lof[i] is None:
            assert got[i]["lof"] is None
        else:
            assert got[i]["lof"] == pytest.approx(lof[i], rel=1e-7)
    assert got[len(pts) - 1]["outlier"]
