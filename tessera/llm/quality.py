"""Quality classifier by positive-unlabelled learning.

The model sees trusted positives (labelled good texts outside the held-out fold)
and unlabelled documents, and minimises the non-negative unbiased risk

    pi E_p[l(f)] + max(0, E_u[l(-f)] - pi E_p[l(-f)])        l: logistic loss

with the class prior pi estimated from the labelled training rows. f is additive:
each surface feature of a text is cut into quantile bins with one weight each.
Samples are bounded (POSITIVES, UNLABELLED); scoring reads every whole text in
Arrow batches.

Edge cases: null text is empty; an empty text gets the score of its features like
any other; a null id counts as held out; repeated rows are scored one by one;
without trusted positives the score is the prior; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held_out
from tessera.llm.learning import filtered, labelled_sample, scored, sigmoid, unlabelled_sample

POSITIVES, UNLABELLED = 6000, 8000
BINS, STEPS, RATE, RIDGE = 10, 400, 0.1, 1e-3
THRESHOLD = 0.3
FOLDS = 5

_SYMBOLS = re.compile(rb"[#$%&*!|<>{}\[\]\\^~=+_@/]")
_UPPER, _DIGIT, _STOP = re.compile(rb"[A-Z]"), re.compile(rb"[0-9]"), re.compile(rb"[.!?]")


def features(text: str | None) -> list[float]:
    """Surface statistics of a whole text."""
    b = (text or "").encode("utf-8", "surrogatepass")
    ws = b.split()
    n, size = max(1, len(ws)), max(1, len(b))
    lines = [x for x in b.split(b"\n") if x.strip()]
    count = Counter(ws)
    ends = Counter(w[-1:] for w in ws)
    odd = sum(c for e, c in ends.items() if e in b"!#$%&*|")
    return [
        np.log1p(len(ws)), np.log1p(len(b)), len(b.translate(None, b" \n\t")) / n,
        len(_UPPER.findall(b)) / size, len(_DIGIT.findall(b)) / size, len(_SYMBOLS.findall(b)) / size,
        len(_STOP.findall(b)) / n, b.count(b",") / n, odd / n, b.count(b"|") / n,
        len(count) / n, len(count) / np.sqrt(n), max(count.values(), default=0) / n,
        sum(x == y for x, y in zip(ws, ws[1:])) / n,
        len(set(lines)) / max(1, len(lines)), len(ws) / max(1, len(lines)),
        max(map(len, lines), default=0) / size, max(map(len, ws), default=0),
        len(zlib.compress(b, 1)) / (size + 20),
    ]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Column number of each feature's bin."""
    width = BINS + 1
    return np.stack([np.searchsorted(c, x[:, j]) + j * width for j, c in enumerate(cuts)], axis=1)


def _sum(weights: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return weights[bins].sum(axis=1) + weights[-1]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> dict:
    """Minimises the non-negative risk by Adam over all sampled rows."""
    both = np.concatenate([positive, unlabelled])
    cuts = [np.unique(np.quantile(both[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(both.shape[1])]
    p, u = binned(positive, cuts), binned(unlabelled, cuts)
    size = both.shape[1] * (BINS + 1) + 1
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)

    def gradient(bins, slope):
        g = np.bincount(bins.ravel(), np.repeat(slope, bins.shape[1]), minlength=size) / len(bins)
        g[-1] = slope.mean()
        return g

    for step in range(1, STEPS + 1):
        fp, fu = _sum(w, p), _sum(w, u)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g_negative = gradient(u, sigmoid(fu)) - prior * gradient(p, sigmoid(fp))
        g_positive = prior * gradient(p, sigmoid(fp) - 1)
        # Below zero the negative part is fitted beyond the truth: step back out of it.
        g = (g_positive + g_negative if negative >= 0 else -g_negative) + RIDGE * np.r_[w[:-1], 0.0]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return {"cuts": cuts, "weights": w}


def class_prior(labels: DataFrame, folds: int = FOLDS) -> float:
    """Share of good rows among the labelled rows outside the held-out fold (add-one)."""
    train = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds) & F.col("quality").isin(0, 1))
    good, n = train.agg(F.sum("quality"), F.count(F.lit(1))).first()
    return ((good or 0) + 1) / (n + 2)


def _collected(sample: DataFrame) -> np.ndarray:
    """Feature rows of a bounded sample, in a fixed order."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def rows(batches):
        for b in batches:
            x = [features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(x, pa.list_(pa.float64()))], schema=schema)

    got = sample.mapInArrow(rows, "doc_id bigint, x array<double>").toArrow().sort_by("doc_id")
    x = np.array(got.column("x").to_pylist(), float)
    return x.reshape(got.num_rows, -1) if got.num_rows else np.zeros((0, 0))


def scorer(documents: DataFrame, labels: DataFrame, folds: int = FOLDS):
    """Learns, and returns a function from a column of texts (in a task) to their scores."""
    prior = class_prior(labels, folds)
    positive = _collected(labelled_sample(documents, labels, F.col("quality") == 1, folds, POSITIVES))
    unlabelled = _collected(unlabelled_sample(documents, UNLABELLED))
    model = fit(positive, unlabelled, prior) if len(positive) and len(unlabelled) else None
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(texts) -> np.ndarray:
        m = shared.value
        if m is None or not len(texts):
            return np.full(len(texts), prior)
        x = np.array([features(t.as_py()) for t in texts])
        return sigmoid(_sum(m["weights"], binned(x, m["cuts"])))

    return score


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return scored(documents, scorer(documents, labels, folds), threshold, folds)


def good_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = FOLDS) -> DataFrame:
    """The rows predicted to be of good quality, all columns."""
    return filtered(documents, scorer(documents, labels, folds), lambda s: s >= threshold)
