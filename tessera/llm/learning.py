"""Bounded, seeded samples of labelled texts and a small logistic fit on the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held_out

#: Longer texts are left out of training samples only; scoring reads whole texts.
LONGEST_SAMPLE = 200_000


def labelled_sample(documents: DataFrame, labels: DataFrame, wanted: Column, folds: int, n: int) -> DataFrame:
    """Texts of at most n labelled rows outside the held-out fold for which `wanted` holds:
    those with the smallest hash of their id. The ids are at most n rows, so they are broadcast."""
    ids = (labels.where(wanted & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds))
           .select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n))
    return (documents.select("doc_id", "text").where(F.length("text").between(1, LONGEST_SAMPLE))
            .join(F.broadcast(ids), "doc_id").select("doc_id", "text"))


def unlabelled_sample(documents: DataFrame, n: int) -> DataFrame:
    """Texts of at most about n documents of all, those with the smallest hash of their id."""
    ids = (documents.where(F.col("doc_id").isNotNull()).select("doc_id")
           .orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id").limit(n).distinct())
    return (documents.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= LONGEST_SAMPLE)
            .join(F.broadcast(ids), "doc_id").select("doc_id", "text"))


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the first weight is the intercept."""
    x = np.c_[np.ones(len(x)), x]
    w, penalty = np.zeros(x.shape[1]), np.r_[1e-6, np.full(x.shape[1] - 1, ridge)]
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def scored(documents: DataFrame, score, threshold: float, folds: int) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= threshold) of every document, in one pass over the texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for b in batches:
            s = score(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held"), pa.array(s, pa.float64()),
                                              pa.array((s >= threshold).astype(np.int32))], schema=schema)

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out(F.col("doc_id"), folds).alias("held"))
    return docs.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def filtered(documents: DataFrame, score, keep) -> DataFrame:
    """The rows whose score satisfies `keep`, with all their columns, in one pass and without a shuffle."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(keep(score(b.column("text"))), pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
