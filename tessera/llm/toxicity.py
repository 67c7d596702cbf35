"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on what is
peculiar to toxic text. A text is cut into windows (its distinct words, as runs
of character 5-grams coded in 8 bytes each, so that one match saves far more than
the rounding of a frame); each window is compressed with both dictionaries. The
toxic dictionary wins a window when its frame is shorter by at least a threshold
calibrated on ordinary texts that the dictionaries have not seen. A logistic fit
on the same calibration texts turns wins and margins into a score.

Training uses bounded samples of labelled rows outside the held-out fold
(TOXIC, ORDINARY rows for the dictionaries, a third as many more to calibrate);
scoring reads every whole text.

Edge cases: null and empty texts have no window and score like a text without
wins; a null id counts as held out; repeated rows are scored one by one; without
labelled rows of both kinds every score is 0; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import words
from tessera.llm.learning import filtered, labelled_sample, logistic, scored, sigmoid

TOXIC, ORDINARY = 1500, 4000
GRAM = 5
TOXIC_BYTES, ORDINARY_BYTES = 1 << 13, 1 << 16
LEVEL = 1
LEAST_DOCS = 3            # toxic sample texts that a peculiar gram occurs in (2 in samples below 200)
FALSE_ALARMS = 0.005      # share of ordinary calibration texts in which a window may win
CACHED = 400_000
THRESHOLD = 0.5
FOLDS = 5
EDGE = b".,!?;:#$%&*()\"'"


def grams(word: bytes) -> list[bytes]:
    w = b"^" + word.strip(EDGE) + b"$"
    return [w[i:i + GRAM] for i in range(max(1, len(w) - GRAM + 1))]


def coded(word: bytes) -> bytes:
    return b"".join(struct.pack("<II", zlib.crc32(g), zlib.crc32(g, 77)) for g in grams(word))


def _dictionary(windows: list[bytes], size: int) -> bytes:
    """A trained dictionary; with too little text to train on, the text itself."""
    try:
        return zstandard.train_dictionary(size, windows, k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(windows)[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(content)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


class Margins(dict):
    """Bytes by which the toxic dictionary shortens a word's window, in units of a coded gram."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        super().__init__()
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHED:
            self.clear()
        window = coded(word)
        out = self[word] = (len(self.ordinary.compress(window)) - len(self.toxic.compress(window))) / 8
        return out


def measures(ws, margins: Margins, win: float) -> list[float]:
    """Of a text's distinct words: highest margin, sum of the three highest, windows won, their share."""
    found = sorted((m for m in map(margins.__getitem__, ws) if m >= 0.5), reverse=True)
    won = sum(m >= win for m in found)
    return [min(found[0], 6.0) if found else 0.0, min(sum(found[:3]), 12.0), float(np.log1p(won)), float(won > 0),
            won / max(20, len(ws))]


def fit(toxic: list[set], ordinary: list[set]) -> dict | None:
    """toxic, ordinary: distinct words of sampled texts. Three quarters train, a quarter calibrates."""
    if not toxic or not ordinary:
        return None
    cut = lambda x: max(1, len(x) * 3 // 4)
    known = {g for ws in ordinary[:cut(ordinary)] for w in ws for g in grams(w)}
    among = Counter(g for ws in toxic[:cut(toxic)] for g in {g for w in ws for g in grams(w)})
    least = min(LEAST_DOCS if cut(toxic) >= 200 else 2, cut(toxic))
    peculiar = lambda w: 2 * sum(g not in known and among[g] >= least for g in grams(w)) >= len(grams(w))
    plain = [coded(w) for ws in ordinary[:cut(ordinary)] for w in sorted(ws)]
    order = np.random.default_rng(1).permutation(len(plain))[:100_000]
    model = {"ordinary": _dictionary([plain[i] for i in order], ORDINARY_BYTES),
             "toxic": _dictionary([coded(w) for ws in toxic[:cut(toxic)] for w in sorted(ws) if peculiar(w)], TOXIC_BYTES)}
    margins = Margins(model["toxic"], model["ordinary"])
    bad, good = (x[cut(x):] or x for x in (toxic, ordinary))
    highest = [max((margins[w] for w in ws), default=0.0) for ws in good]
    model["win"] = max(1.0, float(np.quantile(highest, 1 - FALSE_ALARMS, method="lower")) + 0.05)
    # A win must stay within reach of the toxic calibration texts.
    model["win"] = min(model["win"], max(1.0, float(np.quantile([max((margins[w] for w in ws), default=0.0) for ws in bad], 0.05))))
    x = np.array([measures(ws, margins, model["win"]) for ws in (*bad, *good)])
    y = np.r_[np.ones(len(bad)), np.zeros(len(good))]
    model["weights"] = logistic(x, y)
    return model


def _word_sets(sample: DataFrame) -> list[set]:
    """Distinct words of each text of a bounded sample, in hash order of the ids."""
    schema = pa.schema([("h", pa.int64()), ("words", pa.binary())])

    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("h"), pa.array(
                [b"\n".join(sorted(set(words(t.as_py())))) for t in b.column("text")], pa.binary())], schema=schema)

    got = sample.select(F.xxhash64(F.lit(3), "doc_id").alias("h"), "text").mapInArrow(rows, "h bigint, words binary").toArrow()
    got = got.sort_by([("h", "ascending"), ("words", "ascending")])
    return [set(w.split(b"\n")) - {b""} for w in got.column("words").to_pylist()]


def scorer(documents: DataFrame, labels: DataFrame, folds: int = FOLDS):
    """Learns, and returns a function from a column of texts (in a task) to their scores."""
    model = fit(_word_sets(labelled_sample(documents, labels, F.col("toxic") == 1, folds, TOXIC)),
                _word_sets(labelled_sample(documents, labels, F.col("toxic") == 0, folds, ORDINARY)))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    held = {}                                                 # one pair of compressors a Python worker

    def score(texts) -> np.ndarray:
        m = shared.value
        if m is None or not len(texts):
            return np.zeros(len(texts))
        if "margins" not in held:
            held["margins"] = Margins(m["toxic"], m["ordinary"])
        x = np.array([measures(set(words(t.as_py())), held["margins"], m["win"]) for t in texts])
        return sigmoid(np.c_[np.ones(len(x)), x] @ m["weights"])

    return score


def toxicity_scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return scored(documents, scorer(documents, labels, folds), threshold, folds)


def harmless_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = FOLDS) -> DataFrame:
    """The rows that are not predicted to be toxic, all columns."""
    return filtered(documents, scorer(documents, labels, folds), lambda s: s < threshold)
