"""Quality scores by compression (operator 10).

One zstandard dictionary is trained from good, one from bad labelled text.  A text is
compressed with each; (bad size - good size) / text size is the normalised difference.  Text
that merely repeats itself shrinks with any dictionary, so the share of the text that the good
dictionary leaves is the second input of the logistic calibration that yields the score.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.arrow_rows import map_rows
from tillcast.llm.sampling import hash_share, labelled_sample

DICTIONARY_BYTES = 32_768
DICTIONARY_TEXT_BYTES = 3_000
SAMPLE_PER_LABEL = 1_500
SAMPLE_TEXT_CHARS = 20_000
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray      # difference, left share, constant

    def scorer(self):
        """texts (bytes) -> scores; holds the two digested dictionaries."""
        size_good, size_bad = (_sizer(d) for d in (self.good, self.bad))

        def score(texts: list[bytes]) -> np.ndarray:
            x = np.array([measure(t, size_good, size_bad) for t in texts]).reshape(-1, 2)
            return _logistic(_design(x, self.centre, self.spread) @ self.weights)

        return score


def _sizer(dictionary: bytes):
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)
    return lambda text: len(c.compress(text))


def measure(text: bytes, size_good, size_bad) -> tuple[float, float]:
    good, bad, n = size_good(text), size_bad(text), max(1, len(text))
    return (bad - good) / n, good / n


def _design(x, centre, spread):
    return np.c_[(x - centre) / spread, np.ones(len(x))]


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; of too few texts to train on, the texts themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(texts)[-DICTIONARY_BYTES:]


def _passage(text: bytes) -> bytes:
    start = zlib.crc32(text) % max(1, len(text) - DICTIONARY_TEXT_BYTES + 1)
    return text[start:start + DICTIONARY_TEXT_BYTES]


def fit_quality(sample: list[tuple[int, str]], share_good: float = 0.5) -> QualityModel:
    """``sample``: (quality, text) with the same number of either label, as far as there are;
    ``share_good`` is the share of label 1 among all labelled rows, to which the calibration
    is weighted.  Even rows make the dictionaries, odd rows the calibration; a long text gives the
    dictionaries a passage of DICTIONARY_TEXT_BYTES, from a place that its digest chooses."""
    by = {q: [t.encode() for x, t in sample if x == q] for q in (0, 1)}
    half = {q: [_passage(t) for t in by[q][::2]] for q in by}
    good, bad = _dictionary(half[1]), _dictionary(half[0])
    rest = [(q, t) for q in (0, 1) for t in (by[q][1::2] or by[q])]
    plain = QualityModel(good, bad, np.zeros(2), np.ones(2), np.array([0.0, 0.0, _odds(share_good)]))
    if not by[0] or not by[1]:      # one label only: its share is the score
        return plain
    sizes = _sizer(good), _sizer(bad)
    x = np.array([measure(t, *sizes) for _, t in rest])
    y = np.array([q for q, _ in rest], float)
    importance = np.where(y == 1, share_good / y.mean(), (1 - share_good) / (1 - y.mean()))
    centre, spread = x.mean(0), x.std(0) + 1e-9
    z, w = _design(x, centre, spread), np.zeros(3)
    for _ in range(40):             # Newton steps of the regularised logistic fit
        p = _logistic(z @ w)
        step = z.T @ (importance * (y - p)) - 1e-2 * w
        w = w + np.linalg.solve((z * (importance * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(3), step)
    return QualityModel(good, bad, centre, spread, w)


def _odds(p: float) -> float:
    p = min(max(p, 1e-3), 1 - 1e-3)
    return float(np.log(p / (1 - p)))


def quality_sample(docs: DataFrame, labels: DataFrame) -> tuple[list, float]:
    """Bounded sample of labelled texts and the share of label 1.  A doc_id whose label rows
    disagree, or that are null, teaches nothing."""
    said = (labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").alias("_id"))
            .agg(F.min("quality").alias("quality"), F.max("quality").alias("_q")).where("quality = _q"))
    counts = {r[0]: r[1] for r in said.groupBy("quality").count().collect()}
    # a bounded share of the labelled ids is broadcast to fetch texts: documents are not shuffled
    chosen = said.where(hash_share(F.xxhash64("_id"), F.col("quality"), counts, 3 * SAMPLE_PER_LABEL)).select("_id", "quality")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "quality")
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    return [(r[0], r[2]) for r in labelled_sample(rows, "quality", SAMPLE_PER_LABEL, SAMPLE_TEXT_CHARS)], share


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score >= threshold) of every whole text.

    Null and empty texts are scored as the empty text.  Null doc_id is carried, repeated rows
    score alike.  Without any label all scores are 0.5; with one label only, near 0 or 1.  No
    rows: no rows.  Other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # two dictionaries of fixed size

    def make():
        score = shared.value.scorer()

        def fn(cols):
            s = score([t or b"" for t in cols["text"].cast(pa.binary()).to_pylist()])
            return {"doc_id": cols["doc_id"], "score": s, "predicted": (s >= threshold).astype(np.int32)}

        return fn

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make,
                    "doc_id long, score double, predicted int")
