"""Language identification by string kernels (operator 7).

Kernel: blended spectrum, presence form.  A text is the set of its character n-grams of
1..4 letters inside lower-cased, space-padded words, hashed to 2^18 cells; the kernel of two
texts is |X and Y| / sqrt(|X| |Y|).

Model: ``landmarks`` training texts per language give the Nystroem map
k(x, landmarks) K_mm^(-1/2); one-versus-rest kernel ridge regression on +-1 targets is solved
in that space.  Kernel, map and ridge weights are linear in the presence row of x, so they
are multiplied once into a (cells x languages) matrix, and a batch of texts is scored by one
sparse-by-dense matrix product.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.arrow_rows import keep_rows, map_rows
from tillcast.llm.sampling import labelled_sample
from tillcast.llm.shingles import mix

CELLS = 1 << 18
GRAMS = 4
#: A word character whose Unicode category is one of the letters': numerals such as one half are none.
WORDLIKE = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"


def has_letter(text: str | None) -> bool:
    return any(unicodedata.category(m[0])[0] == "L" for m in WORDLIKE.finditer(text or ""))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple
    weights: np.ndarray          # (CELLS, languages)
    usual: float = 1.0           # median margin of the sample's own texts

    def scores(self, texts: list[str]) -> np.ndarray:
        """(texts, languages) ridge outputs: the presence matrix times the weights."""
        cells = [presence(t) for t in texts]
        n = np.array([len(c) for c in cells])
        out = np.zeros((len(texts), len(self.languages)))
        some = n > 0
        if some.any():
            starts = np.concatenate(([0], np.cumsum(n[some])[:-1]))
            out[some] = np.add.reduceat(self.weights[np.concatenate(cells)], starts, axis=0)
            out[some] /= np.sqrt(n[some])[:, None]
        return out


def margins(scores: np.ndarray) -> np.ndarray:
    """Best ridge output less the runner-up's (of one language alone, its output).  The targets of
    right and wrong language are 2 apart however many languages there are."""
    if scores.shape[1] < 2:
        return scores.max(1)
    top = np.partition(scores, -2, axis=1)[:, -2:]
    return top[:, 1] - top[:, 0]


def presence(text: str) -> np.ndarray:
    """Sorted cells of the n-grams present in the whole text."""
    words = set(text.lower().split())
    if not words:
        return np.empty(0, np.int64)
    joined = " " + " ".join(words) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    gap = codes == 32
    seen = np.zeros(CELLS, bool)
    h = np.zeros(len(codes), np.uint64)
    for size in range(1, GRAMS + 1):
        n = len(codes) - size + 1
        if n <= 0:
            break
        h = h[:n] * np.uint64(0x100000001B3) + codes[size - 1:] + np.uint64(1)
        ok = ~gap[:n] if size == 1 else np.ones(n, bool)
        for inner in range(1, size - 1):       # a space may only open or close an n-gram
            ok &= ~gap[inner:inner + n]
        if size == 2:
            ok &= ~(gap[:n] & gap[1:])
        seen[(mix(h[ok] + np.uint64(size)) >> np.uint64(46)).astype(np.int64)] = True
    return np.flatnonzero(seen)


def fit_languages(sample: list[tuple[str, str]], landmarks: int = 40, ridge: float = 0.1) -> LanguageModel:
    """``sample``: (language, text) pairs.  The first ``landmarks`` of each language are the
    Nystroem landmarks; all pairs take part in the ridge regression."""
    languages = tuple(sorted({lang for lang, _ in sample}))
    sets = [(lang, presence(t)) for lang, t in sample]
    sets = [(lang, s) for lang, s in sets if len(s)]
    if not sets:
        return LanguageModel((), np.zeros((CELLS, 0)))
    marks = [s for lang in languages for s in [s for x, s in sets if x == lang][:landmarks]]
    # only the landmarks' own cells carry weight; the landmarks are rows of a sparse matrix
    cells = np.unique(np.concatenate(marks))
    place = np.full(CELLS, -1, np.int32)
    place[cells] = np.arange(len(cells))
    flat, lengths = np.concatenate([place[s] for s in marks]), np.array([len(s) for s in marks])
    starts, scale = np.concatenate(([0], np.cumsum(lengths)[:-1])), 1 / np.sqrt(lengths)

    def kernel(s):
        held = np.zeros(len(cells), np.float32)
        at = place[s]
        held[at[at >= 0]] = 1
        return np.add.reduceat(held[flat], starts) * scale / np.sqrt(len(s))

    k = np.stack([kernel(s) for _, s in sets]).astype(np.float64)
    k_mm = np.stack([kernel(s) for s in marks]).astype(np.float64)
    values, vectors = np.linalg.eigh((k_mm + k_mm.T) / 2)
    values = np.maximum(values, 1e-6)
    root = vectors / np.sqrt(values) @ vectors.T
    phi = k @ root
    y = np.array([[1.0 if lang == x else -1.0 for x in languages] for lang, _ in sets])
    mean = y.mean(0) if len(languages) > 1 else np.zeros(1)
    beta = np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]), phi.T @ (y - mean))
    weights = np.zeros((CELLS, len(languages)))
    each = np.repeat((root @ beta) * scale[:, None], lengths, axis=0)       # what a landmark gives each of its cells
    for x in range(len(languages)):
        weights[cells, x] = np.bincount(flat, each[:, x], len(cells))
    return LanguageModel(languages, weights, float(np.median(margins(phi @ beta))) or 1.0)


def language_sample(docs: DataFrame, per_language: int = 400, most_chars: int = 20_000) -> list:
    """Bounded training sample: texts with letters and a non-null ``lang``."""
    fit = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", "lang")
    return [(r[0], r[2]) for r in labelled_sample(fit, "lang", per_language, most_chars)]


def judged(model: LanguageModel, texts: list) -> tuple[list, np.ndarray, np.ndarray]:
    """(language, score, margin) of each text."""
    pred, score, margin = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    at = [i for i, t in enumerate(texts) if has_letter(t)] if model.languages else []
    if at:
        s = model.scores([texts[i] for i in at])
        best = s.argmax(1)
        e = np.exp(3 * (s - s.max(1, keepdims=True)))
        score[at] = 1 / e.sum(1)
        margin[at] = margins(s) / model.usual
        for i, b in zip(at, best):
            pred[i] = model.languages[b]
    return pred, score, margin


def in_languages(docs: DataFrame, model: LanguageModel, least_margin: float) -> DataFrame:
    """The rows of ``docs`` whose text is in a recognised language: it has a letter, and its best language
    leads by ``least_margin``.  Every row is judged by its own text, with or without a doc_id."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def fn(cols):
            pred, _, margin = judged(m, cols["text"].to_pylist())
            return [p != UNDETERMINED and g >= least_margin for p, g in zip(pred, margin)]

        return fn

    return keep_rows(docs, make)


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, margin for every row, from the whole text alone.

    ``score`` is the softmax share (0 to 1) of the chosen language, at least 1 / languages.
    ``margin`` is its lead over the runner-up as a multiple of the sample's median lead, which
    does not depend on the number of languages.  Null, empty or letter-free text: ``und``, score
    and margin 0.  Ties go to the language that sorts first.
    Repeated rows get equal results; a null doc_id is carried along.  With nothing to learn
    from, every row is ``und``.  No rows: no rows.  Columns other than doc_id and text are
    ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # CELLS x languages: fixed size

    def make():
        m = shared.value

        def fn(cols):
            pred, score, margin = judged(m, cols["text"].to_pylist())
            return {"doc_id": cols["doc_id"], "lang_pred": pred, "score": score, "margin": margin}

        return fn

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make,
                    "doc_id long, lang_pred string, score double, margin double")
