"""Quality scores from a regularised quadratic discriminant.

Every text is turned into a few statistics, transformed so that each is close to
symmetric.  For each class a mean and a covariance are fitted, the covariance
shrunk towards the pooled one and that towards a multiple of the identity, and
kept as its Cholesky factor.  A score is the logistic of the difference of the
two Mahalanobis log-densities, with the log of the class shares, divided by a
temperature.

The fit uses a bounded sample of labelled rows (SAMPLE_ROWS, picked by a hash of
the key); scoring covers every row.

Defined results: a null or empty text has the statistics of no words and is
scored like any other.  Labels of null are not learned from.  If the sample has
fewer than two classes, scores are the share of good labels, or 0.5 without
labels.  Repeated rows each get a row and are learned from once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import filter_texts, fold_of, labelled_sample, map_texts
from .quality_rules import Stats, repeated_words

#: Labelled rows that the fit uses, about.
SAMPLE_ROWS = 20_000
#: Shrinkage of a class's covariance to the pooled one, of that to the identity, and what divides the log-density difference.
TO_POOLED, TO_IDENTITY, TEMPERATURE = 0.1, 0.02, 4.0
FOLDS, HELD_OUT, GOOD = 4, 2, 0.7

_PUNCTUATION, _MARKS, _DIGITS, _BAR = b".,;:?'\"()-", b"!", b"0123456789", b"|"


def _without(raw: bytes, chars: bytes) -> int:
    """How many bytes of raw are among chars."""
    return len(raw) - len(raw.translate(None, chars))


def features(raw: bytes) -> list[float]:
    """Transformed statistics of one text."""
    s = Stats(raw)
    n, chars = max(s.n_words, 1), max(s.word_chars, 1)
    share = lambda x, of: (x / of) ** 0.5
    distinct = len(set(s.words))
    return [
        np.log1p(s.n_words),
        np.log(max(s.word_chars, 1) / n),
        share(s.n_upper, max(s.n_letters, 1)),
        share(s.n_symbols, chars),
        share(_without(raw, _MARKS), chars),
        share(_without(raw, _PUNCTUATION), chars),
        share(_without(raw, _DIGITS), chars),
        share(_without(raw, _BAR), n),
        np.log1p(distinct) / np.log1p(n),
        share(s.n_dup_lines, max(s.n_lines, 1)),
        np.log1p(n / max(s.n_lines, 1)),
        share(repeated_words(s.words), n),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Means, inverted Cholesky factors, log-determinants and log shares of the classes 0 and 1."""

    means: list
    factors: list
    constants: list
    default: float
    temperature: float = TEMPERATURE

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.default)
        bad, good = (c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True))
        return 1 / (1 + np.exp(np.clip((bad - good) / self.temperature, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY, temperature: float = TEMPERATURE) -> Discriminant:
    if not len(y):
        return Discriminant([], [], [], 0.5)
    counts = [int((y == k).sum()) for k in (0, 1)]
    if min(counts) < 2:
        return Discriminant([], [], [], counts[1] / sum(counts))
    means = [x[y == k].mean(axis=0) for k in (0, 1)]
    scatter = [np.cov(x[y == k], rowvar=False, bias=True) for k in (0, 1)]
    pooled = sum(c * s for c, s in zip(counts, scatter, strict=True)) / sum(counts)
    scale = np.trace(pooled) / len(pooled)
    target = (1 - to_identity) * pooled + to_identity * max(scale, 1e-9) * np.eye(len(pooled))
    factors, constants = [], []
    for c, s in zip(counts, scatter, strict=True):
        lower = np.linalg.cholesky((1 - to_pooled) * s + to_pooled * target)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(c / sum(counts)) - np.log(np.diag(lower)).sum()))
    return Discriminant(means, factors, constants, counts[1] / sum(counts), temperature)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Discriminant:
    """Fit on labelled rows outside the held-out fold; about `rows` of them, picked by a hash of the key."""
    sample = labelled_sample(docs, labels, label, key, text, FOLDS, HELD_OUT, rows)
    got = map_texts(sample, ["y"], "t", lambda texts: [pa.array([features(t) for t in texts], pa.list_(pa.float64()))], "y int, x array<double>").collect()
    # Sorted, so that sums of floats don't depend on the order of arrival.
    got = sorted((r.y, r.x) for r in got)
    return fit(np.array([x for _, x in got], float), np.array([y for y, _ in got], int))


def score(docs: DataFrame, model: Discriminant, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[bytes]) -> list:
        scores = sent.value.score(np.array([features(t) for t in texts]))
        return [pa.array(scores), pa.array((scores >= GOOD).astype(np.int32))]

    kind = docs.schema[key].dataType.simpleString()
    return map_texts(docs, [key, (fold_of(key, FOLDS) == HELD_OUT).alias("held_out")], text, run, f"{key} {kind}, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return score(docs, train(docs, labels, key=key, text=text), key, text)


def keep(docs: DataFrame, model: Discriminant, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is GOOD or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return filter_texts(docs, text, lambda texts: (sent.value.score(np.array([features(t) for t in texts])) >= GOOD).tolist())
