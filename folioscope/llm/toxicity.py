"""Toxicity by maximum-scoring segments.

A token's weight is its log-odds between toxic and other labelled documents,
under an informative Dirichlet prior that follows the pooled frequencies, pulled
towards zero by a multiple of its standard deviation.  Every token also costs
DRIFT, so a text drifts down between toxic tokens, and one linear scan finds all
maximal scoring segments (Ruzzo and Tompa), each a passage.

Calibration follows extreme-value theory: excesses of segment scores over a
threshold in the other training documents have an exponential tail, so a
document of n tokens expects E = n * rate * exp(-(S - threshold) / scale)
segments of score S or more by chance.  A segment with E below SIGNIFICANT
counts for -ln(E); a document's sum of these goes through a logistic curve fitted on the
training documents.

The fit uses a bounded sample of labelled rows (SAMPLE_ROWS), which stays on the
executors: tokens are counted by partial sums, and only the weights, three tail
figures and one number for each sampled row come to the driver.  Every token
whose log-odds exceed the caution has a weight, and every token of every text is
scored.

Defined results: null and empty texts, and those without words, have no segments
and the lowest score.  Null labels aren't learned from; without labels of both
kinds all scores are the share of toxic labels, or 0.  Repeated rows each get a
row and are learned from once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fold_of, labelled_sample, map_texts
from .decontaminate import words_of

#: Labelled rows that the fit uses, about.
SAMPLE_ROWS = 10_000
#: Prior mass as a share of the pooled tokens, standard deviations that a weight must exceed, and the cost of a token.
PRIOR, CAUTION, DRIFT = 0.1, 1.5, 0.25
#: Segments expected less often than this by chance are significant.
SIGNIFICANT = 0.05
FOLDS, HELD_OUT, TOXIC = 5, 0, 0.5


def segments(tokens: list[bytes], table: dict[bytes, float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first token, end, score), in linear time.

    Candidates lie on a stack.  Each keeps a link to the nearest one before it
    whose sum before its start is lower, so a search steps over those that an
    earlier search has passed, and passes each of them once in all.
    """
    get = table.get
    found = [(i, w) for i, t in enumerate(tokens) if (w := get(t)) is not None]
    if not any(w > drift for _, w in found):
        return []
    # Tokens without a weight only cost, so the scan steps over them.
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, link
    total, at = 0.0, 0
    for i, w in found:
        total -= drift * (i - at)
        low, total, at = total, total + w - drift, i + 1
        if w <= drift:
            continue
        start, j = i, len(stack) - 1
        while j >= 0:
            if stack[j][2] >= low:
                j = stack[j][4]
            elif stack[j][3] >= total:
                break
            else:
                start, _, low, _, link = stack[j]
                del stack[j:]
                j = link
        stack.append((start, i + 1, low, total, j))
    return [(a, b, high - low) for a, b, low, high, _ in stack]


@dataclass(frozen=True)
class Model:
    table: dict[bytes, float]
    threshold: float
    rate: float
    scale: float
    intercept: float
    slope: float

    def expected(self, n: int, score: float) -> float:
        """Segments of this score or more that a text of n tokens has by chance."""
        return n * self.rate * exp(-max(-600.0, min(600.0, (score - self.threshold) / self.scale)))

    def evidence(self, n: int, scores: list[float]) -> float:
        """What the significant ones among segment scores count for."""
        found = (self.expected(n, s) for s in scores)
        return sum(min(600.0, -log(max(e, 1e-260))) for e in found if e < SIGNIFICANT)

    def passages(self, tokens: list[bytes]) -> list[tuple[int, int, float, float]]:
        """Significant segments: (first token, end, score, expected number)."""
        n = len(tokens)
        return [(a, b, s, e) for a, b, s in segments(tokens, self.table) if (e := self.expected(n, s)) < SIGNIFICANT]

    def judge(self, tokens: list[bytes]) -> tuple[float, int]:
        """Score and number of passages, by one scan."""
        scores = [s for *_, s, _ in self.passages(tokens)]
        z = self.intercept + self.slope * log(1 + self.evidence(len(tokens), scores))
        return 1 / (1 + exp(-max(-500.0, min(500.0, z)))), len(scores)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope by Newton steps with a small ridge."""
    design, b = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        step = np.linalg.solve((design.T * (p * (1 - p))) @ design + ridge * np.eye(2), design.T @ (y - p) - ridge * b)
        b = b + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def weights(sample: DataFrame) -> dict[bytes, float]:
    """Shrunk log-odds of tokens in (y, t) rows; tokens of no clear side are left out.

    A document counts a token once, or one that repeats it would rule.
    """
    own = map_texts(sample, ["y"], "t", lambda texts: [pa.array([list(set(words_of(t))) for t in texts], pa.list_(pa.binary()))], "y int, words array<binary>")
    counts = checkpointed(own.select("y", F.explode("words").alias("token")).groupBy("token").agg(F.sum(1 - F.col("y")).alias("c0"), F.sum("y").alias("c1")))
    totals = counts.agg(F.sum("c0"), F.sum("c1")).first()
    n0, n1 = (max(1, n or 0) for n in totals)
    mass = PRIOR * (n0 + n1)
    a = F.lit(mass / (n0 + n1)) * (F.col("c0") + F.col("c1"))
    side = lambda c, n: F.log((F.col(c) + a) / (F.lit(n + mass) - F.col(c) - a))
    odds: Column = side("c1", n1) - side("c0", n0)
    caution = CAUTION * F.sqrt(1 / (F.col("c1") + a) + 1 / (F.col("c0") + a))
    clear = counts.select("token", odds.alias("odds"), (F.abs(odds) - caution).alias("w")).where("w > 0").select("token", (F.signum("odds") * F.col("w")).alias("w"))
    return {bytes(r.token): r.w for r in clear.toLocalIterator()}


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the bounded sample, which never leaves the executors."""
    sample = labelled_sample(docs, labels, label, key, text, FOLDS, HELD_OUT, rows)
    kinds = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        share = kinds.get(1, 0) / max(1, sum(kinds.values()))
        return Model({}, 1.0, 1.0, 1.0, log(max(share, 1e-9) / max(1 - share, 1e-9)), 0.0)
    sent = sample.sparkSession.sparkContext.broadcast(weights(sample))

    def scan(texts: list[bytes]) -> list:
        per = [words_of(t) for t in texts]
        return [pa.array([len(p) for p in per], pa.int64()), pa.array([[s for *_, s in segments(p, sent.value)] for p in per], pa.list_(pa.float64()))]

    scanned = checkpointed(map_texts(sample, ["y"], "t", scan, "y int, n bigint, scores array<double>"))
    model = _tail(sent.value, scanned.where("y = 0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [log(1 + model.evidence(n, s)) for n, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.float64())], names=["y", "x"])

    # Sorted, so that sums of floats don't depend on the order of arrival.
    y, x = np.array(sorted(tuple(r) for r in scanned.mapInArrow(run, "y int, x double").collect()), float).T
    intercept, slope = _logistic(x, y)
    return Model(model.table, model.threshold, model.rate, model.scale, intercept, slope)


def _tail(table: dict[bytes, float], others: DataFrame) -> Model:
    """The exponential tail of segment scores in the other documents, (n, scores) rows."""
    n = others.agg(F.sum("n")).first()[0] or 0
    scores = others.select(F.explode("scores").alias("s"))
    threshold = scores.agg(F.percentile("s", F.lit(0.5))).first()[0]
    threshold = 1.0 if threshold is None else threshold
    # Decimals, whose sum doesn't depend on the order.
    over = scores.where(F.col("s") >= threshold).agg(F.count("*"), F.sum((F.col("s") - threshold).cast("decimal(38,12)"))).first()
    count, excess = over[0], float(over[1] or 0)
    # One more segment with an excess of one keeps both figures positive.
    return Model(table, threshold, (count + 1) / (n + 1), (excess + 1) / (count + 1), 0.0, 1.0)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted, n_passages) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[bytes]) -> list:
        model = sent.value
        judged = [model.judge(words_of(t)) for t in texts]
        return [pa.array([s for s, _ in judged], pa.float64()), pa.array([int(s >= TOXIC) for s, _ in judged], pa.int32()), pa.array([n for _, n in judged], pa.int64())]

    kind = docs.schema[key].dataType.simpleString()
    return map_texts(docs, [key, (fold_of(key, FOLDS) == HELD_OUT).alias("held_out")], text, run, f"{key} {kind}, held_out boolean, score double, predicted int, n_passages bigint")


def passages(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, first_word, end_word, score, expected) of every significant passage."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    found = map_texts(docs, [key], text, lambda texts: [pa.array([[{"first_word": a, "end_word": b, "score": s, "expected": e} for a, b, s, e in sent.value.passages(words_of(t))] for t in texts], pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])))], f"{key} {docs.schema[key].dataType.simpleString()}, found array<struct<first_word:bigint,end_word:bigint,score:double,expected:double>>")
    return found.select(key, F.inline("found"))
