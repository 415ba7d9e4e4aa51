"""Segments against brute force, the model against plain Python, accuracy on the held-out fold, and odd rows."""

import os
import random
import time
import zlib
from collections import Counter
from math import exp, log, sqrt

import numpy as np
import pytest

from folioscope.llm import toxicity as T
from folioscope.llm.common import table

LARGE = "/root/testdata/sf0.1"


def brute_segments(scores, offset=0):
    """The maximal segments by their definition: the best one, then both sides."""
    best, at = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-12:
                best, at = total, (i, j + 1)
    if at is None:
        return []
    i, j = at
    return [*brute_segments(scores[:i], offset), (offset + i, offset + j, best), *brute_segments(scores[j:], offset + j)]


def test_segments_against_brute_force():
    rng = random.Random(9)
    table_ = {b"t": 3.017, b"u": 1.509, b"c": -1.731, b"d": -0.203}
    for _ in range(600):
        tokens = [rng.choice([b"t", b"u", b"c", b"d", b"x", b"y"]) for _ in range(rng.randrange(40))]
        want = brute_segments([table_.get(t, 0.0) - T.DRIFT for t in tokens])
        got = T.segments(tokens, table_)
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(got, want))


@pytest.mark.parametrize("gap", [19, 7, 1])
def test_segments_take_linear_time(gap):
    words = ([b"t"] + [b"x"] * gap) * (320_000 // (gap + 1))
    began = time.perf_counter()
    found = T.segments(words, {b"t": 1.7})
    assert time.perf_counter() - began < 1 and found


def plain_model(rows):
    """The same model from (label, text) rows in one process, written apart from the operator."""
    tokens = [(y, T.words_of(t.encode())) for y, t in rows]
    counts = [Counter(w for y, ws in tokens if y == k for w in set(ws)) for k in (0, 1)]
    n0, n1 = (sum(c.values()) for c in counts)
    alpha = {w: T.PRIOR * (counts[0][w] + counts[1][w]) for w in counts[0] | counts[1]}
    mass = T.PRIOR * (n0 + n1)
    weights = {}
    for w, a in alpha.items():
        c0, c1 = counts[0][w] + a, counts[1][w] + a
        odds = log(c1 / (n1 + mass - c1)) - log(c0 / (n0 + mass - c0))
        size = abs(odds) - T.CAUTION * sqrt(1 / c1 + 1 / c0)
        if size > 0:
            weights[w] = size if odds > 0 else -size
    chance = [s for y, ws in tokens if not y for *_, s in T.segments(ws, weights)]
    middle = float(np.median(chance))
    over = [s - middle for s in chance if s >= middle]
    rate, scale = (len(over) + 1) / (sum(len(ws) for y, ws in tokens if not y) + 1), (sum(over) + 1) / (len(over) + 1)

    def strength(ws):
        e = [len(ws) * rate * exp(-(s - middle) / scale) for *_, s in T.segments(ws, weights)]
        return log(1 + sum(min(600, -log(max(x, 1e-260))) for x in e if x < T.SIGNIFICANT))

    b, m = T._logistic(np.array([strength(ws) for _, ws in sorted(tokens)]), np.array([y for y, _ in sorted(tokens)], float))
    return weights, lambda text: 1 / (1 + exp(-(b + m * strength(T.words_of((text or "").encode())))))


def test_query_against_plain_python(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = T.train(docs, labels)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [(toxic[r.doc_id], r.text) for r in docs.collect() if r.doc_id in toxic and zlib.crc32(str(r.doc_id).encode()) % 5]
    weights, score = plain_model(rows)
    assert set(model.table) == set(weights) and all(abs(model.table[w] - x) < 1e-9 for w, x in weights.items())
    got = {r.doc_id: r for r in T.score(docs, model).collect()}
    for r in docs.collect():
        assert abs(got[r.doc_id].score - score(r.text)) < 1e-6
    # The segments that were scored are those of the definition.
    for r in docs.limit(30).collect():
        words = T.words_of(r.text.encode())[:60]
        want = brute_segments([model.table.get(w, 0.0) - T.DRIFT for w in words])
        assert [x[:2] for x in T.segments(words, model.table)] == [x[:2] for x in want]


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="needs the larger tables")
def test_held_out_accuracy(spark):
    docs, labels = table(spark, LARGE, "documents"), table(spark, LARGE, "labels")
    held = T.score(docs, T.train(docs, labels)).where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    assert sum(r.toxic == r.predicted for r in held) / len(held) > 0.97
    assert sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held) > 0.85
    assert sum(r.toxic for r in held if r.predicted) / sum(r.predicted for r in held) > 0.95


def test_fit_survives_missing_kinds(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "c d", None, ""])], "doc_id bigint, text string")
    labels = lambda rows: spark.createDataFrame(rows, "doc_id bigint, toxic int, y int")
    assert T.train(docs, labels([])).judge([])[0] < 0.01
    assert T.train(docs, labels([(i, 1, 0) for i in range(4)])).judge([b"a"])[0] > 0.99
    assert T.train(docs, labels([(0, None, 0), (1, None, 0)])).table == {}


def test_repeated_keys_stay_bounded(spark):
    from pyspark.sql import functions as F

    from folioscope.llm.common import labelled_sample

    docs = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.when(F.col("id") < 5_000, "same").otherwise(F.concat(F.lit("t "), F.col("id"))).alias("text"))
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id bigint, toxic int")
    n = labelled_sample(docs, labels, "toxic", "doc_id", "text", 5, 0, 100).count()
    assert 20 < n < 400


def test_query_and_odd_rows(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = T.train(docs, labels)
    got = T.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    rows = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (None, ("moron idiot " + "fine words here " * 6) * 30_000, "c")], "doc_id bigint, text string, score string")
    odd = sorted((r.doc_id or 0, r.n_passages) for r in T.score(rows, model).collect())
    assert odd[1:] == [(1, 0), (1, 0)] and T.score(rows.limit(0), model).count() == 0
    assert T.train(docs, labels.limit(0)).table == {}
    assert T.train(docs.limit(0), labels).table == {}
    assert T.passages(docs, model).count() == sum(r.n_passages for r in got)
