"""The discriminant against explicit formulas, accuracy on the held-out fold, and odd rows."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from folioscope.llm import quality_classifier as Q
from folioscope.llm.common import table

LARGE = "/root/testdata/sf0.1"


def test_score_is_the_logistic_of_log_densities():
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(0, 1, (200, 3)), rng.normal(1, 2, (100, 3))]
    y = np.r_[np.zeros(200, int), np.ones(100, int)]
    model = Q.fit(x, y, 0.3, 0.1, 2.0)
    cov = [np.cov(x[y == k], rowvar=False, bias=True) for k in (0, 1)]
    pooled = (200 * cov[0] + 100 * cov[1]) / 300
    target = 0.9 * pooled + 0.1 * np.trace(pooled) / 3 * np.eye(3)
    logs = []
    for k, share in ((0, 2 / 3), (1, 1 / 3)):
        c, d = 0.7 * cov[k] + 0.3 * target, x - x[y == k].mean(axis=0)
        logs.append(np.log(share) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d))
    assert np.allclose(model.score(x), 1 / (1 + np.exp((logs[0] - logs[1]) / 2)))


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="needs the larger tables")
def test_held_out_accuracy():
    import pandas as pd

    docs = pd.read_parquet(f"{LARGE}/documents.parquet").merge(pd.read_parquet(f"{LARGE}/labels.parquet"), on="doc_id")
    out = np.array([zlib.crc32(str(i).encode()) % 4 == 2 for i in docs.doc_id])
    x, y = np.array([Q.features(t.encode()) for t in docs.text]), docs.quality.to_numpy()
    good = Q.fit(x[~out], y[~out]).score(x[out]) >= Q.GOOD
    assert (good == y[out]).mean() > 0.98 and good[y[out] == 1].mean() > 0.98


def plain_features(text):
    """The twelve statistics by plain string work, written apart from the operator."""
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip("\x20\t\n\x0b\x0c\r")]
    n, chars, letters = max(len(words), 1), max(sum(map(len, words)), 1), max(len(re.findall("[A-Za-z]", text)), 1)
    share = lambda marks, of: (sum(text.count(m) for m in marks) / of) ** 0.5
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    dups = (len(lines) - len(set(lines))) / max(len(lines), 1)
    return [
        math.log1p(len(words)), math.log(chars / n), (len(re.findall("[A-Z]", text)) / letters) ** 0.5, share("#*$%&|<>", chars), share("!", chars), share(".,;:?'\"()-", chars), share("0123456789", chars), share("|", n),
        math.log1p(len(set(words))) / math.log1p(n), dups**0.5, math.log1p(n / max(len(lines), 1)), (len(repeated) / n) ** 0.5,
    ]


def test_query_against_plain_formulas(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    texts, good = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.quality for r in labels.collect()}
    learnt = [d for d in texts if good.get(d) is not None and zlib.crc32(str(d).encode()) % 4 != 2]
    x, y = np.array([plain_features(texts[d]) for d in learnt]), np.array([good[d] for d in learnt])
    cov = [np.cov(x[y == k], rowvar=False, bias=True) for k in (0, 1)]
    pooled = sum((y == k).sum() * cov[k] for k in (0, 1)) / len(y)
    target = (1 - Q.TO_IDENTITY) * pooled + Q.TO_IDENTITY * np.trace(pooled) / len(pooled) * np.eye(len(pooled))
    got = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    for d, text in texts.items():
        logs = []
        for k in (0, 1):
            c, off = (1 - Q.TO_POOLED) * cov[k] + Q.TO_POOLED * target, np.array(plain_features(text)) - x[y == k].mean(axis=0)
            logs.append(math.log((y == k).mean()) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * off @ np.linalg.inv(c) @ off)
        want = 1 / (1 + math.exp(min(500, max(-500, (logs[0] - logs[1]) / Q.TEMPERATURE))))
        assert abs(got[d].score - want) < 1e-6 and got[d].predicted == (want >= 0.7)


def test_fit_survives_missing_kinds():
    assert Q.fit(np.zeros((0, 12)), np.zeros(0, int)).score(np.zeros((2, 12))).tolist() == [0.5, 0.5]
    assert Q.fit(np.zeros((3, 12)), np.ones(3, int)).score(np.zeros((1, 12))).tolist() == [1.0]
    assert np.isfinite(Q.fit(np.zeros((6, 12)), np.array([0, 0, 0, 1, 1, 1])).score(np.zeros((1, 12)))).all()


def test_query_and_odd_rows(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = Q.train(docs, labels)
    got = Q.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    rows = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (None, "long " * 100_000, "c")], "doc_id bigint, text string, score string")
    odd = Q.score(rows, model).collect()
    assert len(odd) == 3 and all(np.isfinite(r.score) for r in odd) and Q.score(rows.limit(0), model).count() == 0
    assert Q.train(docs, labels.limit(0)).default == 0.5
