"""The statistics and verdicts against brute force, and the order of the cascade."""

import random
import re

import numpy as np

from folioscope.llm import quality_rules as R
from folioscope.llm.common import table

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    dups = sum(x in lines[:i] for i, x in enumerate(lines))
    chars, symbols = sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>")
    upper, letters = len(re.findall("[A-Z]", text)), len(re.findall("[A-Za-z]", text))
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    kept = not (failed or 10 * symbols > chars or 100 * dups > 50 * len(lines) or chars > 20 * len(words) or (100 * upper > 70 * letters and letters >= 10))
    return len(words), chars, symbols, dups, len(hit), failed, kept


def test_query(spark, sf):
    docs = table(spark, sf, "documents").where("n_chars < 3000")
    got = {r.doc_id: tuple(r)[1:] for r in R.statistics(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}
    assert {x[-1] for x in got.values()} == {True, False}


def test_random_texts():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice("ab é\n\t|A　\x1c") for _ in range(rng.randrange(80)))
        s = R.Stats(text.encode())
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == brute(text)[:5]


def test_many_distinct_words_are_ranked_again():
    words = [b"%d" % i for i in range(20_000)]
    assert R.repeated_words(words) == 0
    assert R.repeated_words(words + words[5:11]) == 12


def test_order_by_rejection_per_cost():
    verdicts = np.array([[1, 1, 0], [1, 1, 0], [0, 0, 1], [0, 0, 0]], bool)
    assert R.cascade_order([1.0, 0.1, 0.5], verdicts) == [1, 2, 0]
    assert R.cascade_order([0.0, 0.0], np.zeros((0, 2), bool)) == [0, 1]


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (None, "w " * 200_000, "z")], "doc_id bigint, text string, kept string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_repeat_words, r.base_failed, r.kept) for r in R.statistics(rows).collect())
    assert got == [(0, 200_000, 200_000, True, False), (1, 0, 0, True, False), (1, 0, 0, True, False)]
    assert R.statistics(rows.limit(0)).count() == 0
    by = {r.doc_id: r.rejected_by for r in R.cascade(rows, ["doc_id"]).collect()}
    assert by[1] == "few_words" and by[None] == "repeated_words"
