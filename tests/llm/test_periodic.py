"""Runs against a search of all periods and places."""

import hashlib
import random
import zlib

import pytest

from folioscope.llm import periodic as P
from folioscope.llm import queries as Q
from folioscope.llm.common import table


def brute(words, least=24, fold=3):
    n, seen = len(words), {}
    for p in range(1, n // fold + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            # Ascending periods, so the first that has a stretch is its smallest.
            if j - i + p >= max(least, fold * p):
                seen.setdefault((i, j + p), p)
            i = j + 1
    return sorted((a, b - a, p) for (a, b), p in seen.items())


def some_words(rng):
    n, k = rng.choice((0, 23, 24, 30, 60, 150, 400)), rng.choice((1, 2, 3, 50))
    w = [b"%d" % rng.randrange(k) for _ in range(rng.randrange(n + 1))]
    for _ in range(rng.randrange(6) if w else 0):
        a, p = rng.randrange(len(w)), rng.randint(1, max(1, len(w) // 4))
        for i in range(a, min(len(w), a + rng.randint(p, 6 * p))):
            w[i] = w[a + (i - a) % p]
    return w * rng.choice((1, 1, 1, 3))


@pytest.mark.parametrize("least, fold", [(24, 3), (4, 3), (10, 4)])
def test_against_all_places(least, fold):
    rng = random.Random(least)
    for _ in range(400):
        w = some_words(rng)
        assert P.runs(w, least, fold) == brute(w, least, fold)


def test_overlapping_repeats():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 600:
        a, b = b, b + a
    assert P.runs(b) == brute(b)
    blocks = [b"%d" % (i // 24 % 3) for i in range(500)]
    assert P.runs(blocks) == brute(blocks)
    nested = ([b"x"] * 30 + [b"y"]) * 5 + [b"z"] + ([b"p", b"q"] * 15 + [b"r"]) * 4
    assert P.runs(nested) == brute(nested)


def test_long_texts_stay_quick():
    assert P.runs([b"a"] * 400_000) == [(0, 400_000, 1)]
    assert P.runs([b"a", b"b"] * 200_000) == [(0, 400_000, 2)]
    assert P.runs([b"%d" % (i % 100_000) for i in range(350_000)]) == [(0, 350_000, 100_000)]
    assert P.runs([b"%d" % i for i in range(400_000)]) == []


def test_strongest_and_kept():
    assert P.strongest([]) is None
    assert P.strongest([(0, 24, 8), (5, 30, 10), (40, 33, 11)]) == (0, 24, 8)
    assert P.strongest([(0, 24, 8), (5, 31, 10)]) == (5, 31, 10)
    assert P.kept(6, [(1, 4, 2)]).tolist() == [True, True, True, False, False, True]
    with pytest.raises(ValueError):
        P.runs([b"a"], fold=2)


def test_rows(spark):
    repeated = "a b c " * 20
    rows = [(1, repeated), (1, repeated), (2, None), (3, ""), (None, "x " * 24), (4, " é\x1c " * 30), (5, "one two")]
    frame = spark.createDataFrame([(k, t, 9, "y") for k, t in rows], "doc_id int, text string, runs int, collapsed string")
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed) for r in P.periodic_runs(frame).collect())
    assert got == sorted(
        [("1", 60, [(0, 60, 3)], (0, 60, 3), "a b c")] * 2
        + [("2", 0, [], None, ""), ("3", 0, [], None, ""), ("None", 24, [(0, 24, 1)], (0, 24, 1), "x"), ("4", 30, [(0, 30, 1)], (0, 30, 1), " é\x1c"), ("5", 2, [], None, "one two")]
    )
    assert P.periodic_runs(frame.limit(0)).count() == 0


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark, sf):
    got = {r.doc_id: r for r in Q.QUERIES["op12_periodic_runs"](spark, sf).collect()}
    docs = [r for r in table(spark, sf, "documents").collect() if len((r.text or "").split(" ")) < 1500]
    assert len(docs) > 100
    for row in docs:
        w = (row.text or "").encode().split()
        h, n = zlib.crc32(str(row.doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute(w)
        out = [True] * n
        for s, length, q in found:
            out[s + q : s + length] = [False] * (length - q)
        top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        want = (len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2], digest("".join(f"{a},{b},{c}\n" for a, b, c in found)), digest(b" ".join(x for x, y in zip(w, out, strict=True) if y).decode()))
        assert tuple(got[row.doc_id])[1:] == want
