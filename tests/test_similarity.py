"""The alignment's first gap against the standard library's whole alignment, and the best of many copies against all pairs."""

import random
from difflib import SequenceMatcher

import pytest

from folioscope.functions import similarity as S
from folioscope.operators import compare as K


def whole(a, b):
    return next((tuple(x[1:]) for x in SequenceMatcher(None, a, b).get_opcodes() if x[0] != "equal"), None)


def some_text(rng, kind, n):
    if kind == "few":
        return "".join(rng.choice("abc") for _ in range(n))
    if kind == "many":
        return "".join(chr(97 + int(rng.paretovariate(0.6)) % 150) for _ in range(n))
    return " ".join("".join(rng.choice("eeetaoinsrhldcu") for _ in range(rng.randint(1, 8))) for _ in range(n // 5 + 1))[:n]


@pytest.mark.parametrize("kind", ["few", "many", "words"])
def test_first_gap(kind):
    rng = random.Random(kind)
    for _ in range(500):
        a = some_text(rng, kind, rng.choice((0, 1, 5, 40, 199, 200, 450, 900)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.choice((0, 1, 3, 40))] = some_text(rng, kind, rng.choice((0, 1, 4, 30)))
        b = "".join(b) if rng.random() < 0.7 else some_text(rng, kind, rng.choice((0, 7, 300)))
        a, b = rng.choice(((a, b), (b, a)))
        assert S.first_gap(a, b) == whole(a, b)


def test_long_texts_are_compared_whole():
    rng = random.Random(8)
    a = some_text(rng, "many", 200_000)
    b = a[:150_000] + "OTRA" + a[150_004:]
    assert 0.999 < S.ratio(a, b) < 1 and S.ratio(a, a) == 1
    assert "OTRA" in S.difference(a, b)["right"] and S.difference(a, a) == {"left": None, "right": None}
    assert S.first_gap(a[:3000], b[2:3300]) == whole(a[:3000], b[2:3300])


def pairs(left, right):
    best = None
    for i, a in left:
        for j, b in right:
            r = (-S.ratio(a, b), i, j)
            best = r if best is None or r < best else best
    return best and (-best[0], best[1], best[2])


def test_best_of_many_copies(spark):
    rng = random.Random(5)
    groups = {}
    for key in ("near", "far", "lengths", "few", "long"):
        base = some_text(rng, "words", 9000 if key == "long" else 120)
        make = lambda: some_text(rng, "words", rng.randint(1, 400) if key == "lengths" else rng.randint(80, 160))  # noqa: E731, B023
        n = 3 if key == "few" else 12
        left, right = [(i, make()) for i in range(n)], [(i, make()) for i in range(n + 2)]
        if key in ("near", "long"):
            left[5], right[7] = (5, base), (7, base[:40] + "x" + base[41:])
        groups[key] = left, right
    groups["left only"] = [(0, "a")], []
    rows = lambda side: [(k, i, t) for k, g in groups.items() for i, t in g[side]]
    a, b = spark.createDataFrame(rows(0), "key string, i long, a string"), spark.createDataFrame(rows(1), "key string, j long, b string")
    got = {r.key: ((r.ratio, r.i, r.j), r.compared) for r in K.best_pairs(a, b, ["key"]).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: pairs(*g) for k, g in groups.items() if g[1]}
    # A near pair settles its key at once; few pairs are all compared.
    assert got["near"][1] < 12 * 14 / 10 and got["few"][1] == 15


def test_a_thousand_copies(spark):
    a = spark.range(1000).selectExpr("'nuevo' AS key", "id AS i", "concat(repeat(cast(id AS string), 1 + id % 9), ' texto ', repeat('palabra ', cast(id % 13 AS int))) AS a")
    b = spark.range(1000).selectExpr("'nuevo' AS key", "id AS j", "if(id = 700, repeat('zyx ', 40), concat(repeat('=', cast(id % 50 AS int)), id * 7919)) AS b")
    same = spark.createDataFrame([("nuevo", 5000, "zyx " * 39 + "zyw ")], "key string, i long, a string")
    row = K.best_pairs(a.unionByName(same), b, ["key"]).first()
    assert (row.i, row.j) == (5000, 700) and row.ratio > 0.98 and row.compared < 1000
