"""Weights, noise and draws against plain Python and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb

from folioscope.llm import queries as Q
from folioscope.llm import resampling as R

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(f.encode()) % R.BUCKETS for f in [*w, *map(" ".join, zip(w, w[1:], strict=False))]]


def brute(docs, target, percent=25, least=20):
    s, t = Counter(), Counter()
    own = [(k, *features(text)) for k, text in docs]
    for _, _, f in own:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n_s + R.BUCKETS) / ((s[b] + 1) * (n_t + R.BUCKETS)))) for b in s}
    rows = []
    for k, n, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append((k, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2], r[3]))
    drawn = able[: percent * len(able) // 100]
    return sorted([(*r, i + 1) for i, r in enumerate(drawn)] + [(*r, None) for r in able[len(drawn) :]] + [(*r, None) for r in rows if r[1] < least], key=str)


def test_against_plain_python(spark):
    rng = random.Random(4)
    pool = ["A", "b", "Bc", "é", "É", "語言", "x1", "İ", "\U0001f600", *(f"w{i}" for i in range(30))]
    texts = [None, "", " \x00\x7f", "one", "A_b", "Z" * 5000 + " 7"] + ["".join(rng.choice(pool) + rng.choice(" \n\x00-@[`{\x7f  ") for _ in range(rng.randrange(60))) for _ in range(150)]
    docs = [*enumerate(texts), (None, texts[20]), (-3, texts[21]), (3, texts[3]), (30, texts[30]), (30, texts[30])]
    target = ["w1 w2 w3 w4", None, "A b Bc", "w1 w2"]
    # Other columns have the names of the operator's own.
    frame = spark.createDataFrame([(k, t, "x", 1, []) for k, t in docs], "doc_id bigint, text string, buckets string, n_words int, w array<int>")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = sorted(map(tuple, R.resample(frame, goal).collect()), key=str)
    assert got == brute(docs, target)
    assert R.resample(frame.limit(0), goal).collect() == []
    assert sorted(map(tuple, R.resample(frame, goal.limit(0), percent=100, least_words=0).collect()), key=str) == brute(docs, [], 100, 0)


def test_a_hot_score_is_split(spark):
    # Texts without features all weigh 0, so ranks go by noise and key; the draw takes a third.
    frame = spark.range(9000).selectExpr("id AS doc_id", "if(id % 3 = 0, repeat('a ', 20), concat('w', id)) AS text")
    got = R.resample(frame, frame.limit(1)).where("rank IS NOT NULL").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 751))
    assert all((-a.score, a.doc_id) < (-b.score, b.doc_id) for a, b in zip(got, got[1:], strict=False))


def test_long_text(spark):
    text = " ".join(f"W{i % 977}" for i in range(300_000))
    got = R.resample(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), spark.createDataFrame([("w5 w6",)], "text string")).first()
    assert tuple(got) == brute([(1, text)], ["w5 w6"])[0]


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    found = con.execute(Q.SQL["op11_resampling"])
    columns = [c[0] for c in found.description]
    got = Q.QUERIES["op11_resampling"](spark, sf)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, found.fetchall()))
    assert set(columns) == set(got.columns)
