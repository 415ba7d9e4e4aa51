"""SimHash, block buckets and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from folioscope.llm import graph
from folioscope.llm import simhash as S
from folioscope.llm.common import table


def brute_fingerprint(text, width=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """fps: {node: unsigned}; smallest node reachable over links of distance 3 or less."""
    left, out = sorted(fps), {}
    for start in left:
        if start in out:
            continue
        todo, out[start] = [start], start
        while todo:
            a = todo.pop()
            for b in left:
                if b not in out and (fps[a] ^ fps[b]).bit_count() <= 3:
                    out[b] = start
                    todo.append(b)
    return out


def test_query_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    got = S.near_duplicates(docs).select("doc_id", S.hex_fingerprint().alias("fingerprint"), "component_id").collect()
    want = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    parts = brute_components(want)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{f:016x}", parts[d]) for d, f in want.items()}
    assert len(set(parts.values())) < len(parts)


@pytest.mark.parametrize("bucket", [4096, 45])
def test_links_keep_connectivity(spark, bucket):
    rng = random.Random(5)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(40)}
    signed = {S._signed(f): f for f in fps}
    frame = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    edges = S.links(frame, bucket)
    pairs = edges.collect()
    assert all((signed[e.u] ^ signed[e.v]).bit_count() <= 64 for e in pairs)
    roots = {r.node: r.root for r in graph.components(edges).collect()}
    want = brute_components(signed)
    assert {f: roots.get(f, f) for f in signed} == want


def test_dense_group_returns_a_star():
    base = np.int64(12345)
    fps = np.array([base ^ np.int64(1 << i) for i in range(40)] + [base], np.int64)
    u, v = S._stars(np.zeros(41, np.int64), np.zeros(41, np.int64), fps)
    assert len(u) == 40 and set(v) == {fps.min()}


def test_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5, 5), (1000, 1001), (1001, 1000)], "u bigint, v bigint")
    roots = {r.node: r.root for r in graph.components(edges).collect()}
    assert roots == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}
    assert graph.components(edges.limit(0)).count() == 0


def test_odd_rows(spark):
    long = "w " * 100_000
    rows = [(7, None, 1), (3, "", 2), (9, " \t\n", 3), (4, "A b", 4), (4, "A b", 5), (None, "a B", 6), (8, long, 7), (None, "unseen words stand here alone", 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp int")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fp, r.component_id) for r in S.near_duplicates(docs).collect())
    ab = S._signed(brute_fingerprint("a b"))
    assert [g for g in got if g[1] in (3, 7, 9)] == [(False, 3, 0, 3), (False, 7, 0, 3), (False, 9, 0, 3)]
    assert [g for g in got if g[2] == ab] == [(False, 4, ab, 4), (False, 4, ab, 4), (True, 0, ab, 4)]
    assert [g[3] for g in got if g[0] and g[2] != ab] == [None]
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_hot_keys_are_joined_apart(spark, monkeypatch):
    from folioscope.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 10)
    left = spark.range(300).selectExpr("CASE WHEN id < 200 THEN 1 ELSE id END AS k", "id AS x")
    right = left.groupBy("k").count().selectExpr("k", "k * 2 AS twice", "count AS n").where("k <> 250")
    joined = common.skew_join(left, right, "k", "n", 300)
    assert sorted(map(tuple, joined.select("k", "x", "twice").collect())) == sorted((k, x, 2 * k) for k, x in left.collect() if k != 250)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    # A hub with many leaves, and its leaves' chains.
    edges = spark.createDataFrame([(0, i) for i in range(1, 60)] + [(i, 100 + i) for i in range(1, 60)] + [(500, 501)], "u bigint, v bigint")
    roots = {r.node: r.root for r in graph.components(edges).collect()}
    assert roots == {i: 0 for i in [*range(60), *range(101, 160)]} | {500: 500, 501: 500}
    docs = spark.createDataFrame([(i, "the same words again" if i % 3 else f"text {i} of its own kind {i}") for i in range(90)], "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in S.near_duplicates(docs).collect()}
    assert got == brute_components({i: brute_fingerprint(t) for i, t in docs.collect()})
