"""Curve, order and cuts of the shards against plain Python."""

import zlib
from collections import Counter

import numpy as np

from folioscope.llm import sharding as S
from folioscope.llm.common import table


def test_curve_visits_neighbouring_cells():
    for bits, n in ((3, 2), (3, 3), (2, 4)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), axis=-1).reshape(-1, n)
        index = S.hilbert_index(grid, bits)
        assert sorted(index) == list(range(1 << bits * n))
        path = grid[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def brute(rows, n_shards, bits=S.BITS):
    """rows: (key, lang, source, text)."""
    own = []
    for key, lang, source, text in rows:
        raw = (text or "").encode()
        size = len(raw) + 8
        b = size.bit_length()
        own.append((key, lang or "", source or "", size, zlib.crc32(raw), b * 4 + (size >> (b - 3) & 3)))
    cells = []
    for at in (1, 2, 5):
        known = {v: i for i, v in enumerate(sorted({r[at] for r in own}))}
        cells.append([known[r[at]] * (1 << bits) // len(known) for r in own])
    index = S.hilbert_index(np.array(cells).T, bits)
    return [(r[0], r[3], r[4], int(h)) for r, h in zip(own, index, strict=True)]


def check(got, want, n_shards):
    assert sorted((r.doc_id or -1, r.size, r.text_crc32, r.hilbert) for r in got) == sorted((k or -1, *x) for k, *x in want)
    by = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in by] == sorted(r.hilbert for r in got)
    total, before = sum(r.size for r in got), 0
    slots = Counter()
    for r in by:
        assert r.shard == (2 * before + r.size) * n_shards // (2 * total)
        assert r.slot == slots[r.shard] and r.law == "bytes" and r.grown_shard is None
        slots[r.shard] += 1
        before += r.size


def test_query(spark, sf):
    docs = table(spark, sf, "documents")
    want = brute([(r.doc_id, r.lang, r.source, r.text) for r in docs.collect()], 24)
    got = S.shards(docs, 24).collect()
    check(got, want, 24)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    share = sum(sizes.values()) / 24
    assert max(abs(x - share) for x in sizes.values()) <= max(r.size for r in got)


def test_odd_rows(spark):
    rows = [(1, None, "a", "same", 0), (1, None, "a", "same", 0), (2, "en", None, None, 0), (None, "en", "b", "", 0), (3, "de", "b", "é" * 5000, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string, shard int")
    check(S.shards(docs, 3).collect(), brute([r[:4] for r in rows], 3), 3)
    assert S.shards(docs.limit(0), 3).count() == 0


def test_many_values_of_a_dimension(spark, sf, monkeypatch):
    """Beyond what is broadcast, ordinals are joined, hot values apart."""
    from folioscope.llm import common

    monkeypatch.setattr(S, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    docs = table(spark, sf, "documents")
    check(S.shards(docs, 24).collect(), brute([(r.doc_id, r.lang, r.source, r.text) for r in docs.collect()], 24), 24)
