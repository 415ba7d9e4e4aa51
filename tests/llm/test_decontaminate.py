"""Winnowing against a plain search for windows."""

import hashlib
import random
import re

from folioscope.llm import decontaminate as D
from folioscope.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else []:
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i : i + size]))
                if own is not None:
                    hit |= set(range(i, i + size))
                    found |= {str(x) for x in own if x is not None}
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def rows(frame):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect()}


def test_query(spark, sf):
    docs, benchmark = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    got = rows(D.decontaminate(docs, benchmark))
    assert got == want and any(x[4] for x in got.values())


def test_small_alphabet_short_items_and_blocks(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("aBc") for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(60)] + [(100, None), (101, ""), (102, "É, a-B!c a b c 1 2 3 4 5")]
    items = [(i, text(rng.choice([1, 4, 7, 9, 10, 12, 30]))) for i in range(12)] + [(50, None), (51, "--"), (52, "é a b c a b c 1 2 3"), (None, "3 4 5")]
    a, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert rows(D.decontaminate(a, b)) == want
    assert rows(D.decontaminate(a, b, block_rows=40)) == want
    assert rows(D.decontaminate(a, b.limit(0))) == {k: (v[0], 0, 0, hashlib.sha256(b"").hexdigest(), False) for k, v in want.items()}
    assert D.decontaminate(a.limit(0), b).count() == 0


def test_every_shared_span_has_a_fingerprint():
    rng = random.Random(1)
    for _ in range(200):
        span = [b"%d" % rng.randrange(50) for _ in range(10)]
        doc = [b"%d" % rng.randrange(50) for _ in range(rng.randrange(30))] + span + [b"%d" % rng.randrange(50) for _ in range(rng.randrange(30))]
        assert D._winnow(D._hashes(span), 10, 5)[0] in D._winnow(D._hashes(doc), 10, 5)


def test_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 9), (1, "a b c", 8), (None, "x", 7)], "doc_id bigint, text string, n_hit int")
    items = spark.createDataFrame([(5, "b c")], "item_id bigint, text string")
    for size in (1000, 0.5):
        got = sorted(((r.doc_id or 0), r.n_hit) for r in D.decontaminate(docs, items, block_rows=size if size > 1 else 1).collect())
        assert got == [(0, 0), (1, 2), (1, 2)]


def test_long_texts_and_empty_tables(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    filler = " ".join(f"w{i % 5000}" for i in range(120_000))
    docs = [(1, f"{filler} {passage} {filler}"), (2, " ".join([passage] * 3000)), (3, "w1 w2")]
    items = [(7, passage), (8, " ".join(f"q{i}" for i in range(20)))]
    a, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = {1: (240_014, 14, 1), 2: (42_000, 42_000, 1), 3: (2, 0, 0)}
    for size in (D.BLOCK_ROWS, 1):
        assert {k: v[:3] for k, v in rows(D.decontaminate(a, b, block_rows=size)).items()} == want
        assert [r.doc_id for r in D.keep(a, b, block_rows=size).collect()] == [3]
        for x, y in ((a.limit(0), b), (a.limit(0), b.limit(0))):
            assert D.decontaminate(x, y, block_rows=size).count() == 0
        assert not any(v[4] for v in rows(D.decontaminate(a, b.limit(0), block_rows=size - 2)).values())


def test_a_window_of_very_many_documents(spark, monkeypatch):
    from folioscope.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 50)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 20)
    passage, other = (" ".join(f"{x}{i}" for i in range(11)) for x in "pq")
    docs = spark.range(400).selectExpr("id AS doc_id", f"if(id % 3 = 0, '{passage} tail', if(id = 5, '{other}', 'clean words')) AS text")
    got = D.decontaminate(docs, spark.createDataFrame([(1, passage), (2, other), (3, f"{passage} more")], "item_id bigint, text string"), block_rows=1)
    assert {(r.n_hit, r.n_items): r.n for r in got.groupBy("n_hit", "n_items").count().toDF("n_hit", "n_items", "n").collect()} == {(11, 2): 134, (11, 1): 1, (0, 0): 265}
