"""Plans by checking every window, sums against all subsets, and pieces against the tokenizers library."""

import itertools
import random
import zlib

import numpy as np
import pytest

from folioscope.llm import packing as P
from folioscope.llm import queries as Q
from folioscope.llm.common import table, tokenizer_path


def test_best_sums():
    rng = random.Random(1)
    for _ in range(300):
        counts = {rng.randint(1, 20): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}
        target = rng.randint(0, 40)
        sums = {sum(k * n for k, n in zip(counts, uses, strict=True)) for uses in itertools.product(*(range(n + 1) for n in counts.values()))}
        best, need = P.fill(sorted(counts.items(), reverse=True), target)
        assert best == max(s for s in sums if s <= target) == sum(k * n for k, n in need.items())
        assert all(n <= counts[k] for k, n in need.items())


def check_windows(windows, capacity):
    """Pieces fill each window without gaps, and none needs padding."""
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at < capacity and at & (at - 1) == 0


@pytest.mark.parametrize("capacity", [8, 64, 100])
def test_plans(capacity):
    rng = random.Random(capacity)
    for _ in range(150):
        counts = {rng.randint(1, capacity - 1): rng.choice((1, 2, 3, 10, 100)) for _ in range(rng.randint(0, 12))}
        plan = P.Plan(dict(counts), capacity)
        lengths = [k for k in sorted(counts) for _ in range(counts[k])]
        covered, windows = [[] for _ in lengths], {}
        for level in plan.places(np.arange(len(lengths))):
            for i, at, length, sequence, offset in zip(*(v.tolist() for v in level), strict=True):
                covered[i].append((at, length))
                windows.setdefault(sequence, []).append((offset, length))
        for own, whole in zip(covered, lengths, strict=True):
            at = 0
            for start, length in sorted(own):
                assert start == at
                at += length
            assert at == whole
        assert plan.cut_rows == sum(len(x) > 1 for x in covered)
        assert sorted(windows) == list(range(plan.sequences))
        check_windows(windows, capacity)


def test_plans_stay_small():
    rng = random.Random(2)
    plan = P.Plan({k: int(1e7 * rng.paretovariate(1)) for k in range(1, 2048)})
    assert sum(len(level["low"]) for level in plan.levels) < 20_000
    # Only one length, so every window needs a cut.
    assert P.Plan({1100: 5000}).sequences < 5000 * 1100 / 2048 + 11


def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def pattern():
    import public_tokenizers

    return public_tokenizers.PATTERN


def test_ids_are_the_librarys():
    rng = random.Random(3)
    pool = " \n\t 　\x1c a'sé語1., <|endoftext|>\U0001f600"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["", "it's  <|endoftext|>\n\n x", "a" * 3000]
    by = P.encoder(tokenizer_path("byte_bpe_50k.json"), pattern())
    for text, want in zip(texts, library().encode_batch(texts, add_special_tokens=False), strict=True):
        assert by(text) == want.ids


def check_pieces(rows, docs, capacity):
    """docs: (key, text) rows; equal keys have equal texts here."""
    by, windows = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    check_windows(windows, capacity)
    encode = library()
    for key, text in dict(docs).items():
        ids = [*encode.encode(text or "", add_special_tokens=False).ids, 1]
        copies = sum(k == key for k, _ in docs)
        covered = np.zeros(len(ids), int)
        for r in by.pop(key):
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
            covered[r.start : r.start + r.length] += 1
        assert (covered == copies).all()
    assert not by


def test_rows(spark):
    rng = random.Random(5)
    texts = [None, "", "one", " ".join("word%d" % rng.randrange(99) for _ in range(4000))] + [" ".join("abc" for _ in range(rng.randrange(90))) for _ in range(60)]
    docs = [*enumerate(texts), (None, "no key"), (7, texts[7]), (7, texts[7])]
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id bigint, text string, f int, places string")
    path = tokenizer_path("byte_bpe_50k.json")
    for capacity in (16, 2048):
        check_pieces(P.pack(frame, path, pattern(), capacity=capacity).collect(), docs, capacity)
        assert P.pack(frame.limit(0), path, pattern(), capacity=capacity).count() == 0
    # Equal lengths, so most windows need cuts; the cuts are joined instead of broadcast.
    same = [(i, "abc abc abc") for i in range(200)]
    check_pieces(P.pack(spark.createDataFrame(same, "doc_id bigint, text string"), path, pattern(), capacity=6, cut_rows=0).collect(), same, 6)


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    check_pieces(Q.QUERIES["op13_packing"](spark, sf).collect(), docs, 2048)
