"""Chunk tables against the library over whole texts."""

import hashlib
import random
import struct

import pytest

from folioscope.llm import sentencepiece as S
from folioscope.llm.common import table, tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")


def whole(text):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = sp.encode(text, add_bos=True, add_eos=True)
    return ids, sp.decode(ids)


TRICKY = ["", " ", "  ", "a", " a", "a ", "a  b", "   a   b   ", "▁", "▁a", "a ▁ b", "a▁▁b", "\n\n x\ty", "<s> </s> <unk>", "é　ß ü", "\x00", "日本語 テスト", "😀 😀😀", "a" * 5000, " " * 100 + "x", "<0x0A>", "▁" * 40]


def test_model_is_separable():
    assert S.codec(MODEL).separable


@pytest.mark.parametrize("text", TRICKY)
def test_equals_library(text):
    [(ids, decoded)] = S.codec(MODEL).encode([text.encode()])
    want, back = whole(text)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want
    assert bytes(decoded) == back.encode()


def test_random_texts_and_small_table(monkeypatch):
    monkeypatch.setattr(S, "TABLE_ENTRIES", 5)
    coder, rng = S.ChunkCodec(MODEL), random.Random(7)
    for _ in range(60):
        texts = ["".join(rng.choice("ab  ▁\né.,$<>") for _ in range(rng.randrange(40))) for _ in range(rng.randrange(9))] + rng.sample(TRICKY, rng.randrange(4))
        got = [(i, bytes(d)) for i, d in coder.encode([t.encode() for t in texts])]
        assert len(coder.table) <= 5 and len(got) == len(texts)
        for text, (ids, decoded) in zip(texts, got, strict=True):
            want, back = whole(text)
            assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want and bytes(decoded) == back.encode()


def test_each_chunk_of_a_batch_is_segmented_once():
    coder, seen = S.ChunkCodec(MODEL), []
    library = coder.sp

    class Watched:
        def __getattr__(self, name):
            return getattr(library, name)

        def encode(self, words, **options):
            seen.extend(words)
            return library.encode(words, **options)

    coder.sp = Watched()
    list(coder.encode([b"one two one", b"two  three", b"", b"one"]))
    list(coder.encode([b"three four"]))
    assert sorted(seen) == ["four", "one", "three", "two", "▁three"]


def test_query(spark, sf):
    docs = table(spark, sf, "documents")
    got = {r.doc_id: r for r in S.encode_digests(docs, MODEL).collect()}
    for row in docs.collect():
        ids, decoded = whole(row.text)
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (None, "b", "z")], "doc_id bigint, text string, ids string")
    got = sorted((r.doc_id or 0, r.decoded, list(r.ids)) for r in S.encode(rows, MODEL).collect())
    assert got == [(0, "b", [1, 287, 2]), (1, "", [1, 2]), (1, "", [1, 2])]
    assert S.encode_digests(rows.limit(0), MODEL).count() == 0


def test_very_long_texts(spark):
    texts = [" ".join(f"word{i % 7919} ▁é\n" for i in range(150_000)), "日本語" * 100_000, "x" * 300_000 + " y"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in S.encode_digests(rows, MODEL).collect():
        ids, back = whole(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
