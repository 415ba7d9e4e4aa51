"""Folding of every character against Python's Unicode tables."""

import sys
import unicodedata

from folioscope.functions.text import fold


def plain(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def test_every_character(spark):
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    rows = spark.createDataFrame([(c, f"{chr(c)}x") for c in codes], "code int, text string").repartition(8)
    wrong = [r for r in rows.select("code", fold("text").alias("got")).toPandas().itertuples() if r.got != plain(f"{chr(r.code)}x")]
    assert not wrong, [(hex(r.code), r.got) for r in wrong[:20]]


def test_texts(spark):
    texts = ["한국어 각 가힣", "𝐀𝑩𝟘 x", "ﬁ ½ Ⅷ ㍿", "𐐀𞤀", "Ὀδυσσεύς ΑΣ", "ÁÉ́ ñ", "", "가" * 1000, "𝒳" * 3 + "각", None]
    got = [r.f for r in spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", fold("text").alias("f")).orderBy("i").collect()]
    assert got == [t if t is None else plain(t) for t in texts]
