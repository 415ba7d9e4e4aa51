"""Operators on small inputs with answers worked out by hand or by plain Python."""

import hashlib
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from folioscope.functions import canonical, similarity
from folioscope.functions import html as H
from folioscope.functions import text as T
from folioscope.operators import chunks as C
from folioscope.operators import cleaning as L
from folioscope.operators import compare as K
from folioscope.operators import errata as E
from folioscope.operators import gate
from folioscope.operators import gold as G
from folioscope.operators import manifest as M
from folioscope.operators import taxonomy as X
from folioscope.sources import corpus
from folioscope.streaming import ingest


def plain_fold(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).lower()


def column(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_fold_over_the_basic_plane(spark):
    codes = [c for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF and not 0xAC00 <= c <= 0xD7A3 and unicodedata.ucd_3_2_0.category(chr(c)) != "Cn"]
    texts = ["".join(map(chr, codes[i : i + 200])) for i in range(0, len(codes), 200)] + ["ﬁja 1º ½ ß ÁÉ", "plain", ""]
    got = column(spark, texts, T.fold("x"))
    wrong = [(t, g) for t, g in zip(texts, got) if g.replace("ς", "σ") != plain_fold(t).replace("ς", "σ")]
    assert not wrong


def test_small_text_functions(spark):
    assert column(spark, ["a   b\n", "\t"], T.flat("x")) == ["a b", ""]
    assert column(spark, ["parágrafo 1o. y 2° x3ox 4º"], T.fold_ordinal("x")) == ["paragrafo 1. y 2 x3ox 4"]
    assert column(spark, ["1o.", "1°", "12A..", " 3º ", "nuevo"], T.norm_key("x")) == ["1", "1", "12a", "3", "nuevo"]
    assert column(spark, ["2015Establecer", "de 1994POr", "okYa", "ABCd", "9A"], T.unglue("x")) == ["2015 Establecer", "de 1994 POr", "ok Ya", "ABCd", "9A"]
    assert column(spark, ["abab", "", "b"], T.occurrences("x", F.lit("ab"))) == [2, 0, 0]
    assert column(spark, ["ñandú _x1 ÁREA"], T.tokens("x")) == [["nandu", "_x1", "area"]]


DOCS = ["", "no heading\nat all", "preface\n# One\ntext\n## Two\n", "# Only", "x\r\n# not at a feed?\r\n", "a\u0085# b # c\n# d", "####### seven\n#none\n# ok"]


def test_chunks_lose_nothing(spark):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "id int, text string")
    parts = C.chunks(docs, "id")
    assert {r.id: r.text for r in C.reconstruct(parts, "id").collect()} == dict(enumerate(DOCS))
    assert C.lossless(docs, parts, "id").where("NOT lossless").count() == 0
    heads = [[r.heading for r in parts.where(F.col("id") == i).orderBy("chunk_no").collect()] for i in (1, 2, 3, 6)]
    assert heads == [[None], [None, "# One", "## Two"], ["# Only"], [None, "# ok"]]


def test_manifest_and_mutations(spark):
    rows = [(f"f{i:03d}.md", f"text {i}") for i in range(50)]
    seal = M.manifest(spark.createDataFrame(rows, "name string, text string"), "name")
    lines = "".join(f"{n}:{hashlib.sha256(t.encode()).hexdigest()}\n" for n, t in sorted(rows))
    assert M.set_hash(seal).first().set_hash == hashlib.sha256(lines.encode()).hexdigest()
    shuffled = M.manifest(spark.createDataFrame(random.Random(1).sample(rows, 50), "name string, text string").repartition(7), "name")
    assert M.set_hash(shuffled).first() == M.set_hash(seal).first()
    assert M.integrity_diff(shuffled, seal).count() == 0
    changed = M.manifest(spark.createDataFrame([("f000.md", "text 0!"), ("new.md", "x"), *rows[2:]], "name string, text string"), "name")
    assert {(r.filename, r.status) for r in M.integrity_diff(changed, seal).collect()} == {("f000.md", "modified"), ("f001.md", "removed"), ("new.md", "added")}


def test_sources(spark, tmp_path):
    (tmp_path / "a.md").write_bytes("añ".encode())
    (tmp_path / "b.md").write_bytes("añ".encode("latin-1"))
    (tmp_path / "c.txt").write_bytes(b"x")
    text, encoding = corpus.decode("content")
    got = {r.filename: (r.t, r.e, r.same) for r in corpus.corpus_files(spark, str(tmp_path)).select("filename", text.alias("t"), encoding.alias("e"), (corpus.encode(text, encoding) == F.col("content")).alias("same")).collect()}
    assert got == {"a.md": ("añ", "utf-8", True), "b.md": ("añ", "latin-1", True)}
    seal = spark.createDataFrame([("a.md", "00", 3)], "filename string, sha256 string, bytes bigint")
    corpus.write_manifest(seal, str(tmp_path / "out"), "2026-01-01", "x")
    assert spark.read.parquet(str(tmp_path / "out/files")).count() == 1
    (tmp_path / "m.json").write_text('{"files": {"a.md": {"sha256": "00", "bytes": 3}}}')
    assert corpus.read_manifest(spark, str(tmp_path / "m.json")).first() == ("a.md", "00", 3)
    corpus.write_artifact(spark.createDataFrame([(2, "b"), (1, "a")], "line_no int, text string"), str(tmp_path / "r/x.txt"))
    assert (tmp_path / "r/x.txt").read_text() == "a\nb\n"
    stream = ingest.arriving_violations(ingest.arriving_files(spark, str(tmp_path)), seal)
    run = stream.writeStream.format("memory").queryName("arrived").trigger(availableNow=True).start()
    run.awaitTermination()
    assert {tuple(r) for r in spark.table("arrived").collect()} == {("a.md", "modified"), ("b.md", "added")}


def test_clean_order(spark):
    lines = ["**Concordancias:**", "gone", "**ARTÍCULO 1.** *Uno* [x](http://y) ![i](u)", "| a | | b |", "|---|:--:|", "Ver más aquí", "Auto: 7", "12 13", "ley 142 de 1994 9", "texto del proyecto de ley anterior", "gone too", "# Título I"]
    rows = spark.createDataFrame([("d", i + 1, x) for i, x in enumerate(lines)], "d string, line_no bigint, line string")
    assert [r.line for r in L.clean(rows, "d").orderBy("line_no").collect()] == ["ARTÍCULO 1. Uno x !i", "a b", "Título I"]


def test_compare_states(spark):
    a = spark.createDataFrame([("d", "1", 0, "igual texto"), ("d", "2", 0, "b" * 300 + "x"), ("d", "3", 0, "una cosa"), ("d", "4", 0, "sin par"), ("d", "5", 0, "otra"), ("d", "5", 1, "copia")], "d string, key string, copy_no bigint, text string")
    b = spark.createDataFrame([("d", "1", 0, "IGUAL  texto".replace("  ", " ")), ("d", "2", 0, "b" * 300 + "y"), ("d", "3", 0, "muy distinto"), ("d", "5", 0, "Copia"), ("d", "9", 0, "extra")], "d string, key string, copy_no bigint, text string")
    report = K.compare(a, b, "d")
    assert {r.key: r.state for r in report.collect()} == {"1": "exacto", "2": "casi", "3": "divergente", "4": "ausente_en_fuente", "5": "exacto"}
    docs = spark.createDataFrame([("d",), ("empty",)], "d string")
    assert {r.d: (r.divergent, r.verdict) for r in K.summary(report, docs, "d").collect()} == {"d": (2, "NO_VERIFICADA"), "empty": (0, "SIN_ARTICULOS")}
    assert K.summary(report, docs, "d", strict=False).where("d = 'empty'").first().verdict == "VERIFICADA"


def test_ratio_and_difference():
    from difflib import SequenceMatcher

    rng = random.Random(2)
    a = "".join(rng.choice("abcde ") for _ in range(500))
    b = a[:200] + "zz" + a[210:]
    assert similarity.ratio(a, b) == SequenceMatcher(None, a, b).ratio() and similarity.ratio(a, a) == 1.0 and similarity.ratio("", "") == 1.0
    long = a * 300
    assert 0 < similarity.ratio(long, long[:70_000] + "!" + long[70_001:]) <= 1
    assert similarity.difference("xxabc", "xxadc") == {"left": "xxabc", "right": "xxadc"}
    assert similarity.difference("a" * 30_000, "b" * 30_000) == {"left": "a" * 30_000, "right": "b" * 30_000}


def test_article_headers(spark):
    lines = ["before", "Artículo nuevo", "x", "ARTÍCULO 5o.El", "ARTICULO 2.3.2.1 y", "artículo 7.", "ARTÍCULO 1°", "ARTÍCULO NUEVO", "Articulo 5."]
    rows = spark.createDataFrame([("d", i, x) for i, x in enumerate(lines)], "d string, line_no bigint, line string")
    assert [(r.key, r.copy_no) for r in K.segments(rows, "d").orderBy("key", "copy_no").collect()] == [("2.3.2.1", 0), ("5", 0), ("5", 1), ("nuevo", 0)]
    assert ("1", 0) in [(r.key, r.copy_no) for r in K.segments(rows, "d", ordinals=True).collect()]


def test_html():
    page = "<head><title>no</title></head><p>a&amp;b <b>c</b><br/>d <a href='u'> l </a></p><script>x</script><ul><li>1<li>2</ul><img src=s alt=t>"
    assert H.page_text(page) == "a&b **c**\nd [l](u)\n\n1\n2\n![t](s)"


def test_citations(spark):
    docs = spark.createDataFrame([("a.md", "uno\nDos  tres\ncuatro")], "filename string, text string")
    claims = spark.createDataFrame([(1, "a.md#L2", "dos tres"), (2, "a.md#L1-L2", "UNO dos"), (3, "a.md#L9", "x"), (4, "b.md#L1", "x"), (5, "a.md#L3", "cinco"), (6, "a.md", "x"), (7, "a.md#L2-L1", "x"), (8, None, None), (9, "a.md#L99999999999999999999", "x")], "id int, cita string, verbatim string")
    got = {r.id: r.outcome for r in G.check_citations(claims, docs).collect()}
    assert got == {1: "ok", 2: "ok", 3: "bad_range", 4: "no_such_file", 5: "not_found", 6: "malformed", 7: "bad_range", 8: "malformed", 9: "bad_range"}
    assert {r.id: r.outcome for r in G.check_citations(claims, docs, strict=True).collect()}[1] == "not_found"
    assert [tuple(r)[:3] for r in G.check_absent(docs, "text", ["dos", "zzz", "("]).orderBy("pattern").collect()] == [("(", None, False), ("dos", 1, False), ("zzz", 0, True)]


def test_gate_stops(spark):
    ran = []
    checks = {n: (lambda n=n: (ran.append(n), spark.range(n == "b"))[1]) for n in "abc"}
    rows = gate.run(spark, checks, order=("a", "b", "c")).collect()
    assert [(r.stage, r.outcome) for r in rows] == [("a", "pass"), ("b", "fail"), ("c", "not_run")] and ran == ["a", "b"]
    with pytest.raises(ValueError):
        gate.run(spark, checks, only=("d",))


def test_unique_replace_is_guarded(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a a"), (3, "x")], "k int, text string")
    errata = spark.createDataFrame([(i, "a", "Z") for i in (1, 2, 3)], "k int, buscar string, reemplazar string")
    assert {r.k: (r.state, r.text) for r in E.unique_replace(docs, errata, "k").collect()} == {1: ("aplicada", "Z b c"), 2: ("ambigua", "a a"), 3: ("no_encontrada", "x")}


def test_taxonomy_rules_one_by_one(spark):
    schema = "id string, categoria string, nombre string, descripcion string, fase_lectura int, estado string, origen string, tipo_campo string, requiere_ref_articulo boolean, dependencias array<string>, glosario_terminos array<string>"
    good = ("A.1", "A", "n", "d", 0, "validado", "base", "texto", False, [], [])
    change = lambda **k: tuple(k.get(n.split()[0], v) for n, v in zip(schema.split(", "), good))
    rows = [good, change(id="A.2", categoria="Q"), change(id="A.3", fase_lectura=10), change(id="A.4", estado="?"), change(id="A.5", origen="?"), change(id="A.6", tipo_campo="?"), change(id="a7"), change(id="A.8", nombre=" "), change(id="A.9", descripcion=""), change(id="A.10", dependencias=["B.1"]), change(id="A.1a", fase_lectura=1), change(id="A.11"), change(id="A.11"), change(id=None)]
    got = {(r.code, r.id) for r in X.rules(spark.createDataFrame(rows, schema)).collect()}
    assert got == {("E004", "A.2"), ("E005", "A.3"), ("E006", "A.4"), ("E007", "A.5"), ("E008", "A.6"), ("E009", "a7"), ("E010", "A.8"), ("W001", "A.9"), ("E003", "A.10"), ("E013", "A.1a"), ("E001", "A.11"), ("E002", None)}


def test_canonical_fingerprint():
    assert canonical.fingerprint('{"b": 1, "a": "é"}') == hashlib.sha256('{"a": "é", "b": 1}'.encode()).hexdigest()
    assert canonical.fingerprint('{"a":1}', 16) == canonical.fingerprint('{ "a" : 1 }')[:16]


def test_json_sources_report_problems(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"a": 1, "b": "x"}')
    (tmp_path / "bad.json").write_text('{"a": ')
    read = lambda n: [tuple(r) for r in corpus.read_json(spark, str(tmp_path / n), "a int, b string").collect()]
    assert read("good.json") == [(1, "x", None)]
    assert read("bad.json") == [(None, None, "invalid")]
    assert read("none.json") == [(None, None, "missing")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("t", 1)], "tarea string, entrega int")
    for _ in range(2):
        corpus.append_log(rows, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    corpus.write_state({"x": "é"}, str(tmp_path / "state.json"))
    assert "é" in (tmp_path / "state.json").read_text(encoding="utf-8")


def test_index_is_built_from_sealed_documents_only(spark, tmp_path):
    from folioscope.operators import index

    docs = spark.createDataFrame([("a.md", "# One\nley basica\n## Two\nmas"), ("b.md", "ley"), ("c.md", "")], "filename string, text string")
    seal = M.manifest(docs, "filename")
    index.build(docs, seal, str(tmp_path / "i"), "2026-01-01")
    posted = spark.read.parquet(str(tmp_path / "i/postings"))
    assert {(r.filename, r.chunk_no) for r in posted.where("token = 'ley' AND field = 'text'").collect()} == {("a.md", 0), ("b.md", 0)}
    with pytest.raises(RuntimeError):
        index.build(docs.withColumn("text", F.concat("text", F.lit("!"))), seal, str(tmp_path / "j"), "2026-01-01")
    assert not (tmp_path / "j").exists()


def test_generation_and_certificate(spark):
    from folioscope.operators import director as D

    schema = "id string, categoria string, nombre string, descripcion string, fase_lectura int, estado string, origen string, tipo_campo string, requiere_ref_articulo boolean, dependencias array<string>, glosario_terminos array<string>"
    rows = [("A.10", "A", "n", "d", 0, "validado", "base", "fecha", True, ["A.30"], ["plazo"]), ("A.30", "A", "m", "d", 1, "validado", "base", "texto", False, [], [])]
    found = X.generate(spark.createDataFrame(rows, schema))
    assert {r.term: r.refs for r in found["glossary"].collect()} == {"plazo": "A.10", "vacatio legis": "A.10", "erga omnes": "A.30", "inter partes": "A.30"}
    assert found["ddl"].first().statement == "CREATE TABLE valores_cat_a (id_ficha TEXT PRIMARY KEY, a_10 DATE, a_30 TEXT);"
    with pytest.raises(RuntimeError):
        X.generate(spark.createDataFrame([rows[0]], schema))
    with pytest.raises(ValueError):
        X.generate(spark.createDataFrame(rows, schema), ("maps",))
    none = spark.createDataFrame([], "code string")
    scores = spark.createDataFrame([(9, 16, 25)], "mechanical bigint, human bigint, total bigint")
    opened = gate.run(spark, {"a": lambda: none}, order=("a",))
    fields = spark.createDataFrame([("T1", "A.1", "v"), ("T1", "A.2", None)], "task string, campo string, valor string")
    a, b = (D.certificate(none, scores, opened, f, "2026-01-01") for f in (fields, fields.orderBy("campo", ascending=False)))
    assert a == b and a["gold"]["total"] == 25 and len(a["fingerprint"]) == 64
    with pytest.raises(RuntimeError):
        D.certificate(spark.createDataFrame([("E1",)], "code string"), scores, opened, fields, "2026-01-01")
    spots = spark.createDataFrame([("a", 1)], "anchor string, line_no bigint")
    D.start(none, spots, ["a"])
    with pytest.raises(RuntimeError):
        D.start(none, spots, ["a", "b"])


def test_overlap_by_blocks(spark):
    import random

    rng = random.Random(2)
    lines = [(f"f{rng.randrange(3)}", rng.choice((rng.randrange(1, 40), rng.randrange(1, 5000), rng.randrange(1, 10**7)))) for _ in range(600)]
    spans = [(f"f{rng.randrange(4)}", i, *sorted((rng.choice((1, rng.randrange(1, 300), rng.randrange(1, 10**7))), rng.randrange(1, 6000)))) for i in range(150)] + [("f0", 900, 5, 4), ("f0", 901, 7, 7)]
    got = {(r.filename, r.span_id): r.n_lines for r in E.overlap(spark.createDataFrame(lines, "filename string, line_no int"), spark.createDataFrame(spans, "filename string, span_id long, l1 long, l2 long"), "filename").collect()}
    want = {(f, i): n for f, i, a, b in spans if (n := len({x for g, x in lines if g == f and a <= x <= b}))}
    assert got == want
