"""Bad patterns and JSON, many claims on one file, whole documents, and the small operators."""

import hashlib
import json

import pytest

from folioscope.functions import canonical, html
from folioscope.operators import compare as K
from folioscope.operators import documents as O
from folioscope.operators import errata as E
from folioscope.operators import gate
from folioscope.operators import gold as G
from folioscope.operators import manifest as M
from folioscope.operators import search as S
from folioscope.sources import corpus


def test_bad_patterns_are_rows_not_crashes(spark):
    docs = spark.createDataFrame([("a.md", "uno\ndos\nuno"), ("b.md", "")], "filename string, text string")
    cases = spark.createDataFrame([(1, "a.md", "2", "uno"), (2, "a.md", "0", "("), (3, "lost.md", "0", "x"), (4, "a.md", "0", None), (5, "a.md", "0", "(?P<n>x)"), (6, "b.md", "0", r"\p{L}")], "id int, norma string, valor string, patron string")
    assert sorted((r.id, r.n_found, r.ok) for r in G.check_counts(cases, docs).collect()) == [(1, 2, True), (2, None, False), (3, None, False), (4, None, False), (5, None, False), (6, 0, True)]
    assert sorted(tuple(r) for r in G.count_problems(cases, docs).collect()) == [(2, "invalid_pattern"), (3, "no_such_file"), (4, "invalid_pattern"), (5, "invalid_pattern")]
    assert {r.id: r.ok for r in G.check_absent_in_files(cases, docs).collect()} == {1: False, 2: False, 3: False, 4: False, 5: False, 6: True}
    got = {r.pattern: (r.n, r.ok, r.problem) for r in G.check_absent(corpus.lines(docs, "filename"), "line", ["uno", "x", "("]).collect()}
    assert got == {"uno": (2, False, None), "x": (0, True, None), "(": (None, False, "invalid_pattern")}
    assert G.check_absent(corpus.lines(docs, "filename"), "line", ["["]).count() == 1
    assert [tuple(r) for r in G.pattern_examples(corpus.lines(docs, "filename"), "filename", "line", "uno", 1).collect()] == [("a.md", 1)]


def test_citations_share_lines(spark):
    docs = spark.createDataFrame([("a.md", "uno\ndos\ntres"), ("b.md", "otro")], "filename string, text string")
    claims = spark.createDataFrame([(1, "a.md#L1-L2", "uno dos"), (2, "a.md#L1-L2", "UNO"), (2, "a.md#L1-L2", "UNO"), (3, "a.md#L2-L9999999999", "x"), (4, "c.md#L1", "x"), (5, "a.md", "x"), (6, "b.md#L1", None)], "id int, cita string, verbatim string")
    got = sorted(tuple(r) for r in G.check_citations(claims, docs).collect())
    assert got == [(1, "ok"), (2, "ok"), (2, "ok"), (3, "bad_range"), (4, "no_such_file"), (5, "malformed"), (6, "ok")]


def test_invalid_json_is_told(spark):
    rows = spark.createDataFrame([(1, '{"b": 1, "a": "é"}'), (2, "{"), (3, None)], "i int, d string").withColumn("f", canonical.json_fingerprint("d"))
    got = {r.i: (r.f, r.p) for r in rows.select("i", "f", canonical.json_problem(rows.d, rows.f).alias("p")).collect()}
    assert got == {1: (hashlib.sha256('{"a": "é", "b": 1}'.encode()).hexdigest(), None), 2: (None, "invalid"), 3: (None, "missing")}


def test_copies_and_states(spark):
    arts = spark.createDataFrame([(1, "1", 0, "uno"), (1, "1", 1, "uno"), (1, "2", 0, "dos"), (1, "3", 0, "tres")], "doc int, key string, copy_no long, text string")
    source = spark.createDataFrame([(1, "1", 0, "unos"), (1, "1", 1, "unos"), (1, "2", 0, "dos")], "doc int, key string, copy_no long, text string")
    got = sorted((r.key, r.state, r.ratio, r.compared) for r in K.compare(arts, source, "doc").collect())
    assert got == [("1", "divergente", round(6 / 7, 4), 1), ("2", "exacto", 1.0, 0), ("3", "ausente_en_fuente", None, 0)]
    assert [r.shown for r in K.keyword(arts, "doc", "2.", "dos").collect()] == ["dos"]


def test_many_claims_and_cases_on_one_file(spark):
    text = "\n".join(f"linea {i} x{i % 7}" for i in range(3000))
    docs = spark.createDataFrame([("a.md", text), ("b.md", "otra")], "filename string, text string")
    claims = spark.range(2500).selectExpr("id", "concat('a.md#L', id + 1, '-L', id + 2) AS cita", "concat('LINEA ', id + 1) AS verbatim")
    assert {r.outcome: r.n for r in G.check_citations(claims, docs).groupBy("outcome").agg({"id": "count"}).toDF("outcome", "n").collect()} == {"ok": 2500}
    cases = spark.range(2100).selectExpr("id", "'a.md' AS norma", "'1' AS valor", "concat('^linea ', id, ' ') AS patron")
    assert G.check_counts(cases, docs).where("ok AND n_found = 1").count() == 2100


def test_offsets_of_articles(spark):
    text = "before\n\n  Artículo 1o. Uno\nmore\n\nARTÍCULO nuevo. x\nartículo 3. no header\nArtículo 2.1A: y"
    got = [(r.key, text[r.start : r.end]) for r in K.offsets(spark.createDataFrame([("d", text), ("e", None), ("f", "")], "d string, text string"), "d").orderBy("start").collect()]
    assert got == [("1", "  Artículo 1o. Uno\nmore\n\n"), ("nuevo", "ARTÍCULO nuevo. x\nartículo 3. no header\n"), ("2.1a", "Artículo 2.1A: y")]


def test_structure_profile_of_eight_patterns(spark):
    text = "### TÍTULO I\n#### CAPÍTULO I\n**Artículo 1. Uno.\n**Artículo 2.\nParágrafo. x\n**Artículo nuevo\n(Derogado)\nSuprime el\nDisposición final y disposiciones  transitoria\n### Titulo II"
    row = G.structure_profile(spark.createDataFrame([("a", text)], "d string, text string"), "d").first().asDict()
    assert row == {"d": "a", "articulos_numerados": 2, "titulos": 2, "capitulos": 1, "menciones_paragrafo": 1, "articulos_nuevo": 1, "anotaciones_derogada": 1, "anotaciones_suprime": 1, "disposiciones": 1}


@pytest.fixture
def elements(spark):
    rows = [(1, "B.2", "B", "Beta", "two\nlines", 1, "usuario", True), (2, "A.10", "A", "Ten", "d", 0, "base", False), (3, "A.2", "A", "Two", "e", 1, "base", True)]
    return spark.createDataFrame(rows, "orden int, id string, categoria string, nombre string, descripcion string, fase_lectura int, origen string, requiere_ref_articulo boolean")


def test_category_documents(spark, elements):
    lines = [r.line for r in O.category_documents(elements, "1.2", "2026-01-01").where("categoria = 'B'").orderBy("section", "at").collect()]
    assert lines[:3] == ["# CATEGORIA B — ESTRUCTURA FORMAL INTERNA", "# NP-CAT-B  v1.2  2026-01-01", f"{'B.2':<5} {'Beta':<37} two lines [USUARIO]"]
    source = [{"id": "B.2", "categoria": "B", "nombre": "Beta", "descripcion": "two\nlines", "fase_lectura": 1, "origen": "usuario", "requiere_ref_articulo": True}]
    own = hashlib.sha256(json.dumps(source, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]
    assert lines[3:] == ["| Categoria      | B |", "| Elementos      | 1 |", "| Fase principal | 1 |", "| Origenes       | usuario |", f"| Hash fuente    | {own} |"]
    # In the source's order, not the ids'.
    assert [r.line[:5] for r in O.category_documents(elements, "1", "d").where("categoria = 'A' AND section = 1").orderBy("at").collect()] == ["A.10 ", "A.2  "]


def test_form_document(spark, elements):
    lines = [r.line for r in O.form_document(elements, "1", "d").orderBy("fase", "categoria", "at", "part").collect()]
    assert lines[:4] == ["# NP-FICHA  v1  d", "**Total de campos:** 3", "**Categorias:** 2 (A, B)", "**Fases:** 2 (0, 1)"]
    assert lines[4:12] == ["FASE 0 — PREPARACION", "### Categoria A (1 elementos)", "- [ ] **A.10** — Ten", "  - VALOR: _______________", "  - REF. ARTICULO: _______________", "  - NOTAS: _______________", "**Decision Fase 0:** [ ] CONTINUAR  [ ] PAUSAR  [ ] ABANDONAR", "**Firma:** _______________  **Fecha:** _______________"]
    assert "  - REF. ARTICULO: _______________ (obligatorio)" in lines and lines[-1] == "**PUNTUACION TOTAL: _____ / 50**"


def test_whole_schema(elements):
    schema = O.whole_schema(elements, "1")
    assert schema["required"] == ["meta", "fases", "evidencia"] and schema["properties"]["evidencia"]["minItems"] == 1
    assert set(schema["properties"]["meta"]["properties"]) == set(O.META)
    phases = schema["properties"]["fases"]["properties"]
    assert set(phases) == set(map(str, range(10))) and set(phases["1"]["properties"]) == {"A.2", "B.2"}
    assert phases["1"]["properties"]["A.2"]["properties"]["ref_articulo"] == {"type": "string", "minLength": 1} and "notas" in phases["0"]["properties"]["A.10"]["properties"]


def test_small_operators(spark, tmp_path):
    log = spark.createDataFrame([("b", 1), ("a", 1), ("a", 2), ("c", 1)], "f string, n int")
    assert [tuple(r) for r in E.repair_summary(log, "f").collect()] == [("a", 2), ("b", 1), ("c", 1)]
    docs = spark.createDataFrame([("a.md", "uno"), ("é.md", "dos")], "filename string, text string")
    folder = E.write_version(docs, str(tmp_path), "2", "filename")
    assert spark.read.parquet(folder).count() == 2
    with pytest.raises(Exception, match="(?i)exist"):
        E.write_version(docs, str(tmp_path), "2", "filename")
    assert [r[0] for r in spark.createDataFrame([(0,), (21659754,)], "n long").select(O.thousands("n")).collect()] == ["0", "21,659,754"]
    own = M.manifest(docs, "filename")
    corpus.write_manifest_document(own, str(tmp_path / "m.json"), "now", "*.md")
    assert M.integrity_diff(own, corpus.read_manifest(spark, str(tmp_path / "m.json"))).isEmpty()
    rows = gate.run(spark, {"one": lambda: docs.limit(0), "two": lambda: docs, "three": lambda: docs}, order=("one", "two", "three"))
    assert gate.report(rows) == (["[one] pass", "[two] fail (2 violations)", "[three] not_run", "closed at two"], 1)
    assert gate.report(gate.run(spark, {"one": lambda: docs.limit(0)}, order=("one",)))[1] == 0
    assert gate.examples(docs, 1) == [{"filename": "a.md", "text": "uno"}]
    raw = spark.createDataFrame([(bytearray("<p>niño".encode("latin-1")),), (None,)], "b binary").select(html.html_text(html.page_of_bytes("b")).alias("t")).collect()
    assert sorted(r.t or "" for r in raw) == ["", "niño"]


def test_scans_take_any_character_of_a_term(spark):
    docs = spark.createDataFrame([(1, "Uno a_b \\E dos"), (2, "uno,dos"), (3, "ÚNO")], "d int, text string")
    terms = spark.createDataFrame([("uno",), ("a_b",), ("\\E",), ("niño",)], "term string")
    assert sorted(tuple(r) for r in S.raw_scan(docs, terms, "d").collect()) == [("a_b", 1), ("uno", 1), ("uno", 2)]
    assert sorted(tuple(r) for r in S.term_scan(docs, terms, "d").collect()) == [("a_b", 1), ("uno", 1), ("uno", 2), ("uno", 3)]
    queries = spark.createDataFrame([(1, "uno"), (1, "dos"), (2, "ñu")], "q int, token string")
    hits = spark.createDataFrame([(1, 1), (1, 2), (1, 9), (2, 1)], "q int, d int")
    scanned = spark.createDataFrame([("uno", 1), ("dos", 1), ("uno", 2), ("dos", 2), ("uno", 4), ("dos", 4)], "term string, d int")
    got = S.differential(queries, hits, hits.where("d < 9"), scanned, "d", least=2).first()
    assert tuple(got) == (2, 1, 1, 0, 1, False)
    good = S.differential(queries, hits.where("d < 9"), hits.where("d < 9"), scanned, "d", least=2).first()
    assert tuple(good) == (2, 2, 1, 1, 1, True)


def test_bucket_hash_tells_any_change(spark):
    rows = [(f"f{i}.md", hashlib.sha256(b"%d" % i).hexdigest(), i) for i in range(500)]
    seal = lambda r, n=4: M.bucket_hash(spark.createDataFrame(r, "filename string, sha256 string, bytes bigint").repartition(n)).first()
    own = seal(rows)
    assert (own.file_count, own.total_bytes) == (500, sum(range(500))) and seal(rows[::-1], 7) == own
    assert seal(rows[1:]).bucket_hash != own.bucket_hash != seal([("g.md", *rows[0][1:]), *rows[1:]]).bucket_hash
    assert seal([]).file_count == 0


def test_reports_are_written_by_document(spark, tmp_path):
    a = spark.createDataFrame([(1, "1", 0, "uno"), (1, "2", 0, "dos"), (1, "3", 0, "tres cuatro"), (2, "1", 0, "x")], "doc int, key string, copy_no long, text string")
    b = spark.createDataFrame([(1, "1", 0, "Uno"), (1, "3", 0, "tres cuatra"), (1, "9", 0, "z"), (2, "1", 0, "x"), (3, "1", 0, "solo")], "doc int, key string, copy_no long, text string")
    rows = K.reports(K.compare(a, b, "doc"), a, b, "doc")
    corpus.write_reports(rows, str(tmp_path / "informes"), "doc")
    found = {int(p.parent.name.split("=")[1]): json.loads(p.read_text()) for p in (tmp_path / "informes").glob("documento=*/*.txt")}
    assert {k: v["veredicto"] for k, v in found.items()} == {1: "NO_VERIFICADA", 2: "VERIFICADA", 3: "SIN_ARTICULOS"}
    one = found[1]
    assert one["resumen"] == {"exactos": 1, "casi": 0, "divergentes": 2} and one["sin_contraparte"] == ["9"]
    assert [(r["articulo"], r["estado"]) for r in one["resultados"]] == [("1", "exacto"), ("2", "ausente_en_fuente"), ("3", "divergente")]
    assert one["resultados"][2]["corpus"] == "tres cuatro" and one["resultados"][1]["similitud"] is None
    assert found[3]["resultados"] == [] and found[3]["sin_contraparte"] == ["1"]


def test_whole_pages_and_model(spark, elements):
    from folioscope.operators import taxonomy as X

    page = [r.line for r in O.category_pages_whole(elements, "1.0", "2024-01-01", "part").where("categoria = 'A'").orderBy("block", "at").collect()]
    assert page[0].startswith("# CATEGORIA A") and page[7] == "[Auto-generado desde part — 2 elementos]"
    at = page.index("----- ------------------------------------- -----------------------------------")
    assert page[at + 1].startswith("A.10  Ten") and page[at + 2].startswith("A.2   Two") and page[-1] == "" and page[-2].startswith("| Hash fuente")
    lines = [r.line for r in X.model_lines(elements, "1.0", "2024-01-01", "abc", "norms", "part").orderBy("part", "name", "at").collect()]
    assert lines[:5] == ["-- MODELO RELACIONAL — norms", "-- Version: 1.0", "-- Hash fuente: abc", "-- Generado: 2024-01-01", "-- Fuente: part"]
    assert lines.index("-- TABLAS PRINCIPALES") < lines.index("CREATE TABLE IF NOT EXISTS normas (") < lines.index("-- INDICES") < lines.index("-- DATOS DE CATEGORIAS (maestra)")
    assert [x for x in lines if not x.startswith("--") and x] == [x for r in X.relational_model(elements).orderBy("part", "name").collect() for x in r.statement.split("\n")]
    end = lines.index(");")
    assert lines[end + 1] == "" and lines[-1] == ""
