"""Queries cover every document; rules and inputs that a subset never meets."""

import pytest
from pyspark.sql import functions as F

from folioscope.operators import director as D
from folioscope.operators import records as R
from folioscope.operators import search as S
from folioscope.operators import taxonomy as X
from folioscope.plans import catalogue
from folioscope.plans.registry import docs


def files(spark, sf):
    return {r.filename for r in docs(spark, sf).select("filename").collect()}


def test_cleaning_covers_every_document(spark, sf):
    seen = catalogue.QUERIES["clean_markdown"](spark, sf).select("filename").distinct().collect()
    assert {r.filename for r in seen} == files(spark, sf)


def test_records_cover_every_document(spark, sf):
    assert catalogue.QUERIES["evidence_coverage"](spark, sf).count() == docs(spark, sf).count()


def test_a_record_without_evidence_breaks_a_rule(spark):
    meta = spark.createDataFrame([(1, "a"), (2, "b")], "record long, record_id string")
    evidence = spark.createDataFrame([(1, "A.1")], "record long, campo string")
    assert [tuple(r) for r in R.presence_rules(meta, evidence).collect()] == [(2, "V3:empty_evidence", "b")]


@pytest.mark.parametrize("name", ["gold_citation", "gold_citation_strict", "gold_count", "gold_absent_file"])
def test_gold_cases_cover_every_document(spark, sf, name):
    ids = {r.id for r in catalogue.QUERIES[name](spark, sf).select("id").collect()}
    assert ids == {r.doc_id for r in docs(spark, sf).select("doc_id").collect()}


def test_decoding_keeps_texts_beyond_latin_1(spark, tmp_path):
    texts = ["plain", "se\u00f1or", "\u201cquoted\u201d", "10 \u20ac", "a", "se\u00f1al"]
    spark.createDataFrame([(5 * i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = catalogue.QUERIES["decode_lossless"](spark, str(tmp_path)).orderBy("filename").collect()
    assert [r.encoding for r in rows] == ["utf-8", "latin-1", "utf-8", "utf-8", "utf-8", "latin-1"]
    assert all(r.reversible for r in rows)


def test_repairs_and_deliveries_reach_documents_of_every_id(spark, sf):
    glued = catalogue.QUERIES["glued_words"](spark, sf).select(F.regexp_extract("filename", r"(\d+)\.md", 1).cast("long").alias("i"))
    assert {r.m for r in glued.select((F.col("i") % 3).alias("m")).distinct().collect()} == {0, 1, 2}
    delivered = catalogue.QUERIES["fragment_delivery"](spark, sf)
    assert delivered.select((F.regexp_extract("filename", r"(\d+)\.md", 1).cast("long") % 4).alias("m")).distinct().count() == 4


def test_one_bad_entry_rejects_its_batch_and_ties_go_by_sequence(spark):
    fields = spark.createDataFrame([(1, "A.1", "old"), (1, "A.2", "old")], "task int, campo string, valor string")
    rows = [(0, 0, "A.1", "first"), (1, 0, "A.1", "second"), (2, 1, "A.1", "lost"), (3, 1, "A.2", " ")]
    c = spark.createDataFrame([(s, b, 1, f, v, "f.md#L1", True) for s, b, f, v in reversed(rows)], "seq int, batch int, task int, campo string, valor string, cita string, ref_ok boolean")
    got = {r.campo: r.valor for r in D.apply_corrections(fields, c, seq="seq").collect()}
    assert got == {"A.1": "second", "A.2": "old"}


def test_model_has_every_statement_of_the_reference(spark):
    elements = spark.createDataFrame([("A.10", "A"), ("A.2", "A"), ("B.1", "B")], "id string, categoria string")
    rows = X.relational_model(elements).orderBy("part", "name").collect()
    assert [(r.part, r.name) for r in rows] == [(0, "normas"), (1, "fichas"), (2, "A"), (2, "B")] + [(3, str(i)) for i in range(5)] + [(4, "categorias"), (5, "A"), (5, "B")]
    five = lambda i: f"    {i}_completado BOOLEAN DEFAULT FALSE,\n    {i}_na BOOLEAN DEFAULT FALSE,\n    {i}_valor TEXT,\n    {i}_ref_articulo VARCHAR(100),\n    {i}_notas TEXT,\n"
    head = "CREATE TABLE IF NOT EXISTS valores_cat_A (\n    id SERIAL PRIMARY KEY,\n    ficha_id INTEGER REFERENCES fichas(id) ON DELETE CASCADE,\n"
    assert rows[2].statement == head + five("A_2") + five("A_10") + "    UNIQUE(ficha_id)\n);"
    assert rows[5].statement == "CREATE INDEX idx_normas_autoridad ON normas(autoridad_emisora);"
    assert rows[10].statement == "INSERT INTO categorias (codigo, nombre, total_elementos) VALUES ('A', 'METADATOS DE IDENTIFICACION', 2) ON CONFLICT (codigo) DO UPDATE SET total_elementos = EXCLUDED.total_elementos;"


def test_a_hit_that_the_raw_text_lacks_is_found(spark):
    queries = spark.createDataFrame([(1, "a"), (1, "b")], "q int, token string")
    hits = spark.createDataFrame([(1, 10), (1, 11)], "q int, doc int")
    scanned = spark.createDataFrame([("a", 10), ("b", 10), ("a", 11)], "term string, doc int")
    assert [tuple(r) for r in S.outside_scan(hits, scanned, queries, "doc").collect()] == [(1, 11)]
